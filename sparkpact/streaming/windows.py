"""Sums per window of event time, kept over the batches of a stream.

Below one folder lie, for each batch that left something:

- ``state/batch_id=n``: the windows still open after the batch, one line per window and group with what was counted so
  far, and the latest time seen;
- ``log/level=0/batch_id=n``: the windows the batch closed, and apart from them what came behind the mark.

The mark of a batch is the latest time seen before it less the delay, as in ``withWatermark``: a window that ends at or
before it is closed, and rows that still come for it are behind. Aggregates of the state store drop such rows without
telling which; here they are counted, in lines of their own, so nothing is lost and what was reported once does not change.
Only lines per window and group are kept and moved, never rows. A batch reads the state before it and writes its own, so a
replay after a failure writes the same again. Two states are kept. ``MERGED`` folders of a level of the log are put
together into one of the next, so their number grows with the logarithm of the batches alone; a folder that is covered
by one of a higher level does not count, whether it was deleted yet or not.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

MERGED = 16
# The time seen when windows were closed by hand: everything after it is behind.
_END = "9999-12-31 00:00:00"


@dataclass(frozen=True)
class Sums:
    """How lines of one window and group are put together: ``keys`` beside the window, and what becomes of each value."""

    keys: tuple[str, ...]
    values: dict[str, Callable[[str], Column]]

    def merged(self, lines: DataFrame, *more: str) -> DataFrame:
        keys = ["window_start", "window_end", *self.keys, *more]
        return lines.groupBy(*keys).agg(*[merge(name).alias(name) for name, merge in self.values.items()])


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _numbers(spark: SparkSession, path: str, key: str) -> list[int]:
    """The numbers of the complete folders ``key=n`` below ``path``."""
    fs, at = _fs(spark, path)
    if not fs.exists(at):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(at)]
    done = lambda name: key == "level" or fs.exists(_fs(spark, f"{path}/{name}/_SUCCESS")[1])
    return sorted(int(name.split("=")[1]) for name in names if name.startswith(f"{key}=") and done(name))


def _delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def _log_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders of the log that count: those not covered by one of a higher level."""
    out, covered = [], -1
    for level in reversed(_numbers(spark, f"{path}/log", "level")):
        numbers = _numbers(spark, f"{path}/log/level={level}", "batch_id")
        out += [f"{path}/log/level={level}/batch_id={n}" for n in numbers if n > covered]
        covered = max([covered, *numbers])
    return out


def _merge_log(spark: SparkSession, path: str, batch_id: int, sums: Sums) -> None:
    """Put the last ``MERGED`` folders together at every level that is full after this batch."""
    level, span = 0, MERGED
    while (batch_id + 1) % span == 0:
        at, to = f"{path}/log/level={level}", f"{path}/log/level={level + 1}/batch_id={batch_id}"
        numbers = [n for n in _numbers(spark, at, "batch_id") if batch_id - span < n <= batch_id]
        if batch_id not in _numbers(spark, f"{path}/log/level={level + 1}", "batch_id"):
            lines = _union(spark.read.parquet(f"{at}/batch_id={n}") for n in numbers)
            sums.merged(lines, "behind").coalesce(1).write.mode("overwrite").parquet(to)
        for n in numbers:
            _delete(spark, f"{at}/batch_id={n}")
        level, span = level + 1, span * MERGED


def _union(tables) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def take_batch(share: DataFrame, batch_id: int, path: str, sums: Sums, delay: str) -> None:
    """Add one batch's lines (``window_start, window_end, keys…, values…, last``) to the state and the log.

    ``last`` is the latest time of the rows behind a line. Lines without a window (rows without a time) are logged as they
    come: no mark applies to them.
    """
    spark = share.sparkSession
    share = share.persist()
    try:
        known = [n for n in _numbers(spark, f"{path}/state", "batch_id") if n < batch_id]
        state = spark.read.parquet(f"{path}/state/batch_id={known[-1]}") if known else None
        seen = state.agg(F.max("last")).first()[0] if state is not None else None
        newest = share.agg(F.max("last")).first()[0]
        latest = max((t for t in (seen, newest) if t is not None), default=None)
        mark = lambda time: F.lit(time).cast("timestamp") - F.expr(f"INTERVAL {delay}") if time is not None else F.lit(None).cast("timestamp")

        timed = share.where(F.col("window_start").isNotNull())
        behind = F.coalesce(F.col("window_end") <= mark(seen), F.lit(False))
        lines = timed.where(~behind).drop("last")
        if state is not None:
            lines = lines.unionByName(state.where(F.col("window_start").isNotNull()).drop("last"))
        merged = sums.merged(lines).withColumn("closed", F.coalesce(F.col("window_end") <= mark(latest), F.lit(False))).persist()
        try:
            logged = _union([
                merged.where("closed").drop("closed").withColumn("behind", F.lit(False)),
                timed.where(behind).drop("last").withColumn("behind", F.lit(True)),
                share.where(F.col("window_start").isNull()).drop("last").withColumn("behind", F.lit(False)),
            ])
            logged.coalesce(1).write.mode("overwrite").parquet(f"{path}/log/level=0/batch_id={batch_id}")
            _write_state(merged.where("not closed").drop("closed"), latest, f"{path}/state/batch_id={batch_id}")
        finally:
            merged.unpersist()
    finally:
        share.unpersist()
    for n in known[:-1]:
        _delete(spark, f"{path}/state/batch_id={n}")
    _merge_log(spark, path, batch_id, sums)


def _write_state(windows: DataFrame, latest, to: str) -> None:
    """Open windows, and in a line without window the latest time seen."""
    spark, time = windows.sparkSession, F.lit(latest).cast("timestamp")
    seen = spark.range(1).select(time.alias("last"))
    windows.withColumn("last", time).unionByName(seen, allowMissingColumns=True).coalesce(1).write.mode("overwrite").parquet(to)


def stream_windows(rows: DataFrame, share: Callable[[DataFrame], DataFrame], sums: Sums, path: str, checkpoint: str, delay: str, **trigger) -> StreamingQuery:
    """Keep the sums of a stream's windows below ``path``; without a trigger it processes what there is and ends."""

    def write(batch: DataFrame, batch_id: int) -> None:
        take_batch(share(batch), batch_id, path, sums, delay)

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def close_windows(spark: SparkSession, path: str) -> None:
    """The closing step of a stream that has ended: all open windows are closed, what still comes is behind.

    Run it while no query writes below ``path``. Run again after a failure it does the same.
    """
    last = max(_numbers(spark, f"{path}/state", "batch_id"), default=None)
    if last is None:
        return
    state = spark.read.parquet(f"{path}/state/batch_id={last}")
    if str(state.agg(F.max("last")).first()[0]) == _END:
        return
    windows = state.where(F.col("window_start").isNotNull()).drop("last")
    windows.withColumn("behind", F.lit(False)).coalesce(1).write.mode("overwrite").parquet(f"{path}/closing/batch_id={last}")
    # Read back from there: the state is replaced.
    schema = windows.schema
    _write_state(spark.createDataFrame([], schema), _END, f"{path}/state/batch_id={last}")


def read_windows(spark: SparkSession, path: str, sums: Sums) -> DataFrame:
    """All lines: ``window_start, window_end, keys…, values…, behind, closed``; open windows as they stand."""
    states = _numbers(spark, f"{path}/state", "batch_id")
    parts = [spark.read.parquet(folder).withColumn("closed", F.lit(True)) for folder in _log_folders(spark, path)]
    if states:
        state = spark.read.parquet(f"{path}/state/batch_id={states[-1]}")
        is_closed = str(state.agg(F.max("last")).first()[0]) == _END
        # A closing whose state was not replaced yet does not count.
        closings = [n for n in _numbers(spark, f"{path}/closing", "batch_id") if n < states[-1] or is_closed]
        parts += [spark.read.parquet(f"{path}/closing/batch_id={n}").withColumn("closed", F.lit(True)) for n in closings]
        parts.append(state.where(F.col("window_start").isNotNull()).drop("last").withColumns({"behind": F.lit(False), "closed": F.lit(False)}))
    return sums.merged(_union(parts), "behind", "closed")
