"""Contracts enforced on streams of rows: split, violation counts, latency.

Windows are kept by ``streaming/windows``: open ones as state, closed ones in a log, and what comes behind the mark
counted apart. A reader sees every window and every row: those on time, those behind, and rows without a time in lines
whose window is NULL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparkpact.model import Contract
from sparkpact.operators.enforce import rule_counters, rule_lines, rules, write_split
from sparkpact.operators.sla import latency_ms
from sparkpact.streaming.windows import Sums, read_windows, stream_windows


def stream_split(rows: DataFrame, contract: Contract, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Valid and rejected rows below ``path/rows``, and how often each rule was broken below ``path/counts``, batch by batch.

    Each batch is read once, and has a folder of its own in both, which a replay after a failure replaces: no row is
    there twice. Read the sides with ``enforce.read_split``. Without a trigger it processes what there is and ends.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = write_split(batch, contract, f"{path}/rows/batch_id={batch_id}")
        counts.coalesce(1).write.mode("overwrite").parquet(f"{path}/counts/batch_id={batch_id}")

    writer = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


# How long rows may be late before the window they belong to is closed.
DELAY = "1 day"


def _by_window(rows: DataFrame, ts: str, window: str, slide: str | None, by: list[str], values: list) -> DataFrame:
    """Aggregates per window of ``ts``, and in a line without window for rows without a time.

    ``last`` is the latest time of a line's rows.
    """
    timed = rows.withColumn(ts, F.col(ts).cast("timestamp"))
    span = F.window(ts, window, slide).alias("window")
    bounds = {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
    inside = timed.groupBy(span, *by).agg(*values, F.max(ts).alias("last")).withColumns(bounds).drop("window")
    outside = timed.where(F.col(ts).isNull()).groupBy(*by).agg(*values, F.max(ts).alias("last"))
    # Without groups an aggregate over no rows is a row still.
    return inside.unionByName(outside.where("rows > 0").withColumns(dict.fromkeys(bounds, F.lit(None).cast("timestamp"))))


def _violation_lines(rows: DataFrame, ts: str, contract: Contract, window: str, slide: str | None) -> DataFrame:
    all_rules = rules(rows, contract)
    counted = _by_window(rows, ts, window, slide, [], [F.count(F.lit(1)).alias("rows"), *rule_counters(all_rules)])
    return counted.select("window_start", "window_end", "last", "rows", F.inline(rule_lines(all_rules))).select(
        "window_start", "window_end", "column", "code", "rows", "bad", "last"
    )


def window_violations(rows: DataFrame, ts: str, contract: Contract, window: str, slide: str | None = None) -> DataFrame:
    """``window_start, column, code, rows, bad`` per tumbling or sliding window."""
    return _violation_lines(rows, ts, contract, window, slide).drop("window_end", "last")


def _sla_lines(rows: DataFrame, event_ts: str, arrival_ts: str, contract: Contract, window: str, by: list[str], slide: str | None) -> DataFrame:
    ms = latency_ms(event_ts, arrival_ts)
    values = [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(ms > contract.metadata.sla_max_latency_ms).alias("late"),
        F.max(ms).alias("max_ms"),
        F.kll_sketch_agg_bigint(ms, F.lit(SKETCH_K)).alias("sketch"),
    ]
    return _by_window(rows, event_ts, window, slide, by, values).select("window_start", "window_end", *by, "rows", "late", "max_ms", "sketch", "last")


def window_sla(
    rows: DataFrame, event_ts: str, arrival_ts: str, contract: Contract, window: str, by: list[str] | None = None, slide: str | None = None
) -> DataFrame:
    """``window_start, by…, rows, late, max_ms`` per window of event time."""
    return _sla_lines(rows, event_ts, arrival_ts, contract, window, by or [], slide).drop("window_end", "sketch", "last")


_VIOLATIONS = Sums(("column", "code"), {"rows": F.sum, "bad": F.sum})

# Size of a sketch. A percentile read from one is the value of a rank at most ``RANK_ERROR`` of the rows away, at 99 % confidence.
SKETCH_K, RANK_ERROR = 800, 0.005


def _sla_sums(by: list[str] | None) -> Sums:
    return Sums(tuple(by or ()), {"rows": F.sum, "late": F.sum, "max_ms": F.max, "sketch": F.kll_merge_agg_bigint})


def stream_violation_counts(
    rows: DataFrame, ts: str, contract: Contract, window: str, path: str, checkpoint: str, slide: str | None = None, delay: str = DELAY, **trigger
) -> StreamingQuery:
    """Count violations per window of a stream; read the result with ``read_violation_counts``."""
    return stream_windows(rows, lambda batch: _violation_lines(batch, ts, contract, window, slide), _VIOLATIONS, path, checkpoint, delay, **trigger)


def read_violation_counts(spark: SparkSession, path: str, detail: bool = False) -> DataFrame:
    """``window_start, column, code, rows, bad`` of all rows so far.

    With ``detail`` also ``behind_rows, behind_bad``, those of them that came after their window was closed, and ``closed``.
    """
    lines = read_windows(spark, path, _VIOLATIONS)
    behind = lambda c: F.sum(F.when(F.col("behind"), F.col(c)).otherwise(0)).alias(f"behind_{c}")
    more = [behind("rows"), behind("bad"), F.bool_and("closed").alias("closed")] if detail else []
    return lines.groupBy("window_start", "column", "code").agg(F.sum("rows").alias("rows"), F.sum("bad").alias("bad"), *more)


def stream_sla(
    rows: DataFrame,
    event_ts: str,
    arrival_ts: str,
    contract: Contract,
    window: str,
    path: str,
    checkpoint: str,
    by: list[str] | None = None,
    slide: str | None = None,
    delay: str = DELAY,
    **trigger,
) -> StreamingQuery:
    """Measure latency per window of a stream; read the result with ``read_sla``."""
    lines = lambda batch: _sla_lines(batch, event_ts, arrival_ts, contract, window, by or [], slide)
    return stream_windows(rows, lines, _sla_sums(by), path, checkpoint, delay, **trigger)


def read_sla(
    spark: SparkSession, path: str, by: list[str] | None = None, percentiles: dict[str, float] | None = None, detail: bool = False
) -> DataFrame:
    """``window_start, by…, rows, late, max_ms, met`` of all rows so far.

    ``percentiles`` (such as ``{"p99": 0.99}``) are read from mergeable sketches, within ``RANK_ERROR`` of the rank; exact
    ones take the rows themselves (``sla_latency``). With ``detail`` also ``behind_rows`` and ``closed``.
    """
    lines = read_windows(spark, path, _sla_sums(by))
    more = [F.sum(F.when(F.col("behind"), F.col("rows")).otherwise(0)).alias("behind_rows"), F.bool_and("closed").alias("closed")] if detail else []
    merged = lines.groupBy("window_start", *(by or [])).agg(
        F.sum("rows").alias("rows"), F.sum("late").alias("late"), F.max("max_ms").alias("max_ms"), F.kll_merge_agg_bigint("sketch").alias("sketch"), *more
    )
    # A window whose rows have no latency has an empty sketch, of which nothing can be read.
    read = {name: F.when(F.col("max_ms").isNotNull(), F.kll_sketch_get_quantile_bigint("sketch", F.lit(p))) for name, p in (percentiles or {}).items()}
    return merged.withColumn("met", F.col("late") == 0).withColumns(read).drop("sketch")
