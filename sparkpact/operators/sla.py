"""Service levels measured against what a contract promises, and who answers for it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpact.model import Contract

# Values with more significant bits than this share a bucket, so a group never
# has more than some 10^5 buckets, however long its rows took.
BUCKET_BITS = 12

UNKNOWN_OWNER = "(unknown)"


def latency_ms(event_ts: str, arrival_ts: str) -> Column:
    return F.unix_millis(F.col(arrival_ts).cast("timestamp")) - F.unix_millis(F.col(event_ts).cast("timestamp"))


def _bucket(ms: Column) -> Column:
    """The value with its low bits cleared; never out of order with the value itself."""
    low_bits = F.greatest(F.length(F.bin(F.abs(ms))) - BUCKET_BITS, F.lit(0))
    # shiftright takes a constant; a division that rounds down does the same.
    width = F.pow(F.lit(2.0), low_bits).cast("bigint")
    return F.floor(ms / width).cast("bigint") * width


def sla_latency(
    df: DataFrame,
    event_ts: str,
    arrival_ts: str,
    contract: Contract,
    by: list[str],
    percentiles: dict[str, float] | None = None,
) -> DataFrame:
    """``by…, rows, late, late_ratio, p50, p99, max_ms, met``: rows against ``sla_max_latency_ms``.

    Percentiles are exact (the smallest value that at least that share of rows does
    not exceed). Rows are counted per latency first; then buckets of latencies
    locate each percentile, and only the buckets that hold one are ranked. No step
    puts the latencies of a whole group into one task.
    """
    percentiles = percentiles or {"p50": 0.5, "p99": 0.99}
    if not by:
        # Without groups all rows are one, under a key of its own.
        whole = sla_latency(df.withColumn("__all", F.lit(0)), event_ts, arrival_ts, contract, ["__all"], percentiles)
        return whole.drop("__all")
    limit = contract.metadata.sla_max_latency_ms
    counts = (
        df.select(*by, latency_ms(event_ts, arrival_ts).alias("ms"))
        .where(F.col("ms").isNotNull())
        .groupBy(*by, "ms")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", _bucket(F.col("ms")))
    )
    late = F.sum(F.when(F.col("ms") > limit, F.col("n")).otherwise(0))
    totals = counts.groupBy(*by).agg(F.sum("n").alias("rows"), late.alias("late"), F.max("ms").alias("max_ms"))

    through = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    buckets = (
        counts.groupBy(*by, "bucket")
        .agg(F.sum("n").alias("n"))
        .withColumn("upto", F.sum("n").over(through))
        .withColumn("total", F.sum("n").over(whole))
    )
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.ceil(F.col("total") * F.lit(p)).cast("bigint").alias("rank")) for name, p in percentiles.items()])
    located = (
        buckets.withColumn("w", F.explode(wanted))
        .where((F.col("w.rank") <= F.col("upto")) & (F.col("w.rank") > F.col("upto") - F.col("n")))
        .select(*by, "bucket", F.col("w.name").alias("name"), (F.col("w.rank") - (F.col("upto") - F.col("n"))).alias("rank"))
    )
    inside = Window.partitionBy(*by, "name").orderBy("ms").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.join(located, [*by, "bucket"]).withColumn("upto", F.sum("n").over(inside))
    values = (
        ranked.where(F.col("upto") >= F.col("rank"))
        .groupBy(*by)
        .agg(*[F.min(F.when(F.col("name") == name, F.col("ms"))).alias(name) for name in percentiles])
    )
    return totals.join(values, by).select(
        *by,
        "rows",
        "late",
        F.round(F.col("late") / F.col("rows"), 6).alias("late_ratio"),
        *percentiles,
        "max_ms",
        (F.col("late") == 0).alias("met"),
    )


def sla_uptime(df: DataFrame, ts: str, bucket_seconds: int, contract: Contract, by: list[str] | None = None) -> DataFrame:
    """``by…, expected, live, uptime_pct, met``: share of time buckets that hold a row.

    Rows are reduced to distinct buckets before they are shuffled.
    """
    by = by or []
    bucket = F.floor(F.unix_seconds(F.col(ts).cast("timestamp")) / bucket_seconds)
    live = df.where(F.col(ts).isNotNull()).select(*by, bucket.alias("bucket")).distinct()
    counted = live.groupBy(*by).agg(
        (F.max("bucket") - F.min("bucket") + 1).alias("expected"), F.count(F.lit(1)).alias("live")
    )
    pct = F.round(F.col("live") * 100 / F.col("expected"), 4)
    return counted.select(
        *by, "expected", "live", pct.alias("uptime_pct"), (pct >= contract.metadata.sla_uptime_percentage).alias("met")
    )


def owner_rollup(counts: DataFrame, docs: DataFrame) -> DataFrame:
    """``owner, steward, contract_id, contracts, rows, bad``: violation counts by who must fix them.

    ``counts`` has ``contract_id, rows, bad`` (one line per rule). Lines with a
    NULL contract_id are an owner's total, those with a NULL owner everyone's.
    Counts are reduced to one row per contract before the owners are joined, and
    owners to the newest document's (by ``seq`` and path where there are any, else
    the last by name). Counts of a contract without a document are under
    ``UNKNOWN_OWNER``.
    """
    per_contract = counts.groupBy("contract_id").agg(F.max("rows").alias("rows"), F.sum("bad").alias("bad"))
    who = F.struct(F.col("contract.metadata.data_owner").alias("o"), F.col("contract.metadata.data_steward").alias("s"))
    newest = F.struct(*[F.col(c) for c in ("seq", "file_path") if c in docs.columns], who)
    owners = docs.groupBy(F.col("contract.contract_id").alias("contract_id")).agg(F.max_by(who, newest).alias("who"))
    joined = per_contract.join(owners, "contract_id", "left").select(
        F.coalesce("who.o", F.lit(UNKNOWN_OWNER)).alias("owner"), F.coalesce("who.s", F.lit(UNKNOWN_OWNER)).alias("steward"), "contract_id", "rows", "bad"
    )
    return joined.rollup("owner", "steward", "contract_id").agg(
        F.count(F.lit(1)).alias("contracts"), F.sum("rows").alias("rows"), F.sum("bad").alias("bad")
    ).where(F.col("steward").isNotNull() | F.col("owner").isNull())
