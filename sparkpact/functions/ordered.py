"""Previous values and running sums per key, for keys of any size.

A window puts a whole key into one task. That is right for keys of ordinary
size. Keys above ``HOT_ROWS`` rows are first cut into blocks along the order
and its tie; each block is a window of its own, and only one summary row per block
is needed to carry values from one block to the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpact.session import materialize

HOT_ROWS = 1_000_000
BLOCK = "_block"

MAX_BLOCKS = 1024
# Rows drawn by a hash for each block; the cuts are among them.
DRAWN = 16


class Ordered:
    """The rows of ``df`` per key, in the order of a numeric column.

    Whether any key is hot is counted first (counts are combined before they are
    shuffled); only if one is does the driver see more than a single number: the
    at most ``MAX_BLOCKS`` values at which hot keys are cut.
    """

    def __init__(self, df: DataFrame, keys: list[str], order: str, tie: str | None = None, hot_rows: int = HOT_ROWS) -> None:
        self.keys = keys
        self.ordering = [order, tie] if tie else [order]
        hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
        hot_total = hot.agg(F.sum("_rows")).first()[0]
        self.is_cut = hot_total is not None
        if not self.is_cut:
            self.blocked = df.withColumn(BLOCK, F.lit(0))
            return
        # The cut path reads the rows several times: have them written, not worked out again.
        df = materialize(df, "ordered")
        hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
        # Cutting all hot keys at the same values leaves no block of any key with
        # more than its share of the hot rows. Past MAX_BLOCKS blocks grow, and a
        # window over one sorts with spilling.
        blocks = min(MAX_BLOCKS, 2 * -(-hot_total // hot_rows))
        hot_only = df.join(hot.select(*keys), keys, "left_semi").select(*self.ordering)
        drawn = hot_only.orderBy(F.xxhash64(*self.ordering)).limit(DRAWN * blocks).collect()
        places = sorted(tuple(r) for r in drawn)
        cuts = sorted({places[i * len(places) // blocks] for i in range(1, blocks)})
        marked = df.join(hot.select(*keys, F.lit(True).alias("_hot")), keys, "left")
        block = F.when(F.col("_hot"), _position(self.ordering, cuts)).otherwise(0)
        self.blocked = marked.withColumn(BLOCK, block).drop("_hot")

    def _window(self):
        return Window.partitionBy(*self.keys, BLOCK).orderBy(*self.ordering)

    def previous(self, values: dict[str, Column]) -> "Ordered":
        """Add each value, as it was on the key's previous row, under the name given."""
        df = self.blocked.withColumn("_now", F.struct(*[v.alias(n) for n, v in values.items()]))
        df = df.withColumn("_before", F.lag("_now").over(self._window()))
        if self.is_cut:
            across = Window.partitionBy(*self.keys).orderBy(BLOCK)
            carried = (
                df.groupBy(*self.keys, BLOCK)
                .agg(F.max_by("_now", F.struct(*self.ordering)).alias("_last"))
                .withColumn("_carried", F.lag("_last").over(across))
                .where(F.col("_carried").isNotNull())
                .drop("_last")
            )
            df = df.join(carried, [*self.keys, BLOCK], "left")
            df = df.withColumn("_before", F.coalesce("_before", "_carried")).drop("_carried")
        df = df.withColumns({n: F.col("_before")[n] for n in values})
        return self._with(df.drop("_now", "_before"))

    def running_sum(self, value: Column, to: str) -> "Ordered":
        """Add the sum of ``value`` over this row and all earlier rows of the key."""
        so_far = self._window().rowsBetween(Window.unboundedPreceding, 0)
        df = self.blocked.withColumn("_value", value.cast("bigint")).withColumn(to, F.sum("_value").over(so_far))
        if self.is_cut:
            earlier = Window.partitionBy(*self.keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
            carried = (
                df.groupBy(*self.keys, BLOCK)
                .agg(F.sum("_value").alias("_total"))
                .withColumn("_carried", F.sum("_total").over(earlier))
                .drop("_total")
            )
            df = df.join(carried, [*self.keys, BLOCK], "left")
            df = df.withColumn(to, F.col(to) + F.coalesce("_carried", F.lit(0))).drop("_carried")
        return self._with(df.drop("_value"))

    def with_columns(self, columns: dict[str, Column]) -> "Ordered":
        return self._with(self.blocked.withColumns(columns))

    def rows(self) -> DataFrame:
        return self.blocked.drop(BLOCK)

    def _with(self, blocked: DataFrame) -> "Ordered":
        copy = object.__new__(Ordered)
        copy.__dict__.update(self.__dict__, blocked=blocked)
        return copy


def _position(ordering: list[str], cuts: list[tuple]) -> Column:
    """How many cuts lie below the row, by halving."""
    place = F.struct(*ordering)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        cut = F.struct(*[F.lit(v).alias(n) for v, n in zip(cuts[middle], ordering)])
        return F.when(place > cut, search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(cuts))
