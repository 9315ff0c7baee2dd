"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpact.llm.base import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Every node hands its least neighbour to its greater (``large``) or smaller neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    side = both if large else both.where("b < a")
    least = side.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    told = side.join(least, "a")
    if large:
        return told.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return told.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b"))).where("a <> b")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node, component`` for every node of ``edges`` (``a, b``); a component's name is its least node.

    Large and small stars alternate until every node points at the least of its component. Each round is written
    to the shared folder; the driver sees two numbers of it. A hub is a hot key of a join, split at run time.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if mark == seen or not mark["n"]:
            break
        seen = mark
        edges = written(_star(_star(edges, True), False).distinct(), label)
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
