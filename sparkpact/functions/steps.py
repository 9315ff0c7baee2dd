"""Columns that are worked out once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The struct between the two steps; no column of a table may have this name.
_MADE = "_made_by_bind"


def bind(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Like ``withColumns``, for expressions that are costly and referred to often.

    The optimizer moves filters below projections by copying the expressions they
    refer to. Where one large expression builds on another that multiplies: a
    filter on the last of five steps would hold thousands of copies of the first.
    It copies nothing that a generator makes, so the values come out of one, from an
    array of one struct. Filters on other columns still pass it, down to the scan.
    The struct is made by a projection of its own below: Spark compiles projections and
    works out once what occurs in them twice, but interprets a generator that holds
    functions of arrays. The new columns come last.
    """
    kept = [F.col(f"`{name}`") for name in df.columns if name not in columns]
    made = df.select("*", F.struct(*[value.alias(name) for name, value in columns.items()]).alias(_MADE))
    return made.select(*kept, F.inline(F.array(F.col(_MADE))))
