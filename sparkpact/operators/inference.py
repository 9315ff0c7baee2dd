"""Contracts from JSON texts: which keys they have, and the narrowest type that reads all values of each.

Every value adds one bit for its kind, and a key's kinds are the bits of all its values, so tasks
combine what they saw in any order and move one line per key. The types are a lattice:

    integer < number < string,  date < timestamp < string,  boolean, array, object < string

Nulls fit all of them. The narrowest type above all kinds seen is the column's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpact.functions.steps import bind
from sparkpact.functions.variants import shape_of, text_of
from sparkpact.session import materialize

KINDS = ("null", "boolean", "integer", "number", "string", "array", "object", "date", "timestamp")
_BIT = {kind: 1 << i for i, kind in enumerate(KINDS)}
# Types in the order in which they are tried, with the kinds that they read.
READS = (
    ("boolean", ("boolean",)),
    ("integer", ("integer",)),
    ("number", ("integer", "number")),
    ("date", ("date",)),
    ("timestamp", ("date", "timestamp")),
    ("array", ("array",)),
    ("object", ("object",)),
)
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}(\.\d{1,6})?(Z|[+-]\d{2}:\d{2})?$"


def _bits(*kinds: str) -> int:
    return sum(_BIT[kind] for kind in kinds)


def value_kind(value: Column) -> Column:
    """The bit of one VARIANT value. A whole number beyond 64 bits is a number, a text that is no real date a string."""
    shape, text = shape_of(value), text_of(value)
    written = (
        F.when(text.rlike(_DATE) & text.try_cast("date").isNotNull(), _BIT["date"])
        .when(text.rlike(_TIMESTAMP) & text.try_cast("timestamp").isNotNull(), _BIT["timestamp"])
        .otherwise(_BIT["string"])
    )
    return (
        F.when(shape == "VOID", _BIT["null"])
        .when(shape == "BOOLEAN", _BIT["boolean"])
        .when(shape == "BIGINT", _BIT["integer"])
        .when((shape == "DOUBLE") | shape.startswith("DECIMAL"), _BIT["number"])
        .when(shape.startswith("ARRAY"), _BIT["array"])
        .when(shape.startswith("OBJECT"), _BIT["object"])
        .otherwise(written)
    )


def narrowest_type(kinds: Column) -> Column:
    """The contract type that reads all ``kinds``; string where only nulls were seen."""
    some = kinds.bitwiseAND(F.lit(~_BIT["null"]))
    found = F.when(some == 0, "string")
    for data_type, reads in READS:
        found = found.when(some.bitwiseAND(F.lit(~_bits(*reads))) == 0, data_type)
    return found.otherwise("string")


def infer_json_contract(df: DataFrame, raw_col: str, contract_id: str, name: str) -> DataFrame:
    """``contract_id, name, column, data_type, nullable, seen, objects, unread`` per key of the texts' outermost objects.

    ``seen`` texts hold the key, of ``objects`` that were read; a column is nullable if one of them lacks it or holds null
    there. ``unread`` texts are no JSON object and tell nothing of the columns; null texts are not counted. Of a key that
    is repeated in a text the last value counts. Blank keys cannot be columns and are left out. There are no rows if
    nothing was read.

    The texts are read once. What is shuffled is a line per task and key.
    """
    texts = df.select(F.col(f"`{raw_col}`").alias("raw")).where(F.col("raw").isNotNull())
    fields = bind(texts, {"fields": F.try_variant_get(F.try_parse_json("raw"), "$", "map<string,variant>")})
    # The line without a key stands for the text itself: a one if it is an object.
    itself = F.struct(F.lit(None).cast("string").alias("key"), F.col("fields").isNotNull().cast("int").alias("kind"))
    entries = F.transform(F.map_entries("fields"), lambda e: F.struct(e["key"].alias("key"), value_kind(e["value"]).alias("kind")))
    lines = fields.select(F.inline(F.concat(F.array(itself), F.coalesce(entries, F.array().cast("array<struct<key:string,kind:int>>")))))
    counted = lines.groupBy("key").agg(
        F.count(F.lit(1)).alias("seen"),
        F.bit_or("kind").alias("kinds"),
        # Nulls of a key; objects, in the line without one.
        F.count_if(F.col("kind") == 1).alias("ones"),
    )
    keys = materialize(counted, "json-keys")
    # One row: all texts, and those that are objects.
    whole = keys.where(F.col("key").isNull()).select(F.col("ones").alias("objects"), (F.col("seen") - F.col("ones")).alias("unread"))
    return (
        keys.where(F.trim("key") != "")
        .crossJoin(whole)
        .select(
            F.lit(contract_id).alias("contract_id"),
            F.lit(name).alias("name"),
            F.col("key").alias("column"),
            narrowest_type(F.col("kinds")).alias("data_type"),
            ((F.col("ones") > 0) | (F.col("seen") < F.col("objects"))).alias("nullable"),
            "seen",
            "objects",
            "unread",
        )
    )
