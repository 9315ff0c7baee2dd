"""Type names: contract types, Avro types and table types, and the maps between them."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The data types a contract column may have.
CONTRACT_TYPES = ("string", "integer", "number", "boolean", "date", "timestamp", "object", "array")

# The type maps.
TYPE_MAPS: dict[str, dict[str, str]] = {
    # contract type -> Avro primitive (an array is completed by the Avro writer)
    "avro": {
        "string": "string",
        "integer": "int",
        "number": "double",
        "boolean": "boolean",
        "date": "string",
        "timestamp": "string",
        "object": "string",
        "array": "array",
        "int": "int",
    },
    # contract type -> declared table type
    "table": {
        "string": "string",
        "integer": "bigint",
        "number": "double",
        "boolean": "boolean",
        "date": "date",
        "timestamp": "timestamp",
        "object": "string",
        "array": "array<string>",
    },
    # type name, case ignored -> type the provisioning path gives the table
    "provisioned": {
        "string": "string",
        "int": "int",
        "long": "bigint",
        "float": "float",
        "double": "double",
        "boolean": "boolean",
        "bytes": "binary",
        "date": "date",
        "timestamp": "timestamp",
    },
    # Avro primitive -> contract type
    "from_avro": {
        "string": "string",
        "int": "integer",
        "long": "integer",
        "float": "number",
        "double": "number",
        "boolean": "boolean",
        "bytes": "string",
        "null": "string",
    },
    # table type, case ignored -> type read back; any other type has none
    "from_table": {
        "string": "string",
        "int": "int",
        "long": "long",
        "float": "float",
        "double": "double",
        "boolean": "boolean",
        "bytes": "bytes",
        "date": "date",
        "timestamp": "timestamp",
    },
}
FALLBACK = {"avro": "string", "table": "string", "provisioned": "string", "from_avro": "string", "from_table": None}
IGNORES_CASE = {"provisioned", "from_table"}


def map_types(name: Column, target: str) -> Column:
    """Look a type name up in one of ``TYPE_MAPS``; a constant map, so no join. NULL stays NULL."""
    pairs = TYPE_MAPS[target]
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs.items())])
    key = F.lower(name) if target in IGNORES_CASE else name
    found = F.coalesce(F.try_element_at(table, key), F.lit(FALLBACK[target]).cast("string"))
    return F.when(name.isNotNull(), found)


# Avro resolution: what each writer type may be read as (Avro specification).
PROMOTIONS = {
    "int": ("int", "long", "float", "double"),
    "long": ("long", "float", "double"),
    "float": ("float", "double"),
    "double": ("double",),
    "string": ("string", "bytes"),
    "bytes": ("bytes", "string"),
    "boolean": ("boolean",),
    "array": ("array",),
}
# The Avro types a contract column can render to, nullable or not.
FIELD_CODES = tuple(
    (avro, nullable)
    for avro in sorted(set(TYPE_MAPS["avro"].values()))
    for nullable in (False, True)
)


def readable(writer: tuple[str, bool], reader: tuple[str, bool]) -> bool:
    """Whether a field written with one (type, nullable) can be read with another."""
    promotes = reader[0] in PROMOTIONS[writer[0]]
    null_is_kept = reader[1] or not writer[1]
    return promotes and null_is_kept
