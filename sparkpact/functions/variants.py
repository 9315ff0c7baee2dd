"""Reading untrusted JSON: what a value is, before it is cast to anything.

A typed parse cannot tell an absent key from a null or from a value of the wrong
type, so documents stay VARIANT and each value is looked at as a ``scalar``:
``STRUCT<shape, text>``, where shape is the SQL type the value has in the document,
VOID for null and NULL for no value at all.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def shape_of(value: Column) -> Column:
    return F.schema_of_variant(value)


def text_of(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def object_fields(value: Column, keys: tuple[str, ...]) -> Column:
    """The named keys of an object, as values and as texts; both NULL for anything else.

    One read for all keys: a key that is absent is NULL, one that is null is a
    VARIANT holding null.
    """
    return F.struct(
        F.try_variant_get(value, "$", f"struct<{', '.join(f'{k} variant' for k in keys)}>").alias("value"),
        F.try_variant_get(value, "$", f"struct<{', '.join(f'{k} string' for k in keys)}>").alias("text"),
    )


def scalar(fields: Column, key: str) -> Column:
    """One key read by ``object_fields``."""
    return F.struct(shape_of(fields["value"][key]).alias("shape"), fields["text"][key].alias("text"))


def is_missing(s: Column) -> Column:
    return s["shape"].isNull()


def is_string(s: Column) -> Column:
    return F.coalesce(s["shape"] == "STRING", F.lit(False))


def _is_boolean(s: Column) -> Column:
    return s["shape"] == "BOOLEAN"


def _is_number(s: Column) -> Column:
    return s["shape"].isin("BIGINT", "DOUBLE") | s["shape"].startswith("DECIMAL")


def is_object(s: Column) -> Column:
    return F.coalesce(s["shape"].startswith("OBJECT"), F.lit(False))


def is_falsy(s: Column) -> Column:
    """Empty in the sense of a missing key, null, "", 0, false, [] or {}."""
    shape, text = s["shape"], s["text"]
    return (
        F.when(shape.isNull() | (shape == "VOID"), True)
        .when(shape == "STRING", text == "")
        .when(shape == "BOOLEAN", text == "false")
        .when(shape.startswith("OBJECT"), text == "{}")
        .when(shape.startswith("ARRAY"), text == "[]")
        .otherwise(F.coalesce(text.try_cast("double") == 0, F.lit(False)))
    )


# Texts read as a boolean.
TRUE_TEXTS = ("1", "on", "t", "true", "y", "yes")
FALSE_TEXTS = ("0", "off", "f", "false", "n", "no")
_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
_INTEGER = r"^\s*[+-]?\d+(\.0+)?\s*$"
_NOT_FINITE = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"


def as_boolean(s: Column) -> Column:
    """Boolean, or a number or text that stands for one; NULL when it does not."""
    text = s["text"]
    number = text.try_cast("double")
    return (
        F.when(_is_boolean(s), text == "true")
        .when(_is_number(s), F.when(number == 1, True).when(number == 0, False))
        .when(is_string(s), F.when(F.lower(text).isin(*TRUE_TEXTS), True).when(F.lower(text).isin(*FALSE_TEXTS), False))
    )


def as_double(s: Column) -> Column:
    text = s["text"]
    return (
        F.when(_is_number(s), text.try_cast("double"))
        .when(_is_boolean(s), F.when(text == "true", 1.0).otherwise(0.0))
        .when(is_string(s) & (text.rlike(_DECIMAL) | text.rlike(_NOT_FINITE)), F.trim(text).try_cast("double"))
    )


def as_long(s: Column) -> Column:
    """A whole number; 5.0 and "5.0" are whole, 5.5 is not."""
    text = s["text"]
    wide = text.try_cast("double")
    whole = F.coalesce(text.try_cast("bigint"), F.when(wide == F.floor(wide), wide.try_cast("bigint")))
    return (
        F.when(_is_number(s), whole)
        .when(_is_boolean(s), F.when(text == "true", 1).otherwise(0).cast("bigint"))
        .when(is_string(s) & text.rlike(_INTEGER), F.regexp_replace(F.trim(text), r"\.0+$", "").try_cast("bigint"))
    )
