"""Contracts enforced on the rows of a table.

A contract is small and known when a job is planned, so its rules are baked into
expressions: nothing is joined per row, each operator is one pass, and only the
contract's columns are read. A table may lack columns the contract has and have
columns it lacks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkpact.functions.types import TYPE_MAPS
from sparkpact.model import Column as ContractColumn
from sparkpact.model import Contract

REASON_TYPE = "array<struct<column:string,code:string>>"
_ENTRY_TYPE = "array<struct<column:string,code:string,value:string>>"
_LINE_TYPE = "array<struct<column:string,code:string,bad:bigint>>"

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_TIMES = (T.DateType, T.TimestampType, T.TimestampNTZType)
_NESTED = (T.StructType, T.MapType, T.ArrayType)


def _fields(df: DataFrame) -> dict[str, T.StructField]:
    return {f.name: f for f in df.schema.fields}


def _as_declared(field: T.StructField, data_type: str) -> Column:
    """The column under its declared type; NULL for a value that has no reading."""
    source, col = field.dataType, F.col(f"`{field.name}`")
    target = TYPE_MAPS["table"][data_type]
    if data_type == "object" and isinstance(source, (T.StructType, T.MapType, T.ArrayType, T.VariantType)):
        return F.to_json(col)
    if data_type == "array":
        if isinstance(source, T.ArrayType):
            if isinstance(source.elementType, (*_NESTED, T.VariantType)):
                return F.transform(col, lambda item: F.to_json(item))
            return col.cast("array<string>")
        if isinstance(source, T.StringType):
            return F.try_variant_get(F.try_parse_json(col), "$", "array<string>")
        return F.lit(None).cast(target)
    if isinstance(source, _NESTED):
        return F.to_json(col) if data_type == "string" else F.lit(None).cast(target)
    if isinstance(source, T.BinaryType):
        return col.cast("string").try_cast(target)
    # A number is no point in time and a point in time no number.
    if isinstance(source, (*_NUMERIC, T.BooleanType)) and data_type in ("date", "timestamp"):
        return F.lit(None).cast(target)
    if isinstance(source, _TIMES) and data_type in ("integer", "number", "boolean"):
        return F.lit(None).cast(target)
    if isinstance(source, (T.FloatType, T.DoubleType, T.DecimalType)) and data_type == "integer":
        # 5.0 is a whole number, 5.5 is not one.
        return F.when(col == F.floor(col), col.try_cast(target))
    return col.try_cast(target)


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    """The contract's columns, in its order and under its types; a pure projection.

    Columns the table lacks are NULL, columns the contract lacks are dropped.
    """
    return df.select(*_conformed(df, contract))


def _conformed(df: DataFrame, contract: Contract) -> list[Column]:
    fields = _fields(df)
    return [
        (
            _as_declared(fields[c.name], c.data_type)
            if c.name in fields
            else F.lit(None).cast(TYPE_MAPS["table"][c.data_type])
        ).alias(c.name, metadata={"comment": c.description})
        for c in contract.columns
    ]


def rules(df: DataFrame, contract: Contract) -> list[tuple[ContractColumn, str, Column]]:
    """(column, code, condition that a row breaks it), in contract order."""
    fields = _fields(df)
    found = []
    for c in contract.columns:
        if c.name not in fields:
            if not c.nullable:
                found.append((c, "missing_column", F.lit(True)))
            continue
        is_null = F.col(f"`{c.name}`").isNull()
        if not c.nullable:
            found.append((c, "null_in_required", is_null))
        found.append((c, "uncastable", ~is_null & _as_declared(fields[c.name], c.data_type).isNull()))
    return found


def violations(df: DataFrame, contract: Contract, key: list[str]) -> DataFrame:
    """``key…, column, code, value``: one row for every rule a row breaks. No shuffle."""
    fields = _fields(df)

    def text(name: str) -> Column:
        if name not in fields:
            return F.lit(None).cast("string")
        col = F.col(f"`{name}`")
        return F.to_json(col) if isinstance(fields[name].dataType, (*_NESTED, T.VariantType)) else col.cast("string")

    entries = [
        F.when(broken, F.struct(F.lit(c.name).alias("column"), F.lit(code).alias("code"), text(c.name).alias("value")))
        for c, code, broken in rules(df, contract)
    ]
    return df.select(*key, F.inline(F.array_compact(F.array(*entries).cast(_ENTRY_TYPE))))


def violation_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """``contract_id, column, code, rows, bad, ratio``: all rules in one pass.

    Each task counts on its own, and what is shuffled is one row of counters per
    task, however many rules there are. A contract without rules has no lines.
    """
    all_rules = rules(df, contract)
    counters = df.agg(F.count(F.lit(1)).alias("rows"), *rule_counters(all_rules))
    lines = rule_lines(all_rules)
    return (
        counters.select("rows", F.inline(lines))
        .select(F.lit(contract.contract_id).alias("contract_id"), "column", "code", "rows", "bad", _ratio().alias("ratio"))
    )


def _ratio() -> Column:
    return F.when(F.col("rows") > 0, F.round(F.col("bad") / F.col("rows"), 6)).otherwise(0.0)


def rule_counters(all_rules: list[tuple[ContractColumn, str, Column]]) -> list[Column]:
    return [F.count_if(broken).alias(f"n{i}") for i, (_, _, broken) in enumerate(all_rules)]


def rule_lines(all_rules: list[tuple[ContractColumn, str, Column]]) -> Column:
    """The counters as an array of ``column, code, bad``."""
    lines = [
        F.struct(F.lit(c.name).alias("column"), F.lit(code).alias("code"), F.col(f"n{i}").alias("bad"))
        for i, (c, code, _) in enumerate(all_rules)
    ]
    return F.array(*lines).cast(_LINE_TYPE)


def with_reasons(df: DataFrame, contract: Contract) -> DataFrame:
    """``df`` with ``_reasons``: every rule the row breaks, empty if none."""
    return df.withColumn("_reasons", _reasons(rules(df, contract)))


def _reasons(all_rules: list[tuple[ContractColumn, str, Column]]) -> Column:
    entries = [F.when(broken, F.struct(F.lit(c.name).alias("column"), F.lit(code).alias("code"))) for c, code, broken in all_rules]
    found = F.array_compact(F.array(*entries)) if entries else F.array()
    return found.cast(REASON_TYPE)


def _broken(df: DataFrame, contract: Contract) -> Column:
    return reduce(Column.__or__, (condition for _, _, condition in rules(df, contract)), F.lit(False))


# The folders of a written split, and what rows lie under in each.
SIDES = {"valid": "accepted", "quarantine": "rejected"}


def write_split(df: DataFrame, contract: Contract, path: str) -> DataFrame:
    """Both sides of ``split_rows`` written below ``path`` in one pass over the rows, which also counts violations.

    Returns the lines of ``violation_counts``, which the write observed on its way; read the sides with ``read_split``.
    Replaces what is below ``path``.
    """
    all_rules, broken, seen = rules(df, contract), _broken(df, contract), Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *rule_counters(all_rules))
    rejected = F.struct(*[F.col(f"`{c}`") for c in df.columns], _reasons(all_rules).alias("_reasons"))
    sides = observed.select(
        F.when(~broken, F.struct(*_conformed(df, contract))).alias(SIDES["valid"]),
        F.when(broken, rejected).alias(SIDES["quarantine"]),
        F.when(broken, "quarantine").otherwise("valid").alias("side"),
    )
    sides.write.mode("overwrite").partitionBy("side").parquet(path)
    counts, spark = seen.get, df.sparkSession
    lines = [(contract.contract_id, c.name, code, counts["rows"], counts[f"n{i}"]) for i, (c, code, _) in enumerate(all_rules)]
    found = spark.createDataFrame(lines, "contract_id string, column string, code string, rows bigint, bad bigint")
    return found.withColumn("ratio", _ratio())


def read_split(spark: SparkSession, path: str, side: str, like: DataFrame, contract: Contract) -> DataFrame:
    """One side (``valid`` or ``quarantine``) of a written split of rows ``like`` these: only its files are read."""
    valid, quarantine = split_rows(like, contract)
    ddl = T.StructType([T.StructField(SIDES["valid"], valid.schema), T.StructField(SIDES["quarantine"], quarantine.schema), T.StructField("side", T.StringType())])
    return spark.read.schema(ddl).parquet(path).where(F.col("side") == side).select(f"{SIDES[side]}.*")


def split_rows(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine): accepted rows typed, rejected rows as they were with ``_reasons``.

    Every row is in exactly one of the two. Each is a query of its own over the rows; ``write_split`` takes both from one.
    """
    broken = _broken(df, contract)
    return df.where(~broken).select(*_conformed(df, contract)), with_reasons(df.where(broken), contract)


def parse_records(df: DataFrame, raw_col: str, contract: Contract) -> DataFrame:
    """JSON texts read under the contract; the text of what cannot be is kept in ``_corrupt``.

    Replaces ``raw_col`` by the contract's columns. A field that is absent reads as
    null, also where the contract requires one: that is a violation of the row,
    which ``violations`` and ``split_rows`` find, and no fault of the text.
    """
    declared = ", ".join(f"`{c.name}` {TYPE_MAPS['table'][c.data_type]}" for c in contract.columns)
    read = F.from_json(F.col(raw_col), f"{declared}, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    others = [F.col(f"`{name}`") for name in df.columns if name != raw_col]
    return df.withColumn("_read", read).select(
        *others,
        *[F.col(f"_read.`{c.name}`").alias(c.name) for c in contract.columns],
        # from_json gives NULL, not a corrupt record, for an empty text.
        F.coalesce("_read._corrupt", F.when(F.col("_read").isNull() | (F.trim(raw_col) == ""), F.col(raw_col))).alias("_corrupt"),
    )


def evolve_rows(df: DataFrame, contract: Contract, keep_extra: bool = False) -> DataFrame:
    """Rows carried to another version: new columns NULL, dropped ones gone, retyped ones cast."""
    if not keep_extra:
        return conform(df, contract)
    declared = {c.name for c in contract.columns}
    return df.select(*_conformed(df, contract), *[F.col(f"`{n}`") for n in df.columns if n not in declared])


def union_versions(tables: list[DataFrame], contract: Contract) -> DataFrame:
    """Tables written under several versions, read as one under ``contract``."""
    first, *rest = [evolve_rows(t, contract) for t in tables]
    for table in rest:
        first = first.unionByName(table)
    return first


# -- contracts and schemas -----------------------------------------------------


def _contract_type(data_type: T.DataType) -> str:
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "integer"
    if isinstance(data_type, (T.FloatType, T.DoubleType, T.DecimalType)):
        return "number"
    if isinstance(data_type, T.DateType):
        return "date"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return "timestamp"
    if isinstance(data_type, T.ArrayType):
        return "array"
    if isinstance(data_type, (T.StructType, T.MapType, T.VariantType)):
        return "object"
    return "string"


def infer_contract(df: DataFrame, contract_id: str, name: str) -> DataFrame:
    """A contract document for a table: ``contract_id, name, ordinal, column, data_type, nullable``.

    A column is nullable if any row holds a null, which is one count per column
    in a single pass.
    """
    fields = df.schema.fields
    nulls = df.agg(*[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"n{i}") for i, f in enumerate(fields)])
    lines = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(f.name).alias("column"),
                F.lit(_contract_type(f.dataType)).alias("data_type"),
                (F.col(f"n{i}") > 0).alias("nullable"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return nulls.select(F.lit(contract_id).alias("contract_id"), F.lit(name).alias("name"), F.inline(lines))


def conformance(df: DataFrame, contract: Contract) -> DataFrame:
    """``column, declared, actual, status, unreadable``: the table's schema against the contract.

    ok, missing_required, missing_optional, extra or type_mismatch. For a mismatch
    ``unreadable`` says how many values have no reading under the declared type.
    """
    fields = _fields(df)
    declared = {c.name: c for c in contract.columns}
    lines, counters = [], []
    for name in [*declared, *[n for n in fields if n not in declared]]:
        c, field = declared.get(name), fields.get(name)
        actual = _contract_type(field.dataType) if field else None
        count = F.lit(None).cast("bigint")
        if c is None:
            status = "extra"
        elif field is None:
            status = "missing_optional" if c.nullable else "missing_required"
        elif actual == c.data_type or (c.data_type == "object" and actual == "string"):
            status = "ok"
        else:
            status = "type_mismatch"
            counters.append(
                F.count_if(F.col(f"`{name}`").isNotNull() & _as_declared(field, c.data_type).isNull()).alias(f"n{len(counters)}")
            )
            count = F.col(f"n{len(counters) - 1}")
        lines.append(
            F.struct(
                F.lit(name).alias("column"),
                F.lit(c.data_type if c else None).cast("string").alias("declared"),
                F.lit(actual).cast("string").alias("actual"),
                F.lit(status).alias("status"),
                count.alias("unreadable"),
            )
        )
    counted = df.agg(F.count(F.lit(1)).alias("rows"), *counters)
    return counted.select(F.lit(contract.contract_id).alias("contract_id"), "rows", F.inline(F.array(*lines)))
