"""Contract documents: parse, check, build, flatten.

The operators add columns to a table that has a ``raw`` JSON text column; they
are projections, so any number of them costs one pass and no shuffle.

    parse_contracts   + doc VARIANT, parse_status, quick, facts
    check_structure   + errors
    build_contracts   + contract, build_errors
    check_model       + model_errors
    contract_status   + validate_status, build_status, reason
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpact.functions.steps import bind
from sparkpact.functions.types import CONTRACT_TYPES
from sparkpact.functions.variants import (
    as_boolean,
    as_double,
    as_long,
    is_falsy,
    is_missing,
    is_object,
    is_string,
    object_fields,
    scalar,
    shape_of,
    text_of,
)
from sparkpact.model import DEFAULT_VERSION, Metadata

# The keys a document must have.
REQUIRED_FIELDS = ("contract_id", "name", "description", "columns")

ERROR_TYPE = "array<struct<code:string,idx:int,column:string,detail:string>>"
COLUMN_TYPE = "array<struct<name:string,data_type:string,nullable:boolean,description:string>>"

TEXT_METADATA = ("data_owner", "data_owner_email", "data_steward", "data_steward_email")


TOP_TEXT = ("contract_id", "name", "description", "version")
COLUMN_KEYS = ("name", "data_type", "nullable", "description")
METADATA_KEYS = (*TEXT_METADATA, "sla_uptime_percentage", "sla_max_latency_ms")


def parse_contracts(docs: DataFrame, raw: str = "raw") -> DataFrame:
    """Parse the JSON and look at each value of interest once.

    ``quick`` is the contract of a document with nothing wrong in it. For any other
    ``facts`` keeps what a typed parse would lose: whether a key is absent, null or
    of another type. Later operators read only these two.
    """
    # Read while parsing: without it a repeated key makes the document unreadable.
    docs.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    # For valid JSON text the first character tells an object from anything else.
    holds_object = F.col(raw).rlike(r"^\s*\{")
    status = (
        F.when(F.col("doc").isNull(), F.lit("invalid_json"))
        .when(~holds_object, F.lit("not_object"))
        .otherwise(F.lit("ok"))
    )
    doc = F.col("doc")
    items = F.try_variant_get(doc, "$.columns", "array<variant>")
    parsed = docs.withColumn("doc", F.try_parse_json(F.col(raw))).withColumn("parse_status", status)
    plain = F.schema_of_variant(doc)
    parsed = bind(
        parsed,
        {
            "shape": plain,
            # A text of this shape reads the same from JSON, at a fraction of the cost of a VARIANT's many casts.
            "typed": F.when(plain.rlike(PLAIN_SHAPE), F.from_json(F.col(raw), PLAIN_TYPE)),
        },
    )
    parsed = bind(parsed, {"quick": _quick(F.col("shape"), F.col("typed"))}).drop("shape", "typed")
    found = F.struct(
        object_fields(doc, TOP_TEXT).alias("top"),
        F.try_variant_get(doc, "$.columns", "variant").alias("columns_value"),
        F.transform(items, lambda item: object_fields(item, COLUMN_KEYS)).alias("columns"),
        F.try_variant_get(doc, "$.metadata", "variant").alias("metadata_value"),
        object_fields(F.try_variant_get(doc, "$.metadata", "variant"), METADATA_KEYS).alias("metadata"),
    )
    parsed = bind(parsed, {"found": F.when(doc.isNotNull() & F.col("quick").isNull(), found)})
    return bind(parsed, {"facts": F.when(F.col("found").isNotNull(), _facts(F.col("found")))}).drop("found")


# The shape of a document in which every value has the type it should have. Most
# documents are like that and, if nothing else is wrong with them, need no closer
# look: they are read as typed in one go. A key the pattern does not know, a null
# or another type leads to the closer look, not to a verdict.
PLAIN_SHAPE = (
    r"^OBJECT<columns: ARRAY<OBJECT<data_type: STRING(, description: STRING)?, name: STRING(, nullable: BOOLEAN)?>>, "
    r"contract_id: STRING, description: STRING"
    r"(, metadata: OBJECT<((data_(owner|steward)(_email)?: STRING|sla_max_latency_ms: BIGINT"
    r"|sla_uptime_percentage: (BIGINT|DOUBLE|DECIMAL\(\d+,\d+\)))(, )?)*>)?, name: STRING(, version: STRING)?>$"
)
METADATA_TYPE = "struct<" + ",".join(f"{key}:string" for key in TEXT_METADATA) + ",sla_uptime_percentage:double,sla_max_latency_ms:bigint>"
PLAIN_TYPE = f"struct<contract_id:string,name:string,description:string,version:string,columns:{COLUMN_TYPE},metadata:{METADATA_TYPE}>"


def _quick(shape: Column, typed: Column) -> Column:
    """The contract of a document that is plain and breaks no rule; NULL for all others.

    A shape is that of all columns taken together, so a key that some column has
    and another lacks shows as a NULL, as does a null among columns.
    """
    defaults = Metadata()
    columns, metadata = typed["columns"], typed["metadata"]
    names = columns["name"]
    says_nullable, says_description = shape.contains("nullable: "), shape.contains("data_type: STRING, description: STRING")

    def faulty(c: Column) -> Column:
        """Whether a column breaks a rule or has a null: all in one look."""
        return (
            c["name"].isNull()
            | ~F.coalesce(c["data_type"].isin(*CONTRACT_TYPES), F.lit(False))
            | (c["nullable"].isNull() & says_nullable)
            | (c["description"].isNull() & says_description)
            | _blank(c["name"])
        )

    sound = (
        ~F.exists(columns, faulty)
        & (F.size(F.array_distinct(names)) == F.size(names))
        & ~_blank(typed["contract_id"])
        & ~_blank(typed["name"])
        & ~_blank(typed["description"])
    )
    # No cast to the types of a built contract: it would copy every column only to say that nulls are allowed.
    contract = F.struct(
        *[typed[key].alias(key) for key in ("contract_id", "name", "description")],
        F.coalesce(typed["version"], F.lit(DEFAULT_VERSION)).alias("version"),
        F.transform(
            columns,
            lambda c: F.struct(
                c["name"].alias("name"),
                c["data_type"].alias("data_type"),
                F.coalesce(c["nullable"], F.lit(True)).alias("nullable"),
                F.coalesce(c["description"], F.lit("")).alias("description"),
            ),
        ).alias("columns"),
        F.struct(*[F.coalesce(metadata[key], F.lit(getattr(defaults, key))).alias(key) for key in METADATA_KEYS]).alias("metadata"),
    )
    return F.when(typed.isNotNull() & sound, contract)


def _facts(found: Column) -> Column:
    """The scalars of the document, of each column and of the metadata, and what the two came in."""
    columns, value = found["columns"], found["columns_value"]
    metadata = found["metadata_value"]
    # What an array holds is not worth spelling out: its elements are looked at below.
    is_list = columns.isNotNull()
    return F.struct(
        *[scalar(found["top"], key).alias(key) for key in TOP_TEXT],
        F.struct(
            F.when(is_list, F.lit("ARRAY")).otherwise(shape_of(value)).alias("shape"),
            F.when(is_list, F.when(F.size(columns) == 0, F.lit("[]")).otherwise(F.lit("[...]"))).otherwise(text_of(value)).alias("text"),
        ).alias("columns_value"),
        F.transform(
            columns,
            lambda c: F.struct(
                c["value"].isNotNull().alias("is_object"),
                *[scalar(c, key).alias(key) for key in COLUMN_KEYS],
            ),
        ).alias("columns"),
        F.struct(shape_of(metadata).alias("shape"), text_of(metadata).alias("text")).alias("metadata_value"),
        F.struct(*[scalar(found["metadata"], key).alias(key) for key in METADATA_KEYS]).alias("metadata"),
    )


def _error(code: str, idx: Column | None = None, column: Column | None = None, detail: Column | None = None) -> Column:
    return F.struct(
        F.lit(code).alias("code"),
        (F.lit(None).cast("int") if idx is None else idx.cast("int")).alias("idx"),
        (F.lit(None).cast("string") if column is None else column).alias("column"),
        (F.lit(None).cast("string") if detail is None else detail).alias("detail"),
    )


def _errors(*found: Column) -> Column:
    """Keep the errors that are there, in the order given."""
    return F.array_compact(F.array(*found)).cast(ERROR_TYPE)


def _not_null(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def check_structure(docs: DataFrame) -> DataFrame:
    """What can be said of a document before it is built: ``errors``, empty if none.

    Presence is what counts for the required keys; null or "" passes here. A
    document without ``columns`` gets two errors, as does a column without
    ``data_type``.
    """
    facts = F.col("facts")
    listed = facts["columns"]
    columns_value = facts["columns_value"]
    version = facts["version"]

    def presence(key: str) -> Column:
        value = columns_value if key == "columns" else facts[key]
        return F.when(is_missing(value), _error("missing_field", detail=F.lit(key)))

    def of_column(item: Column, idx: Column) -> Column:
        data_type, name = item["data_type"], item["name"]["text"]
        known = is_string(data_type) & data_type["text"].isin(*CONTRACT_TYPES)
        return F.when(~item["is_object"], F.array(_error("column_not_object", idx))).otherwise(
            F.array(
                F.when(is_missing(item["name"]), _error("column_missing_name", idx)),
                F.when(is_missing(data_type), _error("column_missing_data_type", idx, name)),
                F.when(~known, _error("invalid_data_type", idx, name, data_type["text"])),
            )
        )

    document_errors = _errors(
        *[presence(key) for key in REQUIRED_FIELDS],
        F.when(is_falsy(columns_value), _error("no_columns")).when(listed.isNull(), _error("columns_not_list")),
        F.when(~is_falsy(version) & ~is_string(version), _error("version_not_string", detail=version["text"])),
    )
    column_errors = F.array_compact(F.flatten(F.transform(listed, of_column))).cast(ERROR_TYPE)
    # What the quick reading let pass has no errors.
    errors = F.when(F.col("quick").isNotNull(), F.array().cast(ERROR_TYPE)).when(F.col("parse_status") != "ok", F.array(_error_of(F.col("parse_status"))).cast(ERROR_TYPE)).otherwise(
        F.concat(document_errors, F.coalesce(column_errors, F.array().cast(ERROR_TYPE)))
    )
    return bind(docs, {"errors": errors})


def _error_of(code: Column) -> Column:
    return F.struct(
        code.alias("code"),
        F.lit(None).cast("int").alias("idx"),
        F.lit(None).cast("string").alias("column"),
        F.lit(None).cast("string").alias("detail"),
    )


def build_contracts(docs: DataFrame) -> DataFrame:
    """The typed ``contract`` of each structurally sound document.

    Absent keys get their defaults; a value that is there but cannot be read as
    its type (null included) is a ``build_errors`` entry and leaves no contract.
    """
    facts = F.col("facts")
    defaults = Metadata()

    def text(value: Column, default: str | None = None) -> Column:
        read = F.when(is_string(value), value["text"])
        return read if default is None else read.when(is_missing(value), F.lit(default))

    def boolean(value: Column, default: bool) -> Column:
        return F.when(is_missing(value), F.lit(default)).otherwise(as_boolean(value))

    def one_column(item: Column) -> Column:
        return F.struct(
            text(item["name"]).alias("name"),
            text(item["data_type"]).alias("data_type"),
            boolean(item["nullable"], True).alias("nullable"),
            text(item["description"], "").alias("description"),
        )

    meta = facts["metadata"]
    meta_value = facts["metadata_value"]
    uptime, latency = meta["sla_uptime_percentage"], meta["sla_max_latency_ms"]
    metadata = F.struct(
        *[text(meta[key], getattr(defaults, key)).alias(key) for key in TEXT_METADATA],
        F.when(is_missing(uptime), F.lit(defaults.sla_uptime_percentage)).otherwise(as_double(uptime)).alias("sla_uptime_percentage"),
        F.when(is_missing(latency), F.lit(defaults.sla_max_latency_ms).cast("bigint"))
        .otherwise(as_long(latency))
        .alias("sla_max_latency_ms"),
    )
    draft = F.struct(
        *[text(facts[key]).alias(key) for key in ("contract_id", "name", "description")],
        text(facts["version"], DEFAULT_VERSION).alias("version"),
        F.transform(facts["columns"], one_column).cast(COLUMN_TYPE).alias("columns"),
        metadata.cast(METADATA_TYPE).alias("metadata"),
    )

    def unread(draft: Column) -> Column:
        """Names of what could not be read, from the nulls the draft has."""
        top = [F.when(draft[key].isNull(), F.lit(key)) for key in TOP_TEXT]
        within = [
            F.when(F.exists(draft["columns"][key], F.isnull), F.lit(f"columns.{key}"))
            for key in COLUMN_KEYS
        ]
        meta_fields = [
            F.when(draft["metadata"][key].isNull(), F.lit(f"metadata.{key}"))
            for key in METADATA_KEYS
        ]
        not_object = F.when(~is_falsy(meta_value) & ~is_object(meta_value), F.lit("metadata"))
        return F.array_compact(F.array(*top, *within, not_object, *meta_fields))

    quick = F.col("quick")
    drafted = bind(docs, {"draft": F.when(quick.isNotNull(), quick).when(F.size("errors") == 0, draft)})
    nothing = F.when(quick.isNotNull(), F.array().cast("array<string>"))
    checked = bind(drafted, {"build_errors": nothing.when(F.col("draft").isNotNull(), unread(F.col("draft")))})
    return checked.withColumn("contract", F.when(F.size("build_errors") == 0, F.col("draft"))).drop("draft")


def _blank(value: Column) -> Column:
    return ~value.rlike(r"(?U)\S")


def check_model(docs: DataFrame) -> DataFrame:
    """Rules only a built contract can be held to: ``model_errors``.

    Blank identity, blank or repeated column names (one error for each repeat).
    """
    contract = F.col("contract")
    columns = contract["columns"]
    names = F.transform(columns, lambda c: c["name"])
    has_repeats = F.size(F.array_distinct(names)) < F.size(names)

    def of_column(c: Column, idx: Column) -> Column:
        blank = _blank(c["name"])
        repeat = has_repeats & (F.array_position(names, c["name"]) <= idx)
        return F.array(
            F.when(blank, _error("blank_column_name", idx)).when(repeat, _error("duplicate_column_name", idx, c["name"])),
            F.when(_blank(c["data_type"]), _error("blank_data_type", idx, c["name"])),
            F.when(
                ~c["data_type"].isin(*CONTRACT_TYPES),
                _error("invalid_data_type", idx, c["name"], c["data_type"]),
            ),
        )

    found = F.concat(
        _errors(
            *[F.when(_blank(contract[key]), _error(f"blank_{key}")) for key in ("contract_id", "name", "description")],
            F.when(F.size(columns) == 0, _error("no_columns")),
        ),
        F.array_compact(F.flatten(F.transform(columns, of_column))).cast(ERROR_TYPE),
    )
    return bind(docs, {"model_errors": F.when(F.col("quick").isNotNull(), F.array().cast(ERROR_TYPE)).when(contract.isNotNull(), found)})


def _as_text(errors: Column) -> Column:
    """Errors as texts: the code, then where and what."""
    return F.transform(
        errors,
        lambda e: F.concat(
            e["code"],
            F.coalesce(F.concat(F.lit(" at column "), e["idx"].cast("string")), F.lit("")),
            F.coalesce(F.concat(F.lit(": "), F.nullif(F.concat_ws(" ", e["column"], e["detail"]), F.lit(""))), F.lit("")),
        ),
    )


def contract_status(docs: DataFrame) -> DataFrame:
    """``validate_status`` (valid/invalid), ``build_status`` (built/failed, NULL if invalid), ``reason``.

    Validation and building are two gates: a repeated column name, a blank name
    or a null passes the first and fails the second. ``contract`` stays only on
    rows that pass both; ``document_id`` and ``document_name`` are what any
    document calls itself.
    """
    valid = F.size("errors") == 0
    built = valid & (F.size("build_errors") == 0) & (F.size("model_errors") == 0)
    reasons = F.concat(
        _as_text(F.col("errors")),
        F.coalesce(F.transform("build_errors", lambda field: F.concat(F.lit("unreadable: "), field)), F.array().cast("array<string>")),
        F.coalesce(_as_text(F.col("model_errors")), F.array().cast("array<string>")),
    )
    status = {
        "validate_status": F.when(valid, "valid").otherwise("invalid"),
        "build_status": F.when(_not_null(built), "built").when(valid, "failed"),
        "reason": F.when(F.col("quick").isNull(), F.nullif(F.array_join(reasons, "; "), F.lit(""))),
        "contract": F.when(_not_null(built), F.col("contract")),
        "document_id": F.coalesce("quick.contract_id", "facts.contract_id.text"),
        "document_name": F.coalesce("quick.name", "facts.name.text"),
    }
    return bind(docs, status)


def load_contracts(docs: DataFrame) -> DataFrame:
    """All of the above, without the intermediate columns."""
    return contract_status(check_model(build_contracts(check_structure(parse_contracts(docs))))).drop("doc", "facts", "quick")


def built_contracts(docs: DataFrame) -> DataFrame:
    """The rows of a loaded table that hold a contract."""
    return docs.where(F.col("build_status") == "built")


def explode_columns(docs: DataFrame, *keep: str) -> DataFrame:
    """One row per contract column, with the columns named in ``keep`` carried along."""
    return docs.select(
        F.col("contract.contract_id").alias("contract_id"),
        F.col("contract.version").alias("version"),
        *[F.col(name) for name in keep],
        F.posexplode("contract.columns").alias("ordinal", "c"),
    ).select(
        "contract_id",
        "version",
        *keep,
        "ordinal",
        F.col("c.name").alias("name"),
        F.col("c.data_type").alias("data_type"),
        F.col("c.nullable").alias("nullable"),
        F.col("c.description").alias("description"),
    )
