"""Contracts to Avro record schemas and back, and the metadata both carry as text."""

from __future__ import annotations

from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpact.functions.steps import bind
from sparkpact.functions.types import FALLBACK, TYPE_MAPS, map_types
from sparkpact.model import DEFAULT_VERSION, Metadata
from sparkpact.operators.documents import COLUMN_TYPE

# The namespace of every schema, and how a doc text carries metadata.
NAMESPACE = "com.example.schema"
METADATA_HEAD = "\n\nMetadata:\n"
OWNER_PATTERN = r"(?d)Data Owner:\s+(.+?)\s+\((.+?)\)"
STEWARD_PATTERN = r"(?d)Data Steward:\s+(.+?)\s+\((.+?)\)"
UPTIME_PATTERN = r"SLA Uptime:\s+([\d.]+)%"
LATENCY_PATTERN = r"SLA Max Latency:\s+(\d+)ms"

ARRAY_TYPE = '{"items":"string","type":"array"}'


def _fields_text(struct: Column) -> Column:
    """The keys and values of an object without its braces; NULL is written as null."""
    # What is within begins with a quote and ends with one or with null, so nothing else is cut off.
    return F.btrim(F.to_json(struct, {"ignoreNullFields": "false"}), F.lit("{}"))


def _field(c: Column, strict: bool) -> Column:
    """One Avro field as JSON text, keys sorted; ``doc`` and ``default`` only where they apply.

    Texts are put together: as a VARIANT each string would get a JSON writer of its own.
    """
    texts = {name: ARRAY_TYPE if avro == "array" and not strict else f'"{avro}"' for name, avro in TYPE_MAPS["avro"].items()}
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(texts.items())])
    kind = F.when(c["data_type"].isNull(), "null").otherwise(F.coalesce(F.try_element_at(table, c["data_type"]), F.lit(f'"{FALLBACK["avro"]}"')))
    name, doc = c["name"].alias("name"), c["description"].alias("doc")
    return F.concat(
        F.when(c["nullable"], '{"default":null,').otherwise("{"),
        F.when(c["description"] != "", _fields_text(F.struct(doc, name))).otherwise(_fields_text(F.struct(name))),
        F.when(c["nullable"], ',"type":["null",').otherwise(',"type":'),
        kind,
        F.when(c["nullable"], "]}").otherwise("}"),
    )


def _doc(contract: Column) -> Column:
    meta = contract["metadata"]

    def text(key: str) -> Column:
        return F.coalesce(meta[key].cast("string"), F.lit("null"))

    def person(label: str, key: str) -> list[Column]:
        return [F.lit(f"  {label}: "), text(key), F.lit(" ("), text(f"{key}_email"), F.lit(")\n")]

    return F.concat(
        contract["description"],
        F.lit(METADATA_HEAD),
        *person("Data Owner", "data_owner"),
        *person("Data Steward", "data_steward"),
        F.lit("  SLA Uptime: "),
        text("sla_uptime_percentage"),
        F.lit("%\n  SLA Max Latency: "),
        text("sla_max_latency_ms"),
        F.lit("ms"),
    )


def to_avro(docs: DataFrame, metadata: str = "always", strict_reference: bool = False) -> DataFrame:
    """``avro_schema``: the Avro record schema text of each contract.

    A nullable column is a union with null and has a null default. The text is
    canonical (keys sorted), so equal definitions are equal texts. An array is
    written as an array of strings; ``strict_reference`` writes the bare word
    ``array``, which no Avro parser accepts. With ``metadata="if_present"`` the
    metadata text is left out where the document had no metadata.
    """
    contract = F.col("contract")
    doc = _doc(contract)
    if metadata == "if_present":
        has_metadata = F.coalesce(F.try_variant_get(F.try_parse_json("raw"), "$.metadata", "map<string,variant>"), F.create_map().cast("map<string,variant>"))
        doc = F.when(F.size(F.map_keys(has_metadata)) > 0, doc).otherwise(contract["description"])
    fields = F.transform(contract["columns"], lambda c: _field(c, strict_reference))
    schema = F.concat(
        F.lit("{"),
        _fields_text(F.struct(doc.alias("doc"))),
        F.lit(',"fields":'),
        F.coalesce(F.concat(F.lit("["), F.array_join(fields, ","), F.lit("]")), F.lit("null")),
        F.lit(","),
        _fields_text(F.struct(F.translate(contract["name"], " ", "").alias("name"))),
        F.lit(f',"namespace":"{NAMESPACE}","type":"record"}}'),
    )
    return docs.withColumn("avro_schema", F.when(contract.isNotNull(), schema))


AVRO_TEXT_SCHEMA = "struct<type:string,name:string,namespace:string,doc:string,fields:array<struct<name:string,type:string,doc:string>>>"


def avro_fields(schemas: DataFrame, *keep: str) -> DataFrame:
    """The fields of ``avro_schema`` texts, one row each; ``type`` as JSON text unless a plain name."""
    item = F.posexplode(F.try_variant_get(F.parse_json("avro_schema"), "$.fields", "array<variant>")).alias("ordinal", "f")
    return schemas.select(*keep, item).select(
        *keep,
        "ordinal",
        F.try_variant_get("f", "$.name", "string").alias("name"),
        F.try_variant_get("f", "$.type", "string").alias("type"),
        F.try_variant_get("f", "$.doc", "string").alias("doc"),
        F.coalesce(F.is_variant_null(F.try_variant_get("f", "$.default", "variant")), F.lit(False)).alias("null_default"),
    )


def doc_metadata(df: DataFrame, doc_col: str = "doc", to: str = "metadata") -> DataFrame:
    """The metadata written into a doc text; defaults for what is not there.

    Owner and steward count only together with their mail address. A number that
    matches but cannot be read falls back to its default.
    """
    return df.withColumn(to, _metadata_of(F.col(doc_col)))


def _metadata_of(doc: Column) -> Column:
    defaults = Metadata()

    def group(pattern: str, number: int) -> Column:
        return F.nullif(F.regexp_extract(doc, pattern, number), F.lit(""))

    def pick(found: Column, key: str) -> Column:
        return F.coalesce(found, F.lit(getattr(defaults, key))).alias(key)

    return F.struct(
        pick(group(OWNER_PATTERN, 1), "data_owner"),
        pick(group(OWNER_PATTERN, 2), "data_owner_email"),
        pick(group(STEWARD_PATTERN, 1), "data_steward"),
        pick(group(STEWARD_PATTERN, 2), "data_steward_email"),
        pick(group(UPTIME_PATTERN, 1).try_cast("double"), "sla_uptime_percentage"),
        F.coalesce(group(LATENCY_PATTERN, 1).try_cast("bigint"), F.lit(defaults.sla_max_latency_ms).cast("bigint")).alias("sla_max_latency_ms"),
    )


def from_avro(schemas: DataFrame, schema_col: str = "avro_schema", id_col: str | None = None) -> DataFrame:
    """``contract`` from an Avro record schema text; NULL if the text is no record.

    A union is nullable iff it holds null, and takes its first other branch; any
    type without a counterpart is a string. The text before the metadata block is
    the description. A schema names no contract id: ``id_col`` does, or else the
    record's name in lower case.
    """
    doc = F.col("_avro")
    name = F.try_variant_get(doc, "$.name", "string")
    text = F.coalesce(F.try_variant_get(doc, "$.doc", "string"), F.lit(""))

    # Each step names what the next refers to several times, so that it is worked out once.
    def one_field(f: Column) -> Column:
        kind = F.try_variant_get(f, "$.type", "variant")
        return F.struct(
            F.try_variant_get(f, "$.name", "string").alias("name"),
            F.coalesce(F.try_variant_get(f, "$.doc", "string"), F.lit("")).alias("description"),
            kind.alias("kind"),
            F.try_variant_get(kind, "$", "array<variant>").alias("union"),
        )

    def one_branch(branch: Column) -> Column:
        # "null" the type name is a JSON string, so its JSON text has quotes.
        return F.struct(F.to_json(branch).alias("text"), (F.try_variant_get(branch, "$.type", "string") == "array").alias("is_array"))

    def branches_of(f: Column) -> Column:
        branches = F.transform(F.coalesce(f["union"], F.array(f["kind"])), one_branch)
        return F.struct(f["name"].alias("name"), f["description"].alias("description"), f["union"].isNotNull().alias("is_union"), branches.alias("branches"))

    def chosen_of(f: Column) -> Column:
        chosen = F.try_element_at(F.filter(f["branches"], lambda b: b["text"] != '"null"'), F.lit(1))
        nullable = f["is_union"] & F.array_contains(f["branches"]["text"], '"null"')
        return F.struct(f["name"].alias("name"), f["description"].alias("description"), nullable.alias("nullable"), chosen.alias("chosen"))

    def as_column(f: Column) -> Column:
        chosen = f["chosen"]["text"]
        data_type = F.when(F.coalesce(f["chosen"]["is_array"], F.lit(False)) | (chosen == '"array"'), F.lit("array")).otherwise(
            map_types(F.btrim(F.coalesce(chosen, F.lit("string")), F.lit('"')), "from_avro")
        )
        return F.struct(f["name"].alias("name"), data_type.alias("data_type"), f["nullable"].alias("nullable"), f["description"].alias("description"))

    fields = F.try_variant_get(doc, "$.fields", "array<variant>")
    contract = F.struct(
        (F.col(id_col) if id_col else F.lower(name)).alias("contract_id"),
        name.alias("name"),
        F.substring_index(text, METADATA_HEAD, 1).alias("description"),
        F.lit(DEFAULT_VERSION).alias("version"),
        reduce(F.transform, (one_field, branches_of, chosen_of, as_column), fields).cast(COLUMN_TYPE).alias("columns"),
        _metadata_of(text).alias("metadata"),
    )
    is_record = (F.try_variant_get(doc, "$.type", "string") == "record") & fields.isNotNull()
    read = schemas.withColumn("_avro", F.try_parse_json(F.col(schema_col)))
    return bind(read, {"contract": F.when(is_record, contract)}).drop("_avro")
