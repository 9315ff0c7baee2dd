"""One query per operator, over the whole of the supplied tables.

Each takes a session and the folder of the tables. Contract documents come from
``orders`` (a customer's orders are the versions of one contract), dirtied rows
from ``orders``, ``lineitem`` and ``events``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkpact.functions.types import map_types
from sparkpact.model import Column, Contract
from sparkpact.operators import avro, documents, enforce, inference, registry, results, sla, tables, tags, versions
from sparkpact.plans.provisioning import Run, apply_tables, provision, with_order
from sparkpact.session import configure, materialize, scratch_dir
from sparkpact.sources import contracts as contract_files_source
from sparkpact.sources import corpus
from sparkpact.streaming import contracts as contract_stream
from sparkpact.streaming import rows as row_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[function.__name__] = run
    return run


# -- inputs ----------------------------------------------------------------------


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.contract_corpus(corpus.spread(corpus.table(spark, sf_dir, "orders")))


def _loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.load_contracts(_docs(spark, sf_dir))


def _odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.load_contracts(corpus.odd_corpus(corpus.spread(corpus.table(spark, sf_dir, "part"))))


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version histories, written once: ordered passes read them several times."""
    return materialize(versions.history(_loaded(spark, sf_dir)), "versions")


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(registry.candidates(_loaded(spark, sf_dir)), "candidates")


def _orders_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.orders_dirty(corpus.table(spark, sf_dir, "orders"))


def _lineitem_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.lineitem_dirty(corpus.table(spark, sf_dir, "lineitem"))


def _events_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.events_dirty(corpus.table(spark, sf_dir, "events"))


def _joined(items: str, one: Callable, sep: str) -> F.Column:
    return F.array_join(F.transform(items, one), sep)


# -- contract documents ----------------------------------------------------------


def _write_files(docs: DataFrame, path: str) -> None:
    customer = F.regexp_extract("file_path", r"customer/(\d+)/", 1).cast("bigint")
    contract_files_source.write_contracts(docs.select((customer % 16).alias("domain"), "raw"), f"{path}/all")


@query
def contract_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document written as a file of its own, in folders by customer, then read back."""
    path = scratch_dir(spark, "files")
    _write_files(_docs(spark, sf_dir), path)
    loaded = documents.load_contracts(contract_files_source.read_contracts(spark, path, "*.txt"))
    return loaded.groupBy("domain", "validate_status", "build_status").agg(F.count(F.lit(1)).alias("files"))


@query
def changed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three scans of a folder of documents, one file each: of all, of what did not change, and after some have landed anew."""
    root = scratch_dir(spark, "changed")
    docs = corpus.odd_corpus(corpus.spread(corpus.table(spark, sf_dir, "part")))
    part, scans = F.col("seq"), []
    for number, land in enumerate((F.lit(True), None, part % 7 == 0)):
        if land is not None:
            contract_files_source.write_contracts(docs.where(land).select((part % 16).alias("domain"), "raw"), f"{root}/files/all/{number}")
        known = contract_files_source.read_manifest(spark, f"{root}/manifest")
        changed = contract_files_source.changed_contracts(spark, f"{root}/files", known, "*.txt")
        contract_files_source.write_manifest(changed.files, f"{root}/manifest", str(number))
        scans.append(documents.load_contracts(with_order(changed.documents)).select(F.lit(number).alias("scan"), "validate_status"))
    return reduce(DataFrame.unionByName, scans).groupBy("scan", "validate_status").agg(F.count(F.lit(1)).alias("files"))


@query
def contract_parse_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.parse_contracts(_docs(spark, sf_dir)).select("file_path", "parse_status")


@query
def contract_structure_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = documents.check_structure(documents.parse_contracts(_docs(spark, sf_dir)))
    return (
        checked.select(F.explode("errors").alias("e"))
        .groupBy(F.col("e.code").alias("code"), F.col("e.idx").alias("idx"), F.col("e.column").alias("column_name"), F.col("e.detail").alias("detail"))
        .agg(F.count(F.lit(1)).alias("errors"))
    )


@query
def contract_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    built = documents.build_contracts(documents.check_structure(documents.parse_contracts(_docs(spark, sf_dir))))
    c = F.col("contract")
    return built.where(c.isNotNull()).select(
        "file_path",
        *[c[key].alias(key) for key in ("contract_id", "name", "description", "version")],
        F.size(c["columns"]).alias("n_columns"),
        *[c["metadata"][key].alias(key) for key in documents.METADATA_KEYS],
    )


@query
def contract_model_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir).select("file_path", F.explode("model_errors").alias("e")).select(
        "file_path", F.col("e.code").alias("code"), F.col("e.idx").alias("idx"), F.col("e.column").alias("column_name")
    )


@query
def contract_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(spark, sf_dir).select("file_path", "validate_status", "build_status", "reason")


@query
def contract_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.explode_columns(documents.built_contracts(_loaded(spark, sf_dir)), "seq", "file_path").drop("description")


@query
def type_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = documents.explode_columns(documents.built_contracts(_loaded(spark, sf_dir)))
    mapped = columns.select(
        "data_type",
        map_types(F.col("data_type"), "avro").alias("avro"),
        map_types(F.col("data_type"), "table").alias("declared"),
        map_types(F.col("data_type"), "provisioned").alias("provisioned"),
    ).withColumns(
        {
            "from_avro": map_types(F.col("avro"), "from_avro"),
            "from_declared": map_types(F.col("declared"), "from_table"),
        }
    )
    return mapped.groupBy(*mapped.columns).agg(F.count(F.lit(1)).alias("columns"))


@query
def avro_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    schemas = avro.to_avro(documents.built_contracts(_loaded(spark, sf_dir)))
    return avro.avro_fields(schemas, "file_path").drop("doc")


@query
def avro_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    schemas = avro.to_avro(documents.built_contracts(_loaded(spark, sf_dir))).select(
        "file_path", "avro_schema", F.col("contract.contract_id").alias("id")
    )
    back = avro.from_avro(schemas, id_col="id")
    return documents.explode_columns(back, "file_path").drop("version", "description")


@query
def doc_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    schemas = avro.to_avro(documents.built_contracts(_loaded(spark, sf_dir)))
    docs = schemas.select("file_path", F.get_json_object("avro_schema", "$.doc").alias("doc"))
    return avro.doc_metadata(docs).select("file_path", "metadata.*")


@query
def tag_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = tags.tags(documents.built_contracts(_loaded(spark, sf_dir)))
    return tags.typed_tags(tagged).select("file_path", F.size("tags").alias("n_tags"), "tag_metadata.*")


# -- versions --------------------------------------------------------------------


@query
def version_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.version_history(_versions(spark, sf_dir)).select(
        "contract_id", "seq", "file_path", "version", "changed", "registry_version", "prev_seq", "prev_version"
    )


@query
def version_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.history_diff(_versions(spark, sf_dir)).withColumnRenamed("column", "column_name")


@query
def version_diff_first_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first version of every contract against its last, as two column tables."""
    all_versions = _versions(spark, sf_dir)

    def columns_of(pick) -> DataFrame:
        chosen = all_versions.groupBy("contract_id").agg(pick("contract", F.struct("seq", "file_path")).alias("contract"))
        return documents.explode_columns(chosen).select("contract_id", "name", "data_type", "nullable")

    return versions.diff_versions(columns_of(F.min_by), columns_of(F.max_by)).withColumnRenamed("column", "column_name")


@query
def version_diff_avro(spark: SparkSession, sf_dir: str) -> DataFrame:
    diff = versions.history_diff(_versions(spark, sf_dir), level="avro")
    return diff.groupBy("column", "kind", "old_type", "new_type").agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("column", "column_name")


@query
def version_diff_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = versions.diff_summary(versions.history_diff(_versions(spark, sf_dir)), list(versions.KEY))
    return summary.withColumns({"changes": F.array_join("changes", "; "), "warnings": F.array_join("warnings", "; ")})


def _compatibility(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        checked = versions.compatibility(_versions(spark, sf_dir), mode)
        return checked.withColumn("offending", _joined("offending", lambda o: F.concat_ws(":", o["column"], o["reason"]), ","))

    run.__name__ = f"compat_{mode.lower()}"
    return run


for _mode in versions.MODES:
    query(_compatibility(_mode))


@query
def version_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions.conflicts(_versions(spark, sf_dir), file_col="file_path")


# -- registry --------------------------------------------------------------------


def _accepted(plan: DataFrame) -> DataFrame:
    return plan.where(F.col("action").isin("create", "new_version"))


@query
def registry_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    accepted = _accepted(registry.plan_history(_candidates(spark, sf_dir), "DISABLED"))
    return registry.latest_versions(accepted).select(
        "schema_name",
        "latest_version",
        "next_version",
        "status",
        "data_format",
        "compatibility",
        "metadata.*",
        F.size(F.try_variant_get("schema", "$.fields", "array<variant>")).alias("n_fields"),
    )


def _newest_keys(rows: DataFrame) -> DataFrame:
    return rows.groupBy("contract_id").agg(F.max(F.struct("seq", "file_path")).alias("e")).select("contract_id", "e.*")


def _registration(mode: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """All versions but the newest are registered, the newest of each contract is the candidate."""
        rows = _candidates(spark, sf_dir)
        newest = _newest_keys(rows)
        older = rows.join(newest, list(versions.KEY), "left_anti")
        registered = _accepted(registry.plan_history(older, "DISABLED")).select("contract_id", "registry_version", "definition_hash", "columns")
        # The plan decides by hash and columns; texts and tags, most of a row's bytes, are not sorted for the join.
        one_each = rows.select(*versions.KEY, "definition_hash", "columns").join(newest, list(versions.KEY), "left_semi")
        plan = registry.plan_registration(materialize(registered, "registered"), one_each, mode)
        return plan.select(
            "contract_id",
            "seq",
            "file_path",
            "action",
            "registry_version",
            _joined("offending", lambda o: F.concat_ws(":", o["column"], o["reason"]), ",").alias("offending"),
        )

    run.__name__ = "registration_plan" if mode == "FORWARD_ALL" else f"registration_plan_{mode.lower()}"
    return run


for _mode in ("FORWARD_ALL", "BACKWARD"):
    query(_registration(_mode))


@query
def registration_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions in order, each held against what was accepted before it."""
    return registry.plan_history(_candidates(spark, sf_dir), "FORWARD_ALL").select(
        "contract_id", "seq", "file_path", "action", "registry_version"
    )


@query
def registration_history_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.plan_history(_candidates(spark, sf_dir), "BACKWARD").select(
        "contract_id", "seq", "file_path", "action", "registry_version"
    )


@query
def registry_after_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the versions, the rest, every newest version again; then the second and the first load once more."""
    rows = _candidates(spark, sf_dir)
    path = scratch_dir(spark, "registry")
    middle = rows.agg((F.max("seq") / 2).alias("middle")).scalar()
    first, second = rows.where(F.col("seq") <= middle), rows.where(F.col("seq") > middle)
    third = rows.join(_newest_keys(rows), list(versions.KEY), "left_semi")
    loads = [("1-first", first), ("2-second", second), ("3-third", third), ("2-second", second), ("1-first", first)]
    for load_id, part in loads:
        before = registry.read_registry(spark, path, before_load=load_id)
        registry.apply_registration(registry.plan_history(part, "DISABLED", before), path, load_id)
    return registry.read_registry(spark, path).select("contract_id", "registry_version", "seq", "file_path", "load_id")


def _registered(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """A registry on disk, of all versions in two loads, put together into one."""
    rows = _candidates(spark, sf_dir)
    path = scratch_dir(spark, label)
    middle = rows.agg((F.max("seq") / 2).alias("middle")).scalar()
    for load_id, part in (("1-first", rows.where(F.col("seq") <= middle)), ("2-second", rows.where(F.col("seq") > middle))):
        before = registry.read_registry(spark, path, before_load=load_id)
        registry.apply_registration(registry.plan_history(part, "DISABLED", before), path, load_id)
    registry.compact_registry(spark, path, f"{path}-one", "3")
    return registry.read_registry(spark, f"{path}-one")


@query
def list_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.list_schemas(_registered(spark, sf_dir, "list-schemas"))


@query
def get_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The entries of three contracts, one of which is unknown."""
    known = _registered(spark, sf_dir, "get-schema")
    asked = known.agg(F.min("contract_id").alias("a"), F.max("contract_id").alias("z")).first()
    found = [registry.get_schema(known, name) for name in (asked["a"], asked["z"], "nobody")]
    return reduce(DataFrame.unionByName, found).select("schema_name", "latest_version", "next_version", "status", F.size("columns").alias("n_columns"))


# -- tables ----------------------------------------------------------------------


def _newest_documents(loaded: DataFrame) -> DataFrame:
    payload = F.struct("build_status", "contract", "seq", "file_path")
    return (
        documents.built_contracts(loaded)
        .groupBy(F.col("contract.contract_id").alias("id"))
        .agg(F.max_by(payload, F.struct("seq", "file_path")).alias("d"))
        .select("d.*")
    )


def _existing_tables(loaded: DataFrame) -> DataFrame:
    """Tables as they stand: the first version of two contracts in three; every fifth has lost its version."""
    first = (
        documents.built_contracts(loaded)
        .groupBy(F.col("contract.contract_id").alias("id"))
        .agg(F.min_by("contract", F.struct("seq", "file_path")).alias("contract"))
        .withColumn("customer", F.substring_index("id", "-", -1).cast("bigint"))
        .where("customer % 3 <> 0")
    )
    return documents.explode_columns(first, "customer").select(
        versions.table_name(F.col("contract_id")).alias("table_name"),
        "name",
        map_types(F.col("data_type"), "provisioned").alias("type"),
        "contract_id",
        F.when(F.col("customer") % 5 != 0, F.col("version")).alias("version"),
    )


@query
def table_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = materialize(_loaded(spark, sf_dir), "loaded")
    return tables.plan_tables(_newest_documents(loaded), _existing_tables(loaded))


ORDERS_V2 = Contract(
    contract_id="orders-v1",
    name="Orders",
    description="Orders as they are kept",
    version="2.0.0",
    columns=(
        Column("o_orderkey", "integer", nullable=False),
        Column("o_orderdate", "string"),
        Column("o_totalprice", "number"),
        Column("o_clerk", "string"),
    ),
)


@query
def applied_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table per supplier made in one run, half of them changed in a second; what the catalog holds then, and was noted."""
    root, database = scratch_dir(spark, "applied"), f"applied_{uuid.uuid4().hex}"
    suppliers = corpus.table(spark, sf_dir, "supplier")
    for load_id, part in (("1", suppliers), ("2", suppliers.where("s_suppkey % 2 = 0"))):
        docs = corpus.supplier_corpus(part, int(load_id))
        planned = provision(docs, None, tables.read_catalog(spark, f"{root}/catalog"), load_id)
        apply_tables(planned, root, database, f"{root}/catalog", load_id)
    held = materialize(tables.existing_columns(spark, database), "held")
    spark.sql(f"DROP DATABASE {database} CASCADE")
    noted = tables.read_catalog(spark, f"{root}/catalog").withColumn("noted", F.lit(True))
    return held.join(noted, held.columns, "full").select(*held.columns, F.coalesce("noted", F.lit(False)).alias("noted"))


@query
def evolved_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid orders written as the contract's table, which then goes to a second version."""
    valid, _ = enforce.split_rows(_orders_dirty(spark, sf_dir), corpus.ORDERS_CONTRACT)
    root = scratch_dir(spark, "tables")
    database = "sparkpact_" + root.rsplit("-", 1)[-1][:12]
    tables.write_contract_table(valid, corpus.ORDERS_CONTRACT, root, database)
    table = tables.evolve_table(spark, ORDERS_V2, root, database)
    version = tables.table_properties(spark, table)[tables.VERSION_PROPERTY]
    rows = materialize(spark.table(table.replace("`", "")).withColumn("table_version", F.lit(version)), "evolved")
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return rows


# Columns dropped and added, none retyped.
ORDERS_V3 = Contract(
    contract_id="orders-v1",
    name="Orders",
    description="Orders as they are kept",
    version="3.0.0",
    columns=(
        Column("o_note", "string"),
        Column("o_totalprice", "number"),
        Column("o_orderkey", "integer", nullable=False),
        Column("o_rank", "integer"),
    ),
)


@query
def evolved_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid orders as the contract's table, which goes to a version that adds and drops columns: no file is written."""
    valid, _ = enforce.split_rows(_orders_dirty(spark, sf_dir), corpus.ORDERS_CONTRACT)
    root = scratch_dir(spark, "tables")
    database = "sparkpact_" + root.rsplit("-", 1)[-1][:12]
    name = tables.write_contract_table(valid, corpus.ORDERS_CONTRACT, root, database).replace("`", "")
    before = set(spark.table(name).inputFiles())
    tables.evolve_table(spark, ORDERS_V3, root, database)
    written = len(set(spark.table(name).inputFiles()) - before)
    version = tables.table_properties(spark, name)[tables.VERSION_PROPERTY]
    rows = spark.table(name).withColumns({"table_version": F.lit(version), "files_written": F.lit(written)})
    rows = materialize(rows, "evolved-columns")
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return rows


# -- rows ------------------------------------------------------------------------


@query
def infer_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    inputs = {
        "orders": _orders_dirty(spark, sf_dir),
        "lineitem": _lineitem_dirty(spark, sf_dir),
        "events": _events_dirty(spark, sf_dir),
        "embeddings": corpus.table(spark, sf_dir, "embeddings"),
    }
    found = [enforce.infer_contract(df, f"{name}-v1", name) for name, df in inputs.items()]
    return reduce(DataFrame.unionByName, found).withColumnRenamed("column", "column_name")


def _inferred(texts: DataFrame) -> DataFrame:
    return inference.infer_json_contract(texts, "raw", "inferred-v1", "Inferred").withColumnRenamed("column", "column_name")


@query
def inferred_json_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract of what events carry, some of it cut short or of another type."""
    return _inferred(corpus.event_props(corpus.table(spark, sf_dir, "events")).select(F.col("props").alias("raw")))


@query
def inferred_json_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract of orders that were written as JSON."""
    orders = corpus.table(spark, sf_dir, "orders")
    return _inferred(orders.select(F.to_json(F.struct(*orders.columns)).alias("raw")))


@query
def inferred_json_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract of contract documents."""
    return _inferred(_docs(spark, sf_dir).select("raw"))


@query
def conformance(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = enforce.conformance(_orders_dirty(spark, sf_dir), corpus.ORDERS_CONTRACT)
    lines = enforce.conformance(_lineitem_dirty(spark, sf_dir), corpus.LINEITEM_CONTRACT)
    return orders.unionByName(lines).withColumnRenamed("column", "column_name")


@query
def conform_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = enforce.conform(_orders_dirty(spark, sf_dir), corpus.ORDERS_CONTRACT)
    return typed.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query
def violations_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = enforce.violations(_orders_dirty(spark, sf_dir), corpus.ORDERS_CONTRACT, ["o_orderkey"])
    return found.withColumnRenamed("column", "column_name")


@query
def violation_counts_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which columns of a table break their contract, and how often."""
    counts = enforce.violation_counts(_orders_dirty(spark, sf_dir), corpus.ORDERS_CONTRACT)
    return counts.withColumnRenamed("column", "column_name")


@query
def violation_counts_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = enforce.violation_counts(_lineitem_dirty(spark, sf_dir), corpus.LINEITEM_CONTRACT)
    return counts.withColumnRenamed("column", "column_name")


def _with_reason_text(quarantine: DataFrame) -> DataFrame:
    return quarantine.withColumn("reasons", _joined("_reasons", lambda r: F.concat_ws(":", r["column"], r["code"]), ",")).drop("_reasons")


@query
def quarantine_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_reason_text(enforce.split_rows(_orders_dirty(spark, sf_dir), corpus.ORDERS_CONTRACT)[1])


@query
def valid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = enforce.split_rows(_orders_dirty(spark, sf_dir), corpus.ORDERS_CONTRACT)[0]
    return valid.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


@query
def written_split_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sides written in one pass, the violations it counted, and the rows of each side as read back."""
    dirty, path = _orders_dirty(spark, sf_dir), scratch_dir(spark, "split")
    counts = enforce.write_split(dirty, corpus.ORDERS_CONTRACT, path)
    sizes = [enforce.read_split(spark, path, side, dirty, corpus.ORDERS_CONTRACT).agg(F.count("*").alias(f"{side}_rows")) for side in enforce.SIDES]
    # One row each.
    return reduce(DataFrame.crossJoin, sizes, counts).withColumnRenamed("column", "column_name")


@query
def parse_event_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = enforce.parse_records(corpus.event_props(corpus.table(spark, sf_dir, "events")), "props", corpus.PROPS_CONTRACT)
    return parsed.withColumnRenamed("_corrupt", "corrupt")


@query
def union_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odd orders without their priority and even ones with it, read as one table."""
    orders = corpus.table(spark, sf_dir, "orders")
    old = orders.where("o_orderkey % 2 = 1").drop("o_orderpriority")
    new = orders.where("o_orderkey % 2 = 0")
    both = enforce.union_versions([old, new], corpus.ORDERS_CONTRACT)
    return both.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd"))


# -- service levels --------------------------------------------------------------


@query
def sla_latency_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = corpus.events_arrived(corpus.table(spark, sf_dir, "events"))
    return sla.sla_latency(events, "ts", "arrival_ts", corpus.EVENTS_CONTRACT, ["event_type"])


@query
def sla_uptime_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sla.sla_uptime(corpus.table(spark, sf_dir, "events"), "ts", 300, corpus.EVENTS_CONTRACT)


@query
def sla_uptime_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sla.sla_uptime(corpus.table(spark, sf_dir, "events"), "ts", 3600, corpus.EVENTS_CONTRACT, ["event_type"])


@query
def owner_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of each customer's orders, by the owner in the customer's newest contract."""
    dirty = corpus.orders_dirty(corpus.table(spark, sf_dir, "orders"), F.concat(F.lit("cust-"), "o_custkey").alias("contract_id"))
    reasons = enforce.with_reasons(dirty, corpus.ORDERS_CONTRACT)
    counts = reasons.groupBy("contract_id").agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size("_reasons")).alias("bad"))
    loaded = materialize(_loaded(spark, sf_dir).select("build_status", "contract", "seq", "file_path"), "owners")
    return sla.owner_rollup(counts, documents.built_contracts(loaded))


# -- results ---------------------------------------------------------------------


def _run(spark: SparkSession, sf_dir: str) -> Run:
    loaded = materialize(_loaded(spark, sf_dir).drop("raw"), "loaded")
    return provision(loaded, scratch_dir(spark, "run-registry"), _existing_tables(loaded), "all")


@query
def results_by_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = _run(spark, sf_dir).by_contract
    return merged.select(
        "contract_id",
        F.col("validation.file_path").alias("validated_file"),
        F.col("validation.build_status").alias("build_status"),
        F.col("schema.schema_status").alias("schema_status"),
        F.col("schema.registry_version").alias("registry_version"),
        F.col("table.table_status").alias("table_status"),
        F.col("table.columns_count").alias("columns_count"),
    )


@query
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).summary().withColumn("actions", F.array_join("actions", "; "))


@query
def export_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File results of the odd documents as JSON, read back."""
    path = scratch_dir(spark, "export")
    results.export_results(results.file_status(_odd(spark, sf_dir)), path)
    schema = "file string, status string, contract_name string, reason string"
    return spark.read.schema(schema).json(f"{path}/results")


@query
def odd_structure_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules that documents of orders never break."""
    found = _odd(spark, sf_dir).select("file_path", F.explode("errors").alias("e"))
    return found.select("file_path", F.col("e.code").alias("code"), F.col("e.idx").alias("idx"), F.col("e.column").alias("column_name"), F.col("e.detail").alias("detail"))


@query
def odd_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values read under another type, and what cannot be."""
    built = _odd(spark, sf_dir).where("validate_status = 'valid'")
    c = F.col("contract")
    return built.select(
        "file_path",
        "build_status",
        "reason",
        c["columns"][0]["nullable"].alias("nullable"),
        c["metadata"]["data_owner"].alias("data_owner"),
        c["metadata"]["sla_uptime_percentage"].alias("uptime"),
        c["metadata"]["sla_max_latency_ms"].alias("latency"),
    )


@query
def odd_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of several spellings under one table name."""
    return versions.conflicts(versions.history(_odd(spark, sf_dir)), file_col="file_path")


@query
def status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.status_counts(results.file_status(_loaded(spark, sf_dir)))


@query
def failed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return results.failed_files(results.file_status(_loaded(spark, sf_dir)))


# -- streams ---------------------------------------------------------------------


@query
def stream_contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents registered as a stream; what is in the registry afterwards."""
    docs = corpus.contract_corpus(corpus.table_stream(spark, sf_dir, "orders"))
    root = scratch_dir(spark, "stream")
    contract_stream.register_stream(docs, f"{root}/registry", f"{root}/checkpoint").awaitTermination()
    return registry.read_registry(spark, f"{root}/registry").select("contract_id", "seq", "file_path", "registry_version", "version")


def _runs(spark: SparkSession, df: DataFrame, path: str, part: F.Column, start: Callable) -> None:
    """A stream started ``BATCHES`` times, each time after one more part of ``df``, dealt by ``part``, has landed.

    A part lands in as many files as its scan has tasks; a stream without a limit of files takes them as one batch.
    """
    df.withColumn("part", part).write.partitionBy("part").parquet(f"{path}/dealt")
    for number in range(BATCHES):
        own = spark.read.schema(df.schema).parquet(f"{path}/dealt/part={number}")
        own.write.mode("append").parquet(f"{path}/landed")
        start(spark.readStream.schema(df.schema).parquet(f"{path}/landed")).awaitTermination()


# Runs of a stream, each over what landed since the one before.
BATCHES = 3


@query
def stream_contracts_any_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same documents in several runs, dealt to them by a hash: most versions land before or between registered ones."""
    root = scratch_dir(spark, "stream-any")
    part = F.pmod(F.xxhash64("file_path"), F.lit(BATCHES))
    _runs(spark, _docs(spark, sf_dir), root, part, lambda stream: contract_stream.register_stream(stream, f"{root}/registry", f"{root}/checkpoint"))
    return registry.read_registry(spark, f"{root}/registry").select("contract_id", "seq", "file_path", "registry_version", "version")


@query
def stream_contract_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract files registered as they land; what is in the registry afterwards."""
    root = scratch_dir(spark, "stream-files")
    _write_files(_docs(spark, sf_dir), f"{root}/files")
    contract_stream.stream_contracts(spark, f"{root}/files", f"{root}/registry", f"{root}/checkpoint", "DISABLED", "*.txt").awaitTermination()
    known = registry.read_registry(spark, f"{root}/registry")
    return known.groupBy("contract_id").agg(F.count_distinct("definition_hash").alias("definitions"))


@query
def stream_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders split as a stream; where each of them went."""
    stream = corpus.orders_dirty(corpus.table_stream(spark, sf_dir, "orders"))
    root = scratch_dir(spark, "stream")
    row_stream.stream_split(stream, corpus.ORDERS_CONTRACT, f"{root}/split", f"{root}/checkpoint").awaitTermination()
    valid, quarantine = (enforce.read_split(spark, f"{root}/split/rows", side, stream, corpus.ORDERS_CONTRACT) for side in enforce.SIDES)
    valid, quarantine = valid.select("o_orderkey", F.lit("valid").alias("went"), F.lit("").alias("reasons")), _with_reason_text(quarantine)
    return valid.unionByName(quarantine.select("o_orderkey", F.lit("quarantine").alias("went"), "reasons"))


def _start_text(windows: DataFrame) -> DataFrame:
    return windows.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"))


@query
def stream_violation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = corpus.events_dirty(corpus.table_stream(spark, sf_dir, "events"))
    root = scratch_dir(spark, "stream")
    row_stream.stream_violation_counts(stream, "ts", corpus.EVENTS_CONTRACT, "1 day", f"{root}/shares", f"{root}/checkpoint").awaitTermination()
    return _start_text(row_stream.read_violation_counts(spark, f"{root}/shares")).withColumnRenamed("column", "column_name")


@query
def stream_sla(spark: SparkSession, sf_dir: str) -> DataFrame:
    stream = corpus.events_arrived(corpus.table_stream(spark, sf_dir, "events"))
    root, by = scratch_dir(spark, "stream"), ["event_type"]
    row_stream.stream_sla(stream, "ts", "arrival_ts", corpus.EVENTS_CONTRACT, "6 hours", f"{root}/shares", f"{root}/checkpoint", by).awaitTermination()
    return _start_text(row_stream.read_sla(spark, f"{root}/shares", by))


@query
def stream_violation_counts_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in several runs, most of them after their window was closed: counted, and counted apart."""
    root = scratch_dir(spark, "stream-late")

    def start(stream: DataFrame):
        dirty = corpus.events_dirty(stream)
        return row_stream.stream_violation_counts(dirty, "ts", corpus.EVENTS_CONTRACT, "1 day", f"{root}/windows", f"{root}/checkpoint")

    _runs(spark, corpus.table(spark, sf_dir, "events"), root, F.col("event_id") % BATCHES, start)
    return _start_text(row_stream.read_violation_counts(spark, f"{root}/windows", detail=True)).withColumnRenamed("column", "column_name")


@query
def stream_sla_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles per window from sketches merged over several runs, each held against the ranks of all rows."""
    root, by = scratch_dir(spark, "stream-percentiles"), ["event_type"]

    def start(stream: DataFrame):
        arrived = corpus.events_arrived(stream)
        return row_stream.stream_sla(arrived, "ts", "arrival_ts", corpus.EVENTS_CONTRACT, "5 days", f"{root}/windows", f"{root}/checkpoint", by)

    events = corpus.table(spark, sf_dir, "events")
    _runs(spark, events, root, F.col("event_id") % BATCHES, start)
    found = row_stream.read_sla(spark, f"{root}/windows", by, {"p50": 0.5, "p99": 0.99})
    rows = corpus.events_arrived(events).select("event_type", F.window("ts", "5 days")["start"].alias("window_start"), sla.latency_ms("ts", "arrival_ts").alias("ms"))
    joined = rows.join(found.drop("rows", "late", "max_ms", "met"), ["window_start", "event_type"])
    n = F.count(F.lit(1))

    def near(name: str, share: float) -> F.Column:
        """Whether the rank asked for lies among those of the value, give or take the error stated."""
        below, upto = F.count_if(F.col("ms") < F.col(name)) / n, F.count_if(F.col("ms") <= F.col(name)) / n
        slack = row_stream.RANK_ERROR + 1 / n
        return ((below - slack <= share) & (upto + slack >= share)).alias(f"{name}_near")

    return _start_text(joined.groupBy("window_start", "event_type").agg(n.alias("rows"), near("p50", 0.5), near("p99", 0.99)))
