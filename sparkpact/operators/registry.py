"""The registry: which definitions are accepted, and what to do with a new one.

A registry is a table with one row per accepted version of a contract, stored as
parquet below a folder: one sub-folder per load, in it one per hash of the contract,
in that one file, ordered by contract (more where a file would grow beyond what a
task should write). Load ids are in order: a load is planned against those before it, and
loading again under the same id replaces that load alone. So a retried or replayed
job leaves the registry it left before. ``compact_registry`` puts loads together.

Documents may land late, before versions that are registered. A load then takes back
what earlier loads hold of the contract from a place on, and brings it again as it is
decided now. Which contracts, and from where, stands beside its rows, in a folder of
its own (``WITHDRAWN``) that is written in the same commit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from sparkpact.functions.ordered import HOT_ROWS
from sparkpact.operators import folding
from sparkpact.operators.avro import to_avro
from sparkpact.operators.documents import COLUMN_TYPE, built_contracts
from sparkpact.operators.folding import CHUNK
from sparkpact.operators.tags import tag_map, typed_tags
from sparkpact.operators.versions import (
    KEY,
    MODES,
    OFFENDING_TYPE,
    definition_hash,
    first_declared,
    forward_all_offences,
    pair_offences,
    side_by_side,
)
from sparkpact.session import materialize

# What an entry says of its format.
DATA_FORMAT = "AVRO"
DEFAULT_MODE = "FORWARD_ALL"
AVAILABLE = "AVAILABLE"

REGISTRY_SCHEMA = (
    "contract_id string, registry_version bigint, seq bigint, file_path string, version string, description string, "
    "definition_hash string, "
    f"avro_schema string, columns {COLUMN_TYPE}, tags map<string,string>, data_format string, compatibility string"
)


# Folders of a load. Contracts spread over them by hash, the same in every load.
BUCKETS = 16
# The folder of what a load takes back, beside those of its rows.
WITHDRAWN = -1


def bucket_of(contract_id: Column) -> Column:
    return F.pmod(F.xxhash64(contract_id), F.lit(BUCKETS)).cast("int")


def read_registry(spark: SparkSession, path: str, before_load: str | None = None) -> DataFrame:
    """All accepted versions, with their ``load_id`` and ``bucket``; no rows if nothing was ever loaded.

    With ``before_load`` only loads whose id sorts before it: what the registry was then.
    Filters on ``bucket`` reach the scan and skip whole folders (``get_schema`` and ``of_contracts`` set them).
    """
    try:
        stored = spark.read.schema(f"{REGISTRY_SCHEMA}, load_id string, bucket int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{REGISTRY_SCHEMA}, load_id string, bucket int")
    if before_load is not None:
        stored = stored.where(F.col("load_id") < before_load)
    rows, withdrawn = stored.where(F.col("bucket") >= 0), stored.where(F.col("bucket") == WITHDRAWN)
    # No job if there is no such folder. Only contracts with late documents have lines there, one per load that had some.
    if withdrawn.isEmpty():
        return rows
    marks = withdrawn.groupBy("contract_id").agg(F.collect_list(F.struct("load_id", "seq", "file_path")).alias("_marks"))
    place = F.struct("seq", "file_path")
    gone = F.exists("_marks", lambda m: (m["load_id"] > F.col("load_id")) & (F.struct(m["seq"], m["file_path"]) <= place))
    return rows.join(marks, "contract_id", "left").where(~F.coalesce(gone, F.lit(False))).drop("_marks").select(*rows.columns)


def compact_registry(spark: SparkSession, path: str, to: str, before_load: str) -> None:
    """All loads before ``before_load`` written to the new registry ``to`` as one load under the last of their ids.

    What was taken back is left out. The old registry stays as it is; readers go over when they are given the new folder.
    """
    rows = read_registry(spark, path, before_load)
    last = rows.agg(F.max("load_id")).first()[0]
    if last is not None:
        _write_load(rows.drop("load_id", "bucket"), to, last)


def write_buckets(rows: DataFrame, path: str, order: list[str]) -> None:
    """``rows`` below ``path``, replacing what is there, in folders by bucket and ordered in each.

    One file per bucket, or several of the advisory size where a bucket is large: adaptive execution splits it.
    """
    if "bucket" not in rows.columns:
        rows = rows.withColumn("bucket", bucket_of(F.col("contract_id")))
    dealt = rows.hint("rebalance", F.col("bucket")).sortWithinPartitions("bucket", *order)
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)


def _write_load(rows: DataFrame, path: str, load_id: str) -> None:
    write_buckets(rows, f"{path.rstrip('/')}/load_id={load_id}", ["contract_id", "registry_version"])


def latest_versions(registry: DataFrame) -> DataFrame:
    """The current entry of each contract, with the next version number and parsed schema."""
    newest = registry.groupBy("contract_id").agg(F.max_by(F.struct(*[c for c in registry.columns if c != "contract_id"]), "registry_version").alias("e"))
    entry = typed_tags(newest.select("contract_id", "e.*"), to="metadata")
    return entry.select(
        F.col("contract_id").alias("schema_name"),
        F.col("registry_version").alias("latest_version"),
        (F.col("registry_version") + 1).alias("next_version"),
        F.lit(AVAILABLE).alias("status"),
        "description",
        "data_format",
        "compatibility",
        "metadata",
        "definition_hash",
        "columns",
        F.try_parse_json("avro_schema").alias("schema"),
    )


def list_schemas(registry: DataFrame) -> DataFrame:
    return registry.groupBy(F.col("contract_id").alias("schema_name")).agg(F.max("registry_version").alias("latest_version"))


def get_schema(registry: DataFrame, contract_id: str) -> DataFrame:
    """One contract's current entry; no row for an unknown id. Reads the one folder of a load that can hold it."""
    if "bucket" in registry.columns:
        registry = registry.where(F.col("bucket") == bucket_of(F.lit(contract_id)))
    return latest_versions(registry.where(F.col("contract_id") == contract_id))


def of_contracts(registry: DataFrame, rows: DataFrame) -> DataFrame:
    """What the registry has of the contracts in ``rows``: a batch never aggregates all the rest.

    Folders that hold none of them are not read: the driver learns which buckets occur, at most ``BUCKETS`` numbers.
    """
    names = rows.select("contract_id").distinct()
    return _in_buckets_of(registry, names).join(names, "contract_id", "left_semi")


def _in_buckets_of(table: DataFrame, names: DataFrame) -> DataFrame:
    if "bucket" not in table.columns:
        return table
    held = [r[0] for r in names.select(bucket_of(F.col("contract_id"))).distinct().collect()]
    return table if len(held) == BUCKETS else table.where(F.col("bucket").isin(held))


def candidates(docs: DataFrame, order: str = "seq", mode: str = DEFAULT_MODE) -> DataFrame:
    """Built documents as registry rows that have no number yet; ``file_path`` tells equal ``seq`` apart."""
    entries = to_avro(built_contracts(docs))
    return entries.select(
        F.col("contract.contract_id").alias("contract_id"),
        F.col(order).cast("bigint").alias("seq"),
        "file_path",
        F.col("contract.version").alias("version"),
        F.col("contract.description").alias("description"),
        definition_hash(F.col("avro_schema")).alias("definition_hash"),
        "avro_schema",
        F.col("contract.columns").alias("columns"),
        tag_map(F.col("contract")).alias("tags"),
        F.lit(DATA_FORMAT).alias("data_format"),
        F.lit(mode).alias("compatibility"),
    )


def newest_candidates(docs: DataFrame, order: str = "seq", mode: str = DEFAULT_MODE) -> DataFrame:
    """One candidate per contract, the last in order."""
    rows = candidates(docs, order, mode)
    payload = F.struct(*[c for c in rows.columns if c != "contract_id"])
    last = rows.groupBy("contract_id").agg(F.max_by(payload, F.struct("seq", "file_path")).alias("e"))
    return last.select("contract_id", "e.*")


def plan_registration(registry: DataFrame, one_each: DataFrame, mode: str = DEFAULT_MODE) -> DataFrame:
    """What to do with one candidate per contract: ``action``, ``registry_version``, ``offending``.

    create, new_version, unchanged (the text is the registered one, whatever the
    label says) or rejected (not compatible; nothing is registered).
    """
    if mode not in MODES:
        raise ValueError(f"unknown compatibility mode {mode!r}")
    # Read by every branch below: written once, not worked out again for each.
    one_each = materialize(one_each, "candidates")
    registry = of_contracts(registry, one_each)
    current = registry.groupBy("contract_id").agg(
        F.max_by(F.struct("registry_version", "definition_hash", "columns"), "registry_version").alias("current")
    )
    known = one_each.join(current, "contract_id", "left")
    if mode == "FORWARD_ALL":
        declared = first_declared(registry.select("contract_id", F.col("registry_version").alias("seq"), F.lit("").alias("file_path"), "columns"))
        # Any number after the last will do as the candidate's place in history.
        place = F.struct(F.lit(2**62).cast("bigint").alias("seq"), F.lit("").alias("file_path"))
        known = known.join(declared, "contract_id", "left")
        known = known.withColumn("offending", forward_all_offences(F.col("columns"), place)).drop("declared")
    else:
        known = known.withColumn("offending", pair_offences(side_by_side(F.col("current.columns"), F.col("columns")), mode))
    action = (
        F.when(F.col("current").isNull(), "create")
        .when(F.col("current.definition_hash") == F.col("definition_hash"), "unchanged")
        .when(F.size(F.coalesce("offending", F.array().cast(OFFENDING_TYPE))) == 0, "new_version")
        .otherwise("rejected")
    )
    return (
        known.withColumn("action", action)
        .withColumn("offending", F.when(F.col("action") == "rejected", F.col("offending")).otherwise(F.array().cast(OFFENDING_TYPE)))
        .withColumn(
            "registry_version",
            F.coalesce("current.registry_version", F.lit(0)) + F.when(F.col("action").isin("create", "new_version"), 1).otherwise(0),
        )
        .drop("current")
    )


# -- whole histories -----------------------------------------------------------


def plan_history(
    rows: DataFrame,
    mode: str = DEFAULT_MODE,
    registry: DataFrame | None = None,
    chunk: int = CHUNK,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """What to do with any number of candidates per contract, in order of ``seq`` and path.

    Rejected versions are folded out: each is held against what was accepted
    before it. Adds ``action`` and ``registry_version`` to the rows of ``candidates``.
    Decisions are made on keys, hashes and columns; texts and tags are joined to them at the end. ``rows`` are read
    several times, so give a written table rather than documents still to be parsed.
    """
    state = None if registry is None else folding.registered_state(of_contracts(registry, rows), mode)
    return rows.join(folding.decide(rows, mode, state, chunk, hot_rows), list(KEY))


def apply_registration(plan: DataFrame, path: str, load_id: str) -> None:
    """Write what a plan accepts as one load; the same load id replaces that load.

    Plan with ``read_registry(..., before_load=load_id)``, and a retry, even of a
    job that died half way, ends in the same registry.
    """
    _write_load(accepted(plan), path, load_id)


def accepted(plan: DataFrame) -> DataFrame:
    """The rows a plan adds to the registry."""
    names = [part.split()[0] for part in REGISTRY_SCHEMA.split(", ")]
    return plan.where(F.col("action").isin("create", "new_version")).select(*names)


# -- documents in any order ------------------------------------------------------


def register_landed(spark: SparkSession, earlier: DataFrame, new: DataFrame, path: str, load_id: str, mode: str = DEFAULT_MODE) -> None:
    """Register the candidates of ``new`` as one load, wherever in their contracts' histories they belong.

    ``earlier`` has all candidates that landed before, both tables their ``bucket`` and the ``batch_id`` they came in; a document that landed again under its key counts as it came last. Each contract of
    ``new`` is decided anew from its earliest new version on, from what was accepted before that. So the registry is
    what one load of all landed documents would have left, in whatever order they came. Contracts that ``new`` does
    not have are not read.
    """
    place = F.struct("seq", "file_path")
    since = materialize(new.groupBy("contract_id").agg(F.min(place).alias("_since")), "touched")
    known = _in_buckets_of(read_registry(spark, path, before_load=load_id), since).join(since, "contract_id")
    before = known.where(place < F.col("_since")).drop("_since")

    earlier, again = _in_buckets_of(earlier, since), new
    if not earlier.isEmpty():
        later = earlier.join(since, "contract_id").where(place >= F.col("_since")).drop("_since").unionByName(new)
        payload = [c for c in later.columns if c not in (*KEY, "batch_id")]
        # Read by the decisions and for the texts of what they accept: written once.
        again = materialize(later.groupBy(*KEY).agg(F.max_by(F.struct(*payload), "batch_id").alias("_last")).select(*KEY, "_last.*"), "again")
    rows = accepted(plan_history(again, mode, before))

    # Only where something is taken back is there a line.
    gone = known.where(place >= F.col("_since")).groupBy("contract_id").agg(F.first("_since").alias("_since"))
    marks = gone.select("contract_id", F.col("_since.seq").alias("seq"), F.col("_since.file_path").alias("file_path"), F.lit(WITHDRAWN).alias("bucket"))
    _write_load(rows.withColumn("bucket", bucket_of(F.col("contract_id"))).unionByName(marks, allowMissingColumns=True), path, load_id)
