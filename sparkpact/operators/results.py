"""What came of a run: one row per contract, one row for the run, counts by status."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The third status vocabulary, and the reason that is no failure.
FILE_NOT_FOUND = "File not found"

VALIDATION = ("file_path", "validate_status", "build_status", "reason")
SCHEMA = ("file_path", "schema_status", "registry_version")
TABLE = ("file_path", "table_name", "table_status", "columns_count")


def _last_per_contract(results: DataFrame, fields: tuple[str, ...], to: str) -> DataFrame:
    """A contract in several files is what the last of them, by path, says."""
    present = results.where(F.col("contract_id").isNotNull() & (F.col("contract_id") != ""))
    return present.groupBy("contract_id").agg(F.max_by(F.struct(*fields), "file_path").alias(to))


def collect_results(validation: DataFrame, schema: DataFrame, tables: DataFrame) -> DataFrame:
    """``contract_id`` with the structs ``validation``, ``schema`` and ``table``, NULL where a step has no result.

    Each input is reduced to one row per contract before the three are joined, so
    no key of the join occurs twice.
    """
    merged = _last_per_contract(validation, VALIDATION, "validation")
    merged = merged.join(_last_per_contract(schema, SCHEMA, "schema"), "contract_id", "full_outer")
    return merged.join(_last_per_contract(tables, TABLE, "table"), "contract_id", "full_outer")


def run_summary(validation: DataFrame, schema: DataFrame, tables: DataFrame, strict: bool = False) -> DataFrame:
    """One row: counts, ``ready`` and ``actions`` (what to fix).

    Ready if all files are valid and every contract is registered and has its
    table; what is only planned is not done. Tables that needed no change count as done and invalid files as not
    done; ``strict`` restores the older gate, which looked at contracts instead of
    files and counted only created and updated tables.
    """
    ids = (
        validation.select("contract_id").unionByName(schema.select("contract_id")).unionByName(tables.select("contract_id"))
    ).where(F.col("contract_id").isNotNull() & (F.col("contract_id") != ""))
    total = ids.agg(F.count_distinct("contract_id").alias("total_contracts"))
    v = validation.agg(F.count(F.lit(1)).alias("total_files"), F.count_if(F.col("validate_status") == "valid").alias("validation_passed"))
    s = schema.agg(
        F.count_if(F.col("schema_status") == "registered").alias("schema_registered"),
        F.count_if(F.col("schema_status") == "planned").alias("schema_planned"),
        F.count_if(F.col("schema_status") == "failed").alias("schema_failed"),
        F.count(F.lit(1)).alias("schema_results"),
    )
    t = tables.agg(
        *[F.count_if(F.col("table_status") == name).alias(f"tables_{name}") for name in ("created", "updated", "unchanged", "failed")],
        F.count_if(F.col("table_status").startswith("planned_")).alias("tables_planned"),
        F.count(F.lit(1)).alias("table_results"),
    )
    # Four one-row tables side by side.
    one = total.withColumn("_", F.lit(1))
    for part in (v, s, t):
        one = one.join(part.withColumn("_", F.lit(1)), "_")
    done = F.col("tables_created") + F.col("tables_updated")
    if strict:
        goal = F.col("total_contracts")
        valid_ok, schema_ok, table_ok = F.col("validation_passed") >= goal, F.col("schema_registered") >= goal, done >= goal
        exact = (F.col("validation_passed") == goal) & (F.col("schema_registered") == goal) & (done == goal)
    else:
        valid_ok = F.col("validation_passed") == F.col("total_files")
        schema_ok = F.col("schema_registered") == F.col("schema_results")
        table_ok = done + F.col("tables_unchanged") == F.col("table_results")
        exact = valid_ok & schema_ok & table_ok
    actions = F.array_compact(
        F.array(
            F.when(~valid_ok, F.lit("fix validation errors")),
            F.when(F.col("schema_failed") > 0 if not strict else ~schema_ok, F.lit("fix schema registration")),
            F.when(F.col("tables_failed") > 0 if not strict else ~table_ok, F.lit("fix table creation")),
            F.when(F.col("schema_planned") + F.col("tables_planned") > 0, F.lit("apply what is planned")),
        )
    )
    return one.select(
        "total_files",
        "total_contracts",
        "validation_passed",
        "schema_registered",
        "schema_planned",
        "schema_failed",
        "tables_created",
        "tables_updated",
        "tables_unchanged",
        "tables_planned",
        "tables_failed",
        (exact & (F.col("total_contracts") > 0)).alias("ready"),
        actions.alias("actions"),
    )


def file_status(docs: DataFrame) -> DataFrame:
    """``file, status, contract_name, reason`` of loaded documents, as PASSED, FAILED or SKIPPED.

    Skipped are files that are no JSON by name, and listed files that were not
    there (``raw`` is null).
    """
    missing = F.col("raw").isNull() if "raw" in docs.columns else F.lit(False)
    skipped = ~F.col("file_path").endswith(".json") | missing
    passed = F.col("build_status") == "built"
    status: Column = F.when(skipped, "SKIPPED").when(passed, "PASSED").otherwise("FAILED")
    reason = F.when(missing, FILE_NOT_FOUND).when(skipped, "Not a JSON file").when(F.coalesce(passed, F.lit(False)), F.lit(None)).otherwise(F.col("reason"))
    contract_name = F.when(F.array_contains("errors.code", "invalid_json") | skipped, F.lit(None)).otherwise(F.coalesce("document_name", F.lit("unknown")))
    return docs.select(F.col("file_path").alias("file"), status.alias("status"), contract_name.alias("contract_name"), reason.alias("reason"))


def status_counts(results: DataFrame) -> DataFrame:
    """One row: ``total, passed, failed, skipped, ok``; ok unless a file failed that was there."""
    return results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("status") == "PASSED").alias("passed"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
        F.count_if(F.col("status") == "SKIPPED").alias("skipped"),
        (F.count_if((F.col("status") == "FAILED") & ~F.col("reason").eqNullSafe(FILE_NOT_FOUND)) == 0).alias("ok"),
    )


def failed_files(results: DataFrame) -> DataFrame:
    return results.where(F.col("status") == "FAILED").select("file", "reason")


def export_results(results: DataFrame, path: str) -> None:
    """Results and their summary as JSON, below one folder."""
    root = path.rstrip("/")
    results.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{root}/results")
    status_counts(results).write.mode("overwrite").json(f"{root}/summary")
