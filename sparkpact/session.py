"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # Documents that repeat a key keep its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows that reach a Python task at a time are bounded by bytes; a longer row comes alone.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings; partition counts stay with the cluster."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    # Files that are named one by one, as those of a stream's batch, are looked for by a task each unless told otherwise.
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", spark.conf.get("spark.sql.shuffle.partitions"))
    return spark


def _scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="sparkpact-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/sparkpact/{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder named by ``spark.checkpoint.dir``.

    Only a local session that names no folder (as in tests) gets one of its own.
    """
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch of this application; results that were not written yet are lost with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder once and go on from the written table.

    For tables that several later steps read: it cuts lineage, lets each step
    read only its columns, and is still there when executors are lost. With ``by``
    the table is laid out by the values of that column.
    """
    path = scratch_dir(df.sparkSession, label)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
