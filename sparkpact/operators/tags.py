"""Contract metadata as a map of tags, and typed again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Tag names in the order they are written, and the two constant tags.
MANAGED_BY = "airflow-dag"
SOURCE = "data-contract"
METADATA_TAGS = {
    "DataOwner": "data_owner",
    "DataOwnerEmail": "data_owner_email",
    "DataSteward": "data_steward",
    "DataStewardEmail": "data_steward_email",
    "SLAUptimePercentage": "sla_uptime_percentage",
    "SLAMaxLatencyMs": "sla_max_latency_ms",
}


def tag_map(contract: Column) -> Column:
    pairs = [F.lit("ManagedBy"), F.lit(MANAGED_BY), F.lit("Source"), F.lit(SOURCE)]
    pairs += [F.lit("ContractVersion"), contract["version"]]
    for tag, key in METADATA_TAGS.items():
        pairs += [F.lit(tag), contract["metadata"][key].cast("string")]
    return F.create_map(*pairs)


def tags(docs: DataFrame) -> DataFrame:
    """``tags``: nine texts for each contract."""
    return docs.withColumn("tags", F.when(F.col("contract").isNotNull(), tag_map(F.col("contract"))))


def typed_tags(df: DataFrame, tags_col: str = "tags", to: str = "tag_metadata") -> DataFrame:
    """The tags as typed values; NULL where a tag is absent or no number."""

    def tag(name: str) -> Column:
        return F.try_element_at(F.col(tags_col), F.lit(name))

    typed = {"sla_uptime_percentage": "double", "sla_max_latency_ms": "bigint"}
    fields = [
        (tag(name).try_cast(typed[key]) if key in typed else tag(name)).alias(key) for name, key in METADATA_TAGS.items()
    ]
    return df.withColumn(
        to,
        F.struct(
            *fields,
            tag("ContractVersion").alias("contract_version"),
            tag("ManagedBy").alias("managed_by"),
            tag("Source").alias("source"),
        ),
    )
