"""From raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkpact.llm import contamination, exact_dedup, language, near_dups, packing, tokens
from sparkpact.session import scratch_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return language.keep_identified(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.exact_dedup(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links connect: five-word shingles, similarity 0.75 or more."""
    return near_dups.one_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return contamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, each with its sequence and its place there."""
    pieces = packing.token_pieces(docs, tokens.public_vocabulary("word_bpe_49k.json"), with_ids=False)
    return packing.pack(pieces).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("ngram_jaccard_join", without_near_copies),
    ("decontamination", without_benchmark),
    ("packing", sequences),
]

#: Naive Bayes, suffix arrays and token ids are not for SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written below ``spark.checkpoint.dir`` and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_dir(spark, f"llm-pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
