"""Exact duplicates by composable polynomial fingerprints.

Two texts are equal when they are identical after every run of ``[\\x20\\x09-\\x0D]`` became one space.
A fingerprint is a polynomial of the bytes modulo a prime at two fixed points, with the length. It
composes: the fingerprint of ``a + b`` is that of ``a`` plus that of ``b`` shifted by ``len(a)``. So a
text of more than ``chunk_bytes`` is cut into chunks that are hashed in parallel, anywhere, and added up.

Equal fingerprints are no proof. The members of every group are compared chunk by chunk: per chunk
number, the least and the greatest chunk of the group are kept while the chunks stream by, and all are
equal exactly when these two are. No task holds a group, and a group of any size shrinks to one row per
chunk before it is shuffled. A group that fails is split by the SHA-256 of its texts.

Texts of any length: a task holds one text and its normalised form, and cuts it in one pass.

Defined results: null text is empty text; null ``doc_id`` sorts after all others, so it is kept only if
no other row has the text; of repeated rows (same text and ``doc_id``) one is kept; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkpact.llm.base import ROW, STEP_BYTES, lean, mapped, packed, record, sliced, unpacked, utf8, written

PRIME = (1 << 31) - 1
#: Points at which the polynomials are taken.
POINTS = (1_103_515_245, 1_664_525_999)
CHUNK_BYTES = 1 << 20
BLANKS = r"[\x20\x09-\x0D]+"

_SCHEMA = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "fp1": pa.int64(), "fp2": pa.int64(), "text_sha256": pa.string()}
_TABLES: dict[tuple[int, int], np.ndarray] = {}


def _table(point: int, n: int) -> np.ndarray:
    """Powers of ``point`` modulo ``PRIME``; ``n`` at least."""
    have = _TABLES.get((point, 0))
    if have is None or len(have) < n:
        have = np.ones(1, np.int64)
        while len(have) < n:
            have = np.concatenate((have, have * pow(point, len(have), PRIME) % PRIME))
        _TABLES[point, 0] = have
    return have


def fingerprint(data: np.ndarray, point: int, chunk_bytes: int = CHUNK_BYTES) -> int:
    """Sum of ``data[i] * point ** i`` modulo ``PRIME``, a chunk at a time."""
    total = 0
    for begin in range(0, len(data), chunk_bytes):
        chunk = data[begin : begin + chunk_bytes]
        own = int(np.dot(chunk.astype(np.int64), _table(point, len(chunk))[: len(chunk)])) % PRIME
        total = shifted_sum(total, own, begin, point)
    return total


def shifted_sum(left: int, right: int, length: int, point: int) -> int:
    """Fingerprint of a text from those of its first ``length`` bytes and of the rest."""
    return (left + right * pow(point, length, PRIME)) % PRIME


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with every run of blanks as one space, and their new offsets."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    repeat = np.zeros(len(data), bool)
    repeat[1:] = blank[1:] & blank[:-1]
    begins = offsets[:-1]
    repeat[begins[begins < len(data)]] = False
    keep = ~repeat
    counts = np.concatenate(([0], np.cumsum(keep)))
    return np.where(blank, np.uint8(32), data)[keep], counts[offsets]


def _fingerprints(points: tuple[int, int]):
    def prints(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = normalised(*utf8(batch.column(1)))
        parts = [data[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        hashes = [[fingerprint(x, point) for x in parts] for point in points]
        return record(_SCHEMA, batch.column(0), np.diff(offsets), *hashes, [hashlib.sha256(x).hexdigest() for x in parts])

    return prints


def _chunks(chunk_bytes: int):
    """``doc_id, text_sha256, task, number, chunk``: normalised texts cut one after another, a chunk leaving at a time."""
    schema = {"doc_id": pa.int64(), "text_sha256": pa.string(), "task": pa.int32(), "number": pa.int32(), "chunk": pa.binary()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for part in sliced(batches):
            data, offsets = normalised(*utf8(part.column(1)))
            for doc_id, a, b in zip(part.column(0).to_pylist(), offsets[:-1].tolist(), offsets[1:].tolist()):
                sha = hashlib.sha256(data[a:b]).hexdigest()
                for number, at in enumerate(range(a, b, chunk_bytes)):
                    yield record(schema, [doc_id], [sha], [task], [number], [data[at : min(b, at + chunk_bytes)].tobytes()])

    return cut


def _chunk_terms(chunk_bytes: int, points: tuple[int, int]):
    schema = {"doc_id": pa.int64(), "text_sha256": pa.string(), "number": pa.int32(), "n_bytes": pa.int64(), "fp1": pa.int64(), "fp2": pa.int64()}

    def terms(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(batch.column(1))
        numbers = batch.column(3).to_pylist()
        parts = [data[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        found = [[shifted_sum(0, fingerprint(x, point), n * chunk_bytes, point) for x, n in zip(parts, numbers)] for point in points]
        return record(schema, batch.column(0), batch.column(2), batch.column(3), np.diff(offsets), *found)

    return terms


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, points: tuple[int, int] = POINTS
) -> DataFrame:
    """``doc_id, n_bytes, fp1, fp2, text_sha256`` of every row, of the normalised text."""
    docs = lean(docs, id_col, text_col)
    docs = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    schema = "doc_id bigint, n_bytes bigint, fp1 bigint, fp2 bigint, text_sha256 string"
    short = mapped(docs.where(F.octet_length("text") <= chunk_bytes), _fingerprints(points), schema)
    # Chunks of long texts are dealt out, hashed where they land and added up.
    long = docs.where(F.octet_length("text") > chunk_bytes)
    cut = long.mapInArrow(_chunks(chunk_bytes), "doc_id bigint, text_sha256 string, task int, number int, chunk binary")
    dealt = cut.repartition("text_sha256", "number", "task").select("doc_id", "chunk", "text_sha256", "number")
    terms = mapped(dealt, _chunk_terms(chunk_bytes, points), "doc_id bigint, text_sha256 string, number int, n_bytes bigint, fp1 bigint, fp2 bigint")
    # Repeated rows have each of their chunks as often; they are added once and come back as rows.
    values = ("n_bytes", "fp1", "fp2")
    once = terms.groupBy("doc_id", "text_sha256", "number").agg(*(F.min(c).alias(c) for c in values), F.count(F.lit(1)).alias("copies"))
    sums = once.groupBy("doc_id", "text_sha256").agg(
        F.sum("n_bytes").alias("n_bytes"), *((F.sum(c) % F.lit(PRIME)).alias(c) for c in ("fp1", "fp2")), F.min("copies").alias("copies")
    )
    each = sums.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))
    return short.unionByName(each.select("doc_id", *values, "text_sha256"))


def _compared(docs: DataFrame, shared: DataFrame, chunk_bytes: int, points: tuple[int, int] = POINTS) -> DataFrame:
    """Fingerprints under which the texts are not all equal: ``n_bytes, fp1, fp2``."""
    schema = {"n_bytes": pa.int64(), "fp1": pa.int64(), "fp2": pa.int64(), "number": pa.int32(), "chunk": pa.binary()}

    def chunked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches):
            data, offsets = normalised(*utf8(part.column(1)))
            rows, held = [], 0
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
                key = (b - a, *(fingerprint(data[a:b], point) for point in points))
                for number, at in enumerate(range(a, b, chunk_bytes)):
                    rows.append((*key, number, data[at : min(b, at + chunk_bytes)].tobytes()))
                    held += len(rows[-1][-1])
                    if held >= STEP_BYTES:
                        yield record(schema, *zip(*rows))
                        rows, held = [], 0
            if rows:
                yield record(schema, *zip(*rows))

    ids = shared.select(F.col("doc_id").alias("id")).distinct().hint("shuffle_hash")
    members = docs.join(ids, docs["doc_id"].eqNullSafe(F.col("id")), "left_semi")
    rows = members.select("doc_id", "text").mapInArrow(chunked, "n_bytes bigint, fp1 bigint, fp2 bigint, number int, chunk binary")
    extremes = rows.groupBy("n_bytes", "fp1", "fp2", "number").agg(F.min("chunk").alias("least"), F.max("chunk").alias("most"))
    return extremes.where("least <> most").select("n_bytes", "fp1", "fp2").distinct()


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, points: tuple[int, int] = POINTS
) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256, n_bytes``."""
    prints = written(fingerprints(docs, id_col, text_col, chunk_bytes, points), "fingerprints")
    key = ["n_bytes", "fp1", "fp2"]
    # Groups are written, so that joins with them are plain ones, whose hot keys are split at run time.
    sizes = written(prints.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*key), "shared")
    shared = prints.join(sizes, key, "left_semi")
    texts = lean(docs, id_col, text_col).select(F.col("doc_id").cast("bigint"), "text")
    differ = written(_compared(texts, shared, chunk_bytes, points).withColumn("differ", F.lit(True)), "differ")
    # Texts of one fingerprint are one group unless the comparison said otherwise.
    prints = prints.join(differ, key, "left").withColumn("part", F.when(F.col("differ"), F.col("text_sha256")).otherwise("")).drop("differ")
    key = [*key, "part"]
    groups = written(prints.groupBy(*key).agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")), "groups")
    turn = F.row_number().over(Window.partitionBy(*key, "doc_id").orderBy("doc_id"))
    first = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 1)
    return (
        prints.withColumn("turn", turn)
        .join(groups, key)
        .select("doc_id", "keep_id", "group_size", first.alias("kept"), "text_sha256", "n_bytes")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    kept = exact_groups(docs, id_col, text_col, chunk_bytes).where("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"))
    rows = packed(docs, id_col, text_col)
    rows = rows.withColumn("sha", F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), BLANKS, " "), 256))
    rows = rows.select(F.col("doc_id").cast("bigint").alias("id"), "sha", ROW).withColumn(
        "turn", F.row_number().over(Window.partitionBy("id", "sha").orderBy(F.lit(0)))
    )
    same = F.col("k.sha").eqNullSafe(F.col("r.sha")) & F.col("k.id").eqNullSafe(F.col("r.id"))
    return unpacked(rows.where("turn = 1").alias("r").join(kept.alias("k"), same, "left_semi"), docs.columns)
