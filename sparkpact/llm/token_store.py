"""Token ids of documents in a compressed store that opens one document at a time.

``write_store`` writes two Parquet folders below a path: ``dictionary`` (one row) and ``containers``. A row
of ``containers`` holds the bytes of one container, some hundred documents in ascending order of ``doc_id``
(nulls first; of one ``doc_id`` by a hash of the text). The layout, little-endian:

    6 bytes  mark ``TOKIDS``
    2 bytes  bytes of an id: 2 where all ids of the container fit, else 4
    32 bytes SHA-256 of the dictionary
    8 bytes  number of documents n
    n bytes  1 where doc_id is null
    8n bytes doc_ids
    8n bytes ids of each document, its end id included
    8(n + 1) bytes where each frame begins, counted from the end of this index
    frames, one zstandard frame for each document

Every frame is compressed by itself with one dictionary shared by all, so a short document costs few bytes and
can be read alone: ``read_document`` touches the index and one frame. The dictionary is trained on id arrays of
a bounded sample (``SAMPLE_DOCS`` documents of at most ``SAMPLE_BYTES``, drawn by a hash); it changes sizes only,
never ids. A reader checks its hash.

Defined results: null text is empty text, a document of the end id alone; an empty table gives a store without
containers; repeated rows are repeated documents.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkpact.llm.base import lean, record, sliced, utf8
from sparkpact.llm.tokens import encoder

MARK = b"TOKIDS"
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 2_000, 16_384, 65_536
CONTAINER_BYTES, CONTAINER_DOCS, LEVEL = 1 << 20, 1_000, 3
_HEAD = struct.Struct("<6sH32sq")
_CONTAINER = {"shard": pa.int32(), "number": pa.int64(), "n_docs": pa.int64(), "n_tokens": pa.int64(), "content": pa.binary()}


def train_dictionary(docs: DataFrame, vocabulary: str, end: int) -> bytes:
    """A zstandard dictionary from serialised ids of the sample; empty if the sample is too small to train on."""
    import zstandard

    small = docs.where(F.octet_length("text") <= SAMPLE_BYTES)
    share = min(1.0, 2 * SAMPLE_DOCS / max(1, docs.count()))
    # The hash is a signed number of 64 bits.
    drawn = small.where(F.xxhash64("doc_id", "text") <= F.lit(min((1 << 63) - 1, int(share * 2**64) - (1 << 63))))
    rows = drawn.select("text", F.xxhash64("doc_id", "text").alias("h")).limit(2 * SAMPLE_DOCS).collect()
    sample = [r["text"] for r in sorted(rows, key=lambda r: (r["h"], r["text"]))[:SAMPLE_DOCS]]
    arrays = []
    for begin in range(0, len(sample), 100):
        ids, at = encoder(vocabulary).encode(sample[begin : begin + 100], end)
        arrays += [serialised(ids[a:b]) for a, b in zip(at[:-1], at[1:])]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, arrays).as_bytes()
    except zstandard.ZstdError:
        return b""


def serialised(ids: np.ndarray, width: int = 2) -> bytes:
    return ids.astype("<u2" if width == 2 else "<u4").tobytes()


class Container:
    """Collects documents until it is full."""

    def __init__(self, dictionary: bytes):
        import zstandard

        self.hash = hashlib.sha256(dictionary).digest()
        self.shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=self.shared)
        self.docs: list = []
        self.counts: list[int] = []
        self.frames: list[bytes] = []
        self.size, self.width = 0, 2

    def fits(self, width: int) -> bool:
        full = self.size >= CONTAINER_BYTES or len(self.docs) >= CONTAINER_DOCS
        return not self.docs or (self.width == width and not full)

    def add(self, doc_id: int | None, ids: np.ndarray, width: int) -> None:
        self.width = width
        frame = self.compressor.compress(serialised(ids, width))
        self.docs.append(doc_id)
        self.counts.append(len(ids))
        self.frames.append(frame)
        self.size += len(frame)

    def close(self) -> tuple[int, int, bytes]:
        head = _HEAD.pack(MARK, self.width, self.hash, len(self.docs))
        nulls = np.array([d is None for d in self.docs], np.uint8)
        ids = np.array([d or 0 for d in self.docs], "<i8")
        at = np.concatenate(([0], np.cumsum([len(f) for f in self.frames]))).astype("<i8")
        content = b"".join((head, nulls.tobytes(), ids.tobytes(), np.array(self.counts, "<i8").tobytes(), at.tobytes(), *self.frames))
        out = (len(self.docs), sum(self.counts), content)
        self.docs, self.counts, self.frames, self.size = [], [], [], 0
        return out


class Reader:
    """Documents of one container; the index is read at once, frames when asked for."""

    def __init__(self, content: bytes, dictionary: bytes):
        import zstandard

        mark, self.width, known, n = _HEAD.unpack_from(content)
        if mark != MARK:
            raise ValueError("these bytes are no container of token ids")
        if known != hashlib.sha256(dictionary).digest():
            raise ValueError("this container was written with another dictionary")
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.decompressor = zstandard.ZstdDecompressor(dict_data=shared)
        self.content, at = memoryview(content), _HEAD.size
        nulls = np.frombuffer(content, np.uint8, n, at)
        docs = np.frombuffer(content, "<i8", n, at + n)
        self.docs = [None if x else int(d) for x, d in zip(nulls, docs)]
        self.counts = np.frombuffer(content, "<i8", n, at + 9 * n)
        self.at = np.frombuffer(content, "<i8", n + 1, at + 17 * n) + (at + 25 * n + 8)

    def ids(self, k: int) -> np.ndarray:
        frame = self.content[self.at[k] : self.at[k + 1]]
        raw = self.decompressor.decompress(frame, max_output_size=int(self.counts[k]) * self.width)
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4").astype("<u4")


def read_document(content: bytes, dictionary: bytes, k: int) -> np.ndarray:
    """The ids of document ``k`` of a container."""
    return Reader(content, dictionary).ids(k)


def write_store(docs: DataFrame, path: str, vocabulary: str, end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode all documents and write the store below ``path``, replacing what was there."""
    spark = docs.sparkSession
    docs = lean(docs, id_col, text_col).select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    dictionary = train_dictionary(docs, vocabulary, end)
    row = [(hashlib.sha256(dictionary).hexdigest(), bytearray(dictionary))]
    spark.createDataFrame(row, "dictionary_sha256 string, dictionary binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/dictionary")

    def containers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, box = TaskContext.get().partitionId(), 0, Container(dictionary)
        for part in sliced(batches):
            ids, at = encoder(vocabulary).encode_bytes(*utf8(part.column(1)), end)
            for doc_id, a, b in zip(part.column(0).to_pylist(), at[:-1], at[1:]):
                own = ids[a:b]
                width = 2 if int(own.max(initial=0)) < 1 << 16 else 4
                if not box.fits(width):
                    yield record(_CONTAINER, *([x] for x in (shard, number, *box.close())))
                    number += 1
                box.add(doc_id, own, width)
        if box.docs:
            yield record(_CONTAINER, *([x] for x in (shard, number, *box.close())))

    order = [F.col("doc_id").asc_nulls_first(), F.col("h")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = docs.withColumn("h", F.xxhash64("text")).repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    schema = "shard int, number bigint, n_docs bigint, n_tokens bigint, content binary"
    ordered.mapInArrow(containers, schema).write.mode("overwrite").option("compression", "uncompressed").parquet(f"{path}/containers")


def store_dictionary(spark: SparkSession, path: str) -> bytes:
    row = spark.read.parquet(f"{path}/dictionary").first()
    dictionary = bytes(row["dictionary"])
    if hashlib.sha256(dictionary).hexdigest() != row["dictionary_sha256"]:
        raise ValueError("the dictionary does not fit its hash")
    return dictionary


def _starts(containers: DataFrame) -> DataFrame:
    """Ids before each container: totals of whole shards are added up first, so no task sees all containers."""
    before = (Window.unboundedPreceding, -1)
    shards = containers.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    shards = shards.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(*before)), F.lit(0)).alias("base"))
    own = F.sum("n_tokens").over(Window.partitionBy("shard").orderBy("number").rowsBetween(*before))
    inside = containers.select("shard", "number", F.coalesce(own, F.lit(0)).alias("inside"))
    return inside.join(shards, "shard").select("shard", "number", (F.col("base") + F.col("inside")).alias("before"))


def read_store(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Documents of a store: ``doc_id, start, n_tokens, ids_crc32``, and ``ids`` unless ``with_ids`` is false."""
    dictionary = store_dictionary(spark, path)
    schema = {"shard": pa.int32(), "number": pa.int64(), "doc_id": pa.int64(), "inside": pa.int64(), "n_tokens": pa.int64(), "ids_crc32": pa.int64()}
    if with_ids:
        schema["ids"] = pa.list_(pa.int64())

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, number, content in zip(*(batch.column(i).to_pylist() for i in range(3))):
                box = Reader(content, dictionary)
                arrays = [box.ids(k) for k in range(len(box.docs))]
                inside = np.concatenate(([0], np.cumsum(box.counts)[:-1]))
                n = len(arrays)
                columns = [[shard] * n, [number] * n, box.docs, inside, [len(a) for a in arrays], [zlib.crc32(a.tobytes()) for a in arrays]]
                yield record(schema, *columns, *([[a.tolist() for a in arrays]] if with_ids else []))

    containers = spark.read.parquet(f"{path}/containers")
    ddl = "shard int, number bigint, doc_id bigint, inside bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    rows = containers.select("shard", "number", "content").mapInArrow(opened, ddl)
    rows = rows.join(_starts(containers), ["shard", "number"])
    more = ["ids"] if with_ids else []
    return rows.select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *more)
