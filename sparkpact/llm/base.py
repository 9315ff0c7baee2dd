"""What the operators share: bytes of text columns as numpy arrays, tables written once, rows kept whole.

Texts are handled as UTF-8 bytes, a batch at a time and never cut short. A null text counts as
empty unless an operator says otherwise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpact.session import materialize

#: Bytes of text that one step of a task works on at a time; a longer text is a step of its own.
STEP_BYTES = (1 << 20) - (1 << 16)
#: Bytes of rows that reach a task at a time, where the session does not say; a longer row comes alone.
BATCH_BYTES = "8m"
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Key of the rows of ``docs`` while an operator works on its own columns.
ROW = "__row"


def bounded(docs: DataFrame) -> DataFrame:
    """``docs``, from now on handed to tasks in batches of bounded bytes."""
    conf = docs.sparkSession.conf
    if conf.get(_BATCH_SETTING, None) is None:
        conf.set(_BATCH_SETTING, BATCH_BYTES)
    return docs


def lean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only the columns an operator reads, as ``doc_id, text`` and ``more``, whatever else there is."""
    return bounded(docs).select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *(F.col(f"`{c}`") for c in more))


def packed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text`` and the whole row as a struct, so that no name of the input can clash."""
    whole = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(ROW)
    return bounded(docs).select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), whole)


def unpacked(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(*(F.col(ROW).getField(c).alias(c) for c in columns))


def written(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read from there: survives lost executors.

    With ``by`` it is laid out by that column, and readers of one value read no other.
    """
    return materialize(df, f"llm-{label}", by)


def mapped(df: DataFrame, step: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, limit: int = STEP_BYTES) -> DataFrame:
    """``step`` on every bounded slice of every batch. Column 1 must be the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, limit=limit):
            out = step(part)
            if out is not None and out.num_rows:
                yield out
        # Workers live on: give back what this task needed.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def sliced(batches: Iterator[pa.RecordBatch], text: int = 1, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut between rows so that each holds about ``limit`` bytes of text, or one longer text."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(text_lengths(batch.column(text)))
        begin = 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def text_lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each text; 0 for null."""
    import pyarrow.compute as pc

    return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column one after another, and where each text begins, with the end of the last."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def record(schema: pa.Schema | dict, *columns) -> pa.RecordBatch:
    """Columns (arrays or lists) as a batch; ``schema`` maps names to Arrow types."""
    if isinstance(schema, dict):
        schema = pa.schema(list(schema.items()))
    return pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def scramble(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit values whose every bit depends on all bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every maximal run of true values."""
    edges = np.diff(np.concatenate(([0], mask.view(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


#: Base of the polynomials over 2**64, odd so that it has an inverse.
BASE = 0x9E3779B97F4A7C15
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """``base ** 0 .. base ** n`` modulo 2**64; kept per worker and grown by doubling."""
    have = _POWERS.get(base)
    if have is None or len(have) <= n:
        out = np.ones(1, np.uint64)
        while len(out) <= n:
            out = np.concatenate((out, out * np.uint64(pow(base, len(out), 1 << 64))))
        _POWERS[base] = have = out
    return have[: n + 1]


def prefix_sums(values: np.ndarray, base: int = BASE) -> np.ndarray:
    """``P[i] = sum(values[j] * base ** j for j < i)`` modulo 2**64."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values))[:-1], out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, begin: np.ndarray, end: np.ndarray, base: int = BASE) -> np.ndarray:
    """Hash of each span of values, the same wherever the span lies."""
    inverse = powers(pow(base, -1, 1 << 64), len(prefix) - 1)
    return scramble((prefix[end] - prefix[begin]) * inverse[begin] + (end - begin).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def byte_values() -> np.ndarray:
    """A fixed odd 64-bit value for each byte, so that polynomials over 2**64 mix well."""
    return scramble(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


BYTE_VALUES = byte_values()
