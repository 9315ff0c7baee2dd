"""Fill-in-the-middle over texts kept as seekable compressed frames.

``store_frames`` keeps each text as independent zstandard frames of at most ``FRAME_BYTES`` bytes, cut between code
points, with an index: how many units, code points and bytes lie before each frame, and the totals. A unit is a run of
the letters A-Z and a-z or any other single code point; one that goes on over a cut counts for the frame it begins in,
so no unit, however long, makes a frame longer.

``fill_in_middle`` draws two cuts in units from a hash of the document's id. The index names the frame of each cut, and
only those are decompressed. The transformed text is frames again: whole frames are taken over as they are, what is
left of cut frames is compressed anew. ``digests`` and ``output_texts`` stream the frames of one document in order;
``restored_texts`` finds the marks in the output and reads the three parts in the order of the text, by seeking.

Memory of a task is bounded by a batch of rows and one frame; the longest text is a row of its own, held compressed
after the first step. Nothing is shuffled.

Defined results: a null text is an empty text; empty texts, texts that hold a mark and those not drawn stay as they
are (``plain``; their ``prefix_chars`` and ``middle_chars`` are null); a null id is drawn as the empty string; repeated
rows and ids are rows of their own; an empty table gives no rows; other columns of the input are not read, so no name
of theirs clashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpact.llm.base import lean, mapped, record, utf8, written

FRAME_BYTES, LEVEL = 1 << 16, 3

# The marks of the contract, and which part each begins.
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}

_COUNTS = pa.list_(pa.int64())
_FRAMES = pa.list_(pa.binary())
_STORE = {"doc_id": pa.int64(), "draw": pa.string(), "marked": pa.bool_(), "units": _COUNTS, "chars": _COUNTS, "bytes": _COUNTS, "frames": _FRAMES}
_STORE_DDL = "doc_id bigint, draw string, marked boolean, units array<bigint>, chars array<bigint>, bytes array<bigint>, frames array<binary>"
_OUT = {"doc_id": pa.int64(), "n": pa.int64(), "form": pa.string(), "prefix_chars": pa.int64(), "middle_chars": pa.int64(), "bytes": _COUNTS, "frames": _FRAMES}
_OUT_DDL = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, bytes array<bigint>, frames array<binary>"

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def code_points(data: np.ndarray) -> np.ndarray:
    """Where a code point begins."""
    return (data & 0xC0) != 0x80


def unit_starts(data: np.ndarray, before: int = 0) -> np.ndarray:
    """Where a unit begins, in bytes that follow the byte ``before``."""
    letter = _LETTER[data]
    starts = code_points(data)
    starts[1:] &= ~(letter[1:] & letter[:-1])
    if len(data):
        starts[0] &= not (letter[0] and _LETTER[before])
    return starts


def _begins(points: np.ndarray, begin: int, end: int, size: int) -> np.ndarray:
    """Where frames begin: every ``size`` bytes, moved back to a code point; a frame that would be empty is left out."""
    at = np.arange(begin, end, size)
    for _ in range(3):
        at = at - ~points[at]
    return np.unique(at)


def store_frames(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """One row per document, written once: its frames and their index, whether it holds a mark, and its draw."""
    import zstandard

    rows = lean(docs, id_col, text_col)
    name = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = rows.select(F.col("doc_id").cast("bigint"), "text", F.sha2(F.concat(F.lit(f"{seed}:"), name), 256).alias("draw"))

    def step(part: pa.RecordBatch) -> pa.RecordBatch:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        data, at = utf8(part.column(1))
        points = code_points(data)
        starts = unit_starts(data)
        # Texts lie one after another: a text begins a unit, whatever the one before it ended in.
        starts[at[:-1][at[:-1] < at[1:]]] = True
        blob = data.tobytes()
        may_hold = any(m in blob for m in MARKS.values())
        ends = list(zip(at[:-1].tolist(), at[1:].tolist()))
        begins = [_begins(points, a, b, frame_bytes) for a, b in ends]
        flat = np.concatenate([np.zeros(0, np.int64), *begins])
        units, chars = (np.add.reduceat(x, flat, dtype=np.int64) if len(flat) else flat for x in (starts, points))
        columns: tuple[list, ...] = ([], [], [], [], [])
        k = 0
        for (a, b), own in zip(ends, begins):
            cuts, here = [*own.tolist(), b], slice(k, k + len(own))
            k += len(own)
            values = (
                may_hold and any(blob.find(m, a, b) >= 0 for m in MARKS.values()),
                [0, *np.cumsum(units[here]).tolist()],
                [0, *np.cumsum(chars[here]).tolist()],
                [c - a for c in cuts],
                [compressor.compress(blob[x:y]) for x, y in zip(cuts[:-1], cuts[1:])],
            )
            for column, value in zip(columns, values):
                column.append(value)
        return record(_STORE, part.column(0), part.column(2), *columns)

    return written(mapped(rows, step, _STORE_DDL), "frames")


class Frames:
    """A text as frames; reads any range of its bytes, one frame at a time."""

    def __init__(self, starts: list[int], frames: list[bytes]):
        import zstandard

        self.starts, self.frames = starts, frames
        self.decompressor = zstandard.ZstdDecompressor()
        self.held: tuple[int, bytes] = (-1, b"")

    def frame(self, k: int) -> bytes:
        if self.held[0] != k:
            self.held = (k, self.decompressor.decompress(self.frames[k]))
        return self.held[1]

    def ranges(self, begin: int, end: int) -> Iterator[tuple[int, int, int]]:
        """Number of each frame that holds bytes of the range, and which of its bytes."""
        k = max(0, int(np.searchsorted(self.starts, begin, side="right")) - 1)
        while k < len(self.frames) and self.starts[k] < end:
            yield k, max(0, begin - self.starts[k]), min(end, self.starts[k + 1]) - self.starts[k]
            k += 1

    def read(self, begin: int, end: int) -> Iterator[bytes]:
        for k, a, b in self.ranges(begin, end):
            yield self.frame(k)[a:b]

    def locate(self, unit: int, units: list[int], chars: list[int]) -> tuple[int, int]:
        """Bytes and code points before a unit; decompresses the one frame the unit begins in."""
        if unit >= units[-1]:
            return self.starts[-1], chars[-1]
        k = int(np.searchsorted(units, unit, side="right")) - 1
        data = np.frombuffer(self.frame(k), np.uint8)
        # The frame begins inside a run of letters if its first code point is no unit; only units that begin here are counted.
        begins = np.flatnonzero(unit_starts(data))
        if units[k + 1] - units[k] < len(begins):
            begins = begins[1:]
        at = int(begins[unit - units[k]])
        return self.starts[k] + at, chars[k] + int(code_points(data[:at]).sum())


class _Writer:
    """Frames of an output: whole frames are passed on, bytes between them are compressed."""

    def __init__(self, compressor):
        self.compressor = compressor
        self.starts, self.frames, self.open, self.size = [0], [], [], 0

    def bytes(self, data: bytes, limit: int) -> None:
        self.open.append(data)
        self.size += len(data)
        if self.size >= limit:
            self.close()

    def close(self) -> None:
        if self.size:
            self.frames.append(self.compressor.compress(b"".join(self.open)))
            self.starts.append(self.starts[-1] + self.size)
        self.open, self.size = [], 0

    def range(self, source: Frames, begin: int, end: int, limit: int) -> None:
        for k, a, b in source.ranges(begin, end):
            size = source.starts[k + 1] - source.starts[k]
            if b - a == size and size >= limit // 2:
                self.close()
                self.frames.append(source.frames[k])
                self.starts.append(self.starts[-1] + size)
            else:
                self.bytes(source.frame(k)[a:b], limit)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Row by row, so that only one row is held as Python objects."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield tuple(column[i].as_py() for column in batch.columns)


def _batches(rows: Iterator[tuple], schema: dict, size_of, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= limit or len(held) >= 4096:
            yield record(schema, *zip(*held))
            held, size = [], 0
    if held:
        yield record(schema, *zip(*held))


def fill_in_middle(store: DataFrame, fim_percent: int = 90, spm_percent: int = 20, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars`` and the output as ``frames``, with the ``bytes`` before each.

    ``n`` counts units. The four leading groups of eight hex digits of the draw decide: the lesser and the greater of two
    cuts, whether the text is transformed, and in which order.
    """
    import zstandard

    def transformed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        compressor = zstandard.ZstdCompressor(level=LEVEL)
        for doc_id, draw, marked, units, chars, starts, frames in _rows(batches):
            h = [int(draw[i : i + 8], 16) for i in range(0, 32, 8)]
            n = units[-1]
            if n == 0 or marked or h[2] % 100 >= fim_percent:
                yield doc_id, n, "plain", None, None, starts, frames
                continue
            form = "spm" if h[3] % 100 < spm_percent else "psm"
            source = Frames(starts, frames)
            (a, a_chars), (b, b_chars) = (source.locate(u, units, chars) for u in sorted((h[0] % (n + 1), h[1] % (n + 1))))
            spans = {"prefix": (0, a), "middle": (a, b), "suffix": (b, starts[-1])}
            out = _Writer(compressor)
            for part in ORDERS[form]:
                out.bytes(MARKS[part], frame_bytes)
                out.range(source, *spans[part], frame_bytes)
            out.close()
            yield doc_id, n, form, a_chars, b_chars - a_chars, out.starts, out.frames

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(transformed(batches), _OUT, lambda row: sum(map(len, row[6])))

    return store.mapInArrow(run, _OUT_DDL)


def _parts(form: str, source: Frames) -> dict[str, tuple[int, int]]:
    """Where the parts lie in an output: the marks are found in the order of its form, reading it once."""
    order, found, at, tail = ORDERS[form], [], 0, b""
    for chunk in source.read(0, source.starts[-1]):
        tail, base = tail + chunk, at - len(tail)
        at += len(chunk)
        begin = 0
        while len(found) < 3 and (hit := tail.find(MARKS[order[len(found)]], begin)) >= 0:
            found.append(base + hit)
            begin = hit + 3
        # A mark may lie over the border of two frames.
        tail = tail[max(begin, len(tail) - 2) :]
    ends = [*found[1:], source.starts[-1]]
    return {part: (begin + 3, end) for part, begin, end in zip(order, found, ends)}


def _restored(form: str, source: Frames) -> Iterator[bytes]:
    if form == "plain":
        yield from source.read(0, source.starts[-1])
        return
    spans = _parts(form, source)
    for part in ("prefix", "middle", "suffix"):
        yield from source.read(*spans[part])


def _sha256(chunks: Iterator[bytes]) -> str:
    digest = hashlib.sha256()
    for chunk in chunks:
        digest.update(chunk)
    return digest.hexdigest()


def digests(transformed: DataFrame) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256``; the last of the text rebuilt from the output."""
    schema = {k: v for k, v in _OUT.items() if k not in ("bytes", "frames")} | {"output_sha256": pa.string(), "restored_sha256": pa.string()}

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for *own, starts, frames in _rows(batches):
            source = Frames(starts, frames)
            yield *own, _sha256(source.read(0, starts[-1])), _sha256(_restored(own[2], source))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(digested(batches), schema, lambda row: 200)

    ddl = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output_sha256 string, restored_sha256 string"
    return transformed.mapInArrow(run, ddl)


def _texts(transformed: DataFrame, read) -> DataFrame:
    schema = {"doc_id": pa.int64(), "form": pa.string(), "text": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((row[0], row[2], b"".join(read(row[2], Frames(row[5], row[6]))).decode()) for row in _rows(batches))
        yield from _batches(rows, schema, lambda row: len(row[2]))

    return transformed.mapInArrow(run, "doc_id bigint, form string, text string")


def output_texts(transformed: DataFrame) -> DataFrame:
    """``doc_id, form, text``: the transformed texts themselves."""
    return _texts(transformed, lambda form, source: source.read(0, source.starts[-1]))


def restored_texts(transformed: DataFrame) -> DataFrame:
    """``doc_id, form, text``: the texts as they were, rebuilt from the outputs alone."""
    return _texts(transformed, _restored)
