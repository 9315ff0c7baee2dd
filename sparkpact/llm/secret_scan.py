"""Secrets in texts and in everything that is encoded inside them.

A text is scanned by the rules, then every part of it that looks encoded is decoded, and what comes out is put on
a worklist, scanned and searched for encoded parts in turn, until nothing new appears. Four layers are
unwrapped, in any nesting:

- URL: the whole layer with every ``%XX`` decoded;
- Unicode: the whole layer with every ``\\uXXXX``, ``\\xXX`` and ``&#N;`` decoded;
- base64, standard and URL-safe alphabet, of 16 characters and more (12 bytes, the shortest secret a rule finds),
  in one line and over consecutive lines, read at all four alignments because ``/``, ``-``, ``_`` and letters in
  front join a run;
- compressed: gzip, zlib, bzip2, xz and zstandard anywhere in the bytes behind base64 or behind the escapes of a URL or a
  literal, all streams that follow each other.

Every decoded layer is scanned, text or not: bytes that are no UTF-8 are replaced, the others stay, and what may be
UTF-16 is read as that too. The rules decide; a binary file without secrets matches none.

A layer is followed once for each place it came from: a worklist entry whose content and place were seen is
dropped, so layers that contain themselves end. Each character of a layer remembers the span of the text it came
from (exactly for URL and Unicode, the whole encoded part for base64 and compression), so spans of all layers are
spans of the text, in code points, end exclusive. Spans found in the text itself always stay; layers add to
them. Output of a decompressor beyond ``DECODED_BYTES`` is scanned in blocks of that size, which overlap by ``OVERLAP``,
as it is read; a span of kind ``oversize`` tells of it beside what is found. A secret that lies over a border is whole in
one block, as is what is encoded in up to ``OVERLAP`` bytes inside.

Defined results: null text is empty text, without spans; an empty table gives an empty result; repeated rows are
repeated rows.
"""

from __future__ import annotations

import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpact.llm.base import lean, mapped, record, texts

KINDS = ("assign", "access", "hex", "oversize")
DECODED_BYTES, OVERLAP = 64 << 20, 1 << 20

# Matches are taken leftmost and without overlap, and then those that fail the length are dropped.
_ASSIGN = re.compile(r"""(?ai)(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")  # a run of fewer fails

_URL = re.compile(r"%[0-9A-Fa-f]{2}")
_URL_RUN = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|&#(?:[0-9]{1,7}|x[0-9A-Fa-f]{1,6});")
#: Escapes among which literals of bytes are written, and what the short ones stand for.
_SHORT = dict(zip("abfnrtv0\\'\"", "\a\b\f\n\r\t\v\0\\'\""))
_BYTE_ESCAPE = re.compile(_ESCAPE.pattern + r"""|\\[abfnrtv0\\'"]""")
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
#: Runs on consecutive lines, indented or not; each is tried once, from its begin, and not given back.
_WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]++(?:[ \t]*+(?:\r\n?|\n)[ \t]*+[A-Za-z0-9+/_-]++)+={0,2}")
_STANDARD = str.maketrans("-_", "+/")
#: ASCII as UTF-16, of 12 characters and more: rules and encodings are ASCII, and no secret is shorter.
_WIDE = {"utf-16-le": re.compile(rb"(?:[\t-~]\0){12,}"), "utf-16-be": re.compile(rb"(?:\0[\t-~]){12,}")}
#: How gzip, zlib (the headers without a dictionary), bzip2, xz and zstandard begin.
_MAGIC = re.compile(rb"\x1f\x8b\x08|\x78[\x01\x5e\x9c\xda]|BZh[1-9]|\xfd7zXZ\x00|\x28\xb5\x2f\xfd")
#: Bytes that a decompressor gets at a time, few because they may stand for many.
FED = 256

Span = tuple[int, str, int]


def scan(text: str) -> list[tuple[str, int, int]]:
    """Kind, begin and end of what the rules find."""
    out = []
    for m in _ASSIGN.finditer(text):
        if m.end(1) - m.start(1) >= 6:
            out.append(("assign", m.start(), m.end()))
    for m in _ACCESS.finditer(text):
        if m.end() - m.start() >= 20:
            out.append(("access", m.start(), m.end()))
    for m in _HEX.finditer(text):
        out.append(("hex", m.start(), m.end()))
    return out


@dataclass
class Layer:
    """Some text, and for each of its characters the span it came from and whether it was decoded.

    The text itself has no arrays: each character is its own place and none was decoded.
    """

    text: str
    begin: np.ndarray | None = None
    end: np.ndarray | None = None
    decoded: np.ndarray | None = None

    def span(self, a: int, b: int) -> tuple[int, int]:
        """The span of the whole text behind characters ``a`` to ``b`` (one at least)."""
        if self.begin is None:
            return a, b
        return int(self.begin[a:b].min()), int(self.end[a:b].max())

    def inside(self, text: str, a: int, b: int) -> Layer:
        """A layer all of whose characters came from ``a`` to ``b`` of this one."""
        begin, end = self.span(a, b)
        return Layer(text, *(np.broadcast_to(x, len(text)) for x in (np.int64(begin), np.int64(end), np.True_)))

    def replaced(self, parts: list[tuple[int, int, str]]) -> Layer:
        """This layer with some parts decoded, in order, each to one character."""
        text, out, at = self.text, [], 0
        for a, b, new in parts:
            out += [text[at:a], new]
            at = b
        out.append(text[at:])
        a, b = (np.array([x[i] for x in parts], np.int64) for i in (0, 1))
        inner = np.zeros(len(text) + 1, np.int8)
        inner[a + 1] += 1
        inner[b] -= 1
        begin = np.flatnonzero(np.cumsum(inner[:-1]) == 0)  # where each character of the new text begins in this one
        decoded = np.zeros(len(begin), bool) if self.decoded is None else self.decoded[begin]
        decoded[np.searchsorted(begin, a)] = True
        if self.begin is None:
            return Layer("".join(out), begin, np.append(begin[1:], len(text)), decoded)
        return Layer("".join(out), np.minimum.reduceat(self.begin, begin), np.maximum.reduceat(self.end, begin), decoded)


def _url_parts(text: str) -> list[tuple[int, int, str]]:
    """Each escaped byte run as characters; a character of several bytes stands for all of its escapes."""
    out = []
    for m in _URL_RUN.finditer(text):
        raw = bytes.fromhex(m.group().replace("%", ""))
        at = m.start()
        for c in raw.decode("utf-8", "surrogateescape"):
            n = 1 if "\udc80" <= c <= "\udcff" else len(c.encode())
            out.append((at, at + 3 * n, "�" if "\udc80" <= c <= "\udcff" else c))
            at += 3 * n
    return out


def _escape_parts(text: str) -> list[tuple[int, int, str]]:
    out: list[tuple[int, int, str]] = []
    high = None  # a first half of a pair waiting for its second
    for m in _ESCAPE.finditer(text):
        own = m.group()
        if own[0] == "&":
            code = int(own[3:-1], 16) if own[2] == "x" else int(own[2:-1])
        else:
            code = int(own[2:], 16)
        if high and high[1] == m.start() and 0xDC00 <= code < 0xE000:
            out[-1] = (high[0], m.end(), chr(0x10000 + ((high[2] - 0xD800) << 10) + code - 0xDC00))
            high = None
            continue
        high = (m.start(), m.end(), code) if 0xD800 <= code < 0xDC00 else None
        valid = code < 0x110000 and not 0xD800 <= code < 0xE000
        out.append((m.start(), m.end(), chr(code) if valid else "�"))
    return out


def _byte(escape: str) -> str:
    """The byte an escape stands for, as the character of that number."""
    if escape[0] == "%":
        return chr(int(escape[1:], 16))
    if escape[0] == "&":
        code = int(escape[3:-1], 16) if escape[2] == "x" else int(escape[2:-1])
    else:
        code = int(escape[2:], 16) if len(escape) > 2 else ord(_SHORT[escape[1]])
    return chr(code) if code < 256 else "?"


def _decompressor(magic: bytes):
    if magic[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if magic[:1] == b"\x78":
        return zlib.decompressobj()
    if magic[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if magic[:1] == b"\xfd":
        return lzma.LZMADecompressor()
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj()


class _Run:
    """What compressed streams hold that follow each other without a gap, piece after piece.

    ``end`` is where reading ended, ``resume`` where the next search begins: behind a stream that is whole, else one byte
    further than its begin.
    """

    def __init__(self, data: bytes, at: int):
        self.data, self.end, self.resume = data, at, at

    def __iter__(self) -> Iterator[bytes]:
        whole = True
        while whole and _MAGIC.match(self.data, self.end):
            begins, whole = self.end, False
            machine, place = _decompressor(self.data[begins : begins + 6]), begins
            while place < len(self.data) and not machine.eof:
                try:
                    out = machine.decompress(self.data[place : place + FED])
                except (zlib.error, OSError, lzma.LZMAError, EOFError, ValueError):
                    break
                except Exception as error:
                    if type(error).__name__ == "ZstdError":
                        break
                    raise
                place = min(place + FED, len(self.data))
                whole = machine.eof
                self.end = place - len(machine.unused_data) if whole else place
                yield out
            self.resume = self.end if whole else begins + 1


def _blocks(run: _Run) -> Iterator[bytes]:
    """A long run in blocks of ``DECODED_BYTES`` that overlap, so that what lies over a border is whole in one of them."""
    overlap, held = min(OVERLAP, DECODED_BYTES // 4), bytearray()
    for out in run:
        held += out
        while len(held) > DECODED_BYTES:
            yield bytes(held[:DECODED_BYTES])
            del held[: DECODED_BYTES - overlap]
    yield bytes(held)


def streams(data: bytes) -> Iterator[tuple[bytes | None, int, int]]:
    """What is compressed in the bytes, wherever it begins, and its place.

    Streams that follow each other are one. More than ``DECODED_BYTES`` is told by ``None`` and comes in overlapping blocks;
    it is read a first time to learn where it ends, so no more than a block of it is ever held.
    """
    at = 0
    while m := _MAGIC.search(data, at):
        run, held, size = _Run(data, m.start()), [], 0
        for out in run:
            size += len(out)
            held.append(out)
            if size > DECODED_BYTES:
                held.clear()
        at = run.resume
        if size > DECODED_BYTES:
            yield None, m.start(), run.end
            for block in _blocks(_Run(data, m.start())):
                yield block, m.start(), run.end
        elif size:
            yield b"".join(held), m.start(), run.end


def _as_texts(data: bytes) -> Iterator[str]:
    """The bytes as text, fit to read or not, and also as UTF-16 where some of them may be."""
    if data:
        yield data.decode("utf-8", "replace")
    for codec, wide in _WIDE.items():
        for parity in sorted({m.start() % 2 for m in wide.finditer(data)}) if b"\0" in data else ():
            yield data[parity:].decode(codec, "replace")


def contents(data: bytes | None) -> Iterator[bytes | None]:
    """The bytes, and what is in any number of compressions inside them; ``None`` for what is too large."""
    seen: set[bytes] = set()
    open_ = [iter([(data, 0, 0)])]
    while open_:
        found = next(open_[-1], None)
        if found is None:
            open_.pop()
            continue
        data = found[0]
        mark = None if data is None else hashlib.sha256(data).digest()
        if mark not in seen:
            yield data
        if mark and mark not in seen:
            seen.add(mark)
            open_.append(streams(data))


def _base64_runs(text: str) -> Iterator[tuple[int, int, str]]:
    """Runs of base64 characters in one line, then those that go on from line to line; without line ends and padding."""
    for m in _BASE64.finditer(text):
        yield m.start(), m.end(), m.group().rstrip("=")
    if "\n" in text or "\r" in text:
        for m in _WRAPPED.finditer(text):
            body = "".join(m.group().rstrip("=").split())
            if len(body) >= 16:
                yield m.start(), m.end(), body


def _base64_bytes(body: str) -> Iterator[bytes]:
    """A run read from each of its first four characters, as a word or path in front may have joined it."""
    body = body.translate(_STANDARD)
    for k in range(4):
        n = len(body) - k
        own = body[k : len(body) - (n % 4 == 1)]
        yield binascii.a2b_base64(own + "=" * (-len(own) % 4))


def layers_of(layer: Layer) -> Iterator[Layer | tuple[int, int]]:
    """What one step of decoding makes of a layer; a pair of places for what is too large."""
    text = layer.text
    for parts_of, escape, marks in ((_url_parts, _URL, ("%",)), (_escape_parts, _BYTE_ESCAPE, ("\\", "&#"))):
        if any(mark in text for mark in marks) and (parts := parts_of(text)):
            yield layer.replaced(parts)
            view = layer.replaced([(*m.span(), _byte(m.group())) for m in escape.finditer(text)])
            for out, a, b in streams(view.text.encode("latin-1", "replace")):
                yield from _inner(out, view, a, b)
    for a, b, body in _base64_runs(text):
        # What neither holds nor touches a decoded character was found in the layer before.
        if layer.decoded is not None and not layer.decoded[max(0, a - 1) : b + 1].any():
            continue
        for data in _base64_bytes(body):
            yield from _inner(data, layer, a, b)


def _inner(data: bytes | None, layer: Layer, a: int, b: int) -> Iterator[Layer | tuple[int, int]]:
    """The layers of bytes that were behind characters ``a`` to ``b``."""
    for own in contents(data):
        if own is None:
            yield layer.span(a, b)
            continue
        for text in _as_texts(own):
            yield layer.inside(text, a, b)


def find_secrets(text: str) -> tuple[list[tuple[str, int, int]], set[tuple[str, int, int]]]:
    """Spans in the text itself, and all spans with those of its layers."""
    base = scan(text)
    spans = set(base)
    work, seen = [Layer(text)], set()
    while work:
        for found in layers_of(work.pop()):
            if isinstance(found, tuple):
                spans.add(("oversize", *found))
                continue
            place = found.span(0, len(found.text)) if found.text else (0, 0)
            mark = (hashlib.sha256(found.text.encode("utf-8", "surrogatepass")).digest(), place)
            if not found.text or mark in seen:
                continue
            seen.add(mark)
            # What holds no decoded character was there to be found before.
            spans.update((kind, *found.span(a, b)) for kind, a, b in scan(found.text) if found.decoded[a:b].any())
            work.append(found)
    return base, spans


def in_order(spans) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def secret_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, base, spans``, arrays of ``kind, begin, end`` in order of begin and kind."""
    span = pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())])
    schema = {"doc_id": pa.int64(), "base": pa.list_(span), "spans": pa.list_(span)}

    def entries(found) -> list[dict]:
        return [{"kind": k, "begin": a, "end": b} for k, a, b in in_order(found)]

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [find_secrets(x) for x in texts(batch.column(1))]
        return record(schema, batch.column(0), [entries(b) for b, _ in found], [entries(s) for _, s in found])

    kind = "array<struct<kind:string,begin:bigint,end:bigint>>"
    docs = lean(docs, id_col, text_col).select(F.col("doc_id").cast("bigint"), "text")
    return mapped(docs, step, f"doc_id bigint, base {kind}, spans {kind}")
