"""Conversations as text for training: typed content parts, one template, a loss mask, and the way back.

A turn's content is a text or a list of typed parts: text, image, audio, document. A visitor walks the parts in order:
text is escaped and written, any other part becomes a placeholder, whose attachment (kind, reference, place, and how many
tokens it expands to in the model) is recorded beside the text.

The template writes ``<|im_start|>role``, a line end, the content, ``<|im_end|>`` and a line end for each turn. All
control strings begin with ``<|``. In texts and roles every ``<``, any number of backslashes, ``|`` gets one backslash
more, so nothing that came in as text is ever read as control, and one backslash less gives the text back.

``format_conversations`` deals turns out by ranges of (conversation, turn), so a conversation with a third of all rows
lies over many tasks, and returns segments: whole turns of one conversation, of about ``SEGMENT_CHARS`` characters, in the
order of ``shard, number``. No conversation is ever held whole. ``conversation_digests`` parses the segments and streams
them, in order, through running digests. A SHA-256 of a conversation has to see it in order, in one task, which holds a
segment at a time.

Defined results: null content is an empty text, a null role an empty role; turns are in order of ``turn``, nulls first,
of one number by role and content; repeated rows are repeated turns; rows without a conversation id are one
conversation; parts that are null are left out, parts of another kind are written ``<|file|>`` and expand to nothing; an
empty table gives no rows; columns beyond those named are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from sparkpact.llm.base import bounded, record, written

SEGMENT_CHARS = 1 << 18

# Control strings.
START, END = "<|im_start|>", "<|im_end|>"
PLACEHOLDERS = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>", "other": "<|file|>"}

#: Columns of a typed part; a text part has a text, the others a reference and what their size is told by.
PART = "kind string, text string, ref string, width int, height int, seconds double, pages int"

_ATTACHMENT = pa.struct([("turn", pa.int32()), ("kind", pa.string()), ("ref", pa.string()), ("at", pa.int64()), ("tokens", pa.int64())])
_SPAN = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
_SEGMENT = {"conv_id": pa.int64(), "shard": pa.int32(), "number": pa.int64(), "text": pa.string(), "n_turns": pa.int64(),
            "loss": pa.list_(_SPAN), "attachments": pa.list_(_ATTACHMENT), "expanded_tokens": pa.int64()}
_SEGMENT_DDL = (
    "conv_id bigint, shard int, number bigint, text string, n_turns bigint, loss array<struct<begin:bigint,end:bigint>>, "
    "attachments array<struct<turn:int,kind:string,ref:string,at:bigint,tokens:bigint>>, expanded_tokens bigint"
)


def escaped(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescaped(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def escaped_role(role: str) -> str:
    """As a text, and on one line."""
    return escaped(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))


@dataclass(frozen=True)
class Expansion:
    """How many tokens a part takes in the model. What a part does not say of its size counts as its default."""

    patch: int = 28
    image_default: int = 256
    tokens_per_second: float = 25.0
    audio_default: int = 750
    tokens_per_page: int = 512

    def image(self, part: dict) -> int:
        if not part.get("width") or not part.get("height"):
            return self.image_default
        return math.ceil(part["width"] / self.patch) * math.ceil(part["height"] / self.patch)

    def audio(self, part: dict) -> int:
        seconds = part.get("seconds")
        return self.audio_default if seconds is None or not math.isfinite(seconds) else math.ceil(max(0.0, seconds) * self.tokens_per_second)

    def document(self, part: dict) -> int:
        return max(1, part.get("pages") or 1) * self.tokens_per_page

    def other(self, part: dict) -> int:
        return 0


class Segment:
    """Visits the parts of turns and writes them one after another."""

    def __init__(self, conv_id: int | None, expansion: Expansion, loss_role: str):
        self.conv_id, self.expansion, self.loss_role = conv_id, expansion, loss_role
        self.pieces: list[str] = []
        self.size = self.turns = self.tokens = 0
        self.loss: list[dict] = []
        self.attachments: list[dict] = []

    def write(self, piece: str) -> None:
        self.pieces.append(piece)
        self.size += len(piece)

    def turn(self, role: str | None, content: str | list | None) -> None:
        self.write(f"{START}{escaped_role(role or '')}\n")
        parts = [{"kind": "text", "text": content}] if content is None or isinstance(content, str) else content
        # Neighbouring texts are one text: a control string could otherwise come about where they meet.
        texts: list[str] = []
        for part in parts:
            if part is None:
                continue
            if part["kind"] == "text":
                texts.append(part.get("text") or "")
                continue
            self.visit_text("".join(texts), role)
            texts = []
            getattr(self, f"visit_{part['kind']}", self.visit_other)(part)
        self.visit_text("".join(texts), role)
        self.write(f"{END}\n")
        self.turns += 1

    def visit_text(self, text: str, role: str | None) -> None:
        begin = self.size
        self.write(escaped(text))
        if role == self.loss_role and self.size > begin:
            self.loss.append({"begin": begin, "end": self.size})

    def visit_image(self, part: dict) -> None:
        self._attach("image", part)

    def visit_audio(self, part: dict) -> None:
        self._attach("audio", part)

    def visit_document(self, part: dict) -> None:
        self._attach("document", part)

    def visit_other(self, part: dict) -> None:
        self._attach("other", part)

    def _attach(self, kind: str, part: dict) -> None:
        tokens = getattr(self.expansion, kind)(part)
        name = part["kind"] if kind == "other" else kind
        self.attachments.append({"turn": self.turns, "kind": name, "ref": part.get("ref"), "at": self.size, "tokens": tokens})
        self.tokens += tokens
        self.write(PLACEHOLDERS[kind])

    def row(self, shard: int, number: int) -> tuple:
        return self.conv_id, shard, number, "".join(self.pieces), self.turns, self.loss, self.attachments, self.tokens


def _batched(rows: Iterator[tuple], schema: dict, size_of, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= limit or len(held) >= 4096:
            yield record(schema, *zip(*held))
            held, size = [], 0
    if held:
        yield record(schema, *zip(*held))


def format_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    content_col: str = "text",
    loss_role: str = "assistant",
    expansion: Expansion = Expansion(),
    segment_chars: int = SEGMENT_CHARS,
) -> DataFrame:
    """Segments of formatted text: ``conv_id, shard, number, text, n_turns, loss, attachments, expanded_tokens``, written once.

    ``content_col`` is a text or an array of parts (``PART``; columns may be missing). ``loss`` has the spans of ``text``
    that are trained on, ``attachments`` the place of each placeholder and the turn of the segment it is in.
    """
    content = F.col(f"`{content_col}`")
    is_typed = isinstance(turns.schema[content_col].dataType, ArrayType)
    # Of one number turns are in order of role and content.
    tie = F.to_json(content) if is_typed else content
    rows = bounded(turns).select(
        F.col(f"`{conv_col}`").cast("bigint").alias("conv_id"), F.col(f"`{turn_col}`").cast("bigint").alias("turn"), F.col(f"`{role_col}`").alias("role"),
        content.alias("content"), tie.alias("tie"),
    )
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Many turns under one number are dealt out by what their content begins with, in the order they are written in.
    dealt = rows.repartitionByRange(parts, "conv_id", "turn", "role", F.substring("tie", 1, 64))
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "tie").drop("tie")

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        shard, number, own = TaskContext.get().partitionId(), 0, None
        for batch in batches:
            for i in range(batch.num_rows):
                conv_id, _, role, content = (column[i].as_py() for column in batch.columns)
                if own is not None and (own.conv_id != conv_id or own.size >= segment_chars):
                    yield own.row(shard, number)
                    number, own = number + 1, None
                own = own or Segment(conv_id, expansion, loss_role)
                own.turn(role, content)
        if own is not None:
            yield own.row(shard, number)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(segments(batches), _SEGMENT, lambda row: len(row[3]))

    return written(ordered.mapInArrow(run, _SEGMENT_DDL), "conversations")


def parsed_turns(text: str) -> Iterator[tuple[str, str]]:
    """Role and content of each turn of a segment, as they came in; placeholders stand for attachments."""
    at = 0
    while at < len(text):
        head = text.index("\n", at)
        end = text.index(END, head)
        yield unescaped_role(text[at + len(START) : head]), unescaped(text[head + 1 : end])
        at = end + len(END) + 1


def read_turns(segments: DataFrame) -> DataFrame:
    """One row per turn, read back from the formatted text: ``conv_id, shard, number, place, role, text``."""
    schema = {"conv_id": pa.int64(), "shard": pa.int32(), "number": pa.int64(), "place": pa.int32(), "role": pa.string(), "text": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (
            (*(batch.column(c)[i].as_py() for c in range(3)), k, role, text)
            for batch in batches for i in range(batch.num_rows) for k, (role, text) in enumerate(parsed_turns(batch.column(3)[i].as_py()))
        )
        yield from _batched(rows, schema, lambda row: len(row[5]))

    lean = segments.select("conv_id", "shard", "number", "text")
    return lean.mapInArrow(run, "conv_id bigint, shard int, number bigint, place int, role string, text string")


class _Running:
    """Counts and digests of one conversation, segment after segment."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.turns, self.loss_chars, self.chars = conv_id, 0, 0, 0
        self.whole, self.loss = hashlib.sha256(), hashlib.sha256()

    def take(self, text: str, loss: list[dict]) -> None:
        for role, content in parsed_turns(text):
            self.whole.update(f"{role}\n{content}\n".encode())
            self.turns += 1
        for span in loss:
            trained = unescaped(text[span["begin"] : span["end"]])
            self.loss.update(trained.encode())
            self.loss_chars += len(trained)
        self.chars += len(text)

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.whole.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def conversation_digests(segments: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of each conversation, all from its segments."""
    schema = {"conv_id": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(), "loss_sha256": pa.string(),
              "formatted_chars": pa.int64()}

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        own = None
        for batch in batches:
            for i in range(batch.num_rows):
                conv_id, text, loss = (batch.column(c)[i].as_py() for c in (0, 3, 4))
                if own is None or own.conv_id != conv_id:
                    if own is not None:
                        yield own.row()
                    own = _Running(conv_id)
                own.take(text, loss)
        if own is not None:
            yield own.row()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(digested(batches), schema, lambda row: 200)

    lean = bounded(segments).select("conv_id", "shard", "number", "text", "loss")
    ordered = lean.repartition("conv_id").sortWithinPartitions("conv_id", "shard", "number")
    return ordered.mapInArrow(run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
