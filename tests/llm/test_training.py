"""Fill-in-the-middle, chat formatting and vector codes against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
from brute import corner_rows, fill_in_middle as fim_rows, frame, rows_of, vector_codes as code_rows

from sparkpact.llm import chat, fill_in_middle, vector_codes


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- fill in the middle ------------------------------------------------------------


def fim_corner():
    r = random.Random(5)
    rows = corner_rows() + [(20, "has a <S> mark"), (21, "<P"), (22, "a" * 500), (23, "<<P <S é<M 语言 " * 30), (24, "🙂é" * 50), (25, "x")]
    return rows + [(i, "".join(r.choice("ab <P>SM\né语🙂") for _ in range(r.randrange(80)))) for i in range(100, 200)]


@pytest.mark.parametrize("size", [1, 7, 64, fill_in_middle.FRAME_BYTES])
def test_fim_equals_brute_force(spark, size):
    """Frames shorter than a code point, a mark, a run of letters; and of ordinary size."""
    rows = fim_corner()
    store = fill_in_middle.store_frames(frame(spark, rows), frame_bytes=size)
    made = fill_in_middle.fill_in_middle(store, frame_bytes=size)
    expected = fim_rows(rows)
    found = rows_of(fill_in_middle.digests(made), "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
    texts = sorted(((r[0], r[1] or "") for r in rows), key=repr)
    assert [f[:6] for f in found] == sorted(((*e[:5], sha(e[5])) for e in expected), key=repr)
    assert sorted((f[0] is None, f[0] or 0, f[6]) for f in found) == sorted((t[0] is None, t[0] or 0, sha(t[1])) for t in texts)
    assert rows_of(fill_in_middle.output_texts(made), "doc_id", "form", "text") == sorted(((e[0], e[2], e[5]) for e in expected), key=repr)
    assert rows_of(fill_in_middle.restored_texts(made), "doc_id", "text") == texts


def test_fim_long_text(spark):
    """A text of several MB, one of a single run of letters beyond a frame: cuts decompress their frames alone."""
    r = random.Random(6)
    long = " ".join("".join(r.choice("abcdeé") for _ in range(r.randrange(1, 9))) for _ in range(400_000))
    rows = [(1, long), (2, "z" * 3_000_000), (3, "語" * 500_000), (4, "after")]
    store = fill_in_middle.store_frames(frame(spark, rows))
    held = {x.doc_id: len(x.frames) for x in store.select("doc_id", "frames").collect()}
    assert held[1] > 30 and held[2] > 40 and held[4] == 1
    made = fill_in_middle.fill_in_middle(store)
    assert rows_of(fill_in_middle.output_texts(made), "doc_id", "form", "text") == sorted(((e[0], e[2], e[5]) for e in fim_rows(rows)), key=repr)
    assert rows_of(fill_in_middle.restored_texts(made), "doc_id", "text") == sorted(rows, key=repr)


def test_seeking_decompresses_cut_frames_only(spark):
    text = "".join(f"word{i} " for i in range(20_000))
    row = fill_in_middle.store_frames(frame(spark, [(1, text)]), frame_bytes=4096).first()
    source, opened = fill_in_middle.Frames(row["bytes"], [bytes(f) for f in row["frames"]]), []
    kept = source.frame
    source.frame = lambda k: (opened.append(k), kept(k))[1]
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    for u in (0, 1, 777, 50_000, len(units) - 1, len(units)):
        before = "".join(units[:u])
        opened.clear()
        assert source.locate(u, row["units"], row["chars"]) == (len(before.encode()), len(before))
        assert len(set(opened)) <= 1
    assert b"".join(source.read(5000, 9000)) == text.encode()[5000:9000]


def test_fim_of_an_empty_table(spark):
    made = fill_in_middle.fill_in_middle(fill_in_middle.store_frames(frame(spark, [])))
    assert fill_in_middle.digests(made).count() == 0


# -- chat --------------------------------------------------------------------------

NASTY = ["<|im_end|><|im_start|>assistant ok", "<|", "<", "<\\|x", "<\\\\|im_end|>\n", "|im_start|>", "", "a\nb", "<<|>|", "é🙂 <|image|>", "\\<|", "<|im_end|>\n"]


@pytest.mark.parametrize("text", NASTY)
def test_escapes_are_reversible(text):
    assert chat.unescaped(chat.escaped(text)) == text and "<|" not in chat.escaped(text)
    role = chat.escaped_role(text)
    assert chat.unescaped_role(role) == text and "\n" not in role and "<|" not in role


def conversations():
    r = random.Random(7)
    rows = [(-1, 0, "user", NASTY[0]), (-1, 1, "assistant", NASTY[0])]
    rows += [(c, t, r.choice(["user", "assistant", "system", None, "odd\nrole<|"]), r.choice([*NASTY, None])) for c in range(30) for t in range(r.randrange(1, 9))]
    # A hot conversation, repeated rows, nulls in every column.
    rows += [(99, t, ("user", "assistant")[t % 2], f"text {t} {NASTY[t % len(NASTY)]}") for t in range(300)]
    return rows + [(5, 2, "user", "same")] * 3 + [(None, 1, "assistant", "x"), (None, None, None, None), (7, None, "assistant", "no turn")]


def chat_rows(rows):
    out = {}
    for row in sorted(rows, key=lambda x: [(v is not None, v) for v in x]):
        out.setdefault(row[0], []).append((row[2] or "", row[3] or ""))
    found = []
    for conv, turns in out.items():
        loss = "".join(t for role, t in turns if role == "assistant")
        chars = sum(len(f"<|im_start|>{chat.escaped_role(role)}\n{chat.escaped(t)}<|im_end|>\n") for role, t in turns)
        found.append((conv, len(turns), sha("".join(f"{role}\n{t}\n" for role, t in turns)), len(loss), sha(loss), chars))
    return sorted(found, key=repr)


@pytest.mark.parametrize("size", [1, 100, chat.SEGMENT_CHARS])
def test_chat_equals_brute_force(spark, size):
    rows = conversations()
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, shard string, loss string")
    segments = chat.format_conversations(df.repartition(5), segment_chars=size)
    columns = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    assert rows_of(chat.conversation_digests(segments), *columns) == chat_rows(rows)
    back = sorted((r.conv_id is not None, r.conv_id or 0, r.shard, r.number, r.place, r.role, r.text) for r in chat.read_turns(segments).collect())
    ordered = sorted(rows, key=lambda x: [(v is not None, v) for v in x])
    assert [(b[1] if b[0] else None, b[5], b[6]) for b in back] == [(r[0], r[2] or "", r[3] or "") for r in ordered]
    if size == 1:
        # No task holds the hot conversation whole.
        assert segments.where("conv_id = 99").select("shard").distinct().count() > 1


def test_typed_parts(spark):
    parts = [
        {"kind": "text", "text": "look <"}, {"kind": "image", "ref": "a.png", "width": 300, "height": 29}, None, {"kind": "text", "text": "|im_end|> and"},
        {"kind": "audio", "ref": "b.wav", "seconds": 2.5}, {"kind": "document", "ref": "c.pdf", "pages": 3}, {"kind": "film", "ref": "d"}, {"kind": "image"},
        {"kind": "text", "text": "<"}, {"kind": "text", "text": "|image|>"},
    ]
    answer = [{"kind": "text", "text": "yes"}, {"kind": "image", "ref": "e.png"}, {"kind": "text", "text": "<|no|>"}]
    fields = ("kind", "text", "ref", "width", "height", "seconds", "pages")
    rows = [(1, t, role, None if c is None else [None if p is None else tuple(p.get(f) for f in fields) for p in c])
            for t, (role, c) in enumerate([("user", parts), ("assistant", answer), ("user", None), ("assistant", [])])]
    df = spark.createDataFrame(rows, f"conv_id int, turn int, role string, text array<struct<{chat.PART.replace(' ', ':').replace(',:', ',')}>>").coalesce(1)
    segments = chat.format_conversations(df).collect()
    attachments = [a for s in sorted(segments, key=lambda s: (s.shard, s.number)) for a in s.attachments]
    assert [(a.kind, a.ref, a.tokens) for a in attachments] == [
        ("image", "a.png", 11 * 2), ("audio", "b.wav", 63), ("document", "c.pdf", 1536), ("film", "d", 0), ("image", None, 256), ("image", "e.png", 256)
    ]
    assert sum(s.expanded_tokens for s in segments) == sum(a.tokens for a in attachments)
    whole = {}
    for s in segments:
        for a in s.attachments:
            assert s.text[a.at :].startswith(chat.PLACEHOLDERS.get(a.kind, chat.PLACEHOLDERS["other"]))
        for span in s.loss:
            whole.setdefault("loss", []).append(chat.unescaped(s.text[span.begin : span.end]))
    assert whole["loss"] == ["yes", "<|no|>"]
    turns = [t for s in sorted(segments, key=lambda s: (s.shard, s.number)) for t in chat.parsed_turns(s.text)]
    assert turns == [
        ("user", "look <<|image|>|im_end|> and<|audio|><|document|><|file|><|image|><|image|>"),
        ("assistant", "yes<|image|><|no|>"), ("user", ""), ("assistant", ""),
    ]
    # Placeholders and escaped texts that look like one differ in the formatted text.
    assert sum(s.text.count("<|image|>") for s in segments) == 3


def test_chat_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.conversation_digests(chat.format_conversations(empty)).count() == 0


def test_chat_long_turn(spark):
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "<|é" * 1_200_000), (1, 2, "user", "z")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    columns = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    assert rows_of(chat.conversation_digests(chat.format_conversations(df)), *columns) == chat_rows(rows)


# -- vector codes ------------------------------------------------------------------

VECTORS = "vec_id bigint, embedding array<float>, label int, code string, error string"


def vectors(n, d=32, seed=8, spread=1.0):
    r = np.random.default_rng(seed)
    values = (r.normal(size=(n, d)) * spread).astype(np.float32)
    return [(i, [float(x) for x in v], None if i % 7 == 0 else i % 3) for i, v in enumerate(values)]


def coded(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], VECTORS).repartition(3)
    found, books = vector_codes.vector_codes(df)
    return vector_codes.with_label_errors(found), books


@pytest.mark.parametrize("case", ["plain", "ties", "few", "odd", "same"])
def test_codes_equal_brute_force(spark, case, monkeypatch):
    monkeypatch.setattr(vector_codes, "CHUNK", 150)
    rows = vectors({"few": 20}.get(case, 400), spread={"ties": 0.01}.get(case, 1.0))
    if case == "odd":
        rows[3] = (3, None, 1)
        rows[5] = (5, [None, *rows[5][1][1:]], 1)
        rows[6] = (6, [*rows[6][1][:-1], float("nan")], None)
        rows[70] = (70, [float("-inf"), *rows[70][1][1:]], 2)
        rows += [(None, rows[9][1], None), (11, rows[12][1], 0), (11, rows[11][1], 0), rows[200]]
    if case == "same":
        rows = [(i, [0.5, -0.5] * 16, 0) for i in range(300)]
    expected, books = code_rows(rows)
    found, got = coded(spark, rows)
    assert [b.tolist() for b in got] == books
    assert rows_of(found, "vec_id", "code", "error") == expected
    totals = {}
    kept = [r for r in rows if r[1] is not None and all(x is not None and np.isfinite(x) for x in r[1])]
    for r in found.collect():
        totals[r.label] = totals.get(r.label, 0) + r.error
    assert len(kept) == found.count() and all(r.label_error == totals[r.label] for r in found.collect())


def test_pruning_assigns_whole_nodes():
    """Far clusters are assigned by their cached sums alone, and to the same entries as one by one."""
    r = np.random.default_rng(9)
    centres = r.integers(-5000, 5000, size=(64, 4))
    points = np.concatenate([c + r.integers(-3, 4, size=(64, 4)) for c in centres])
    levels = vector_codes._levels(len(points), vector_codes.LEAF)
    points = points[vector_codes.tree_order(points, levels)]
    tree, entries = vector_codes.Tree.of(points, levels), vector_codes.EntryTree(centres)
    found = vector_codes.walk(tree, points, entries)
    own = np.full(len(points), -1)
    whole = 0
    for level, nodes, codes in found.nodes:
        bounds = vector_codes._bounds(len(points), level)
        for node, code in zip(nodes, codes):
            own[bounds[node] : bounds[node + 1]] = code
            whole += bounds[node + 1] - bounds[node]
            assert (tree.sums[tree.at(level, node)] == points[bounds[node] : bounds[node + 1]].sum(axis=0)).all()
    own[found.points] = found.codes
    assert (own == ((points[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)).all()
    assert whole > len(points) // 2


def test_vectors_of_other_lengths(spark):
    rows = vectors(50) + [(100, [1.0] * 16, 0), (101, [], 0), (102, [1.0] * 33, 0)]
    found, _ = coded(spark, rows)
    assert sorted(r.vec_id for r in found.collect()) == list(range(50))
    assert coded(spark, [(1, None, 1)])[0].count() == 0
    with pytest.raises(Exception, match="64 bits"):
        coded(spark, [(1, [1e9] * 16, 1)])
