"""The registered queries that have no SQL, run as registered and held against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from brute import base_spans, corner_rows, crc, frame, rows_of, token_ids, without_repeats
from test_tokens import BYTES, packed_right

from sparkpact.llm.queries import QUERIES


def numbered(extra=()):
    """Corner texts and more, each with an id of its own."""
    secrets = ["token = abcdefgh", "AKIA" + "B" * 16 + " deadbeefdeadbeefdeadbeef", "é password: 'hunter22'"]
    return [(3 * i, t) for i, t in enumerate([r[1] for r in corner_rows()] + secrets + list(extra))]


def long_text():
    r = random.Random(2)
    return " ".join(r.choice(["alpha,", "beta.", "secret=abcdefgh", "文字", "é", "\n"]) + str(r.randrange(9999)) for _ in range(130_000))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder of documents with a text over one step of a task; its rows."""
    path = tmp_path_factory.mktemp("long")
    rows = numbered([long_text()])
    assert len(rows[-1][1].encode()) > 1 << 20
    frame(spark, rows, clashes=False).repartition(3).write.parquet(str(path / "documents.parquet"))
    return str(path), rows


def test_token_store(spark, folder):
    path, rows = folder
    expected, at = [], 0
    for (doc_id, _), ids in zip(rows, token_ids([t for _, t in rows], BYTES)):
        expected.append((doc_id, at, len(ids), crc(ids)))
        at += len(ids)
    found = QUERIES["op2_token_store"](spark, path)
    assert rows_of(found, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=repr)


def test_shards(spark, folder):
    path, rows = folder
    found = QUERIES["op3_histogram_shards"](spark, path).collect()
    sizes = {i: len((t or "").encode()) + 16 for i, t in rows}
    crcs = {i: zlib.crc32((t or "").encode()) for i, t in rows}
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == sorted((i, sizes[i], crcs[i]) for i in sizes)
    slots = defaultdict(list)
    for r in found:
        assert 0 <= r["shard"] < 40 and r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_packing(spark, folder):
    path, rows = folder
    packed_right(QUERIES["op7_packing"](spark, path).collect(), rows, 2048)


def test_secrets(spark, folder):
    path, rows = folder
    expected = []
    for doc_id, text in rows:
        spans = base_spans(text)
        kinds = Counter(k for k, _, _ in spans)
        digest = hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
        expected.append((doc_id, kinds["assign"], kinds["access"], kinds["hex"], digest))
    found = QUERIES["op10_secret_scan"](spark, path)
    assert rows_of(found, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256") == sorted(expected, key=repr)


def test_repeats(spark, tmp_path):
    """Passages of 300 to 500 bytes in several places, beside the corner texts."""
    r = random.Random(6)
    letters = lambda n: "".join(r.choice("abcdefgh é") for _ in range(n))
    passages = [letters(n) for n in (300, 380, 398, 402, 450, 500)]
    extra = [letters(200) + p + letters(r.randrange(300)) for p in passages for _ in range(2)] + [p + letters(50) + p for p in passages]
    rows = numbered(extra)
    frame(spark, rows, clashes=False).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    found = QUERIES["op9_suffix_dedup"](spark, str(tmp_path))
    assert rows_of(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == without_repeats(rows, 400)
    assert all(r["has_repeats"] == (r["n_removed"] > 0) for r in found.collect())


def test_languages(spark, sf_dir):
    found = QUERIES["op5_language_id"](spark, sf_dir)
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    told = found.collect()
    assert sorted(r["doc_id"] for r in told) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in told)
    judged = [(r["lang_pred"], docs[r["doc_id"]]["lang"]) for r in told if r["held_out"] and docs[r["doc_id"]]["lang"] is not None]
    assert judged and sum(a == b for a, b in judged) >= 0.9 * len(judged)
