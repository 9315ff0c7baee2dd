from __future__ import annotations

import random

import numpy as np
import pytest
from brute import corner_rows, crc, frame, rows_of, token_ids
from pyspark.sql import functions as F

from sparkpact.llm import packing, token_store, tokens

BYTES, WORDS = (tokens.public_vocabulary(x) for x in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["foo_, a_.", "×. é. é, ×,é", "3.5.6 a...b ,x", "x! y!! z?!a", "é.é ʿ. ˂. ö:b", "word.\nNext", "x.<|endoftext|>.y, it.s",
       "", " ", "  a", "a  b", "a \n b\n\n c", "x<|endoftext|> y <|startoftext|>z", "don't 'll it's", "\t\ta  b", "é ́x", "AİΣ Σ", "a\x1cb \x1cq",
       "日本 語。 、ok", "#%&&& 12 345 6", "a,\nb.\nC d\n", "ab\x85 \x85 c", "ᄀ ᅡ 가 가", "a\t\nb", "a\r\nb c", "x \nHello world"]


@pytest.mark.parametrize("vocabulary", [BYTES, WORDS])
@pytest.mark.parametrize("kept", [0, 100_000])
def test_encoder_equals_the_library(vocabulary, kept, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_PIECES", kept)
    own, r = tokens.Encoder(vocabulary), random.Random(4)
    alphabet = "ab É.,'\n\t 12<|>"
    for round_ in range(3):
        texts = ODD + ["".join(r.choice(alphabet) for _ in range(r.randrange(60))) for _ in range(150)]
        ids, at = own.encode(texts, 0)
        for text, a, b, expected in zip(texts, at[:-1], at[1:], token_ids(texts, vocabulary)):
            assert ids[a:b].tolist() == expected.tolist(), text


def test_supplied_vocabularies_are_cut():
    assert all(tokens.Encoder(v).cuts for v in (BYTES, WORDS))


def other_tokenizers():
    from tokenizers import AddedToken, Tokenizer, normalizers, pre_tokenizers

    for change in range(5):
        tokenizer = Tokenizer.from_file(BYTES)
        if change == 0:
            tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=True)
        elif change == 1:
            tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        elif change == 2:
            tokenizer.normalizer = normalizers.Strip()
        elif change == 3:
            tokenizer.add_tokens([AddedToken("a b"), AddedToken("it.s")])
        else:
            tokenizer.add_tokens([AddedToken("b", lstrip=True, rstrip=True)])
        yield tokenizer


def test_other_tokenizers_get_whole_texts(tmp_path):
    for k, tokenizer in enumerate(other_tokenizers()):
        path = str(tmp_path / f"{k}.json")
        tokenizer.save(path)
        own = tokens.Encoder(path)
        assert not own.cuts
        for _ in range(2):
            ids, at = own.encode(ODD, 0)
            assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [x.tolist() for x in token_ids(ODD, path)]


@pytest.mark.parametrize("vocabulary", [BYTES, WORDS])
def test_encoder_on_a_long_text(vocabulary):
    """A text over one step, with rare and common pieces."""
    r = random.Random(8)
    long = " ".join(r.choice(ODD) + str(r.randrange(5000)) for _ in range(150_000))
    assert len(long.encode()) > 1 << 20
    ids, at = tokens.Encoder(vocabulary).encode(["", long, "end."], 0)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [x.tolist() for x in token_ids(["", long, "end."], vocabulary)]


def test_store_round_trip(spark, tmp_path):
    rows = corner_rows() + [(100 + i, t) for i, t in enumerate(ODD)]
    path = str(tmp_path / "store")
    token_store.write_store(frame(spark, rows), path, BYTES)
    found = token_store.read_store(spark, path).collect()
    ids = token_ids([r[1] for r in rows], BYTES)
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"], tuple(r["ids"])) for r in found), key=repr) == sorted(
        ((r[0], len(i), crc(i), tuple(i.tolist())) for r, i in zip(rows, ids)), key=repr
    )
    # In ascending order of doc_id, nulls first, without gaps.
    ordered = sorted(found, key=lambda r: r["start"])
    assert [r["doc_id"] for r in ordered] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    at = 0
    for r in ordered:
        assert r["start"] == at
        at += r["n_tokens"]


def test_one_document_alone(spark, tmp_path):
    """Any document of a container can be read by itself, and only with its dictionary."""
    rows = [(i, " ".join(f"word{i * k % 13} text" for k in range(30))) for i in range(300)]
    path = str(tmp_path / "store")
    token_store.write_store(frame(spark, rows), path, BYTES)
    dictionary = token_store.store_dictionary(spark, path)
    assert dictionary
    boxes = spark.read.parquet(f"{path}/containers").collect()
    expected = dict(zip((r[0] for r in rows), token_ids([r[1] for r in rows], BYTES)))
    seen = 0
    for box in boxes:
        reader = token_store.Reader(box["content"], dictionary)
        k = len(reader.docs) // 2
        assert token_store.read_document(box["content"], dictionary, k).tolist() == expected[reader.docs[k]].tolist()
        seen += len(reader.docs)
    assert seen == len(rows) and len(boxes) > 1
    with pytest.raises(ValueError):
        token_store.Reader(boxes[0]["content"], b"another")


def test_containers_are_closed_when_full():
    box = token_store.Container(b"")
    ids = np.arange(5, dtype=np.uint32)
    for i in range(token_store.CONTAINER_DOCS):
        assert box.fits(2)
        box.add(i, ids, 2)
    assert not box.fits(2)
    assert token_store.Reader(box.close()[2], b"").docs == list(range(token_store.CONTAINER_DOCS))
    assert box.fits(4)


def test_wide_ids():
    box = token_store.Container(b"")
    ids = np.array([1, 70_000, 3], np.uint32)
    box.add(5, ids, 4)
    assert not box.fits(2)
    assert token_store.Reader(box.close()[2], b"").ids(0).tolist() == ids.tolist()


def test_empty_store(spark, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_store(frame(spark, []), path, BYTES)
    assert token_store.read_store(spark, path).count() == 0


# -- packing -------------------------------------------------------------------


def packed_right(found, rows, size):
    """Every piece of every document once, places gapless, nothing too long; how many sequences."""
    expected = []
    for r, ids in zip(rows, token_ids([r[1] for r in rows], WORDS)):
        expected += [(r[0], k, a, len(ids[a : a + size]), crc(ids[a : a + size])) for k, a in enumerate(range(0, len(ids), size))]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found), key=repr) == sorted(expected, key=repr)
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


@pytest.mark.parametrize("group", [60_000, 20])
def test_packing(spark, group, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", group)
    r = random.Random(6)
    rows = corner_rows() + [(1000 + i, " ".join(["word"] * r.randrange(90))) for i in range(150)]
    docs = frame(spark, rows)
    found = packing.pack(packing.token_pieces(docs, WORDS, size=64, with_ids=False), size=64).collect()
    n = packed_right(found, rows, 64)
    total = sum(r["length"] for r in found)
    assert n <= -(-total // 64) + (3 if group > 100 else 20)


def test_pieces_carry_ids(spark):
    rows = corner_rows()
    found = packing.token_pieces(frame(spark, rows), WORDS, size=50).groupBy("doc_id", "piece").agg(F.count("*").alias("n"), F.first("ids").alias("ids")).where("n = 1").collect()
    ids = dict(zip((r[0] for r in rows), token_ids([r[1] for r in rows], WORDS)))
    for r in found:
        if r["doc_id"] not in (None, 9):
            assert r["ids"] == ids[r["doc_id"]][50 * r["piece"] : 50 * r["piece"] + 50].tolist()


def test_rule_by_hand():
    """Each piece goes where the sum of squares becomes smallest, found by trying all places."""
    r = random.Random(2)
    lengths = [r.randrange(1, 12) for _ in range(200)]
    bins = packing.sum_of_squares(np.array(lengths), 12)
    gaps: dict[int, int] = {}
    for n, own in zip(lengths, bins.tolist()):

        def squares(change):
            after = {**gaps, **change}
            counts = [list(after.values()).count(g) for g in range(1, 12)]
            return sum(c * c for c in counts)

        places = {b: g for b, g in gaps.items() if g >= n}
        best = min([squares({b: g - n}) for b, g in places.items()] or [squares({max(gaps, default=-1) + 1: 12 - n})])
        assert (own in gaps) == bool(places)
        assert squares({own: gaps.get(own, 12) - n}) == best
        gaps[own] = gaps.get(own, 12) - n


def test_empty_packing(spark):
    assert packing.pack(packing.token_pieces(frame(spark, []), WORDS)).count() == 0
