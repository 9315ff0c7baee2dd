from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from brute import corner_rows, exact_groups, frame, near_groups, rows_of, without_repeats

from sparkpact.llm import components, exact_dedup, near_dups, repeats


def words(n, seed):
    r = random.Random(seed)
    return [f"w{r.randrange(5000)}" for _ in range(n)]


@pytest.fixture(scope="module")
def families():
    """Copies with more and more words changed, of texts of several lengths, with a passage that all share."""
    r, rows = random.Random(5), []
    common = words(12, 99)
    for f, size in enumerate((6, 9, 14, 40, 150, 700)):
        base = words(size, f)
        for k in range(14):
            own = list(base)
            for _ in range(k * size // 90):
                own[r.randrange(size)] = f"x{r.randrange(10**6)}"
            if k % 3 == 0:
                own += common
            rows.append((100 * f + k, " ".join(own)))
    return rows


# -- exact ---------------------------------------------------------------------


def test_fingerprints_compose():
    data = np.frombuffer(random.Random(1).randbytes(5000), np.uint8)
    whole = exact_dedup.fingerprint(data, exact_dedup.POINTS[0])
    assert whole == exact_dedup.fingerprint(data, exact_dedup.POINTS[0], 7)
    left, right = (exact_dedup.fingerprint(x, exact_dedup.POINTS[0]) for x in (data[:123], data[123:]))
    assert whole == exact_dedup.shifted_sum(left, right, 123, exact_dedup.POINTS[0])


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 64])
def test_exact_groups(spark, chunk_bytes):
    rows = corner_rows()
    found = exact_dedup.exact_groups(frame(spark, rows), chunk_bytes=chunk_bytes)
    assert rows_of(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == exact_groups(rows)


def test_exact_dedup_keeps_rows_whole(spark):
    rows = corner_rows()
    docs = frame(spark, rows)
    kept = exact_dedup.exact_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in kept.collect()) == sorted((g[0] is None, g[0]) for g in exact_groups(rows) if g[3])


#: At this point a fingerprint is the sum of the bytes, so texts of the same letters collide.
SUMS = (1, 1)


@pytest.mark.parametrize("chunk_bytes", [1 << 20, 4])
def test_equal_fingerprints_are_compared(spark, chunk_bytes):
    """Real collisions go through the comparison, in the first chunk, in a later one, and beside true copies."""
    texts = ["abcd efgh", "abcd ehgf", "bacd efgh", "abcd  efgh", "abcd\tehgf", "dcba hgfe ", "xyz", "xyz", "zyx", None, "", " " * 9, "abcd efgh"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, "abcd efgh"), (None, "abcd ehgf")]
    found = exact_dedup.exact_groups(frame(spark, rows), chunk_bytes=chunk_bytes, points=SUMS)
    assert rows_of(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == exact_groups(rows)


def test_comparison_finds_what_differs(spark):
    texts = ["abcd efgh", "abcd  ehgf", "same text", "same  text", "ab", "ba", "abcd efgh"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    total = lambda t: sum(t.encode())
    differ = exact_dedup._compared(docs, docs, 4, SUMS)
    assert rows_of(differ, "n_bytes", "fp1", "fp2") == sorted((len(t), total(t), total(t)) for t in ("abcd efgh", "ab"))
    # At the real points nothing collides.
    assert exact_dedup._compared(docs, docs, 4).count() == 0
    assert exact_dedup._compared(docs, docs.where("doc_id > 9"), 4, SUMS).count() == 0


def test_long_texts(spark):
    """Texts of many chunks, copies that differ in blanks, repeated rows and a change in the last byte."""
    base = " ".join(words(400_000, 3))
    rows = [(1, base), (2, base.replace(" ", " \t\n", 5)), (3, base + "x"), (1, base), (4, "short"), (None, base), (5, " " * 3_000_000), (6, "\n")]
    assert len(base) > 2 << 20
    found = exact_dedup.exact_groups(frame(spark, rows))
    assert rows_of(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == exact_groups(rows)


# -- near ----------------------------------------------------------------------


def test_near_groups(spark, families):
    rows = families + corner_rows()
    found = near_dups.near_duplicates(frame(spark, rows))
    expected = near_groups(rows)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == expected
    assert len({e[2] for e in expected}) < len(rows) - 20


@pytest.mark.parametrize("bits", [1, 5])
def test_sets_of_one_name_stay_apart(spark, families, bits):
    """With names of few bits many sets share one, and their second hash parts them."""
    rows = families + corner_rows()
    docs = frame(spark, rows)
    found = near_dups.near_duplicates(docs, key_bits=bits)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == near_groups(rows)
    kept = rows_of(near_dups.one_of_each(docs, key_bits=bits), "doc_id", "text")
    assert kept == rows_of(near_dups.one_of_each(docs), "doc_id", "text")


def test_near_groups_in_tiles(spark, families, monkeypatch):
    """Blocks cut into many tiles give the same components."""
    monkeypatch.setattr(near_dups, "TILE", 200)
    assert rows_of(near_dups.near_duplicates(frame(spark, families)), "doc_id", "n_shingles", "component_id") == near_groups(families)


def test_one_of_each(spark, families):
    rows = families + corner_rows()
    docs = frame(spark, rows)
    kept = near_dups.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = near_groups(rows)
    expected = {g[0] for g in groups if g[1] and g[0] is not None and g[0] == g[2]}
    got = [r["doc_id"] for r in kept.collect() if near_groups([(1, r["text"])])[0][1]]
    assert set(got) == expected
    assert kept.where("doc_id in (3, 4, 5)").count() == 3


def test_tree_bound_keeps_every_link(families):
    sets = near_dups.shingle_sets(*flat([t for _, t in families]))
    pairs = near_dups.links(sets)
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    for i in range(len(sets)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                assert find(i) == find(j)


def flat(texts):
    data = [t.encode() for t in texts]
    return np.frombuffer(b"".join(data), np.uint8), np.concatenate(([0], np.cumsum([len(d) for d in data])))


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1060)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found = components.components(spark.createDataFrame(edges, "a bigint, b bigint"))
    lonely = {a for a, b in edges if a == b} - {x for a, b in edges if a != b for x in (a, b)}
    assert rows_of(found, "node", "component") == sorted(((x, find(x)) for x in root if x not in lonely), key=repr)


# -- repeats -------------------------------------------------------------------


def repeat_rows():
    r = random.Random(8)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    passages = [text(n) for n in (70, 120, 45, 60, 300)]
    rows = []
    for i in range(60):
        parts = [r.choice(passages) if r.random() < 0.5 else text(r.randrange(90)) for _ in range(r.randrange(6))]
        rows.append((i, "".join(parts)))
    return rows + [(100, "ab" * 200), (101, "é" * 100), (102, rows[5][1]), (102, rows[5][1])] + corner_rows()


def digest(found):
    out = []
    for r in found.collect():
        removed = sum(s["b"] - s["a"] for s in r["spans"])
        out.append((r["doc_id"], r["n_bytes"], removed, len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("held", [20_000, 3])
def test_repeats(spark, held):
    rows = repeat_rows()
    found = repeats.without_repeats(frame(spark, rows), length=40, gram=10, held=held)
    assert digest(found) == without_repeats(rows, 40)


def test_repeats_at_full_length(spark):
    rows = corner_rows()
    assert digest(repeats.without_repeats(frame(spark, rows))) == without_repeats(rows, 400)


def test_merge_sort_orders_suffixes():
    data = np.frombuffer(bytes(random.Random(2).choices(b"ab", k=400)), np.uint8)
    at = np.arange(0, 360, 3)
    group = np.repeat(np.arange(4), 30)
    sums = repeats.prefix_sums(repeats.BYTE_VALUES[data])
    order = repeats.Suffixes(data, sums, at, np.full(len(at), 40), False).merge_sorted(group)
    expected = sorted(range(len(at)), key=lambda i: (group[i], data[at[i] : at[i] + 40].tobytes(), i))
    assert [data[at[i] : at[i] + 40].tobytes() for i in order] == [data[at[i] : at[i] + 40].tobytes() for i in expected]


def test_colliding_hashes_are_compared(monkeypatch):
    """With a hash that always collides nothing wrong is found."""
    data = np.frombuffer(b"abcdefgh" + b"abcdxxgh" + b"abcdefgh", np.uint8)
    begin = np.array([0, 8, 16])
    real = repeats.span_hashes
    monkeypatch.setattr(repeats, "span_hashes", lambda sums, a, b, base=0: real(sums, a, b) & np.uint64(0))
    run, at = repeats.repeated_windows(data, begin, begin, np.array([1, 1, 1]), np.zeros(3, np.int64), 8)
    assert sorted(zip(run.tolist(), at.tolist())) == [(0, 0), (2, 16)]


@pytest.mark.parametrize("operator", [exact_dedup.exact_groups, exact_dedup.exact_dedup, near_dups.near_duplicates, near_dups.one_of_each, repeats.without_repeats])
def test_empty_table(spark, operator):
    assert operator(frame(spark, [])).count() == 0


def test_runs_of_long_texts(monkeypatch):
    """Runs are the same whether a text is cut into parts or not, also beyond the bits of a place."""
    r = np.random.default_rng(3)
    passage = r.integers(97, 123, 3000).astype(np.uint8)
    own = [r.integers(97, 123, n).astype(np.uint8) for n in (5000, 0, 700, 20_000)]
    texts = [np.concatenate((own[0], passage, own[2], passage)), own[1], own[2], np.concatenate((passage, own[3], np.full(9000, 97, np.uint8), passage))]
    data, offsets = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
    whole = repeats.window_runs(data, offsets)
    monkeypatch.setattr(repeats, "_PLACE", 12)
    for part in (1000, 1777, 4096):
        monkeypatch.setattr(repeats, "PART", part, raising=False)
        for a, b in zip(whole, repeats.window_runs(data, offsets), strict=True):
            assert a.tolist() == b.tolist()


def _connected(n, pairs):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    return [find(x) for x in range(n)]


def _same_parts(x, y):
    return len(set(zip(x, y))) == len(set(x)) == len(set(y))


@pytest.mark.parametrize("few", [0, 2, 16])
@pytest.mark.parametrize("sided", [False, True])
def test_parted_blocks_lose_no_link(few, sided, monkeypatch):
    """Sets of many sizes around shared templates: what links connect is what all pairs connect."""
    monkeypatch.setattr(near_dups, "FEW", few)
    r = np.random.default_rng(12)
    for _ in range(6):
        templates = [r.integers(0, 1 << 62, 60).astype(np.uint64) for _ in range(3)]
        sets = []
        for k in range(160):
            own = templates[k % 3][: r.integers(1, 40)]
            more = r.integers(0, 1 << 62, r.integers(0, 6)).astype(np.uint64)
            sets.append(np.unique(np.concatenate((own, more, templates[(k + 1) % 3][50 : 50 + r.integers(0, 4)]))))
        side = r.integers(0, 2, len(sets)) if sided else None
        pairs = []
        for i in range(len(sets)):
            for j in range(i):
                both = len(np.intersect1d(sets[i], sets[j]))
                if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and (side is None or side[i] != side[j]):
                    pairs.append((i, j))
        found = near_dups.links(sets, side)
        assert set(map(frozenset, found)) <= set(map(frozenset, pairs)) and pairs
        assert _same_parts(_connected(len(sets), found), _connected(len(sets), pairs))


def test_templates_do_not_meet(monkeypatch):
    """16,000 texts of one template that link with nobody, and a few that do, take no time that grows with their pairs."""
    import time

    r = np.random.default_rng(13)
    template = r.integers(0, 1 << 62, 3).astype(np.uint64)
    sets = [np.unique(np.append(template, r.integers(0, 1 << 62, 1).astype(np.uint64))) for _ in range(16_000)]
    sets += [np.unique(template), np.unique(r.integers(0, 1 << 62, 9).astype(np.uint64))]
    begin = time.time()
    alone = near_dups.links(sets[:16_000])
    assert alone == [] and time.time() - begin < 10
    # The template itself links with all of them.
    assert len(near_dups.links(sets)) == 16_000
