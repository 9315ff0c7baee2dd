"""Benchmark passages in training documents, by suffix arrays over the documents.

Words are maximal runs of bytes other than ``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became a-z. Every task
cuts its documents into shards of bounded size and builds a suffix array of each shard's words by prefix
doubling: suffixes are sorted by 1, 2, 4, 8, ... words, and only groups that are still equal are sorted again.
Every suffix of every benchmark item is then searched in the array, all at once: an interval of the array is
narrowed word by word with two binary searches, until it is empty. What was left before is the longest
verbatim match, and the array gives its places. Documents are parted by words that occur nowhere, so no
match crosses a boundary. From every place where a window occurs the same search is made the other way, in the
suffix array of the items, so that the longest match of each document is exact, with its place.

A window is ``WINDOW`` consecutive words of an item; an item of fewer words, but some, is one window. Words of a
document inside any occurrence of a window are hit. A document is contaminated when at least one in
``1 / SHARE`` of its words is hit. Words are found by 64-bit hashes; each word of a document that has the hash of
one of the items is then compared with it byte by byte, and is another word if it differs. Windows of the same
words share one interval of the array, whose places are taken together.

The items are cut into blocks of about ``BLOCK_BYTES`` by their total size. Blocks are read, sent to the tasks and
met with all documents one after another, so the driver and a task hold one of them, whatever the benchmark's size;
hits of several blocks are merged per document. A text longer than a step is a step of its own, and a task's memory
is in proportion to it. Defined results: null text has no words; items without words occur nowhere; a null item_id is
counted and sorts as the empty text; repeated items count once for each row; an empty benchmark hits nothing;
an empty table of documents gives an empty result.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpact.llm.base import BASE, BYTE_VALUES, lean, mapped, packed, prefix_sums, record, runs_of, span_hashes, unpacked, utf8, written

WINDOW = 13
SHARE = 20
BLOCK_BYTES = 16 << 20

_IS_WORD = np.ones(256, bool)
for _a, _b in ((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)):
    _IS_WORD[_a : _b + 1] = False
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


@dataclass
class Words:
    """The words of some texts: their hashes, where their bytes are, and where each text's words begin."""

    data: np.ndarray
    hashes: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def bytes(self, i: int) -> bytes:
        return self.data[self.begin[i] : self.end[i]].tobytes()


def words_of(data: np.ndarray, offsets: np.ndarray, base: int = BASE) -> Words:
    data = _FOLD[data]
    # A gap after every text keeps words apart.
    ends = offsets[1:]
    gapped = np.insert(data, ends, 32)
    begin, end = runs_of(_IS_WORD[gapped])
    hashes = span_hashes(prefix_sums(BYTE_VALUES[gapped], base), begin, end, base)
    first = np.searchsorted(begin, offsets + np.arange(len(offsets)))
    return Words(gapped, hashes, begin, end, first)


# Words that are compared at a time.
_COMPARED = 1 << 16


def same_words(a: Words, i: np.ndarray, b: Words, j: np.ndarray) -> np.ndarray:
    """Whether the words ``i`` of ``a`` have the bytes of the words ``j`` of ``b``."""
    out = (a.end[i] - a.begin[i]) == (b.end[j] - b.begin[j])
    equal = np.flatnonzero(out)
    for part in (equal[k : k + _COMPARED] for k in range(0, len(equal), _COMPARED)):
        from_, to = a.begin[i[part]], b.begin[j[part]]
        size = a.end[i[part]] - from_
        start = np.cumsum(size) - size
        within = np.arange(int(size.sum())) - np.repeat(start, size)
        differs = a.data[np.repeat(from_, size) + within] != b.data[np.repeat(to, size) + within]
        out[part] = ~np.logical_or.reduceat(differs, start)
    return out


def suffix_array(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Beginnings of all suffixes in the order of their first ``depth`` symbols (non-negative integers)."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1

    def ranked(keys: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of sorted keys, the place of the first equal key, and which are not alone."""
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        begins = np.flatnonzero(new)
        sizes = np.diff(np.append(begins, len(keys)))
        return np.repeat(at[begins], sizes), np.repeat(sizes > 1, sizes)

    places = np.arange(n)
    values, shared = ranked(symbols[order], places)
    rank[order] = values
    length, open_places = 1, places[shared]
    while length < depth and len(open_places):
        who = order[open_places]
        group, after = rank[who], rank[np.minimum(who + length, n)]
        key = group * np.int64(n + 2) + after + 1
        turn = np.argsort(key, kind="stable")
        who, key = who[turn], key[turn]
        order[open_places] = who
        values, shared = ranked(key, open_places)
        rank[who] = values
        open_places = open_places[shared]
        length *= 2
    return order


def narrowed(symbols: np.ndarray, order: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The part of each interval of the array whose suffixes have the wanted symbol at ``depth``."""

    def bound(strict: bool) -> np.ndarray:
        a, b = low.copy(), high.copy()
        while (open_ := a < b).any():
            middle = (a + b) // 2
            at = order[np.minimum(middle, len(order) - 1)] + depth
            have = np.where(at < len(symbols), symbols[np.minimum(at, len(symbols) - 1)], -1)
            right = open_ & ((have < wanted) | ((have == wanted) & strict))
            a = np.where(right, middle + 1, a)
            b = np.where(open_ & ~right, middle, b)
        return a

    return bound(False), bound(True)


class SharedHash(ValueError):
    """Two words of a block have the same hash: another base is to be taken."""


# Words that end items; words of documents have smaller numbers.
_ITEM_END = np.int64(1) << np.int64(62)


@dataclass
class Benchmark:
    """Items of one block."""

    items: list[str]
    words: Words
    base: int = BASE

    def __post_init__(self):
        first = self.words.first
        counts = np.diff(first)
        self.vocabulary, self.example, self.symbols = np.unique(self.words.hashes, return_index=True, return_inverse=True)
        everyone = np.arange(len(self.symbols))
        if not same_words(self.words, everyone, self.words, self.example[self.symbols]).all():
            raise SharedHash
        item = np.repeat(np.arange(len(counts)), counts)
        left = first[1:][item] - everyone  # words from here to the end of the item
        # Every suffix is searched as far as its item goes; windows are those long enough.
        self.item, self.left = item, left
        self.need = np.minimum(WINDOW, counts[item])
        # The items as documents are searched: one after another, each with an end of its own.
        self.parted = np.insert(self.symbols.astype(np.int64), first[1:], _ITEM_END + np.arange(len(counts)))
        self.order = suffix_array(self.parted, self.depth)

    @classmethod
    def of(cls, items: list[str], data: np.ndarray, offsets: np.ndarray) -> "Benchmark":
        base = BASE
        while True:
            try:
                return cls(items, words_of(data, offsets, base), base)
            except SharedHash:
                base += 2

    @property
    def depth(self) -> int:
        return int(self.left.max(initial=0))


def longest_matches(benchmark: Benchmark, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For every suffix of the benchmark: words of its longest match; and the array with each window's interval."""
    order = suffix_array(symbols, benchmark.depth)
    n = len(benchmark.symbols)
    length = np.zeros(n, np.int64)
    window_low, window_high = np.zeros(n, np.int64), np.zeros(n, np.int64)
    alive = np.arange(n)
    low, high = np.zeros(n, np.int64), np.full(n, len(order), np.int64)
    depth = 0
    while len(alive):
        low, high = narrowed(symbols, order, low, high, depth, benchmark.symbols[alive + depth])
        found = low < high
        alive, low, high = alive[found], low[found], high[found]
        depth += 1
        length[alive] = depth
        complete = benchmark.need[alive] == depth
        window_low[alive[complete]], window_high[alive[complete]] = low[complete], high[complete]
        more = benchmark.left[alive] > depth
        alive, low, high = alive[more], low[more], high[more]
    return length, order, window_low, window_high


def match_lengths(benchmark: Benchmark, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Words of the longest match that any suffix of the items has with the words from each place on."""
    length = np.zeros(len(places), np.int64)
    alive = np.arange(len(places))
    low, high = np.zeros(len(places), np.int64), np.full(len(places), len(benchmark.order), np.int64)
    depth = 0
    while len(alive):
        low, high = narrowed(benchmark.parted, benchmark.order, low, high, depth, symbols[places[alive] + depth])
        found = low < high
        alive, low, high = alive[found], low[found], high[found]
        depth += 1
        length[alive] = depth
    return length


_HITS = {"n_words": pa.int64(), "hit_from": pa.list_(pa.int32()), "hit_to": pa.list_(pa.int32()), "items": pa.list_(pa.string()), "longest": pa.int64(), "longest_from": pa.int64()}


def _searcher(benchmark: Benchmark):
    """Hits of each document of a shard: word spans, items that occur, words and place of the longest match."""

    def search(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = benchmark
        words = words_of(*utf8(batch.column(1)), own.base)
        n_docs = batch.num_rows
        counts = np.diff(words.first)
        spans: list[list[tuple[int, int]]] = [[] for _ in range(n_docs)]
        items: list[set[str]] = [set() for _ in range(n_docs)]
        longest: list[int] = [0] * n_docs
        longest_from: list[int | None] = [None] * n_docs
        if len(words.hashes) and len(own.symbols):
            # Words as numbers of the benchmark's vocabulary; unknown ones get numbers above all, each its own.
            at = np.minimum(np.searchsorted(own.vocabulary, words.hashes), len(own.vocabulary) - 1)
            known = own.vocabulary[at] == words.hashes
            maybe = np.flatnonzero(known)
            # Equal hashes are no proof.
            known[maybe] = same_words(words, maybe, own.words, own.example[at[maybe]])
            symbols = np.where(known, at, 0)
            symbols[~known] = len(own.vocabulary) + np.arange(np.count_nonzero(~known))
            # After each document a symbol of its own.
            parted = np.insert(symbols, words.first[1:], len(own.vocabulary) + len(symbols) + np.arange(n_docs))
            doc_of = np.repeat(np.arange(n_docs), counts + 1)
            _, order, low, high = longest_matches(own, parted)
            occurring = np.flatnonzero(high > low)
            # Windows of the same words have the same interval.
            _, one, interval = np.unique(low[occurring] * (WINDOW + 1) + own.need[occurring], return_index=True, return_inverse=True)
            begin, size, need = low[occurring[one]], (high - low)[occurring[one]], own.need[occurring[one]]
            which = np.repeat(np.arange(len(one)), size)
            place = order[np.arange(len(which)) + np.repeat(begin - (np.cumsum(size) - size), size)]
            hit = np.bincount(place, minlength=len(parted) + 1) - np.bincount(place + need[which], minlength=len(parted) + 1)
            # Items of each interval, then of each document that has it.
            named = np.argsort(interval, kind="stable")
            edges = np.searchsorted(interval[named], np.arange(len(one) + 1))
            names = [{own.items[own.item[k]] for k in occurring[named[a:b]].tolist()} for a, b in zip(edges[:-1], edges[1:])]
            for pair in np.unique(doc_of[place] * max(1, len(one)) + which).tolist():
                items[pair // len(one)] |= names[pair % len(one)]
            begins, ends = runs_of(np.cumsum(hit[:-1]) > 0)
            for a, b in zip(begins.tolist(), ends.tolist()):
                doc = int(doc_of[a])
                base = int(words.first[doc]) + doc
                spans[doc].append((a - base, b - base))
            place = np.unique(place)
            length = match_lengths(own, parted, place)
            # Of each document the longest, of those the first.
            turn = np.lexsort((place, -length, doc_of[place]))
            docs, best = np.unique(doc_of[place][turn], return_index=True)
            for doc, k in zip(docs.tolist(), turn[best].tolist()):
                longest[doc] = int(length[k])
                longest_from[doc] = int(place[k]) - int(words.first[doc]) - doc
        columns = [counts, [[a for a, _ in s] for s in spans], [[b for _, b in s] for s in spans], [sorted(x) for x in items], longest, longest_from]
        first, rest = batch.column(0), [batch.column(i) for i in range(2, batch.num_columns)]
        found = [pa.array(c, kind) for c, kind in zip(columns, _HITS.values())]
        return pa.record_batch([first, *rest, *found], ["doc_id", *batch.schema.names[2:], *_HITS])

    return search


def benchmark_rows(items: DataFrame, item_col: str = "item_id", text_col: str = "text") -> tuple[DataFrame, int]:
    """The items as ``item, text, block``, and the number of blocks, each of about ``BLOCK_BYTES``."""
    rows = items.select(F.coalesce(F.col(f"`{item_col}`").cast("string"), F.lit("")).alias("item"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    if blocks == 1:
        return rows.withColumn("block", F.lit(0)), 1
    # Rows that are repeated are dealt out too.
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("item", "text", F.monotonically_increasing_id()), F.lit(blocks)).cast("int"))
    return written(dealt, "benchmark", "block"), blocks


def benchmark_block(rows: DataFrame, block: int) -> Benchmark:
    """One block; each row has a name of its own even if its id repeats."""
    table = rows.where(F.col("block") == block).select("item", "text").orderBy("item", "text").toArrow().combine_chunks()
    ids = table.column("item").to_pylist()
    texts = table.column("text").combine_chunks()
    texts = texts if isinstance(texts, pa.Array) else pa.concat_arrays(texts.chunks)
    # Repeated ids are told apart by a number that is cut off again.
    return Benchmark.of([f"{x}\0{block}.{i}" for i, x in enumerate(ids)], *utf8(texts))


_DDL = "n_words bigint, hit_from array<int>, hit_to array<int>, items array<string>, longest bigint, longest_from bigint"


def _found(docs: DataFrame, items: DataFrame, item_col: str, item_text: str) -> DataFrame:
    """``docs`` (``doc_id, text`` and more) without text and with hits."""
    rows, blocks = benchmark_rows(items, item_col, item_text)
    more = [f for f in docs.schema if f.name not in ("doc_id", "text")]
    ddl = ", ".join(["doc_id bigint", *(f"`{f.name}` {f.dataType.simpleString()}" for f in more), _DDL])
    docs = docs.select(F.col("doc_id").cast("bigint"), "text", *(f"`{f.name}`" for f in more))
    if blocks == 1:
        return mapped(docs, _searcher(benchmark_block(rows, 0)), ddl)
    # Several blocks: number the rows in a written table, search block by block, merge per row.
    docs = written(docs.withColumn("__n", F.monotonically_increasing_id()), "documents")
    lean_docs = docs.select("doc_id", "text", "__n")
    parts = None
    for block in range(blocks):
        own = written(mapped(lean_docs, _searcher(benchmark_block(rows, block)), "doc_id bigint, __n bigint, " + _DDL), "block")
        parts = own if parts is None else parts.unionByName(own)
    spans = F.flatten(F.collect_list(F.arrays_zip("hit_from", "hit_to")))
    merged = parts.groupBy("__n").agg(
        F.first("n_words").alias("n_words"), F.array_sort(spans).alias("spans"), F.array_sort(F.flatten(F.collect_list("items"))).alias("items"),
        F.max(F.struct("longest", (-F.col("longest_from")).alias("early"))).alias("best"),
    )
    # Sorted spans become disjoint ones: one that begins within the last is joined to it.
    step = """aggregate(spans, cast(array() as array<struct<hit_from:int, hit_to:int>>), (out, s) ->
        CASE WHEN size(out) = 0 OR element_at(out, -1).hit_to < s.hit_from THEN concat(out, array(s))
             ELSE concat(slice(out, 1, size(out) - 1), array(named_struct('hit_from', element_at(out, -1).hit_from,
                         'hit_to', greatest(element_at(out, -1).hit_to, s.hit_to)))) END)"""
    merged = merged.withColumn("spans", F.expr(step)).select("__n", "n_words", "spans.hit_from", "spans.hit_to", "items", "best.longest", (-F.col("best.early")).alias("longest_from"))
    return docs.drop("text").join(merged, "__n").drop("__n")


def _judged(found: DataFrame) -> DataFrame:
    n_hit = F.aggregate(F.arrays_zip("hit_from", "hit_to"), F.lit(0).cast("bigint"), lambda n, s: n + s["hit_to"] - s["hit_from"])
    out = found.withColumn("n_hit", n_hit)
    return out.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * SHARE >= F.col("n_words")))


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_words, hit_from, hit_to, items, longest, longest_from, n_hit, contaminated``.

    ``hit_from, hit_to`` are the maximal spans of hit words; ``items`` are the ids of items with an occurring
    window; ``longest`` is the number of words of the longest verbatim match with any item that begins where a window
    occurs (so of all matches of a window or more), and ``longest_from`` the first word of the first such match; 0 and
    null where no window occurs. Columns of ``docs`` other than these two are not read, whatever their names.
    """
    found = _judged(_found(lean(docs, id_col, text_col), items, item_col, item_text))
    return found.withColumn("items", F.transform("items", lambda x: F.substring_index(x, "\0", 1)))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    found = _judged(_found(packed(docs, id_col, text_col), items, item_col, item_text))
    return unpacked(found.where(~F.col("contaminated")), docs.columns)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
