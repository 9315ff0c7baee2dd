"""Near duplicates: an exact Jaccard join of word shingles with count-vector R-trees.

A document's set holds its distinct shingles of five words (A-Z lower-cased, words parted by
``[\\x20\\x09-\\x0D]``), or its whole word sequence if it has fewer. Two documents link when
``100 * intersection >= 75 * union``; a document's component is all it reaches by links.

1. Equal sets are one class. A class needs ``ceil(3 n / 4)`` of its ``n`` shingles in a partner's set.
2. First cut. Of each set the first ``n - ceil(3 n / 4) + l`` hashes in ascending order go to an exchange, with ``l``
   a tenth of ``n``, one at least. Two sets that link share as many of them as the smaller ``l``, and the smaller
   set has three quarters of the larger at least. So a class stays only if a tenth of ``ceil(3 n / 4)`` of its
   hashes also occur in others; most classes leave here.
3. Second cut, on whole sets of the classes that stay. How many of them hold a shingle orders the shingles, rare ones
   first. A class stays only if ``ceil(3 n / 4)`` of its shingles occur in others. Of those that link, each has one of
   the partner's shingles among its first ``n - ceil(3 n / 4) + 1`` in that order: what many documents share,
   a licence, a line, comes last and connects nobody.
4. Blocks. Classes that share one of those first shingles are chained, neighbours by size among those of one
   shingle: a link never leaves its block. Chains are linear in the rows, however many classes share a shingle.
5. In a block the hashes of each set are counted in ``GROUPS`` groups; the counts are a point. Points are packed
   into an R-tree whose nodes keep the largest coordinates, and the sum of the coordinatewise minima bounds
   the intersection: a subtree is skipped when the bound is too small for a link. Surviving pairs are verified
   on the whole sets. Pairs already connected are not verified again, so a family of a thousand copies takes
   about a thousand verifications. Texts of one template that share most shingles and link with nobody would all be
   compared in such a tree, so a block of more than ``SMALL`` sets is parted first by its own rarest shingles, where a
   partner that is not smaller is held against fewer of them. A block of more than ``TILE`` shingles or ``TILE_SETS`` sets
   is cut into tiles by a hash, and each pair of tiles is a task of its own, so no task holds more than two tiles.
6. The links found (a forest for each task) are connected again.

Classes are told apart by two 64-bit hashes: one is their name, the other replaces it where several classes have it.
Shingles are told apart by 64 bits, so an intersection is off by one in one of 2**64 pairs of shingles that meet in two
sets. Nothing is capped. Defined results: null text and text
without words have an empty set and link with nothing; null ``doc_id`` counts above all others; repeated rows are
copies; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkpact.llm.base import ROW, lean, mapped, packed, record, scramble, sliced, unpacked, utf8, written
from sparkpact.llm.components import components
from sparkpact.llm.shingles import WORDS, shingle_sets

GROUPS_BITS = 8
GROUPS = 1 << GROUPS_BITS
PAGE = 16
TILE, TILE_SETS = 4 << 20, 1 << 16
#: Up to so many sets a block goes to one tree; a shingle that so few smaller sets are known by has its pairs verified.
SMALL, FEW = 64, 16
#: Bits of a hash that the first cut compares; fewer only let more classes stay.
CUT_BITS = 44
#: From so many holders on, shingles count as equally common.
COMMON = 4096
_SEED, _SECOND = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
#: First hashes that several sets may have; more than chance gives for any number of sets that can be stored.
TWICE = 100_000


def _mixed(shingles: np.ndarray, seed: np.uint64) -> int:
    mixed = scramble(shingles ^ seed).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(scramble(np.array([mixed]))[0].view(np.int64))


@dataclass(frozen=True)
class Names:
    """What a set is called: a signed 64-bit hash, and a second one where several sets have the first.

    ``twice`` holds the first hashes of several sets. By chance one in 2**65 pairs of sets has one: some three for
    10**10 sets, some three hundred for 10**11. ``bits`` is 64; with fewer, first hashes are made to collide.
    """

    twice: frozenset[int] = frozenset()
    bits: int = 64

    def first(self, shingles: np.ndarray) -> int:
        return _mixed(shingles, _SEED) >> (64 - self.bits)

    def second(self, shingles: np.ndarray) -> int:
        return _mixed(shingles, _SECOND)

    def of(self, shingles: np.ndarray) -> int:
        first = self.first(shingles)
        return self.second(shingles) if first in self.twice else first


def needed(n: int) -> int:
    """Shingles that a partner of a set of ``n`` must share."""
    return -(-3 * n // 4)


def prefix_need(n: int) -> int:
    """By how many hashes the prefix is longer than one shared hash needs, and that one."""
    return min(max(1, n // 10), needed(n))


def _sets_of(batch: pa.RecordBatch, width: int) -> list[np.ndarray]:
    return shingle_sets(*utf8(batch.column(1)), width)


def _classes(docs: DataFrame, width: int, bits: int) -> tuple[DataFrame, Names]:
    """``doc_id, key, n`` of every row, and how their sets are called."""
    names = Names(bits=bits)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = _sets_of(batch, width)
        schema = {"doc_id": pa.int64(), "first": pa.int64(), "second": pa.int64(), "n": pa.int64()}
        return record(schema, batch.column(0), [names.first(s) for s in sets], [names.second(s) for s in sets], [len(s) for s in sets])

    own = written(mapped(docs, step, "doc_id bigint, first bigint, second bigint, n bigint"), "classes")
    seen = own.where("n > 0").groupBy("first").agg(F.min("second").alias("least"), F.max("second").alias("most"))
    twice = [r["first"] for r in seen.where("least <> most").select("first").limit(TWICE + 1).collect()]
    if len(twice) > TWICE:
        raise ValueError(f"more than {TWICE} hashes of several sets each; {bits} bits are too few")
    key = F.when(F.col("first").isin(twice), F.col("second")).otherwise(F.col("first")) if twice else F.col("first")
    return own.select("doc_id", key.alias("key"), "n"), Names(frozenset(twice), bits)


def _prefixes(docs: DataFrame, width: int, names: Names) -> DataFrame:
    """``h, key`` for the prefix of every set."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        sets = [s for s in _sets_of(batch, width) if len(s)]
        cut = [s[: len(s) - needed(len(s)) + prefix_need(len(s))] for s in sets]
        if not cut:
            return None
        keys = np.repeat(np.array([names.of(s) for s in sets], np.int64), [len(c) for c in cut])
        return record({"h": pa.int64(), "key": pa.int64()}, (np.concatenate(cut) >> np.uint64(64 - CUT_BITS)).view(np.int64), keys)

    return mapped(docs, step, "h bigint, key bigint")


def _shared(rows: DataFrame) -> DataFrame:
    """Distinct ``h, key`` whose ``h`` occurs with another key, in one pass over sorted partitions."""
    ordered = rows.repartition(F.col("h")).sortWithinPartitions("h", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_h, held_key, held_shared = np.zeros(0, np.int64), np.zeros(0, np.int64), False
        for batch in batches:
            h = np.concatenate((held_h, batch.column(0).to_numpy()))
            key = np.concatenate((held_key, batch.column(1).to_numpy()))
            if not len(h):
                continue
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (key[1:] != key[:-1])
            h, key = h[new], key[new]
            same = h[1:] == h[:-1]
            shared = np.zeros(len(h), bool)
            shared[1:] |= same
            shared[:-1] |= same
            shared[0] |= held_shared
            # The last row may be shared with the first of the next batch.
            out = shared[:-1]
            yield pa.record_batch([pa.array(h[:-1][out]), pa.array(key[:-1][out])], ["h", "key"])
            held_h, held_key, held_shared = h[-1:], key[-1:], bool(shared[-1])
        if len(held_h) and held_shared:
            yield pa.record_batch([pa.array(held_h), pa.array(held_key)], ["h", "key"])

    return ordered.mapInArrow(run, "h bigint, key bigint")


def _staying(docs: DataFrame, classes: DataFrame, width: int, names: Names) -> DataFrame:
    """``key, n, id`` of the classes that pass the first cut; ``id`` is the class's least document."""
    shared = _shared(_prefixes(docs, width, names))
    # A partner has at least ceil(3 n / 4) shingles, and may show only the tenth of its own prefix.
    need = F.expr("greatest(1L, ((3 * n + 3) div 4) div 10)")
    counts = shared.groupBy("key").agg(F.count(F.lit(1)).alias("have"))
    members = classes.groupBy("key").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"))
    return counts.join(members, "key").where(F.col("have") >= need).select("key", "n", "id")


def _whole_sets(docs: DataFrame, staying: DataFrame, width: int, names: Names) -> DataFrame:
    """``key, n, shingles`` of those classes, from one document of each."""
    wanted = staying.select("id", "key")
    rows = docs.join(wanted.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(wanted["id"])).select("doc_id", "text", "key")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        # A repeated doc_id may have other texts; the class is the one asked for.
        own = [(k, len(s), s.tobytes()) for s, k in zip(_sets_of(batch, width), batch.column(2).to_pylist()) if len(s) and names.of(s) == k]
        return record({"key": pa.int64(), "n": pa.int64(), "shingles": pa.binary()}, *zip(*own)) if own else None

    return mapped(rows, step, "key bigint, n bigint, shingles binary")


def _with_holders(sets: DataFrame) -> DataFrame:
    """``key, h, n, holders`` for every shingle that several classes hold, ``holders`` up to ``COMMON``."""
    schema = {"h": pa.int64(), "key": pa.int64(), "n": pa.int32()}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, text=2):
            data, offsets = utf8(part.column(2))
            counts = np.diff(offsets) // 8
            keys, sizes = (np.repeat(part.column(i).to_numpy(), counts) for i in (0, 1))
            yield record(schema, np.frombuffer(data.tobytes(), np.int64), keys, sizes.astype(np.int32))

    rows = sets.mapInArrow(spread, "h bigint, key bigint, n int")
    ordered = rows.repartition(F.col("h")).sortWithinPartitions("h", "key")
    names = ["key", "h", "n", "holders"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What is held back: the rows of the last shingle so far, and whether it was found common already.
        held, common = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int32)), False

        def told(h, key, n, last: bool):
            nonlocal held, common
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (key[1:] != key[:-1])
            h, key, n = h[new], key[new], n[new]
            begins = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
            sizes = np.diff(np.append(begins, len(h)))
            if common:
                sizes[0] = COMMON
            holders = np.repeat(np.minimum(sizes, COMMON), np.diff(np.append(begins, len(h))))
            if last:
                out = holders > 1
                held = (h[:0], key[:0], n[:0])
            else:
                common = bool(sizes[-1] >= COMMON)
                # Rows of the last shingle wait for the rest of it, unless enough are known; one stays as its mark.
                keep = len(h) - 1 if common else int(begins[-1])
                out = np.zeros(len(h), bool)
                out[:keep] = holders[:keep] > 1
                held = (h[keep:], key[keep:], n[keep:])
            return pa.record_batch([pa.array(key[out]), pa.array(h[out]), pa.array(n[out]), pa.array(holders[out].astype(np.int32))], names)

        for batch in batches:
            columns = [np.concatenate((a, batch.column(i).to_numpy())) for i, a in enumerate(held)]
            if len(columns[0]):
                yield told(*columns, False)
        if len(held[0]):
            yield told(*held, True)

    return ordered.mapInArrow(run, "key bigint, h bigint, n int, holders int")


def _rare(rows: DataFrame) -> DataFrame:
    """``h, key, n``: of the classes that pass the second cut, the shared ones among their first shingles."""
    ordered = rows.repartition(F.col("key")).sortWithinPartitions("key", "holders", "h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int32))

        def first(key, h, n):
            begins = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            have = np.diff(np.append(begins, len(key)))
            rank = np.arange(len(key)) - np.repeat(begins, have)
            size = n[begins].astype(np.int64)
            # Unshared shingles come before all shared ones and take their places among the first.
            places = have - (3 * size + 3) // 4 + 1
            out = rank < np.repeat(places, have)
            return pa.record_batch([pa.array(h[out]), pa.array(key[out]), pa.array(n[out])], ["h", "key", "n"])

        for batch in batches:
            key, h, n = (np.concatenate((a, batch.column(i).to_numpy())) for i, a in enumerate(held))
            if not len(key):
                continue
            cut = int(np.searchsorted(key, key[-1]))  # the last class may go on
            if cut:
                yield first(key[:cut], h[:cut], n[:cut])
            held = (key[cut:], h[cut:], n[cut:])
        if len(held[0]):
            yield first(*held)

    return ordered.mapInArrow(run, "h bigint, key bigint, n int")


def _blocks(sets: DataFrame) -> DataFrame:
    """``key, block`` of the classes that may link with another."""
    rows = _rare(_with_holders(sets))
    # Of one shingle only neighbours by size are chained, unless the smaller is too small even for the next.
    turn = Window.partitionBy("h").orderBy("n", "key")
    chained = rows.select(F.col("key").alias("a"), F.lag("key").over(turn).alias("b"), "n", F.lag("n").over(turn).alias("m"))
    edges = chained.where("b is not null and a <> b and 4 * m >= 3 * n").select("a", "b")
    found = components(edges, "blocks")
    return found.select(F.col("node").alias("key"), F.col("component").alias("block"))


class CountTree:
    """A packed R-tree over points of counts; ``order`` puts like sets side by side."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = np.array([len(s) for s in sets], np.int64)
        self.order = np.lexsort((self.sizes, np.array([s[0] for s in sets], np.uint64)))
        shift = np.uint64(64 - GROUPS_BITS)
        points = [np.bincount((scramble(sets[i]) >> shift).astype(np.int64), minlength=GROUPS) for i in self.order]
        self.points = np.array(points, np.int32).reshape(-1, GROUPS)
        sizes = self.sizes[self.order]
        # Each level: largest coordinates, least and greatest size of every node; level 0 has the pages.
        self.levels = []
        top, low, high = self.points, sizes, sizes
        while not self.levels or len(top) > 1:
            at = np.arange(0, len(top), PAGE)
            top, low, high = (np.maximum.reduceat(top, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at))
            self.levels.append((top, low, high))
            if len(at) == 1:
                break

    def pages(self, page: int) -> list[int]:
        """Pages from this one on whose bound allows a link with a point of this one."""
        begin, end = page * PAGE, min(len(self.order), (page + 1) * PAGE)
        points, sizes = self.points[begin:end], self.sizes[self.order[begin:end]]
        nodes = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            # Nodes wholly before this page were its partners when they asked.
            nodes = nodes[(nodes + 1) * PAGE**level > page]
            top, low, high = (x[nodes] for x in self.levels[level])
            keep = np.zeros(len(nodes), bool)
            for point, size in zip(points, sizes.tolist()):
                open_ = np.flatnonzero(~keep & (4 * high >= 3 * size) & (3 * low <= 4 * size))
                if len(open_):
                    bound = np.minimum(top[open_], point).sum(axis=1)
                    keep[open_] = 7 * bound >= 3 * (size + low[open_])
            nodes = nodes[keep]
            if level:
                below = (nodes[:, None] * PAGE + np.arange(PAGE)).ravel()
                nodes = below[below < len(self.levels[level - 1][0])]
        return nodes[nodes >= page].tolist()


class Roots:
    """Which sets are connected: a label for each, kept by giving the smaller side the label of the larger."""

    def __init__(self, sets: list[np.ndarray]):
        self.sets, self.label = sets, np.arange(len(sets))
        self.members: dict[int, list[int]] = {}
        self.found: list[tuple[int, int]] = []

    def verify(self, a: int, b: int) -> None:
        """Connect two sets if they link and are not connected yet."""
        if self.label[a] == self.label[b]:
            return
        x, y = self.sets[a], self.sets[b]
        both = len(np.intersect1d(x, y, assume_unique=True))
        if 100 * both >= 75 * (len(x) + len(y) - both):
            self.found.append((a, b))
            self.connect(a, b)

    def connect(self, a: int, b: int) -> None:
        i, j = int(self.label[a]), int(self.label[b])
        if i == j:
            return
        one, two = self.members.pop(i, [i]), self.members.pop(j, [j])
        if len(one) < len(two):
            one, two, i = two, one, j
        self.label[two] = i
        one.extend(two)
        self.members[i] = one


def _first_shingles(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle, set and rank of what each set is known by: its first ``n - ceil(3 n / 4) + 1``, those rare among these sets first."""
    size = np.array([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), size)
    _, shingle, holders = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.lexsort((shingle, holders[shingle], owner))
    shingle, owner = shingle[order], owner[order]
    rank = np.arange(len(shingle)) - (np.cumsum(size) - size)[owner]
    first = rank < (size - (3 * size + 3) // 4 + 1)[owner]
    return shingle[first], owner[first], rank[first]


def _parted(roots: Roots, side: np.ndarray | None) -> list[np.ndarray]:
    """The sets in parts that no unverified link leaves.

    Of two sets that link, the one that is not larger has at least six sevenths of its shingles in the other. So the two
    share a shingle that is among the first ``n - ceil(6 n / 7) + 1`` of that one, and among the first
    ``n - ceil(3 n / 4) + 1`` of the other. A shingle that no set has among its fewer ones connects nobody; one that few
    have so has their pairs verified at once; all others chain their sets into one part.
    """
    sets = roots.sets
    size = np.array([len(x) for x in sets], np.int64)
    shingle, owner, rank = _first_shingles(sets)
    by = np.lexsort((owner, shingle))
    shingle, owner, rank = shingle[by], owner[by], rank[by]
    known = rank < (size - (6 * size + 6) // 7 + 1)[owner]
    parts = Roots(sets)
    begins = np.flatnonzero(np.append(True, shingle[1:] != shingle[:-1]))
    ends = np.append(begins[1:], len(shingle))
    meet = (ends - begins > 1) & np.logical_or.reduceat(known, begins)
    for begin, end in zip(begins[meet].tolist(), ends[meet].tolist()):
        own = owner[begin:end]
        few = own[known[begin:end]]
        if len(few) > FEW:
            for other in own[1:].tolist():
                parts.connect(int(own[0]), other)
            continue
        for a in few.tolist():
            for b in own[size[own] >= size[a]].tolist():
                if a != b and 4 * size[a] >= 3 * size[b] and (side is None or side[a] != side[b]):
                    roots.verify(a, b)
    order = np.argsort(parts.label, kind="stable")
    return [x for x in np.split(order, np.flatnonzero(np.diff(parts.label[order])) + 1) if len(x) > 1]


def links(sets: list[np.ndarray], side: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Enough linked pairs to connect all that links connect; with ``side``, of pairs across the sides only."""
    roots = Roots(sets)
    if len(sets) > 1:
        for part in _parted(roots, side) if len(sets) > SMALL else [np.arange(len(sets))]:
            _by_tree(roots, part, side)
    return roots.found


def _by_tree(roots: Roots, part: np.ndarray, side: np.ndarray | None) -> None:
    """Verify the pairs of a part that its tree leaves."""
    tree = CountTree([roots.sets[i] for i in part])
    places, sizes = part[tree.order], tree.sizes[tree.order]
    for page in range(len(tree.levels[0][0])):
        here = slice(page * PAGE, (page + 1) * PAGE)
        own = places[here]
        for other in tree.pages(page):
            there = slice(other * PAGE, (other + 1) * PAGE)
            theirs = places[there]
            open_ = roots.label[own][:, None] != roots.label[theirs][None, :]
            if other == page:
                open_ &= np.triu(np.ones(open_.shape, bool), 1)
            if side is not None:
                open_ &= side[own][:, None] != side[theirs][None, :]
            if not open_.any():
                continue
            bound = np.minimum(tree.points[here][:, None, :], tree.points[None, there, :]).sum(axis=2)
            open_ &= 7 * bound >= 3 * (sizes[here][:, None] + sizes[there][None, :])
            for i, j in zip(*np.nonzero(open_)):
                roots.verify(int(own[i]), int(theirs[j]))


def _links(sets: DataFrame, blocks: DataFrame) -> DataFrame:
    """Links between classes: ``a, b``."""
    members = sets.join(blocks, "key")
    full = F.greatest(F.sum("n") / F.lit(TILE), F.count(F.lit(1)) / F.lit(TILE_SETS))
    tiles = members.groupBy("block").agg(F.ceil(full).cast("int").alias("tiles"))
    found = members.join(tiles, "block").withColumn("tile", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int"))
    found = found.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    found = found.select("block", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), "tile", "key", "shingles")

    def joined(table: pa.Table) -> pa.Table:
        keys, own = np.unique(table.column("key").to_numpy(), return_index=True)
        own = own.tolist()
        shingles = table.column("shingles").to_pylist()
        cross = table.column("i")[0] != table.column("j")[0]
        side = table.column("tile").to_numpy()[own] if cross else None
        pairs = links([np.frombuffer(shingles[k], np.uint64) for k in own], side)
        return pa.table({"a": pa.array([int(keys[a]) for a, _ in pairs], pa.int64()), "b": pa.array([int(keys[b]) for _, b in pairs], pa.int64())})

    return found.groupBy("block", "i", "j").applyInArrow(joined, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS, key_bits: int = 64) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, key``; the component is its least ``doc_id``."""
    return _near_duplicates(docs, id_col, text_col, width, key_bits)[0]


def _near_duplicates(docs: DataFrame, id_col: str, text_col: str, width: int, key_bits: int) -> tuple[DataFrame, Names]:
    docs = lean(docs, id_col, text_col).select(F.col("doc_id").cast("bigint"), "text")
    own, names = _classes(docs, width, key_bits)
    classes = own.where("n > 0")
    staying = written(_staying(docs, classes, width, names), "staying")
    sets = written(_whole_sets(docs, staying, width, names), "sets")
    blocks = written(_blocks(sets), "block-members")
    linked = components(_links(sets, blocks), "links")
    # The least doc_id of a class, then of its component.
    least = classes.groupBy("key").agg(F.min("doc_id").alias("least")).join(linked.withColumnRenamed("node", "key"), "key", "left")
    least = least.select("key", "least", F.coalesce("component", "key").alias("component"))
    lowest = least.groupBy("component").agg(F.min("least").alias("component_id"))
    named = least.join(lowest, "component").select("key", "component_id")
    full = classes.join(named, "key").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "key")
    return full.unionByName(own.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "key")), names


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WORDS, key_bits: int = 64) -> DataFrame:
    """The rows of ``docs`` that stay, with all columns: of each component the one with the least ``doc_id``.

    Documents without shingles all stay. Of repeated rows one stays.
    """
    found, names = _near_duplicates(docs, id_col, text_col, width, key_bits)
    keep = found.where((F.col("n_shingles") > 0) & F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("id"), F.col("key").alias("class")).distinct()
    rows = packed(docs, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = _sets_of(batch, width)
        keys = pa.array([names.of(s) for s in sets], pa.int64())
        return pa.record_batch([batch.column(0), keys, batch.column(2)], ["doc_id", "key", ROW])

    wordless = ~F.coalesce("text", F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    keyed = mapped(rows.where(~wordless), step, f"doc_id bigint, key bigint, `{ROW}` {rows.schema[ROW].dataType.simpleString()}")
    turn = F.row_number().over(Window.partitionBy("doc_id", "key").orderBy(F.lit(0)))
    first = keyed.withColumn("turn", turn).where("turn = 1")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("class"))
    return unpacked(first.join(keep, same, "left_semi"), docs.columns).unionByName(unpacked(rows.where(wordless), docs.columns))
