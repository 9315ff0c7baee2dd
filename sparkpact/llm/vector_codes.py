"""Product codes of vectors by dual-tree Lloyd rounds, in integers.

Each component becomes ``floor(256 * x)``; a vector is cut into ``PARTS`` equal parts, and each part position has a
codebook of up to ``ENTRIES`` entries. ``vector_forest`` packs vectors into chunks and builds, for each chunk and part
position, a balanced k-d tree over the parts, with the box, the sum and the size of every node; it is written once and
read by every round. Each round walks that tree against a tree over the entries: a pair of nodes is dropped when the
least distance between their boxes is above the greatest distance to some other entry node, a node with one entry left is
assigned whole by its cached sum, and the parts of leaves with several entries left are compared one by one. All
distances, bounds and sums are integers, so pruning loses nothing and ties go to the lower index exactly.

A task holds one chunk. What tasks send on are sums per entry, combined before the shuffle; the driver sees the codebooks
alone, whose size is fixed by the parameters (parts x entries x components of a part).

Defined results: rows without a vector, or with a null or non-finite component, are dropped, as are vectors whose number
of components differs from the first kept one's (by id) or is no positive multiple of the parts; codebooks begin with
the first kept vectors by id, nulls last, ties by the vector, and have fewer entries if fewer are kept; repeated rows
count each; rows without a label are one label; an empty table gives no rows; other columns are not read. A component
beyond 2**24 in units of 1/256 raises an error, as errors would not fit in 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpact.llm.base import bounded, record, written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Vectors of a chunk, and parts of a leaf at most.
CHUNK, LEAF = 4096, 32
LIMIT = 1 << 24

_FOREST = {"vec_ids": pa.list_(pa.int64()), "labels": pa.list_(pa.string()), "points": pa.binary(), "orders": pa.binary(), "low": pa.binary(),
           "high": pa.binary(), "sums": pa.binary()}
_FOREST_DDL = "vec_ids array<bigint>, labels array<string>, points binary, orders binary, low binary, high binary, sums binary"


def _levels(n: int, leaf: int) -> int:
    """How often ``n`` items are halved until at most ``leaf`` are left; every node holds one at least."""
    levels = 0
    while n > leaf << levels and n >= 2 << levels:
        levels += 1
    return levels


def _bounds(n: int, level: int) -> np.ndarray:
    """Where the nodes of a level begin, and the end of the last."""
    return (np.arange((1 << level) + 1) * n) >> level


def tree_order(points: np.ndarray, levels: int) -> np.ndarray:
    """The points in the order of a balanced tree: each node is halved along the dimension in which it is widest."""
    order, n = np.arange(len(points)), len(points)
    for level in range(levels):
        bounds = _bounds(n, level)
        here = points[order]
        spread = np.maximum.reduceat(here, bounds[:-1]) - np.minimum.reduceat(here, bounds[:-1])
        node = np.repeat(np.arange(1 << level), np.diff(bounds))
        along = here[np.arange(n), spread.argmax(axis=1)[node]]
        order = order[np.lexsort((along, node))]
    return order


class Tree:
    """Boxes and sums of all nodes, level by level, of points in tree order."""

    def __init__(self, n: int, levels: int, low: np.ndarray, high: np.ndarray, sums: np.ndarray):
        self.n, self.levels, self.low, self.high, self.sums = n, levels, low, high, sums

    @staticmethod
    def of(points: np.ndarray, levels: int) -> "Tree":
        nodes = [_bounds(len(points), level)[:-1] for level in range(levels + 1)]
        joined = lambda f: np.concatenate([f.reduceat(points, at) for at in nodes])
        return Tree(len(points), levels, joined(np.minimum), joined(np.maximum), joined(np.add))

    def at(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Rows of ``low``, ``high`` and ``sums`` of nodes of a level."""
        return (1 << level) - 1 + nodes


class EntryTree:
    """The entries of one codebook in tree order; the last level is the entries themselves."""

    def __init__(self, entries: np.ndarray):
        self.levels = _levels(len(entries), 1)
        self.order = tree_order(entries, self.levels)
        self.entries = entries[self.order]
        bounds = [_bounds(len(entries), level) for level in range(self.levels + 1)]
        self.bounds = [*bounds, np.arange(len(entries) + 1)]
        self.low = [np.minimum.reduceat(self.entries, b[:-1]) for b in self.bounds]
        self.high = [np.maximum.reduceat(self.entries, b[:-1]) for b in self.bounds]

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nodes of the next level below each node, and how many each has."""
        own, below = self.bounds[level], self.bounds[level + 1]
        first = np.searchsorted(below, own[nodes])
        count = np.searchsorted(below, own[nodes + 1]) - first
        return _ranges(first, count), count


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``first[i], first[i] + 1, ...``, ``count[i]`` of them, one after another."""
    before = np.cumsum(count) - count
    return np.arange(int(count.sum())) - np.repeat(before - first, count)


class Assigned:
    """What a walk has found: whole nodes and single points, each with the index of its entry."""

    def __init__(self) -> None:
        self.nodes: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.points, self.codes = np.zeros(0, np.int64), np.zeros(0, np.int64)


def walk(tree: Tree, points: np.ndarray, entries: EntryTree) -> Assigned:
    """The nearest entry of every point (in tree order), by pairs of nodes of both trees."""
    out = Assigned()
    p = e = np.zeros(1, np.int64)
    p_level = e_level = 0
    last = len(entries.bounds) - 1
    while len(p):
        at = tree.at(p_level, p)
        low, high, e_low, e_high = tree.low[at], tree.high[at], entries.low[e_level][e], entries.high[e_level][e]
        gap = np.maximum(np.maximum(low - e_high, e_low - high), 0)
        reach = np.maximum(high - e_low, e_high - low)
        least, most = (gap * gap).sum(axis=1), (reach * reach).sum(axis=1)
        first = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
        count = np.diff(np.append(first, len(p)))
        # An entry at the same distance stays: it may have the lower index.
        kept = least <= np.repeat(np.minimum.reduceat(most, first), count)
        left = np.repeat(np.add.reduceat(kept.astype(np.int64), first), count)
        if e_level == last:
            done = kept & (left == 1)
            out.nodes.append((p_level, p[done], entries.order[e[done]]))
            kept &= ~done
        p, e = p[kept], e[kept]
        if e_level == last and p_level == tree.levels:
            break
        if e_level < last:
            e, count = entries.children(e_level, e)
            p = np.repeat(p, count)
            e_level += 1
        if p_level < tree.levels and len(p):
            # Both children of a node meet all entries of the node.
            first = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
            count = np.diff(np.append(first, len(p)))
            twice = np.repeat(first, 2), np.repeat(count, 2)
            node = np.repeat(p[first], 2) * 2 + np.tile([0, 1], len(first))
            e = e[_ranges(*twice)]
            p = np.repeat(node, twice[1])
            p_level += 1
    if len(p):
        _settle(tree, points, entries, p, e, out)
    return out


def _settle(tree: Tree, points: np.ndarray, entries: EntryTree, p: np.ndarray, e: np.ndarray, out: Assigned) -> None:
    """Every point of the leaves against every entry left to its leaf; of equal distances the lower index."""
    first = np.flatnonzero(np.concatenate(([True], p[1:] != p[:-1])))
    count = np.diff(np.append(first, len(p)))
    bounds = _bounds(tree.n, tree.levels)
    leaf = p[first]
    size = bounds[leaf + 1] - bounds[leaf]
    point = _ranges(bounds[leaf], size)
    n_entries, begin = np.repeat(count, size), np.repeat(first, size)
    entry = e[_ranges(begin, n_entries)]
    off = points[np.repeat(point, n_entries)] - entries.entries[entry]
    distance, index = (off * off).sum(axis=1), entries.order[entry]
    starts = np.cumsum(n_entries) - n_entries
    least = np.repeat(np.minimum.reduceat(distance, starts), n_entries)
    out.points = point
    out.codes = np.minimum.reduceat(np.where(distance == least, index, len(entries.order)), starts)


class Chunk:
    """The vectors of one row of the forest."""

    def __init__(self, row: dict, dims: int):
        self.ids, self.labels, self.n = row["vec_ids"], row["labels"], len(row["vec_ids"])
        self.levels = _levels(self.n, LEAF)
        of = lambda name, dtype: np.frombuffer(row[name], dtype).reshape(PARTS, -1, *(() if name == "orders" else (dims,)))
        self.points, self.orders = of("points", np.int32), of("orders", np.int32)
        self.low, self.high, self.sums = of("low", np.int32), of("high", np.int32), of("sums", np.int64)

    def assigned(self, part: int, entries: EntryTree) -> tuple[np.ndarray, Tree, Assigned]:
        points = self.points[part].astype(np.int64)
        tree = Tree(self.n, self.levels, self.low[part].astype(np.int64), self.high[part].astype(np.int64), self.sums[part])
        return points, tree, walk(tree, points, entries)


def _part_sums(chunk: Chunk, codebooks: list[np.ndarray], trees: list[EntryTree], sums: np.ndarray, counts: np.ndarray) -> None:
    """Add what each entry is given by a chunk: whole nodes by their cached sums, then single points."""
    for part, entries in enumerate(trees):
        points, tree, found = chunk.assigned(part, entries)
        for level, nodes, codes in found.nodes:
            bounds = _bounds(tree.n, level)
            np.add.at(sums[part], codes, tree.sums[tree.at(level, nodes)])
            np.add.at(counts[part], codes, bounds[nodes + 1] - bounds[nodes])
        np.add.at(sums[part], found.codes, points[found.points])
        np.add.at(counts[part], found.codes, 1)


def _codes(chunk: Chunk, codebooks: list[np.ndarray], trees: list[EntryTree]) -> tuple[np.ndarray, np.ndarray]:
    """Entry of every part of every vector, in the order of the chunk, and the squared distances summed over parts."""
    codes, error = np.zeros((chunk.n, PARTS), np.int64), np.zeros(chunk.n, np.int64)
    for part, entries in enumerate(trees):
        points, tree, found = chunk.assigned(part, entries)
        own = np.zeros(chunk.n, np.int64)
        for level, nodes, given in found.nodes:
            bounds = _bounds(tree.n, level)
            size = bounds[nodes + 1] - bounds[nodes]
            own[_ranges(bounds[nodes], size)] = np.repeat(given, size)
        own[found.points] = found.codes
        off = points - codebooks[part][own]
        order = chunk.orders[part]
        codes[order, part] = own
        error[order] += (off * off).sum(axis=1)
    return codes, error


def whole_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``vec_id, vector, label`` of rows whose vector has no null and no non-finite component."""
    vector = F.col(f"`{vector_col}`")
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    kept = bounded(rows).where(vector.isNotNull() & ~odd & (F.size(vector) > 0) & (F.size(vector) % PARTS == 0))
    return kept.select(
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), vector.cast("array<double>").alias("vector"), F.col(f"`{label_col}`").cast("string").alias("label")
    )


def _integers(values: np.ndarray) -> np.ndarray:
    out = np.floor(values * SCALE)
    if out.size and np.abs(out).max() > LIMIT:
        raise ValueError(f"a component is beyond {LIMIT / SCALE:.0f}: squared distances would not fit in 64 bits")
    return out.astype(np.int64)


def _by_part(vectors: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(vectors.reshape(len(vectors), PARTS, -1).swapaxes(0, 1))


def first_codebooks(vectors: DataFrame, entries: int = ENTRIES) -> list[np.ndarray]:
    """The parts of the first vectors by id, by part position; no codebooks if there are no vectors."""
    order = [F.col("vec_id").asc_nulls_last(), F.col("vector")]
    rows = vectors.select("vec_id", "vector").orderBy(*order).limit(entries).collect()
    same = [r["vector"] for r in rows if len(r["vector"]) == len(rows[0]["vector"])]
    return list(_by_part(_integers(np.array(same)))) if same else []


def vector_forest(vectors: DataFrame, dims: int) -> DataFrame:
    """Chunks of vectors with ``dims`` components a part, and their trees, written once."""

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, CHUNK):
                part = batch.slice(begin, CHUNK)
                values = _by_part(_integers(part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)))
                levels = _levels(part.num_rows, LEAF)
                orders = [tree_order(v, levels) for v in values]
                values = [v[o] for v, o in zip(values, orders)]
                built = [Tree.of(v, levels) for v in values]
                packed = lambda arrays, dtype: b"".join(a.astype(dtype).tobytes() for a in arrays)
                columns = (
                    packed(values, np.int32), packed(orders, np.int32), packed([t.low for t in built], np.int32),
                    packed([t.high for t in built], np.int32), packed([t.sums for t in built], np.int64),
                )
                yield record(_FOREST, [part.column(0).to_pylist()], [part.column(2).to_pylist()], *([c] for c in columns))

    same = vectors.where(F.size("vector") == dims * PARTS)
    return written(same.mapInArrow(trees, _FOREST_DDL), "vector-forest")


def _chunks(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[Chunk]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield Chunk({name: batch.column(name)[i].as_py() for name in _FOREST}, dims)


def lloyd_round(forest: DataFrame, codebooks: list[np.ndarray]) -> list[np.ndarray]:
    """Codebooks whose entries are the floored means of their parts; entries without parts stay."""
    dims = codebooks[0].shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [EntryTree(c) for c in codebooks]
        total = np.zeros((PARTS, len(codebooks[0]), dims), np.int64)
        counts = np.zeros(total.shape[:2], np.int64)
        for chunk in _chunks(batches, dims):
            _part_sums(chunk, codebooks, trees, total, counts)
        part, entry = np.nonzero(counts)
        given = np.concatenate((counts[part, entry][:, None], total[part, entry]), axis=1)
        # One line for each component, and one, under -1, for the count.
        places = np.tile(np.arange(-1, dims), len(part))
        schema = {"part": pa.int32(), "entry": pa.int32(), "place": pa.int32(), "value": pa.int64()}
        yield record(schema, np.repeat(part, dims + 1), np.repeat(entry, dims + 1), places, given.ravel())

    lines = forest.mapInArrow(sums, "part int, entry int, place int, value bigint")
    found = {(r["part"], r["entry"], r["place"]): r["value"] for r in lines.groupBy("part", "entry", "place").agg(F.sum("value").alias("value")).collect()}
    out = [c.copy() for c in codebooks]
    for (part, entry, place), value in found.items():
        if place >= 0:
            out[part][entry, place] = value // found[part, entry, -1]
    return out


def vector_codes(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """``vec_id, label, code, error`` of every kept vector, written once, and the codebooks by part position.

    ``code`` has two hex digits for each part, ``error`` the squared distance to what it stands for.
    """
    ddl = "vec_id bigint, label string, code string, error bigint"
    vectors = whole_vectors(rows, id_col, vector_col, label_col)
    codebooks = first_codebooks(vectors)
    if not codebooks:
        return rows.sparkSession.createDataFrame([], ddl), codebooks
    dims = codebooks[0].shape[1]
    forest = vector_forest(vectors, dims)
    for _ in range(rounds):
        codebooks = lloyd_round(forest, codebooks)

    schema = {"vec_id": pa.int64(), "label": pa.string(), "code": pa.string(), "error": pa.int64()}

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = [EntryTree(c) for c in codebooks]
        for chunk in _chunks(batches, dims):
            codes, error = _codes(chunk, codebooks, trees)
            yield record(schema, chunk.ids, chunk.labels, [bytes(c).hex() for c in codes.astype(np.uint8)], error)

    return written(forest.mapInArrow(coded, ddl), "vector-codes"), codebooks


def with_label_errors(coded: DataFrame) -> DataFrame:
    """Adds ``label_error``: errors are summed per label before the shuffle, and joined back by label."""
    # Written, so that Spark knows the size of the totals and leaves the rows where they are if it is small.
    totals = written(coded.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return coded.join(totals, coded["label"].eqNullSafe(totals["__label"]), "left").drop("__label")


def codebooks_sha256(codebooks: list[np.ndarray]) -> Column:
    text = ",".join(str(x) for c in codebooks for x in c.ravel().tolist())
    return F.lit(hashlib.sha256(text.encode()).hexdigest())
