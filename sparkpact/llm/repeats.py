"""Repeated passages removed by a hash-compared suffix sort.

A byte goes when a string of ``LENGTH`` bytes that covers it also begins anywhere else, in the same document or
another. Strings are judged on the input; matches never cross documents.

Sorting the suffixes at every byte of a corpus would move it many times over. So a sparse set of suffixes is
sorted, chosen so that nothing is lost: of the ``GRAM``-byte strings inside a window of ``LENGTH`` bytes the one
with the least hash, leftmost of equals, is the window's anchor. Equal windows have their anchors at the same
place, so whatever repeats does so at suffixes that begin at anchors, about one in 150 bytes. The windows of one anchor
are consecutive: a run.

1. Every run is an anchor's hash, the hash of the run's bytes (two prefix polynomials over 2**64, independent
   bases), and where it lies. Runs that are equal within a step of a task are settled there, and one of them goes
   on for all: a line that fills a third of the corpus sends one row for each step. Runs are exchanged by the
   anchor's hash and sorted; neighbours tell. A run whose bytes occur again repeats as a whole. A run that only shares its anchor is open, and so is one run of
   each kind beside it.
2. The bytes of open runs meet by their anchor. In a task the suffixes at the anchors are sorted by a mergesort
   that compares two suffixes by binary search on their prefix hashes: the longest common extension takes
   ``log2(LENGTH)`` steps, and the next byte decides. The reversed prefixes are sorted alike. In sorted order the
   longest extension of a suffix, to the right and to the left, is the one with a neighbour; windows that
   reach beyond either cannot repeat. What is left, few windows for each end of a passage, is sorted by
   window hash, and equal hashes are compared byte by byte before they count.
3. Spans are united per document and removed.

An anchor shared by more than ``HELD`` open runs is not sorted in one task: each of its windows is counted by its
hash in an exchange with partial sums, and compared by a second hash. Both ways find the same windows.

Defined results: null text is empty text; repeated rows repeat each other; texts shorter than ``LENGTH`` stay as they
are; an empty table gives an empty result. Null ``doc_id`` is an id like others here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpact.llm.base import BASE, BYTE_VALUES, lean, mapped, prefix_sums, record, runs_of, scramble, span_hashes, utf8, written

LENGTH = 400
GRAM = 100
HELD = 20_000
STEP = 1 << 20
#: Base of the second polynomial.
OTHER = 0xD1342543DE82EF95
#: Bytes of a longer text whose runs are made at a time; far more than a window.
PART = 1 << 20
#: Low bits of an anchor's rank that hold its place in a part.
_PLACE = 28

_RUN = {"kind": pa.int32(), "fp": pa.int64(), "seg": pa.int64(), "twin": pa.int64(), "doc_id": pa.int64(), "th": pa.int64(), "lo": pa.int32(), "at": pa.int32(), "m": pa.int32(), "done": pa.bool_()}
_RUN_DDL = "kind int, fp bigint, seg bigint, twin bigint, doc_id bigint, th bigint, lo int, at int, m int, done boolean"
#: Rows of the written table: a run that stands for all of its kind in a step, and bytes that repeat within a step.
_WITNESS, _SETTLED = 0, 1


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = len(values) - width + 1
    whole = -(-len(values) // width) * width
    blocks = np.full(whole, np.iinfo(np.uint64).max, np.uint64)
    blocks[: len(values)] = values
    blocks = blocks.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def window_runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of windows with one anchor: text, first window, anchor (places in the text), windows; and their hashes."""
    if np.diff(offsets).max(initial=0) <= PART:
        return _window_runs(data, offsets, length, gram)
    # A part's last run may go on: it is left to the next part, which begins with its first window.
    found = []
    for text, (begin, end) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        at = begin
        while at is not None:
            stop = min(at + PART, end)
            own = list(_window_runs(data[at:stop], np.array([0, stop - at]), length, gram))
            after = None
            if stop < end:
                after = at + int(own[1][-1])
                own = [x[:-1] for x in own]
            found.append([own[0] + text, own[1] + (at - begin), own[2] + (at - begin), *own[3:]])
            at = after
    return tuple(np.concatenate(x) for x in zip(*found))


def _window_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    n = len(data) - length + 1
    none = np.zeros(0, np.int64)
    if n <= 0:
        return none, none, none, none, *(np.zeros(0, np.uint64),) * 3
    sums = prefix_sums(BYTE_VALUES[data])
    at = np.arange(len(data) - gram + 1)
    hashes = span_hashes(sums, at, at + gram)
    place = at - np.repeat(offsets[:-1], np.diff(offsets))[: len(at)]
    ranks = (hashes >> np.uint64(_PLACE) << np.uint64(_PLACE)) | (place.astype(np.uint64) & np.uint64((1 << _PLACE) - 1))
    least = sliding_least(ranks, length - gram + 1)
    # Windows that begin in a text and end in it.
    lengths = np.diff(offsets)
    text = np.repeat(np.arange(len(lengths)), lengths)[:n]
    valid = np.arange(n) + length <= offsets[1:][text]
    change = np.ones(n, bool)
    change[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    begin = np.flatnonzero(valid & change)
    ends = np.flatnonzero(valid & np.append(change[1:] | ~valid[1:], True))
    # A run begins where the anchor changes and ends before the next change or at the text's last window.
    text, first = text[begin], begin
    anchor = (least[begin] & np.uint64((1 << _PLACE) - 1)).astype(np.int64) + offsets[:-1][text]
    windows = ends - begin + 1
    fp = hashes[anchor]
    shift = scramble((anchor - first).astype(np.uint64) + np.uint64(1))
    seg = scramble(span_hashes(sums, first, ends + length) ^ shift)
    del sums, hashes, ranks, least
    twin = scramble(span_hashes(prefix_sums(BYTE_VALUES[data], OTHER), first, ends + length, OTHER) ^ shift)
    base = offsets[:-1][text]
    return text, first - base, anchor - base, windows, fp, seg, twin


def _united(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping spans of each text as one; spans come in order of text and begin."""
    if not len(text):
        return text, begin, end
    wide = text * (int(end.max()) + 1)
    reach = np.maximum.accumulate(wide + end)
    new = np.append(True, (wide + begin)[1:] > reach[:-1])
    at = np.flatnonzero(new)
    return text[at], begin[at], reach[np.append(at[1:], len(text)) - 1] - wide[at]


def _runs(docs: DataFrame, length: int, gram: int) -> DataFrame:
    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        text, first, anchor, windows, fp, seg, twin = window_runs(*utf8(batch.column(1)), length, gram)
        order = np.lexsort((twin, seg, fp))
        same = (fp[order[1:]] == fp[order[:-1]]) & (seg[order[1:]] == seg[order[:-1]]) & (twin[order[1:]] == twin[order[:-1]])
        begins = np.flatnonzero(np.append(True, ~same)) if len(order) else order
        sizes = np.diff(np.append(begins, len(order)))
        often = np.zeros(len(order), bool)
        often[order] = np.repeat(sizes > 1, sizes)
        witness = order[begins]
        where, a, b = _united(text[often], first[often], first[often] + windows[often] - 1 + length)
        zeros = np.zeros(len(where), np.int64)
        owner = pa.array(np.concatenate((text[witness], where)))
        joined = lambda x, y: np.concatenate((x[witness], y))
        return record(
            _RUN,
            np.concatenate((np.full(len(witness), _WITNESS), np.full(len(where), _SETTLED))).astype(np.int32),
            *(joined(x.view(np.int64), zeros) for x in (fp, seg, twin)),
            batch.column(0).take(owner),
            batch.column(2).take(owner),
            joined(first, a).astype(np.int32),
            joined(anchor, zeros).astype(np.int32),
            joined(windows, b - a).astype(np.int32),
            joined(often, zeros.astype(bool)),
        )

    return mapped(docs, step, _RUN_DDL, STEP)


def _told(runs: DataFrame) -> DataFrame:
    """Runs that repeat as a whole (``done``) or are open, from their neighbours in the order of the hashes."""
    columns = ["fp", "seg", "twin", "doc_id", "th", "lo", "at", "m", "done"]
    ordered = runs.select(*columns).repartition(F.col("fp")).sortWithinPartitions("fp", "seg", "twin")

    def judge(table: pa.Table, known: tuple[bool, bool], last: bool) -> tuple[list[pa.RecordBatch], pa.Table, tuple[bool, bool]]:
        """``known``: of the first row, whether the row before it has its bytes, and whether it has its anchor only."""
        fp, seg, twin = (table.column(i).to_numpy() for i in range(3))
        anchor = fp[1:] == fp[:-1]
        same = anchor & (seg[1:] == seg[:-1]) & (twin[1:] == twin[:-1])
        done, open_ = table.column("done").to_numpy().copy(), np.zeros(len(fp), bool)
        done[1:] |= same
        done[:-1] |= same
        open_[1:] |= anchor & ~same
        open_[:-1] |= anchor & ~same
        done[0] |= known[0]
        open_[0] |= known[1]
        end = len(fp) if last else len(fp) - 1
        keep = np.flatnonzero((done | open_)[:end])
        out = table.select(["fp", "doc_id", "th", "lo", "at", "m"]).take(pa.array(keep))
        out = out.append_column("done", pa.array(done[keep])).append_column("open", pa.array(open_[keep]))
        return out.to_batches(), table.slice(len(fp) - 1), (bool(done[-1]), bool(open_[-1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = None, (False, False)
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            out, held, known = judge(table, known, False)
            yield from out
        if held is not None:
            yield from judge(held, known, True)[0]

    return ordered.mapInArrow(run, "fp bigint, doc_id bigint, th bigint, lo int, at int, m int, done boolean, open boolean")


class Suffixes:
    """Suffixes (or reversed prefixes) at some places of a byte array, compared by their prefix hashes."""

    def __init__(self, data: np.ndarray, sums: np.ndarray, at: np.ndarray, limit: np.ndarray, left: bool):
        self.data, self.sums, self.at, self.limit, self.left = data, sums, at, limit, left

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """The longest common extension of each pair, by binary search."""
        x, y = self.at[i], self.at[j]
        low, high = np.zeros(len(i), np.int64), np.minimum(self.limit[i], self.limit[j])
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            if self.left:
                same = span_hashes(self.sums, x - middle, x) == span_hashes(self.sums, y - middle, y)
            else:
                same = span_hashes(self.sums, x, x + middle) == span_hashes(self.sums, y, y + middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low

    def before(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """-1, 0 or 1: how each pair compares."""
        same = self.common(i, j)
        ends_i, ends_j = same >= self.limit[i], same >= self.limit[j]
        step = -1 - same if self.left else same
        a = np.where(ends_i, -1, self.data[np.where(ends_i, 0, self.at[i] + step)].astype(np.int16))
        b = np.where(ends_j, -1, self.data[np.where(ends_j, 0, self.at[j] + step)].astype(np.int16))
        return np.sign(a - b)

    def merge_sorted(self, group: np.ndarray) -> np.ndarray:
        """The numbers of the suffixes, sorted inside every group (groups are consecutive), runs doubling in length.

        All merges of a round are done at once: each suffix finds its rank in the run beside its own.
        """
        n = len(group)
        begins = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        sizes = np.diff(np.append(begins, n))
        base, size = np.repeat(begins, sizes), np.repeat(sizes, sizes)
        order, own = np.arange(n), np.arange(n) - base
        width = 1
        while width < sizes.max(initial=0):
            block = own // width
            low = np.minimum((block ^ 1) * width, size)
            high = np.minimum(low + width, size)
            first = low.copy()
            # In the left run equal suffixes stay before those of the right one.
            is_right = (block & 1).astype(bool)
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                sign = self.before(order[base[open_] + middle], order[open_])
                smaller = (sign < 0) | ((sign == 0) & is_right[open_])
                low[open_[smaller]] = middle[smaller] + 1
                high[open_[~smaller]] = middle[~smaller]
            new = np.empty_like(order)
            new[base + np.where(is_right, (block ^ 1) * width, block * width) + own % width + low - first] = order
            order = new
            width *= 2
        return order

    def longest(self, group: np.ndarray) -> np.ndarray:
        """Of each suffix the longest extension it shares with another of its group."""
        order = self.merge_sorted(group)
        best = np.zeros(len(group), np.int64)
        beside = np.flatnonzero(group[order[1:]] == group[order[:-1]])
        shared = self.common(order[beside], order[beside + 1])
        np.maximum.at(best, order[beside], shared)
        np.maximum.at(best, order[beside + 1], shared)
        return best


def repeated_windows(data: np.ndarray, begin: np.ndarray, anchor: np.ndarray, windows: np.ndarray, group: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Run and place (in ``data``) of every window that occurs twice in its group.

    Run ``k`` has its windows at ``begin[k], begin[k] + 1, ...`` and its anchor at ``anchor[k]``; groups are consecutive.
    """
    sums = prefix_sums(BYTE_VALUES[data])
    end = begin + windows - 1 + length
    right = Suffixes(data, sums, anchor, end - anchor, False).longest(group)
    left = Suffixes(data, sums, anchor, anchor - begin, True).longest(group)
    # A window that begins d bytes before the anchor needs d to the left and the rest to the right.
    low = np.maximum(length - right, anchor - begin - windows + 1)
    high = np.minimum(left, anchor - begin)
    low = np.maximum(low, 0)
    count = np.maximum(high - low + 1, 0)
    run = np.repeat(np.arange(len(begin)), count)
    if not len(run):
        return run, run
    back = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count) + low[run]
    at = anchor[run] - back
    hashes = span_hashes(sums, at, at + length)
    order = np.lexsort((hashes, back, group[run]))
    beside = (hashes[order[1:]] == hashes[order[:-1]]) & (back[order[1:]] == back[order[:-1]]) & (group[run[order[1:]]] == group[run[order[:-1]]])
    pairs = np.flatnonzero(beside)
    # Equal hashes are no proof: a chain of equal windows is compared link by link.
    equal = np.ones(len(pairs), bool)
    for some in range(0, len(pairs), 4096):
        k = pairs[some : some + 4096]
        span = np.arange(length)
        equal[some : some + 4096] = (data[at[order[k]][:, None] + span] == data[at[order[k + 1]][:, None] + span]).all(axis=1)
    if not equal.all():
        return _by_bytes(data, run, at, back, group, length)
    twice = np.zeros(len(run), bool)
    twice[order[pairs]] = True
    twice[order[pairs + 1]] = True
    return run[twice], at[twice]


def _by_bytes(data: np.ndarray, run: np.ndarray, at: np.ndarray, back: np.ndarray, group: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The same by the bytes themselves, for a chunk in which hashes collided."""
    seen: dict[tuple, list[int]] = {}
    for k in range(len(run)):
        seen.setdefault((group[run[k]], back[k], data[at[k] : at[k] + length].tobytes()), []).append(k)
    twice = np.array(sorted(k for ks in seen.values() if len(ks) > 1 for k in ks), np.int64)
    return run[twice], at[twice]


_SPAN = {"doc_id": pa.int64(), "th": pa.int64(), "a": pa.int64(), "b": pa.int64()}
_SPAN_DDL = "doc_id bigint, th bigint, a bigint, b bigint"


_OPEN = {"fp": pa.int64(), "bytes": pa.binary(), "doc_id": pa.int64(), "th": pa.int64(), "lo": pa.int32(), "at": pa.int32(), "m": pa.int32(), "done": pa.bool_()}
_OPEN_DDL = "fp bigint, bytes binary, doc_id bigint, th bigint, lo int, at int, m int, done boolean"


def _bytes_of_runs(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """``runs`` with the bytes of their windows."""
    entry = F.struct("fp", "lo", "at", "m", "done")
    wanted = runs.groupBy("doc_id", "th").agg(F.collect_list(entry).alias("runs"))
    wanted = wanted.select(F.col("doc_id").alias("id"), F.col("th").alias("t"), "runs")
    same = docs["doc_id"].eqNullSafe(wanted["id"]) & (docs["th"] == wanted["t"])
    rows = docs.join(wanted.hint("shuffle_hash"), same).select("doc_id", "text", "th", "runs")

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        data, offsets = utf8(batch.column(1))
        out = []
        for begin, doc_id, th, own in zip(offsets.tolist(), *(batch.column(i).to_pylist() for i in (0, 2, 3))):
            for r in own:
                a = begin + r["lo"]
                out.append((r["fp"], data[a : a + r["m"] - 1 + length].tobytes(), doc_id, th, r["lo"], r["at"], r["m"], r["done"]))
        return record(_OPEN, *zip(*out)) if out else None

    return mapped(rows, step, _OPEN_DDL, STEP)


def _sorted_groups(rows: DataFrame, length: int) -> DataFrame:
    """Spans of open runs that repeat, by suffix sort of the runs that share an anchor."""
    ordered = rows.repartition(F.col("fp")).sortWithinPartitions("fp")

    def solve(table: pa.Table) -> pa.RecordBatch:
        get = lambda c: table.column(c).to_numpy(zero_copy_only=False)
        column = table.column("bytes").combine_chunks()
        data, offsets = utf8(column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks))
        data = data.copy()
        begin, lo = offsets[:-1], get("lo").astype(np.int64)
        run, at = repeated_windows(data, begin, begin + get("at") - lo, get("m").astype(np.int64), get("fp"), length)
        keep = ~get("done").astype(bool)[run]
        run, at = run[keep], at[keep]
        order = np.lexsort((at, run))
        run, at = run[order], at[order]
        # Consecutive windows of a run are one span.
        new = np.ones(len(run), bool)
        new[1:] = (run[1:] != run[:-1]) | (at[1:] != at[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(run)) - 1 if len(first) else first
        owner = run[first]
        a = at[first] - begin[owner] + lo[owner]
        b = at[last] - begin[owner] + lo[owner] + length
        pick = pa.array(owner)
        plain = lambda c: pa.concat_arrays(table.column(c).take(pick).chunks) if len(owner) else pa.array([], pa.int64())
        return record(_SPAN, plain("doc_id"), plain("th"), a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.Table.from_batches([batch]))
            size += batch.nbytes
            if size < STEP:
                continue
            table = pa.concat_tables(held)
            fp = table.column("fp").to_numpy()
            cut = int(np.searchsorted(fp, fp[-1]))  # the last group may go on
            if cut:
                yield from pieces(table.slice(0, cut))
                table = table.slice(cut)
            held, size = [table], table.nbytes
        if held:
            yield from pieces(pa.concat_tables(held))

    def pieces(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """Whole groups, about ``STEP`` bytes at a time."""
        fp = table.column("fp").to_numpy()
        ends = np.append(np.flatnonzero(fp[1:] != fp[:-1]) + 1, len(fp))
        per_row = max(1, table.nbytes // max(1, len(fp)))
        begin = 0
        while begin < len(fp):
            at = int(np.searchsorted(ends, begin + max(1, 4 * STEP // per_row), side="right"))
            end = int(ends[at - 1]) if at and ends[at - 1] > begin else int(ends[at])
            yield solve(table.slice(begin, end - begin).combine_chunks())
            begin = end

    return ordered.mapInArrow(run, _SPAN_DDL)


def _counted_windows(rows: DataFrame, length: int) -> DataFrame:
    """The same spans for anchors with very many runs: every window counted by two hashes in an exchange."""
    schema = {"h": pa.int64(), "g": pa.int64(), **_SPAN, "done": pa.bool_()}

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(batch.column(1))
        m = batch.column(5).to_numpy().astype(np.int64)
        run = np.repeat(np.arange(len(m)), m)
        at = np.arange(len(run)) - np.repeat(np.cumsum(m) - m, m) + offsets[:-1][run]
        h = span_hashes(prefix_sums(BYTE_VALUES[data], BASE), at, at + length)
        g = span_hashes(prefix_sums(BYTE_VALUES[data], OTHER), at, at + length, OTHER)
        a = at - offsets[:-1][run] + batch.column(4).to_numpy()[run]
        pick = pa.array(run)
        return record(schema, h.view(np.int64), g.view(np.int64), batch.column(2).take(pick), batch.column(3).take(pick), a, a + length, batch.column(6).take(pick))

    rows = rows.select("fp", "bytes", "doc_id", "th", "lo", "m", "done")
    windows = written(mapped(rows, step, f"h bigint, g bigint, {_SPAN_DDL}, done boolean", STEP), "windows")
    twice = windows.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "g")
    return windows.where("not done").join(twice, ["h", "g"], "left_semi").select("doc_id", "th", "a", "b")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, held: int = HELD) -> tuple[DataFrame, DataFrame]:
    """The documents as ``doc_id, text, th`` (``th``: a hash of the text), and spans of repeated bytes ``doc_id, th, a, b``."""
    docs = lean(docs, id_col, text_col).select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("th", F.xxhash64("text"))
    runs = written(_runs(docs.where(F.octet_length("text") >= length), length, gram), "runs", "kind")
    told = written(_told(runs.where(F.col("kind") == _WITNESS)), "told")
    span = lambda end: [F.col("lo").cast("bigint").alias("a"), (F.col("lo") + F.col("m") + F.lit(end)).cast("bigint").alias("b")]
    whole = told.where("done").select("doc_id", "th", *span(length - 1))
    whole = whole.unionByName(runs.where(F.col("kind") == _SETTLED).select("doc_id", "th", *span(0)))
    open_ = told.where("open").drop("open")
    # Anchors too common for one task; their number is bounded by the open runs over ``held``.
    common = open_.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > held).select("fp")
    if common.limit(1).count():
        common = written(common, "common")
        rows = written(_bytes_of_runs(docs, open_.join(common, "fp", "left_semi"), length), "common-runs")
        spans = _counted_windows(rows, length)
        open_ = open_.join(common, "fp", "left_anti")
        whole = whole.unionByName(spans)
    return docs, whole.unionByName(_sorted_groups(_bytes_of_runs(docs, open_, length), length))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, held: int = HELD) -> DataFrame:
    """One row per document: ``doc_id, n_bytes, spans`` (removed, maximal, as ``a, b`` in bytes) and the bytes ``kept``."""
    docs, spans = repeated_spans(docs, id_col, text_col, length, gram, held)
    spans = spans.groupBy("doc_id", "th").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    spans = spans.select(F.col("doc_id").alias("id"), F.col("th").alias("t"), "spans")
    same = docs["doc_id"].eqNullSafe(spans["id"]) & (docs["th"] == spans["t"])
    rows = docs.join(spans.hint("shuffle_hash"), same, "left").select("doc_id", "text", F.col("spans.a").alias("a"), F.col("spans.b").alias("b"))
    span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    schema = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "spans": span, "kept": pa.binary()}

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(batch.column(1))
        found, kept = [], []
        for begin, end, a, b in zip(offsets[:-1], offsets[1:], batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            own = data[begin:end]
            if not a:
                found.append([])
                kept.append(own.tobytes())
                continue
            edges = np.zeros(len(own) + 1, np.int64)
            np.add.at(edges, a, 1)
            np.add.at(edges, b, -1)
            gone = np.cumsum(edges[:-1]) > 0
            found.append([{"a": int(x), "b": int(y)} for x, y in zip(*runs_of(gone))])
            kept.append(own[~gone].tobytes())
        return record(schema, batch.column(0), np.diff(offsets), found, kept)

    return mapped(rows, step, "doc_id bigint, n_bytes bigint, spans array<struct<a:bigint,b:bigint>>, kept binary")

