"""Shards of nearly equal bytes by histogram sort, in DataFrame functions alone.

Rows are ordered by a 64-bit hash of their id and text, so shards are mixed. The boundaries between shards
are found before anything is moved: each round counts the exact bytes below every candidate boundary, over
all rows and all partitions. The first round's candidates are spaced evenly; each later round probes only
the intervals that still hold a boundary, with ``FAN`` candidates in each. A boundary is settled when the
bytes below it are within the tolerance of its share, or when its interval is a single key. Then the rows
are exchanged once.

The driver sees at most ``FAN`` counts per shard and round, whatever the number of rows. Rows with the same
id and text have the same key; if such a group weighs more than the tolerance it is spread over the shards
whose boundaries fall on it, in proportion and by the row's number in its input split.

Slots are numbered in runs: pieces of a shard of about ``RUN_BYTES`` by the key's first bits, and a heavy key in
``SPREAD`` of them. Rows of a run are numbered in one task, and begin where the counts of the runs before it end.
No task gets a shard, whatever the number of shards.

Defined results: the size of a row is the UTF-8 bytes of its text (none for null) and ``ROW_BYTES``; an empty
table gives an empty result; slots count from 0 in each shard, in the order of its runs and in them of the keys.
A text of any length is one row and is only hashed and measured.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkpact.llm.base import written

ROW_BYTES = 16
FAN_BITS = 8
#: A boundary may be off by this share of a shard's bytes.
TOLERANCE = 0.001
KEY_BITS = 63
#: Bytes of rows that are numbered together.
RUN_BYTES = 64 << 20
#: Parts of the rows of one key, where a key is so heavy that shards share it.
SPREAD = 64

# Columns while rows are dealt; no name of the input is theirs.
_KEY, _DRAW, _RUN, _PART, _ROW = "__key", "__draw", "__run", "__part", "__row"


def document_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + F.lit(ROW_BYTES)


def row_key(*columns: Column) -> Column:
    """A hash of 63 bits, so that shifts keep its order."""
    return F.xxhash64(*columns).bitwiseAND(F.lit((1 << KEY_BITS) - 1))


def _prefix(bits: int) -> Column:
    return F.shiftright(_KEY, KEY_BITS - bits)


def splitters(rows: DataFrame, shards: int, tolerance: float = TOLERANCE) -> tuple[list[tuple[int, float]], int]:
    """For each boundary: the first key above it, and the share of the bytes of the key before that stays below.

    ``rows`` has keys and ``size``. The share is 1 unless one key alone outweighs the tolerance. With them comes the
    number of all bytes.
    """
    bits = min(KEY_BITS, max(FAN_BITS, (64 * shards - 1).bit_length()))
    counted = rows.groupBy(_prefix(bits).alias("p")).agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
    total = sum(r["n"] for r in counted)
    slack = tolerance * total / shards
    targets = [total * i / shards for i in range(1, shards)]
    found: dict[int, tuple[int, float]] = {}
    # Where a boundary may be: the bytes below an interval, and the candidates in it with their bytes.
    histogram = {(): (0, sorted((r["p"], r["n"], r["rows"]) for r in counted))}
    pending = {i: () for i in range(len(targets))}
    while pending and total:
        inside: dict[int, tuple[int, int, int]] = {}
        for i, interval in pending.items():
            below, counts = histogram[interval]
            for prefix, n, rows_here in counts:
                if below + n >= targets[i]:
                    break
                below += n
            above = below + n
            if above - targets[i] <= slack:
                found[i] = ((prefix + 1) << (KEY_BITS - bits), 1.0)
            elif targets[i] - below <= slack:
                found[i] = (prefix << (KEY_BITS - bits), 1.0)
            elif rows_here == 1:
                # One row goes to the nearer side.
                first = prefix + (above - targets[i] <= targets[i] - below)
                found[i] = (first << (KEY_BITS - bits), 1.0)
            elif bits == KEY_BITS:
                found[i] = (prefix + 1, (targets[i] - below) / n)
            else:
                inside[i] = (prefix, below, n)
        pending = {i: (prefix,) for i, (prefix, _, _) in inside.items()}
        if pending:
            wanted, old = sorted({p for p, _, _ in inside.values()}), bits
            bits = min(KEY_BITS, bits + FAN_BITS)
            part = rows.where(_prefix(old).isin(wanted))
            counted = part.groupBy(_prefix(old).alias("o"), _prefix(bits).alias("p")).agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
            histogram = {(p,): (below, []) for p, below, _ in inside.values()}
            for r in sorted(counted, key=lambda r: r["p"]):
                histogram[(r["o"],)][1].append((r["p"], r["n"], r["rows"]))
    return [found.get(i, (0, 1.0)) for i in range(len(targets))], total


def shard_of(cuts: list[tuple[int, float]], draw: Column) -> Column:
    """The shard of a row's key: a binary search among the boundaries, as nested conditions."""
    key = F.col(_KEY)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        first, share = cuts[middle]
        below = key < F.lit(first)
        if share < 1.0:
            below = (key < F.lit(first - 1)) | ((key == F.lit(first - 1)) & (draw < F.lit(share)))
        return F.when(below, search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(cuts))


def histogram_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", tolerance: float = TOLERANCE) -> DataFrame:
    """``docs`` with ``shard, slot, size`` in front of its columns, exchanged into their shards.

    Columns of ``docs`` with these three names are left out; all others stay, whatever their names.
    """
    own = [c for c in docs.columns if c.lower() not in ("shard", "slot", "size")]
    text, doc_id = F.col(f"`{text_col}`"), F.col(f"`{id_col}`")
    whole = F.struct(*(F.col(f"`{c}`") for c in own)) if own else F.struct(F.lit(None))
    keyed = docs.select(row_key(doc_id, text).alias(_KEY), document_size(text).alias("size"), whole.alias(_ROW))
    cuts, total = splitters(keyed.select(_KEY, "size"), shards, tolerance)
    if any(share < 1.0 for _, share in cuts):
        # One number per row for all boundaries, so that shares of a heavy key add up.
        draw = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20)) / F.lit(float(1 << 20))
        part = F.floor(F.col(_DRAW) * SPREAD).cast("int")
    else:
        draw, part = F.lit(0.0), F.lit(0)
    bits = min(KEY_BITS, (total // RUN_BYTES).bit_length())
    placed = keyed.withColumn(_DRAW, draw).select("*", shard_of(cuts, F.col(_DRAW)).alias("shard"), _prefix(bits).alias(_RUN), part.alias(_PART))
    if any(share < 1.0 for _, share in cuts):
        # Numbers of rows in their input split: drawn once, as both sides below read them.
        placed = written(placed, "placed")
    run = ["shard", _RUN, _PART]
    # One line per run: the rows of its shard that lie before it.
    before = Window.partitionBy("shard").orderBy(_RUN, _PART).rowsBetween(Window.unboundedPreceding, -1)
    runs = placed.groupBy(*run).agg(F.count(F.lit(1)).alias("n")).select(*run, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    numbered = placed.withColumn("slot", F.row_number().over(Window.partitionBy(*run).orderBy(_KEY, _DRAW)) - 1)
    return numbered.join(runs, run).select(
        "shard", (F.col("before") + F.col("slot")).cast("bigint").alias("slot"), "size", *(F.col(_ROW).getField(c).alias(c) for c in own)
    )
