"""Sequences of a fixed size packed from documents by the sum-of-squares rule.

A document's ids (with an end id) are cut into pieces only if they do not fit one sequence. A piece of
full size is a sequence of its own. Any other piece goes into the open sequence for which the sum over all gaps of
the squared number of open sequences with that gap becomes smallest, and into a new one only if it fits into none.
Many open sequences with the same gap are thus avoided, which keeps gaps of all sizes at hand. Of equal choices
the smallest gap, the best fit, is taken. Longer pieces are placed first.

Pieces are dealt by a hash of their number in the written table to groups of about ``GROUP``, so groups
are alike and each is packed by one task. Sequences that a group leaves open are pieces of the next round,
which fills them with each other, until one group is left or a round gains little.

Defined results: null text is empty text, a piece of the end id alone; repeated rows are repeated documents;
an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkpact.llm.base import lean, mapped, record, utf8, written
from sparkpact.llm.tokens import encoder

SIZE = 2048
GROUP = 60_000


def sum_of_squares(lengths: np.ndarray, size: int) -> np.ndarray:
    """The bin of each length, in the order given; bins are numbered as they are opened."""
    counts = np.zeros(size + 1, np.int64)  # open bins by gap; none is counted at 0 and at size
    open_bins: list[list[int]] = [[] for _ in range(size + 1)]
    bins, opened = np.zeros(len(lengths), np.int64), 0
    far = np.iinfo(np.int64).max
    for i, n in enumerate(lengths.tolist()):
        here = counts[n : size + 1]
        change = np.where(here > 0, 1 - 2 * here, far)
        if not here[:-1].any():
            change[-1] = 0  # a new bin leaves no gap behind
        usable = change != far
        after = 2 * counts[: size + 1 - n] + 1
        after[0] = 0  # a full bin is open no more
        change[usable] += after[usable]
        gap = n + int(np.argmin(change))
        if gap == size:
            bins[i], opened = opened, opened + 1
        else:
            bins[i] = open_bins[gap].pop()
            counts[gap] -= 1
        rest = gap - n
        if rest:
            open_bins[rest].append(int(bins[i]))
            counts[rest] += 1
    return bins


def token_pieces(docs: DataFrame, vocabulary: str, size: int = SIZE, end: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every piece, and its ``ids`` unless told otherwise."""
    schema = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}
    if with_ids:
        schema["ids"] = pa.list_(pa.int32())

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, at = encoder(vocabulary).encode_bytes(*utf8(batch.column(1)), end)
        ids = ids.astype("<u4")
        rows = []
        for doc_id, a, b in zip(batch.column(0).to_pylist(), at[:-1].tolist(), at[1:].tolist()):
            for k, begin in enumerate(range(a, b, size)):
                own = ids[begin : min(b, begin + size)]
                rows.append((doc_id, k, begin - a, len(own), zlib.crc32(own.tobytes()), *((own.tolist(),) if with_ids else ())))
        return record(schema, *zip(*rows))

    ddl = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if with_ids else "")
    docs = lean(docs, id_col, text_col)
    return mapped(docs.select(F.col("doc_id").cast("bigint"), "text"), cut, ddl)


def _packer(size: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def pack_group(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["length", "item"], ascending=[False, True], kind="stable").reset_index(drop=True)
        bins = sum_of_squares(items["length"].to_numpy(), size)
        before = items["length"].groupby(bins).cumsum() - items["length"]
        return pd.DataFrame({"item": items["item"], "grp": items["grp"], "bin": bins, "at": before, "length": items["length"]})

    return pack_group


def _pack_round(items: DataFrame, n: int, size: int, number: int) -> tuple[DataFrame, int]:
    """``item, bin, at, length`` with bins numbered apart in each group; how many groups there were."""
    groups = max(1, -(-n // GROUP))
    dealt = items.withColumn("grp", F.expr(f"pmod(xxhash64(item), {groups})").cast("bigint"))
    out = dealt.groupBy("grp").applyInPandas(_packer(size), "item bigint, grp bigint, bin bigint, at bigint, length bigint")
    # Numbered apart by round, group and place in the group.
    bin_number = F.lit(number << 56) + F.col("grp") * F.lit(1 << 32) + F.col("bin")
    return out.select("item", bin_number.alias("bin"), "at", "length"), groups


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """``pieces`` (with ``length``) and, in front of their columns, ``sequence_id, offset``."""
    pieces = written(pieces.withColumn("__item", F.monotonically_increasing_id()), "pieces")
    columns = [c for c in pieces.columns if c != "__item"]
    items = pieces.where(F.col("length") < size).select(F.col("__item").alias("item"), "length")
    # A piece's place: the sequence it is in now, and where.
    placed, rounds, n = None, 0, items.count()
    while n:
        bins, groups = _pack_round(items, n, size, rounds)
        bins = written(bins, f"packed-{rounds}")
        if placed is None:
            placed = bins.select("item", "bin", "at")
        else:
            moved = bins.select(F.col("item").alias("bin"), F.col("bin").alias("to"), F.col("at").alias("more"))
            placed = placed.join(moved, "bin", "left").select(
                "item", F.coalesce("to", "bin").alias("bin"), (F.col("at") + F.coalesce("more", F.lit(0))).alias("at")
            )
        rounds += 1
        if groups == 1:
            break
        items = bins.groupBy("bin").agg(F.sum("length").alias("length")).where(F.col("length") < size).select(F.col("bin").alias("item"), "length")
        left = items.count()
        if left > 0.9 * n:
            break
        placed = written(placed, f"placed-{rounds}")
        n = left
    whole = F.col("length") >= size
    if placed is None:
        out = pieces.withColumn("bin", F.lit(None).cast("bigint")).withColumn("at", F.lit(0).cast("bigint"))
    else:
        out = pieces.join(placed, pieces["__item"] == placed["item"], "left")
    # Full pieces are sequences of their own, below zero; others take the number of their bin.
    number = F.when(whole, -1 - F.col("__item")).otherwise(F.col("bin"))
    return out.select(number.alias("sequence_id"), F.coalesce("at", F.lit(0)).cast("bigint").alias("offset"), *columns)
