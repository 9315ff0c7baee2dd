"""Language identification by error-correcting output codes over byte n-grams.

Every language gets a codeword of bits. One binary classifier per bit, a naive Bayes model over byte trigrams,
learns to tell the languages whose codeword has the bit set from those that have not; it has seen every labelled
document of every task, as its counts are summed over the whole table. A text's classifiers each give a
margin, the mean log-odds of the text's trigrams. Decoding is weighted by loss: the codeword with the least
total logistic loss against the margins is the nearest, so a sure bit outweighs unsure ones. If the two
nearest codewords are about as near, or the margins are against the nearest one (their mean, signed by its bits, is
not positive), the text is flagged ambiguous.

Up to seven languages take all ways to split them in two (an exhaustive code); more take ``10 log2(n)`` columns
drawn by a hash, every language's word different.

The model is ``BUCKETS`` x languages counts, whatever the size of the table. Defined results: null text, or text
without a letter, is ``und`` with score 0 and flagged; without any labelled text everything is; with one
language every text with a letter is of it, score 1. Labels that are null are not learned from.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkpact.llm.base import lean, packed, scramble, sliced, unpacked, utf8

BUCKETS = 1 << 15
SMOOTHING = 0.5
#: Margins are taken as if a text had this many independent trigrams.
EVIDENCE = 24.0
#: Least difference of the two best scores that is not ambiguous.
CLEAR = 0.02
#: Languages whose counts a task holds before it hands them on.
HELD_LANGUAGES = 64
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The bucket of the trigram that begins at each byte of some texts; A-Z count as a-z, other ASCII as blank.

    A text ends in blanks. Trigrams of more than one blank say nothing and share bucket 0.
    """
    first = np.where((data >= 65) & (data <= 90), data | 32, data)
    first[(first < 97) | ((first > 122) & (first < 128))] = 32
    ends = offsets[1:][np.diff(offsets) > 0]
    second = np.append(first[1:], 32).astype(np.uint8)
    second[ends - 1] = 32
    third = np.append(second[1:], 32).astype(np.uint8)
    third[ends - 1] = 32
    code = (first.astype(np.uint64) << np.uint64(16)) | (second.astype(np.uint64) << np.uint64(8)) | third
    buckets = 1 + (scramble(code) >> np.uint64(33)).astype(np.int64) % (BUCKETS - 1)
    blanks = (first == 32).astype(np.uint8) + (second == 32) + (third == 32)
    buckets[blanks > 1] = 0
    return buckets


def codewords(n: int) -> np.ndarray:
    """``n`` rows of +1 and -1."""
    if n <= 7:
        # All columns that split the languages, each split once: the first language is always +1.
        masks = range(1, 1 << (n - 1)) if n > 1 else ()
        return np.array([[-1 if i and m >> (i - 1) & 1 else 1 for m in masks] for i in range(n)], np.int8).reshape(n, -1)
    width = math.ceil(10 * math.log2(n))
    for salt in count():
        bits = scramble(np.arange(n * width, dtype=np.uint64) + np.uint64(1 + salt * n * width)) & np.uint64(1)
        words = (2 * bits.astype(np.int8) - 1).reshape(n, width)
        if len(np.unique(words, axis=0)) == n and (np.abs(words.sum(axis=0)) < n).all():
            return words


@dataclass(frozen=True)
class Model:
    languages: list[str]
    words: np.ndarray  # languages x bits
    weights: np.ndarray  # bits x BUCKETS, log-odds of a trigram for bit +1

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each row of margins: the number of the nearest codeword, its score, and whether it is ambiguous."""
        signed = margins[:, None, :] * self.words[None, :, :]
        loss = np.logaddexp(0.0, -signed).sum(axis=2)
        score = np.exp(loss.min(axis=1, keepdims=True) - loss)
        score /= score.sum(axis=1, keepdims=True)
        order = np.argsort(-score, axis=1, kind="stable")
        rows = np.arange(len(score))
        best = order[:, 0]
        top = score[rows, best]
        second = score[rows, order[:, 1]] if score.shape[1] > 1 else np.zeros(len(score))
        against = signed[rows, best].sum(axis=1) <= 0 if signed.shape[2] else np.zeros(len(score), bool)
        return best, top, (top - second < CLEAR) | against


def fit(docs: DataFrame, label_col: str = "lang", text_col: str = "text") -> Model:
    """A model from all rows with text and label."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def handed() -> pa.RecordBatch:
            rows = [(label, int(i), int(own[i])) for label, own in held.items() for i in np.flatnonzero(own)]
            held.clear()
            labels, buckets, ns = zip(*rows) if rows else ((), (), ())
            return pa.record_batch([pa.array(labels, pa.string()), pa.array(buckets, pa.int32()), pa.array(ns, pa.int64())], ["lang", "bucket", "n"])

        for part in sliced(batches):
            labels = part.column(0).to_pylist()
            data, offsets = utf8(part.column(1))
            codes = grams(data, offsets)
            for label in set(labels):
                inside = np.repeat(np.array([x == label for x in labels]), np.diff(offsets))
                own = held.setdefault(label, np.zeros(BUCKETS, np.int64))
                own += np.bincount(codes[inside], minlength=BUCKETS)
            if len(held) > HELD_LANGUAGES:
                yield handed()
        yield handed()

    rows = docs.select(F.col(f"`{label_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    parts = rows.where("lang is not null and text is not null").mapInArrow(counted, "lang string, bucket int, n bigint")
    # At most BUCKETS rows for a language come to the driver.
    sums = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sums.column("lang").to_numpy(zero_copy_only=False)
    languages = sorted(set(names.tolist()))
    counts = np.zeros((len(languages), BUCKETS))
    row = {name: i for i, name in enumerate(languages)}
    counts[[row[x] for x in names], sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    # Languages weigh alike however much of each there is.
    shares = (counts + SMOOTHING) / (counts + SMOOTHING).sum(axis=1, keepdims=True)
    words = codewords(len(languages)) if languages else np.zeros((0, 0), np.int8)
    shares[:, 0] = 1.0
    weights = [np.log(shares[words[:, b] > 0].mean(axis=0)) - np.log(shares[words[:, b] < 0].mean(axis=0)) for b in range(words.shape[1])]
    return Model(languages, words, np.array(weights, np.float32).reshape(words.shape[1], BUCKETS))


def margins(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Margins of each text for each bit: mean log-odds, weighted by how much text there is up to ``EVIDENCE``."""
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), len(model.weights)))
    some = np.flatnonzero(lengths)
    if len(some) and len(model.weights):
        codes = grams(data, offsets)
        for b, own in enumerate(model.weights):
            out[some, b] = np.add.reduceat(own[codes], offsets[:-1][some], dtype=np.float64)
        out[some] *= (np.minimum(lengths[some], EVIDENCE) / lengths[some])[:, None]
    return out


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous``; with ``keep`` also the whole row as a struct."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    names = ["doc_id", "lang_pred", "score", "ambiguous"]

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for part in sliced(batches):
            column = part.column(1)
            letters = np.array([bool(x) and _LETTER.search(x) is not None for x in column.to_pylist()])
            if model.languages:
                best, score, ambiguous = model.decode(margins(model, *utf8(column)))
            else:
                best, score, ambiguous, letters = np.zeros(len(letters), int), np.zeros(len(letters)), letters, letters & False
            langs = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
            columns = [part.column(0), pa.array(langs, pa.string()), pa.array(np.where(letters, score, 0.0)), pa.array(ambiguous | ~letters)]
            yield pa.record_batch(columns + ([part.column(2)] if keep else []), names + (["__row"] if keep else []))

    rows = packed(docs, id_col, text_col) if keep else lean(docs, id_col, text_col)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    first, _, rest = ddl.partition(", `__row`")
    return rows.mapInArrow(predicted, f"{first}, lang_pred string, score double, ambiguous boolean" + (f", `__row`{rest}" if keep else ""))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: the crc32 of its id as text is a multiple of 5; null ids as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """Learn from the labelled documents that are not held out, and predict all."""
    model = fit(docs.where(~held_out(F.col(f"`{id_col}`"))), label_col, text_col)
    return predict(docs, model, id_col, text_col).withColumn("held_out", held_out(F.col("doc_id")))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose language is told and not ambiguous."""
    model = fit(docs.where(~held_out(F.col(f"`{id_col}`"))), label_col, text_col)
    found = predict(docs, model, id_col, text_col, keep=True)
    return unpacked(found.where((F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous")), docs.columns)
