"""Document statistics and the quality verdict of boosted trees over them.

The statistics of a whole Arrow batch are computed with numpy over its bytes
(``textvec``); nothing is shuffled.  The trees are fitted on at most
``sample`` labelled documents (chosen by a hash of ``doc_id``, so the choice
does not depend on the layout of the table), the only bounded part; every
document is scored.  The score may only fall as the shares of symbols, repeated
lines, repeated words and capitals rise.

Defined results: null or empty text has no words, so it fails the base rules;
labels that are null, or of documents not present, are ignored; a document
labelled several times counts once, with its mean label; without labels of both
classes the trees keep everything that passes the base rules; rows with equal or
null ids are judged like any other; an empty table stays empty.  Other columns
pass through unless they have the name of a result column, which then replaces
them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textvec as tv
from .common import ship
from .trees import Forest, fit

SAMPLE = 20_000
SLICE = 1 << 20
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeat_words", "capitals", "digits", "marks",
            "distinct_words", "top_word", "words_per_line", "non_ascii")
MONOTONE = np.array([0, 0, -1, -1, -1, -1, 0, 0, 0, 0, 0, 0])


def _table(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars.encode())] = True
    return t


_SYMBOL = _table("#*$%&|<>")
_CAPITAL = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_DIGIT = _table("0123456789")
_MARK = _table("!\"'()+,-./:;=?@[\\]^_`{}~")
_HIGH = np.arange(256) >= 0x80
_FOLLOWS = (np.arange(256) & 0xC0) == 0x80  # UTF-8 continuation bytes


def _per_row(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Number of set flags between consecutive offsets."""
    if not len(flags):
        return np.zeros(len(offs) - 1, np.int64)
    got = np.add.reduceat(flags, np.minimum(offs[:-1], len(flags) - 1), dtype=np.int64)
    return np.where(offs[1:] > offs[:-1], got, 0)


def _slices(column) -> list[tuple[int, int]]:
    """Row ranges of about ``SLICE`` bytes, at least one row each."""
    _, offs = tv.column_bytes(column)
    out, i, n = [], 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + SLICE, side="right")) - 1)
        out.append((i, j))
        i = j
    return out


def _dup_lines(data: np.ndarray, offs: np.ndarray, inside_starts: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same row, by row."""
    view, out = memoryview(np.ascontiguousarray(data)), np.zeros(len(offs) - 1, np.int64)
    breaks = np.flatnonzero(data == 10)
    for row, (a, b) in enumerate(zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)):
        ends = [*breaks[np.searchsorted(breaks, a):np.searchsorted(breaks, b)].tolist(), b]
        if len(ends) < 2:
            continue
        starts = [a, *(e + 1 for e in ends[:-1])]
        first = np.searchsorted(inside_starts, starts)
        last = np.searchsorted(inside_starts, ends)
        keys = [xxhash.xxh3_128_intdigest(view[s:e]) for s, e, x, y in zip(starts, ends, first, last, strict=True) if y > x]
        out[row] = len(keys) - len(set(keys))
    return out


def statistics(column) -> tuple[np.ndarray, np.ndarray]:
    """(counts as in ``COUNTS``, features as in ``FEATURES``) of every row of a string column."""
    counts, features = [], []
    for i, j in _slices(column):
        data, offs = tv.column_bytes(column.slice(i, j - i))
        rows = j - i
        starts, ends = tv.word_spans(data, offs)
        hashes = tv.span_hashes(data, starts, ends, lower=False) if len(starts) else np.zeros(0, np.uint64)
        first = np.searchsorted(starts, offs, side="left")
        n_words = np.diff(first)
        row_of = np.repeat(np.arange(rows), n_words)
        inside = ~tv._SPACE[data]
        word_chars = _per_row(inside & ~_FOLLOWS[data], offs)
        own = tv.mix64(hashes ^ tv.mix64(row_of.astype(np.uint64) + np.uint64(1)))  # a word is compared within its row only
        distinct, top = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
        if len(own):
            _, at, times = np.unique(own, return_index=True, return_counts=True)
            np.add.at(distinct, row_of[at], 1)
            np.maximum.at(top, row_of[at], times)
        covered = np.zeros(len(own), bool)
        if len(own) >= 3:
            w = tv.windows(own, 3)
            whole = row_of[2:] == row_of[:-2]
            _, back, times = np.unique(w, return_inverse=True, return_counts=True)
            again = whole & (times[back] >= 2)
            for k in range(3):
                covered[k:k + len(w)] |= again
        n_repeat = np.bincount(row_of[covered], minlength=rows)
        n_dup = _dup_lines(data, offs, starts)
        n_symbols = _per_row(_SYMBOL[data], offs)
        counts.append(np.stack([n_words, word_chars, n_symbols, n_dup, n_repeat], axis=1))
        n_lines = _per_row(data == 10, offs) + 1
        words, chars = np.maximum(n_words, 1), np.maximum(word_chars, 1)
        share = lambda t: _per_row(t[data], offs) / chars  # noqa: E731, B023
        features.append(np.stack([np.log1p(n_words), word_chars / words, n_symbols / words, n_dup / n_lines, n_repeat / words,
                                  share(_CAPITAL), share(_DIGIT), share(_MARK), distinct / words, top / words,
                                  n_words / n_lines, share(_HIGH)], axis=1))
    if not counts:
        return np.zeros((0, len(COUNTS)), np.int64), np.zeros((0, len(FEATURES)))
    return np.concatenate(counts).astype(np.int64), np.concatenate(features)


def fit_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Forest:
    """Fit the trees on at most ``sample`` labelled documents (20,000 rows of twelve numbers reach the driver)."""
    ship(docs.sparkSession)
    chosen = (labels.where("doc_id is not null and quality is not null")
              .groupBy(F.col("doc_id").cast("long").alias("__id")).agg(F.avg("quality").alias("__y"))
              .orderBy(F.xxhash64("__id"), "__id").limit(sample))
    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").alias("text")).join(
        F.broadcast(chosen), "__id").select("__id", "__y", "text")  # 16 bytes a row, `sample` rows at most

    def run(batches):
        for batch in batches:
            _, x = statistics(batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(x), pa.list_(pa.float64()))],
                                             ["id", "y", "x"])

    got = rows.mapInArrow(run, "id long, y double, x array<double>").toArrow().sort_by("id")
    x = np.array(got["x"].to_pylist(), float).reshape(-1, len(FEATURES))
    return fit(x, (got["y"].to_numpy() >= 0.5).astype(float), MONOTONE)


def judge(docs: DataFrame, labels: DataFrame, min_words: int = 50, max_repeat_pct: int = 50, threshold: float = 0.5,
          sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` with the counts, ``base_failed``, ``score`` (probability of quality) and ``kept``."""
    ship(docs.sparkSession)
    forest = fit_quality(docs, labels, sample)
    added = [*COUNTS, "base_failed", "score", "kept"]
    docs = docs.drop(*added).withColumn("text", F.col("text").cast("string"))
    schema = T.StructType([*docs.schema.fields, *(T.StructField(c, T.LongType()) for c in COUNTS),
                           T.StructField("base_failed", T.BooleanType()), T.StructField("score", T.DoubleType()),
                           T.StructField("kept", T.BooleanType())])

    def run(batches):
        for batch in batches:
            counts, x = statistics(batch.column("text"))
            score = forest.probability(x)
            failed = (counts[:, 0] < min_words) | (100 * counts[:, 4] > max_repeat_pct * counts[:, 0])
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(c) for c in counts.T), pa.array(failed),
                                              pa.array(score), pa.array(~failed & (score >= threshold))],
                                             [f.name for f in schema.fields])

    return docs.mapInArrow(run, schema)
