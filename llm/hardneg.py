"""Hard negatives: a vertical scan (BOND) finds each anchor's nearest positives and the best negatives within their score windows.

Components become whole numbers, ``floor(scale * x)``; a score is the integer
inner product.  Rows are dealt into row groups held column by column, one array
for each dimension, with the least and the greatest value of every column.  An
anchor reads the columns in descending order of its own magnitudes.  After every
few columns a row's score lies between its partial sum plus the least and plus
the greatest that the columns not yet read can add; rows whose interval cannot
matter leave the candidate bitmap.  For positives that is an upper end below the
k-th best lower end; for negatives an interval outside every window
``low * positive <= of * score <= high * positive`` or below the k-th best lower end
inside it.  What is left at the last column has exact scores.

Spark joins groups of anchors with groups of rows (each pair of groups one task,
bounded by ``ANCHORS`` and ``ROWS``) and merges the tasks' best rows per anchor.
Anchors are a stated query set held against all rows; no pair of rows is emitted
but the few best of each task.

Defined results: rows with a null id, label or vector, or a null or non-finite
component, take no part; nor do rows with a component beyond ``2**20`` after scaling
(their scores may not fit a long).  Shorter vectors count as padded with zeros.
Rows with equal ids are rows of their own (an anchor's other rows are all but
itself); ties go to the smaller id.  An anchor without positives, or a window
without rows, gives no rows; an empty table stays empty.  Other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut_lineage, ship

ANCHORS = 2048       # anchors of one task
ROWS = 32_768        # rows of one task
LEAST_ROWS = 1024
STEP = 8             # columns read between two looks at the bitmap
LIMIT = 1 << 20


class Columns:
    """Rows held by dimension, with each column's bounds."""

    def __init__(self, matrix: np.ndarray, ids: np.ndarray, labels: np.ndarray, uids: np.ndarray):
        self.by_dim = np.ascontiguousarray(matrix.T).astype(np.int64)
        self.ids, self.labels, self.uids = ids, labels, uids
        some = matrix.shape[0] > 0
        self.least = self.by_dim.min(1) if some else np.zeros(matrix.shape[1], np.int64)
        self.most = self.by_dim.max(1) if some else np.zeros(matrix.shape[1], np.int64)

    def scan(self, anchor: np.ndarray, bitmap: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
        """(rows, exact scores) that ``keep(lower, upper)`` leaves after every ``STEP`` columns."""
        d = min(len(anchor), len(self.by_dim))
        order = np.argsort(-np.abs(anchor[:d]), kind="stable")
        a = anchor[order]
        ends = np.stack([a * self.least[order], a * self.most[order]])
        rest_least = np.concatenate([np.cumsum(ends.min(0)[::-1])[::-1], [0]])
        rest_most = np.concatenate([np.cumsum(ends.max(0)[::-1])[::-1], [0]])
        rows = np.flatnonzero(bitmap)
        partial = np.zeros(len(rows), np.int64)
        for k in range(0, max(d, 1), STEP):
            for j in range(k, min(k + STEP, d)):
                partial += a[j] * self.by_dim[order[j]][rows]
            upto = min(k + STEP, d)
            stay = keep(partial + rest_least[upto], partial + rest_most[upto])
            if not stay.all():
                rows, partial = rows[stay], partial[stay]
            if not len(rows):
                break
        return rows, partial


def _kth(values: np.ndarray, k: int):
    """The k-th greatest, or None if there are fewer."""
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else None


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -score))[:k]


def best_positives(cols: Columns, anchor: np.ndarray, label: int, uid: int, k: int) -> list[tuple[int, int]]:
    """(row, score) of the first ``k`` other rows of the label."""
    def keep(lower, upper):
        bar = _kth(lower, k)
        return np.ones(len(lower), bool) if bar is None else upper >= bar

    rows, score = cols.scan(anchor, (cols.labels == label) & (cols.uids != uid), keep)
    return [(int(rows[i]), int(score[i])) for i in _best(score, cols.ids[rows], k)]


def best_negatives(cols: Columns, anchor: np.ndarray, label: int, windows: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(window, row, score) of the first ``k`` rows of other labels within each window (``least, most``)."""
    def keep(lower, upper):
        stay = np.zeros(len(lower), bool)
        for least, most in windows:
            inside = _kth(lower[(lower >= least) & (upper <= most)], k)
            stay |= (upper >= (least if inside is None else max(least, inside))) & (lower <= most)
        return stay

    rows, score = cols.scan(anchor, cols.labels != label, keep)
    out = []
    for w, (least, most) in enumerate(windows):
        own = np.flatnonzero((score >= least) & (score <= most))
        out.extend((w, int(rows[own[i]]), int(score[own[i]])) for i in _best(score[own], cols.ids[rows[own]], k))
    return out


def _pack(rows: DataFrame, size: int) -> DataFrame:
    """One row per ``size`` rows at most: numbers of all, one after the other (``uid, id, label, vector[, extra]``)."""
    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, size):
                part = batch.slice(a, size)
                vectors = part.column(3)
                lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype("<i4")
                extra = part.column(4)
                count = extra.value_lengths().to_numpy(zero_copy_only=False).astype("<i4")
                yield pa.RecordBatch.from_arrays([
                    *(pa.array([x], pa.binary()) for x in (
                        *(part.column(c).to_numpy(zero_copy_only=False).astype("<i8").tobytes() for c in range(3)),
                        lengths.tobytes(), vectors.flatten().to_numpy(zero_copy_only=False).astype("<i4").tobytes(),
                        count.tobytes(), extra.flatten().to_numpy(zero_copy_only=False).astype("<i8").tobytes()))],
                    ["uids", "ids", "labels", "lengths", "values", "counts", "extras"])

    return rows.mapInArrow(run, "uids binary, ids binary, labels binary, lengths binary, values binary, counts binary, extras binary")


def _joined(group: pa.Table, name: str, kind: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for x in group[name].to_pylist())])


def _matrix(group: pa.Table) -> np.ndarray:
    lengths, values = _joined(group, "lengths", "<i4"), _joined(group, "values", "<i4")
    out = np.zeros((len(lengths), int(lengths.max()) if len(lengths) else 0), np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


def _met(rows: DataFrame, anchors: DataFrame, row_groups: int, anchor_groups: int, task, schema: str) -> DataFrame:
    """``task(columns, anchors' group)`` for each group of anchors and group of rows."""
    every = lambda n: F.sequence(F.lit(0), F.lit(n - 1))
    blocks = _pack(rows.repartition(row_groups), ROWS).withColumn("j", F.pmod(F.spark_partition_id(), F.lit(row_groups)).cast("int"))
    blocks = blocks.withColumn("i", F.explode(every(anchor_groups))).withColumn("anchors", F.lit(False))
    asked = _pack(anchors.repartition(anchor_groups), ANCHORS).withColumn("i", F.pmod(F.spark_partition_id(), F.lit(anchor_groups)).cast("int"))
    asked = asked.withColumn("j", F.explode(every(row_groups))).withColumn("anchors", F.lit(True))

    def run(cell: pa.Table) -> pa.Table:
        is_anchor = cell["anchors"].to_numpy()
        own, ask = cell.filter(pa.array(~is_anchor)), cell.filter(pa.array(is_anchor))
        cols = Columns(_matrix(own), *(_joined(own, c, "<i8") for c in ("ids", "labels", "uids")))
        return task(cols, ask)

    return blocks.unionByName(asked).groupBy("i", "j").applyInArrow(run, schema)


def mine(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, of: int = 100,
         scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that ``anchor`` selects."""
    spark = vectors.sparkSession
    ship(spark)
    far = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) * scale > LIMIT)  # noqa: E731  also infinite
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"),
                          F.col(vector).cast("array<double>").alias("vector"), anchor.alias("is_anchor"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()).where(~F.exists("vector", far))
    rows = cut_lineage(rows.select(F.monotonically_increasing_id().alias("uid"), "id", "label",
                                   F.transform("vector", lambda x: F.floor(x * scale).cast("int")).alias("vector"), "is_anchor"))
    n, asked = rows.agg(F.count("*"), F.count_if("is_anchor")).first()
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    size = min(ROWS, max(LEAST_ROWS, -(-n // tasks)))
    row_groups, anchor_groups = max(1, -(-n // size)), max(1, -(-asked // ANCHORS))
    nothing = F.array().cast("array<long>").alias("extra")
    held = rows.select("uid", "id", "label", "vector", nothing)
    anchors = rows.where("is_anchor")

    def find_positives(cols: Columns, ask: pa.Table) -> pa.Table:
        matrix, out = _matrix(ask), []
        for vec, uid, of_label in zip(matrix, _joined(ask, "uids", "<i8"), _joined(ask, "labels", "<i8"), strict=True):
            out.extend((int(uid), int(cols.ids[r]), int(cols.uids[r]), s) for r, s in best_positives(cols, vec, of_label, uid, positives))
        return pa.table([pa.array([o[c] for o in out], pa.int64()) for c in range(4)], ["anchor", "positive_id", "positive", "score"])

    near = _met(held, anchors.select("uid", "id", "label", "vector", nothing), row_groups, anchor_groups, find_positives,
                "anchor long, positive_id long, positive long, score long")
    place = F.row_number().over(Window.partitionBy("anchor").orderBy(F.desc("score"), "positive_id", "positive"))
    near = cut_lineage(near.withColumn("place", place).where(F.col("place") <= positives))
    windows = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("w"))  # `positives` entries at most
    asking = anchors.join(windows, anchors.uid == windows.anchor).select("uid", "id", "label", "vector", F.col("w.score").alias("extra"))

    def find_negatives(cols: Columns, ask: pa.Table) -> pa.Table:
        matrix, out = _matrix(ask), []
        counts, scores = _joined(ask, "counts", "<i4"), _joined(ask, "extras", "<i8")
        begin = np.concatenate([[0], np.cumsum(counts)])
        for x, (vec, uid, of_label) in enumerate(zip(matrix, _joined(ask, "uids", "<i8"), _joined(ask, "labels", "<i8"), strict=True)):
            s = scores[begin[x]:begin[x + 1]]
            out.extend((int(uid), w + 1, int(cols.ids[r]), v) for w, r, v in best_negatives(
                cols, vec, of_label, np.stack([-(-low * s // of), high * s // of], 1), negatives))
        return pa.table([pa.array([o[c] for o in out], pa.int64()) for c in range(4)], ["anchor", "place", "negative_id", "negative_score"])

    found = _met(held, asking, row_groups, anchor_groups, find_negatives, "anchor long, place long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor", "place").orderBy(F.desc("negative_score"), "negative_id"))
    found = found.withColumn("rank", rank).where(F.col("rank") <= negatives)
    named = near.join(anchors.select(F.col("uid").alias("anchor"), F.col("id").alias("anchor_id")), "anchor")
    return found.join(named, ["anchor", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", F.col("score").alias("positive_score"), "negative_score")
