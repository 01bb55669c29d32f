import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int, uid long, extra string"


def plain(rows, positives=5, negatives=10):
    """Every pair of rows, sorted."""
    held = []
    for vec_id, vector, label, *_ in rows:
        if vec_id is None or vector is None or label is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        held.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    out = []
    for i, (anchor, a, label) in enumerate(held):
        if anchor % 10:
            continue
        scored = [(-sum(x * y for x, y in zip(a, b, strict=False)), v, other) for j, (v, b, other) in enumerate(held) if j != i]
        scored.sort(key=lambda t: t[:2])
        for s, p, _ in [t for t in scored if t[2] == label][:positives]:
            fit = [t for t in scored if t[2] != label and 30 * -s <= 100 * -t[0] <= 90 * -s]
            out.extend((anchor, p, r + 1, v, -s, -t) for r, (t, v, _) in enumerate(fit[:negatives]))
    return sorted(out)


def mined(frame, rows):
    df = frame([(i, None if v is None else [None if x is None else float(x) for x in v], k, 7, "x") for i, v, k in rows], SCHEMA)
    got = hardneg.mine(df, F.col("vec_id") % 10 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in got.collect())


def vectors(n, dims, seed, spread=0.2):
    g = np.random.default_rng(seed)
    centre = g.normal(0, spread, dims)
    return [(i, [float(np.float32(x)) for x in centre + g.normal(0, spread, dims)], int(g.integers(0, 3))) for i in range(n)]


@pytest.mark.parametrize("small", [False, True])
def test_equals_every_pair(frame, monkeypatch, small):
    if small:  # several groups of rows and of anchors
        monkeypatch.setattr(hardneg, "ROWS", 40)
        monkeypatch.setattr(hardneg, "LEAST_ROWS", 7)
        monkeypatch.setattr(hardneg, "ANCHORS", 4)
    rows = vectors(150, 20, 1)
    want = plain(rows)
    assert len(want) > 100 and mined(frame, rows) == want


def test_rows_that_take_no_part_ties_and_repeated_rows(frame):
    rows = vectors(60, 6, 2)
    rows += [(100, None, 1), (101, [0.5] * 6, None), (None, [0.5] * 6, 1), (110, [0.1, None, 0, 0, 0, 0], 1),
             (120, [float("nan")] + [0.1] * 5, 2), (130, [float("inf")] + [0.1] * 5, 2)]
    rows += [(200 + i, rows[0][1], 1 + i % 2) for i in range(30)]  # equal scores
    rows += [rows[0], rows[10], rows[10]]                          # rows repeated as a whole
    assert mined(frame, rows) == plain(rows)


def test_short_empty_and_zero_vectors(frame):
    rows = [(0, [0.5, 0.25], 0), (1, [0.5], 0), (2, [], 1), (3, [0.25, 0.25, 0.9], 1), (4, [0.0, 0.0], 1), (10, [], 1), (20, [0.0], 0), (5, [0.3, 0.1], 1)]
    assert mined(frame, rows) == plain(rows)


def test_empty_table_and_no_positive(frame):
    assert mined(frame, []) == []
    assert mined(frame, [(0, [0.5], 0), (1, [0.4], 1)]) == []


def test_far_components_take_no_part(frame):
    rows = [(0, [0.5, 0.5], 0), (1, [0.5, 0.4], 0), (2, [0.3, 0.3], 1), (3, [1e30, 0.0], 1)]
    assert [r[3] for r in mined(frame, rows)] == [2]


def test_scan_drops_rows_before_the_last_column():
    g = np.random.default_rng(3)
    matrix = np.concatenate([g.integers(-3, 4, (500, 32)), g.integers(-3, 4, (5, 32)) + 40])
    cols = hardneg.Columns(matrix, np.arange(505), np.zeros(505, int), np.arange(505))
    seen = []
    keep = lambda lower, upper: seen.append(len(lower)) or upper >= hardneg._kth(lower, 5)
    rows, score = cols.scan(np.full(32, 10), np.ones(505, bool), keep)
    assert rows.tolist() == [500, 501, 502, 503, 504] and score.tolist() == (matrix[500:].sum(1) * 10).tolist()
    assert seen[0] == 505 and seen[-1] < 100
