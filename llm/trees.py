"""Gradient-boosted trees for two classes with monotonic constraints, as flat node arrays.

Fitting is histogram-based on a bounded table (the caller's sample).  The
fitted trees are five arrays over all nodes of all trees; scoring walks all
rows of a batch down one level at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    feature: np.ndarray    # int32, -1 at a leaf
    threshold: np.ndarray  # go left if value <= threshold
    left: np.ndarray       # node numbers
    right: np.ndarray
    value: np.ndarray      # of leaves, log odds
    roots: np.ndarray
    depth: int
    bias: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row of ``x``."""
        out = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root, np.int32)
            for _ in range(self.depth):
                f = self.feature[node]
                inner = f >= 0
                down = np.where(x[rows, np.maximum(f, 0)] <= self.threshold[node], self.left[node], self.right[node])
                node = np.where(inner, down, node)
            out += self.value[node]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2,
        bins: int = 64, min_rows: int = 20, ridge: float = 1.0) -> Forest:
    """``monotone[j]``: +1 (the score may only rise with feature j), -1 (only fall) or 0.

    One class, or no row at all, gives a forest without trees: the score is that class's.
    """
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    mean = float(np.clip(y.mean(), 1e-4, 1 - 1e-4)) if len(y) else 1 - 1e-4
    bias = float(np.log(mean / (1 - mean)))
    n, m = x.shape
    if 0 < y.sum() < n:
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
        code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        score = np.full(n, bias)
        for _ in range(trees):
            p = 1.0 / (1.0 + np.exp(-score))
            grad, hess = y - p, p * (1 - p)

            def node() -> int:
                for a, v in ((feature, -1), (threshold, 0.0), (left, 0), (right, 0), (value, 0.0)):
                    a.append(v)
                return len(feature) - 1

            def leaf(rows, lo, hi, grad=grad, hess=hess):
                return float(np.clip(grad[rows].sum() / (hess[rows].sum() + ridge), lo, hi))

            def grow(rows, level, lo, hi, me, grad=grad, hess=hess, score=score):
                best = (1e-6, None)
                if level < depth and len(rows) >= 2 * min_rows:
                    g, h = grad[rows], hess[rows]
                    total_g, total_h = g.sum(), h.sum()
                    for j in range(m):
                        k = len(cuts[j]) + 1
                        if k < 2:
                            continue
                        c = code[rows, j]
                        gl, hl = np.cumsum(np.bincount(c, g, k))[:-1], np.cumsum(np.bincount(c, h, k))[:-1]
                        nl = np.cumsum(np.bincount(c, minlength=k))[:-1]
                        vl = np.clip(gl / (hl + ridge), lo, hi)
                        vr = np.clip((total_g - gl) / (total_h - hl + ridge), lo, hi)
                        gain = gl**2 / (hl + ridge) + (total_g - gl)**2 / (total_h - hl + ridge) - total_g**2 / (total_h + ridge)
                        ok = (nl >= min_rows) & (len(rows) - nl >= min_rows) & (monotone[j] * (vr - vl) >= 0)
                        gain = np.where(ok, gain, -1)
                        i = int(gain.argmax())
                        if gain[i] > best[0]:
                            best = (gain[i], (j, i, vl[i], vr[i]))
                if best[1] is None:
                    value[me] = rate * leaf(rows, lo, hi)
                    score[rows] += value[me]
                    return
                j, i, vl, vr = best[1]
                mid = (vl + vr) / 2
                a, b = node(), node()
                feature[me], threshold[me], left[me], right[me] = j, float(cuts[j][i]), a, b
                goes = code[rows, j] <= i
                bounds = {1: ((lo, mid), (mid, hi)), -1: ((mid, hi), (lo, mid)), 0: ((lo, hi), (lo, hi))}[int(monotone[j])]
                grow(rows[goes], level + 1, *bounds[0], a)
                grow(rows[~goes], level + 1, *bounds[1], b)

            roots.append(node())
            grow(np.arange(n), 0, -np.inf, np.inf, roots[-1])
    return Forest(np.array(feature, np.int32), np.array(threshold, float), np.array(left, np.int32),
                  np.array(right, np.int32), np.array(value, float), np.array(roots, np.int32), depth, bias)
