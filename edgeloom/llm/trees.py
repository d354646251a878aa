"""Histogram gradient-boosted trees (logistic loss), flattened into numpy node arrays.

A model is three arrays of complete binary trees: node ``i`` of a tree has its
children at ``2i+1`` and ``2i+2``; a row goes right where its feature exceeds
the node's threshold. A node without a split has an infinite threshold, so its
rows follow the left children down to one leaf.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    feature: np.ndarray    # (trees, inner nodes) int32
    threshold: np.ndarray  # (trees, inner nodes)
    value: np.ndarray      # (trees, leaves)
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of ``x``: all rows descend one level at a time."""
        inner = self.feature.shape[1]
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, v in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            while len(at) and at[0] < inner:
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            total += v[at - inner] if len(at) else 0
        return 1.0 / (1.0 + np.exp(-total))


def _cut_points(col: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` thresholds halfway between neighbouring values near the quantiles."""
    values = np.unique(col)
    if len(values) > bins:
        values = np.unique(np.quantile(col, np.linspace(0, 1, bins), method="nearest"))
    return (values[1:] + values[:-1]) / 2


def fit(x: np.ndarray, y: np.ndarray, monotone: dict[int, int] | None = None, trees: int = 60, depth: int = 4,
        bins: int = 64, rate: float = 0.15, l2: float = 1.0, min_rows: int = 8) -> Forest:
    """``monotone``: feature -> +1 (score never falls as it grows) or -1 (never rises).

    Without rows, or with one class only, the model is the smoothed share of label 1.
    """
    monotone = monotone or {}
    inner, leaves = 2 ** depth - 1, 2 ** depth
    base = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    if len(y) == 0 or y.min() == y.max():
        z = np.zeros((0, inner))
        return Forest(z.astype(np.int32), z, np.zeros((0, leaves)), base)
    n, width = x.shape
    cuts = [_cut_points(x[:, f], bins) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    total = np.full(n, base)
    all_f, all_t, all_v = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        feat, thr = np.zeros(inner, dtype=np.int32), np.full(inner, np.inf)
        low, high = np.full(inner + leaves, -np.inf), np.full(inner + leaves, np.inf)
        at = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, count = 2 ** level - 1, 2 ** level
            node = at - first
            best = np.full(count, 1e-6)
            pick = np.full((count, 2), -1)
            mids = np.zeros(count)
            lo, hi = low[first:first + count, None], high[first:first + count, None]
            for f in range(width):
                if not len(cuts[f]):
                    continue
                key, size = node * bins + binned[:, f], count * bins
                g = np.bincount(key, grad, size).reshape(count, bins).cumsum(1)
                h = np.bincount(key, hess, size).reshape(count, bins).cumsum(1)
                c = np.bincount(key, minlength=size).reshape(count, bins).cumsum(1)
                gl, hl, cl = g[:, :len(cuts[f])], h[:, :len(cuts[f])], c[:, :len(cuts[f])]
                gr, hr, cr = g[:, -1:] - gl, h[:, -1:] - hl, c[:, -1:] - cl
                vl, vr = np.clip(gl / (hl + l2), lo, hi), np.clip(gr / (hr + l2), lo, hi)
                v0 = np.clip(g[:, -1:] / (h[:, -1:] + l2), lo, hi)
                worth = lambda gs, hs, v: gs * v - 0.5 * (hs + l2) * v * v
                gain = worth(gl, hl, vl) + worth(gr, hr, vr) - worth(g[:, -1:], h[:, -1:], v0)
                bad = (cl < min_rows) | (cr < min_rows)
                if sign := monotone.get(f):
                    bad |= sign * (vr - vl) < 0
                gain[bad] = -1
                k = gain.argmax(1)
                better = gain[np.arange(count), k] > best
                best[better] = gain[np.arange(count), k][better]
                pick[better, 0], pick[better, 1] = f, k[better]
                mids[better] = ((vl + vr) / 2)[np.arange(count), k][better]
            for i in range(count):
                me, left, right = first + i, 2 * (first + i) + 1, 2 * (first + i) + 2
                low[left] = low[right] = low[me]
                high[left] = high[right] = high[me]
                f, k = pick[i]
                if f < 0:
                    continue
                feat[me], thr[me] = f, cuts[f][k]
                if sign := monotone.get(int(f)):
                    upper, lower = (right, left) if sign > 0 else (left, right)
                    low[upper], high[lower] = max(low[me], mids[i]), min(high[me], mids[i])
            at = 2 * at + 1 + (x[np.arange(n), feat[at]] > thr[at])
        leaf = at - inner
        g, h = np.bincount(leaf, grad, leaves), np.bincount(leaf, hess, leaves)
        value = rate * np.clip(g / (h + l2), low[inner:], high[inner:])
        total += value[leaf]
        all_f.append(feat)
        all_t.append(thr)
        all_v.append(value)
    return Forest(np.array(all_f), np.array(all_t), np.array(all_v), base)
