"""Gradient-boosted trees for a yes/no label, with monotonic constraints; trees are rows of flat numpy arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Complete binary trees: node i has the children 2i+1 and 2i+2; a row goes right where its value is above the threshold.

    ``feature`` and ``threshold`` are trees x inner nodes, ``leaf`` is trees x leaves. A branch that ended early sends all rows
    left (threshold infinity).
    """

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row of ``x``; all trees at once, one step per level."""
        trees, inner = self.feature.shape
        at = np.zeros((len(x), trees), np.int64)
        tree, row = np.arange(trees)[None, :], np.arange(len(x))[:, None]
        for _ in range(int(np.log2(inner + 1))):
            at = 2 * at + 1 + (x[row, self.feature[tree, at]] > self.threshold[tree, at])
        return self.base + self.leaf[tree, at - inner].sum(1)


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    return [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]


def fit(x: np.ndarray, y: np.ndarray, monotone: dict[int, int], trees: int = 60, depth: int = 4, rate: float = 0.2,
        bins: int = 64, least: float = 5.0, ridge: float = 1.0) -> Forest:
    """Fit by second-order boosting on binned values.

    ``monotone`` maps a feature to +1 or -1: the score may only rise, or only fall, with it. A split that breaks this is not
    taken, and both sides are bounded by the middle of their values, so that no later split breaks it either. ``least`` is the
    smallest sum of second derivatives on a side.
    """
    edges = bin_edges(x, bins)
    codes = [np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)]
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    base = float(np.log(share / (1 - share)))
    inner, score = 2 ** depth - 1, np.full(len(y), base)
    feature = np.zeros((trees, inner), np.int64)
    threshold, leaf = np.full((trees, inner), np.inf), np.zeros((trees, inner + 1))
    for tree in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        bounds = {0: (-np.inf, np.inf)}
        for level in range(depth):
            first = 2 ** level - 1
            split = [_best(codes, edges, g, h, at - first, n, bounds[first + n], monotone, least, ridge)
                     for n in range(2 ** level)]
            for n, found in enumerate(split):
                node, (low, high) = first + n, bounds[first + n]
                bounds[2 * node + 1] = bounds[2 * node + 2] = (low, high)
                if found is None:
                    continue
                f, cut, left, right = found
                feature[tree, node], threshold[tree, node] = f, edges[f][cut]
                middle = (left + right) / 2
                if monotone.get(f):
                    up = monotone[f] > 0
                    bounds[2 * node + 1] = (low, middle) if up else (middle, high)
                    bounds[2 * node + 2] = (middle, high) if up else (low, middle)
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[tree, at]] > threshold[tree, at])
        at -= inner
        sums = [np.bincount(at, v, inner + 1) for v in (g, h)]
        values = sums[0] / (sums[1] + ridge)
        for n in range(inner + 1):
            leaf[tree, n] = rate * np.clip(values[n], *bounds[inner + n])
        score += leaf[tree, at]
    return Forest(feature, threshold, leaf, base)


def _best(codes, edges, g, h, at, node, bound, monotone, least, ridge):
    mine = at == node
    if not mine.any():
        return None
    gn, hn = g[mine], h[mine]
    total_g, total_h = gn.sum(), hn.sum()
    best, out = 1e-6, None
    for f, cuts in enumerate(edges):
        if not len(cuts):
            continue
        code = codes[f][mine]
        lg = np.cumsum(np.bincount(code, gn, len(cuts) + 1))[:-1]
        lh = np.cumsum(np.bincount(code, hn, len(cuts) + 1))[:-1]
        rg, rh = total_g - lg, total_h - lh
        left, right = np.clip(lg / (lh + ridge), *bound), np.clip(rg / (rh + ridge), *bound)
        gain = lg ** 2 / (lh + ridge) + rg ** 2 / (rh + ridge) - total_g ** 2 / (total_h + ridge)
        ok = (lh >= least) & (rh >= least)
        if monotone.get(f):
            ok &= (right - left) * monotone[f] >= 0
        gain = np.where(ok, gain, 0)
        cut = int(gain.argmax())
        if gain[cut] > best:
            best, out = gain[cut], (f, cut, left[cut], right[cut])
    return out
