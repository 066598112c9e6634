"""Gradient-boosted trees with isotonic calibration, fitted on the driver over a bounded sample.

Trees have a fixed depth and are stored as arrays, so scoring is a few vector steps, or one
nested CASE expression where a query has to stay inside SQL.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """``feature`` and ``cut`` of inner nodes (tree x node) and ``leaf`` values; goes right where x > cut."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray
    #: Calibration: the score at each margin, linear between them.
    margins: np.ndarray
    scores: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1] if self.feature.size else 0
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while inner and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - inner]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.empty(0)
        return np.interp(self.margin(x), self.margins, self.scores)

    def sql_margin(self, names: list[str]) -> str:
        """The margin as an SQL expression over columns or fields ``names``."""

        def branch(t: int, node: int) -> str:
            inner = self.feature.shape[1]
            if node >= inner:
                return f"{float(self.leaf[t, node - inner])!r}D"
            left, right = branch(t, 2 * node + 1), branch(t, 2 * node + 2)
            if left == right or not np.isfinite(self.cut[t, node]):
                return left
            return f"CASE WHEN {names[self.feature[t, node]]} > {float(self.cut[t, node])!r}D THEN {right} ELSE {left} END"

        return " + ".join([f"{self.base!r}D", *(f"({branch(t, 0)})" for t in range(len(self.leaf)))])

    def margin_for(self, score: float) -> float:
        """The smallest margin that reaches a score (infinite if none does)."""
        at = np.flatnonzero(self.scores >= score)
        if not len(at):
            return float("inf")
        i = at[0]
        if i == 0 or self.scores[i] == self.scores[i - 1]:
            return float(self.margins[i])
        part = (score - self.scores[i - 1]) / (self.scores[i] - self.scores[i - 1])
        return float(self.margins[i - 1] + part * (self.margins[i] - self.margins[i - 1]))


def isotonic(x: np.ndarray, y: np.ndarray, weight: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing fit by pooling adjacent violators: knots and values, each pooled block drawn
    towards the mean by ``weight`` rows, so that no block is certain."""
    order = np.argsort(x, kind="stable")
    x, y = x[order], y[order].astype(float)
    mean = y.mean()
    blocks: list[list[float]] = []  # sum of y, rows, first x, last x
    for a, b in zip(x, y, strict=True):
        blocks.append([b, 1.0, a, a])
        while len(blocks) > 1 and (blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1] or blocks[-2][3] == blocks[-1][2]):
            s, n, _, last = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += n
            blocks[-1][3] = last
    at, value, top = [], [], 0.0
    for s, n, first, last in blocks:
        top = max(top, (s + weight * mean) / (n + weight))
        at += [first, last] if last > first else [first]
        value += [top, top] if last > first else [top]
    return np.array(at), np.array(value)


def fit(
    x: np.ndarray, y: np.ndarray, calibrate_x: np.ndarray, calibrate_y: np.ndarray,
    trees: int = 80, depth: int = 3, rate: float = 0.15, least: int = 8, ridge: float = 1.0, bins: int = 48,
) -> Forest:
    """Logistic loss, histogram splits; calibrated on rows that the trees have not seen."""
    n, width = x.shape
    inner, leaves = 2**depth - 1, 2**depth
    share = np.clip(y.mean() if n else 0.0, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    feature = np.zeros((0, inner), np.int64)
    cuts = np.zeros((0, inner))
    values = np.zeros((0, leaves))
    if n and 0 < y.sum() < n:
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
        # Rare signals are zero nearly everywhere: quantiles of what is not zero, too.
        edges = [np.unique(np.concatenate([e, np.quantile(v, np.linspace(0, 1, bins)) if len(v := x[x[:, f] != 0, f]) else e, [0.0]])) for f, e in enumerate(edges)]
        binned = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)], axis=1)
        size = max(len(e) for e in edges) + 1
        margin = np.full(n, base)
        rows = []
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = y - p, p * (1 - p)
            node = np.zeros(n, np.int64)
            tree_f, tree_c = np.zeros(inner, np.int64), np.full(inner, np.inf)
            for level in range(depth):
                first, count = 2**level - 1, 2**level
                best = np.full(count, 1e-6)
                split_bin = np.full(count, size)
                for f in range(width):
                    key = (node - first) * size + binned[:, f]
                    g = np.bincount(key, grad, count * size).reshape(count, size).cumsum(axis=1)
                    h = np.bincount(key, hess, count * size).reshape(count, size).cumsum(axis=1)
                    c = np.bincount(key, minlength=count * size).reshape(count, size).cumsum(axis=1)
                    gt, ht, ct = g[:, -1:], h[:, -1:], c[:, -1:]
                    gain = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
                    gain[(c < least) | (ct - c < least)] = 0
                    at = gain.argmax(axis=1)
                    top = gain[np.arange(count), at]
                    for k in np.flatnonzero(top > best):
                        if at[k] < len(edges[f]):
                            best[k], split_bin[k] = top[k], at[k]
                            tree_f[first + k], tree_c[first + k] = f, edges[f][at[k]]
                own = binned[np.arange(n), tree_f[node]]
                node = 2 * node + 1 + (own > split_bin[node - first])
            g = np.bincount(node - inner, grad, leaves)
            h = np.bincount(node - inner, hess, leaves)
            value = rate * g / (h + ridge)
            margin += value[node - inner]
            rows.append((tree_f, tree_c, value))
        feature, cuts, values = (np.stack(z) for z in zip(*rows, strict=True))
    out = Forest(base, feature, cuts, values, np.array([0.0]), np.array([share]))
    if len(calibrate_x):
        out.margins, out.scores = isotonic(out.margin(calibrate_x), calibrate_y)
    return out


def fit_crossed(x: np.ndarray, y: np.ndarray, part: np.ndarray, **how) -> Forest:
    """Trees over all rows, calibrated on margins that rows of each part get from trees over the other parts."""
    none = np.empty((0, x.shape[1])), np.empty(0)
    out = fit(x, y, *none, **how)
    margin, seen = np.zeros(len(y)), np.zeros(len(y), bool)
    for p in np.unique(part):
        own = part == p
        if 0 < y[~own].sum() < (~own).sum():
            margin[own], seen[own] = fit(x[~own], y[~own], *none, **how).margin(x[own]), True
    if seen.any():
        out.margins, out.scores = isotonic(margin[seen], y[seen])
    return out
