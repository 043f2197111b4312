"""Gradient-boosted trees for binary labels on binned features, in numpy.

Trained on a bounded sample; a model is a few hundred numbers, sent to the
tasks that score with it.
"""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """Complete trees of one depth: per tree, features and thresholds of its
    inner nodes (by level) and leaf values."""

    def __init__(self, trees: int = 60, depth: int = 5, rate: float = 0.2, l2: float = 1.0, least: float = 5.0, rows: int = 24_000):
        self.trees, self.depth, self.rate, self.l2, self.least, self.rows = trees, depth, rate, l2, least, rows
        self.base = 0.0
        self.feature: list[np.ndarray] = []
        self.cut: list[np.ndarray] = []
        self.leaf: list[np.ndarray] = []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        n, m = x.shape
        share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
        self.base = float(np.log(share / (1 - share)))
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(m)]
        binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in range(m)], axis=1)
        score = np.full(n, self.base)
        inner = 2 ** self.depth - 1
        draw = np.random.default_rng(5)
        for _ in range(self.trees):
            # Each tree grows on other rows, at most ``rows`` of them.
            some = draw.choice(n, min(n, self.rows), replace=False)
            p = 1 / (1 + np.exp(-score[some]))
            grad, hess = y[some] - p, p * (1 - p)
            own, own_bins = x[some], binned[some]
            feature, cut, where = np.zeros(inner, dtype=np.int64), np.full(inner, np.inf), np.zeros(len(some), dtype=np.int64)
            for level in range(self.depth):
                first, width = 2 ** level - 1, 2 ** level
                gain = np.full(width, 1e-9)
                pick, at = np.zeros(width, dtype=np.int64), np.full(width, np.inf)
                for f in range(m):
                    if not len(edges[f]):
                        continue
                    cell = (where - first) * BINS + own_bins[:, f]
                    g = np.bincount(cell, grad, width * BINS).reshape(width, BINS).cumsum(axis=1)
                    h = np.bincount(cell, hess, width * BINS).reshape(width, BINS).cumsum(axis=1)
                    allg, allh = g[:, -1:], h[:, -1:]
                    best = g ** 2 / (h + self.l2) + (allg - g) ** 2 / (allh - h + self.l2) - allg ** 2 / (allh + self.l2)
                    best[(h < self.least) | (allh - h < self.least)] = 0
                    best = best[:, :len(edges[f])]
                    top = best.argmax(axis=1)
                    value = best[np.arange(width), top]
                    more = value > gain
                    gain[more], pick[more], at[more] = value[more], f, edges[f][top[more]]
                feature[first:first + width], cut[first:first + width] = pick, at
                where = 2 * where + 1 + (own[np.arange(len(some)), feature[where]] > cut[where])
            leaf = where - inner
            g, h = np.bincount(leaf, grad, 2 ** self.depth), np.bincount(leaf, hess, 2 ** self.depth)
            value = self.rate * g / (h + self.l2)
            self.feature.append(feature)
            self.cut.append(cut)
            self.leaf.append(value)
            score += self._leaves(x, feature, cut, value)
        return self

    def _leaves(self, x: np.ndarray, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray) -> np.ndarray:
        row, where = np.arange(len(x)), np.zeros(len(x), dtype=np.int64)
        for _ in range(self.depth):
            where = 2 * where + 1 + (x[row, feature[where]] > cut[where])
        return leaf[where - (2 ** self.depth - 1)]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of label 1 of each row."""
        out = np.full(len(x), self.base)
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            out += self._leaves(x, feature, cut, leaf)
        return out
