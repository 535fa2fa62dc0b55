"""Gradient boosted trees for small samples, with calibrated probabilities."""

from __future__ import annotations

import numpy as np

TREES, DEPTH, RATE, BINS, LEAST = 40, 4, 0.2, 32, 10


class BoostedTrees:
    """Logistic loss, Newton leaves, splits at quantiles. Every level of a tree is a table of splits."""

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        cuts = np.linspace(0, 1, BINS + 1)[1:-1]
        self.edges = [np.unique(np.quantile(c, cuts)) if len(c) else c for c in x.T]
        binned = self._binned(x)
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
        self.base = float(np.log(rate / (1 - rate)))
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        margin = np.full(len(y), self.base)
        for _ in range(TREES if len(y) else 0):
            p = 1 / (1 + np.exp(-margin))
            tree, leaf = self._tree(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            margin += tree[2][leaf]
        return self

    def _binned(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(x.shape, np.int64)
        return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(self.edges, x.T)], axis=1)

    def _tree(self, binned: np.ndarray, gradient: np.ndarray, hessian: np.ndarray):
        nodes = 2 ** (DEPTH + 1) - 1
        feature, cut = np.full(nodes, -1), np.zeros(nodes, np.int64)
        node = np.zeros(len(binned), np.int64)
        for level in range(DEPTH):
            first, n = 2**level - 1, 2**level
            local = node - first
            at = np.flatnonzero(local >= 0)
            best = np.full(n, 1e-6)
            for f in range(binned.shape[1]):
                cell = local[at] * BINS + binned[at, f]
                g, h, c = (
                    np.bincount(cell, w, n * BINS).reshape(n, BINS).cumsum(axis=1)
                    for w in (gradient[at], hessian[at], None)
                )
                gain = self._gain(g, h) + self._gain(g[:, -1:] - g, h[:, -1:] - h) - self._gain(g[:, -1:], h[:, -1:])
                gain = np.where((c >= LEAST) & (c[:, -1:] - c >= LEAST), gain, 0)
                top = gain.argmax(axis=1)
                better = gain[np.arange(n), top] > best
                best = np.where(better, gain[np.arange(n), top], best)
                feature[first : first + n][better], cut[first : first + n][better] = f, top[better]
            split = at[feature[node[at]] >= 0]
            right = binned[split, feature[node[split]]] > cut[node[split]]
            node[split] = 2 * node[split] + 1 + right
        g, h = np.bincount(node, gradient, nodes), np.bincount(node, hessian, nodes)
        value = RATE * g / (h + 1.0)
        return (feature, cut, value), node

    @staticmethod
    def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return g * g / (h + 1.0)

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned = self._binned(x)
        out = np.full(len(x), self.base)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                f = feature[node]
                inner = np.flatnonzero(f >= 0)
                node[inner] = 2 * node[inner] + 1 + (binned[inner, f[inner]] > cut[node[inner]])
            out += value[node]
        return out


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into probabilities, by Newton's method with smoothed targets."""
    up, down = y.sum(), len(y) - y.sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, w = p - target, np.maximum(p * (1 - p), 1e-9)
        hessian = np.array([[(w * margin**2).sum() + 1e-3, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hessian, [(g * margin).sum() + 1e-3 * (a - 1), g.sum()])
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)
