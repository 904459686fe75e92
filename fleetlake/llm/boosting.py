"""Gradient-boosted trees for two classes, on arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Complete binary trees of one depth; a row goes right where its feature exceeds the threshold."""

    features: np.ndarray  # tree, inner node
    thresholds: np.ndarray
    leaves: np.ndarray  # tree, leaf
    start: float

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of the positive class for each row."""
        out = np.full(len(rows), self.start)
        depth = self.leaves.shape[1].bit_length() - 1
        every = np.arange(len(rows))
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (rows[every, feature[node]] > threshold[node])
            out += leaf[node - (len(leaf) - 1)]
        return out

    @staticmethod
    def fit(rows: np.ndarray, labels: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, bins: int = 32) -> Trees:
        """Newton boosting of the logistic loss with histograms of feature values."""
        n, width = rows.shape
        edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
        binned = np.stack([np.searchsorted(edges[f], rows[:, f], "left") for f in range(width)], axis=1)
        share = labels.mean().clip(1e-3, 1 - 1e-3)
        start = float(np.log(share / (1 - share)))
        margin = np.full(n, start)
        features, thresholds, leaves = [], [], []
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            slope, curve = p - labels, p * (1 - p) + 1e-6
            feature, threshold = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
            node = np.zeros(n, np.int64)
            for level in range(depth):
                first, count = 2**level - 1, 2**level
                best = np.full(count, 1e-9)
                for f in range(width):
                    cells = (node - first) * bins + binned[:, f]
                    g = np.bincount(cells, slope, count * bins).reshape(count, bins).cumsum(1)
                    h = np.bincount(cells, curve, count * bins).reshape(count, bins).cumsum(1)
                    total_g, total_h = g[:, -1:], h[:, -1:]
                    gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - total_g**2 / (total_h + 1)
                    gain = gain[:, : len(edges[f])]
                    if not gain.shape[1]:
                        continue
                    at = gain.argmax(1)
                    top = gain[np.arange(count), at]
                    better = np.flatnonzero(top > best)
                    best[better] = top[better]
                    feature[first + better] = f
                    threshold[first + better] = edges[f][at[better]]
                node = 2 * node + 1 + (rows[np.arange(n), feature[node]] > threshold[node])
            leaf = node - (2**depth - 1)
            value = -rate * np.bincount(leaf, slope, 2**depth) / (np.bincount(leaf, curve, 2**depth) + 1)
            margin += value[leaf]
            features.append(feature)
            thresholds.append(threshold)
            leaves.append(value)
        return Trees(np.stack(features), np.stack(thresholds), np.stack(leaves), start)
