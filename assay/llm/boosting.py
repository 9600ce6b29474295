"""Gradient-boosted trees for log loss with soft targets, on numpy arrays.

Features are cut into quantile bins once; every tree is grown level by level on histograms of
gradients and Hessians. Training is deterministic. A model is a few small arrays, so tasks
carry it in their closure and score whole batches of rows at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES = 60
DEPTH = 4
RATE = 0.25
BINS = 32
#: L2 penalty of a leaf's value, and the least sum of Hessians in a leaf.
LEAF_DECAY = 1.0
LEAST_HESSIAN = 2.0


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: feature and threshold of the inner places in level order, and leaf values."""

    start: float
    feature: np.ndarray  # (trees, 2**depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # (trees, 2**depth)

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of the rows of ``x``."""
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        depth = (inner + 1).bit_length() - 1
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, f[at]] > t[at])
            out += leaf[at - inner]
        return out


def quantile_cuts(x: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Ascending thresholds of every feature; a value belongs to the bin of the number of thresholds below it."""
    cuts = []
    for c in range(x.shape[1]):
        values = np.unique(x[:, c])
        if len(values) > bins:
            values = np.unique(np.quantile(x[:, c], np.linspace(0, 1, bins + 1)[1:-1], method="inverted_cdf"))
        cuts.append(values[:-1] if len(values) and values[-1] == x[:, c].max() else values)
    return cuts


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE) -> Trees:
    """Fit rows ``x`` to targets ``y`` between 0 and 1."""
    n, width = x.shape
    mean = float(np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3))
    start = float(np.log(mean / (1 - mean)))
    cuts = quantile_cuts(x)
    binned = np.stack([np.searchsorted(c, x[:, i], side="left") for i, c in enumerate(cuts)], axis=1) if width else np.zeros((n, 0), int)
    inner = 2**depth - 1
    feature, threshold = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    margin = np.full(n, start)
    for k in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, places = 2**level - 1, 2**level
            place = at - first
            total_g = np.bincount(place, g, places)
            total_h = np.bincount(place, h, places)
            best = np.full(places, 1e-6)
            for c in range(width):
                if not len(cuts[c]):
                    continue
                size = len(cuts[c]) + 1
                cell = place * size + binned[:, c]
                left_g = np.bincount(cell, g, places * size).reshape(places, size).cumsum(axis=1)[:, :-1]
                left_h = np.bincount(cell, h, places * size).reshape(places, size).cumsum(axis=1)[:, :-1]
                right_g, right_h = total_g[:, None] - left_g, total_h[:, None] - left_h
                gain = left_g**2 / (left_h + LEAF_DECAY) + right_g**2 / (right_h + LEAF_DECAY) - (total_g**2 / (total_h + LEAF_DECAY))[:, None]
                gain[(left_h < LEAST_HESSIAN) | (right_h < LEAST_HESSIAN)] = 0
                top = gain.argmax(axis=1)
                value = gain[np.arange(places), top]
                better = np.flatnonzero(value > best + 1e-9)
                best[better] = value[better]
                feature[k, first + better] = c
                threshold[k, first + better] = cuts[c][top[better]]
            at = 2 * at + 1 + (x[np.arange(n), feature[k, at]] > threshold[k, at])
        ends = at - inner
        leaf[k] = -rate * np.bincount(ends, g, inner + 1) / (np.bincount(ends, h, inner + 1) + LEAF_DECAY)
        margin += leaf[k][ends]
    return Trees(start, feature, threshold, leaf)
