"""Histogram gradient-boosted trees: fitted on binned columns, flattened into arrays, scored without per-row Python.

Every tree is complete: node i has the children 2i + 1 and 2i + 2, so a forest is three arrays (feature, threshold,
leaf value) and scoring is `depth` rounds of gathers for all rows and trees at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # rows with a value above it go right
    leaf: np.ndarray  # trees x leaves
    base: float

    @property
    def depth(self) -> int:
        return int(np.log2(self.leaf.shape[1]))

    def probability(self, values: np.ndarray, rows_at_once: int = 4096) -> np.ndarray:
        """Probability of label 1 for each row of finite values."""
        trees = np.arange(len(self.leaf))
        out = np.full(len(values), self.base)
        for begin in range(0, len(values) if len(trees) else 0, rows_at_once):
            part = values[begin : begin + rows_at_once]
            rows = np.arange(len(part))[:, None]
            node = np.zeros((len(part), len(trees)), np.int64)
            for _ in range(self.depth):
                right = part[rows, self.feature[trees, node]] > self.threshold[trees, node]
                node = 2 * node + 1 + right
            out[begin : begin + rows_at_once] += self.leaf[trees, node - self.feature.shape[1]].sum(1)
        return 1 / (1 + np.exp(-np.clip(out, -40, 40)))


def _best_splits(grad: np.ndarray, hess: np.ndarray, ridge: float, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """From nodes x features x bins sums: the best feature and bin (last one that goes left) of each node, and its gain."""
    left_g, left_h = np.cumsum(grad, 2), np.cumsum(hess, 2)
    all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = left_g**2 / (left_h + ridge) + right_g**2 / (right_h + ridge) - all_g**2 / (all_h + ridge)
    gain[(left_h < least) | (right_h < least)] = 0
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(1)
    return best // gain.shape[2], best % gain.shape[2], flat[np.arange(len(flat)), best]


def fit(values: np.ndarray, labels: np.ndarray, trees: int = 80, depth: int = 4, bins: int = 64, rate: float = 0.15, ridge: float = 1.0, least: float = 5.0) -> Forest:
    """Logistic loss. Without rows or with one label only: a constant forest."""
    labels = np.asarray(labels, np.float64)
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    base = float(np.log(share / (1 - share)))
    inner = 2**depth - 1
    if len(set(labels.tolist())) < 2:
        return Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    n, width = values.shape
    edges = [np.unique(np.quantile(values[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(e, values[:, j], "left") for j, e in enumerate(edges)], 1)
    limits = np.full((width, bins), np.inf)
    for j, e in enumerate(edges):
        limits[j, : len(e)] = e
    cell = binned + np.arange(width) * bins
    logit = np.full(n, base)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        grad, hess = labels - p, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, wide = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (width * bins) + cell).ravel()
            size = wide * width * bins
            sums = [np.bincount(at, np.repeat(x, width), size).reshape(wide, width, bins) for x in (grad, hess)]
            j, b, gain = _best_splits(*sums, ridge, least)
            split = gain > 1e-9  # without a gain the threshold stays infinite and all rows go left
            feature[first : first + wide] = np.where(split, j, 0)
            threshold[first : first + wide] = np.where(split, limits[j, b], np.inf)
            mine = node - first
            node = 2 * node + 1 + (split[mine] & (binned[np.arange(n), j[mine]] > b[mine]))
        place = node - inner
        value = rate * np.bincount(place, grad, inner + 1) / (np.bincount(place, hess, inner + 1) + ridge)
        logit += value[place]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(value)
    return Forest(np.array(features), np.array(thresholds), np.array(leaves), base)
