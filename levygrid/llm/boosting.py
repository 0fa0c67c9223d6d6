"""Gradient-boosted trees for a binary target, on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_BINS = 32


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: split features, thresholds and leaf values."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log odds of the rows of ``x``."""
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(feature) and node[0] < len(feature):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += leaf[node - len(feature)]
        return out


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 4, rate: float = 0.25,
    ridge: float = 1.0, min_rows: int = 5,
) -> Trees:
    """Newton boosting of the logistic loss; deterministic."""
    n, k = x.shape
    inner = (1 << depth) - 1
    share = np.clip(y.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    if not n or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), int), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, _BINS)[1:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, side="left") for c, v in zip(cuts, x.T)], axis=1)
    limits = np.full((k, _BINS), np.inf)
    for i, c in enumerate(cuts):
        limits[i, : len(c)] = c
    odds = np.full(n, base)
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-odds))
        grad, hess = y - p, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, int), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            slot = ((node - first)[:, None] * k + np.arange(k)) * _BINS + binned
            shape = (width, k, _BINS)
            g, h, c = (
                np.bincount(slot.ravel(), np.repeat(w, k), width * k * _BINS).reshape(shape).cumsum(axis=2)
                for w in (grad, hess, np.ones(n))
            )
            gt, ht, ct = g[:, :, -1:], h[:, :, -1:], c[:, :, -1:]
            gain = g**2 / (h + ridge) + (gt - g) ** 2 / (ht - h + ridge) - gt**2 / (ht + ridge)
            gain[(c < min_rows) | (ct - c < min_rows)] = 0
            best = gain.reshape(width, -1).argmax(axis=1)
            useful = gain.reshape(width, -1)[np.arange(width), best] > 1e-9
            f, b = best // _BINS, best % _BINS
            feature[first : first + width] = f
            threshold[first : first + width] = np.where(useful, limits[f, b], np.inf)
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        at = node - inner
        leaf = rate * np.bincount(at, grad, inner + 1) / (np.bincount(at, hess, inner + 1) + ridge)
        odds += leaf[at]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(base, np.array(features), np.array(thresholds), np.array(leaves))
