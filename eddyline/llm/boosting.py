"""Gradient-boosted trees for a two-class loss, and isotonic calibration, on small numeric tables."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Boosted:
    """Complete trees of equal depth: a feature and a threshold per inner node, a value per leaf."""

    start: float
    features: np.ndarray  # trees x inner nodes
    thresholds: np.ndarray
    values: np.ndarray  # trees x leaves

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, threshold, value in zip(
            self.features, self.thresholds, self.values, strict=True
        ):
            node = np.zeros(len(x), np.int64)
            for _ in range(len(value).bit_length() - 1):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            out += value[node - len(feature)]
        return out


def boost(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 120,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 48,
    least: float = 0.5,
    ridge: float = 1.0,
) -> Boosted:
    """Newton boosting on binned features; ``least`` is the curvature a leaf must have."""
    n, d = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(d)], axis=1)
    width = max(len(c) for c in cuts) + 1
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    start = float(np.log(share / (1 - share)))
    margin = np.full(n, start)
    inner = 2**depth - 1
    features = np.zeros((trees, inner), np.int64)
    thresholds = np.full((trees, inner), np.inf)
    values = np.zeros((trees, 2**depth))
    rows = np.arange(n)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        gradient, curvature = y - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        limit = np.full(inner, width, np.int64)  # bins above it go right; none by default
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            at = node - first
            g, h = np.zeros((2, d, count * width))
            for j in range(d):
                place = at * width + binned[:, j]
                g[j] = np.bincount(place, gradient, count * width)
                h[j] = np.bincount(place, curvature, count * width)
            g = g.reshape(d, count, width).cumsum(axis=2)
            h = h.reshape(d, count, width).cumsum(axis=2)
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = (
                g**2 / (h + ridge)
                + (all_g - g) ** 2 / (all_h - h + ridge)
                - all_g**2 / (all_h + ridge)
            )
            gain[(h < least) | (all_h - h < least)] = 0
            flat = gain.transpose(1, 0, 2).reshape(count, -1)
            best = flat.argmax(axis=1)
            for k in np.nonzero(flat[np.arange(count), best] > 1e-9)[0]:
                j, b = divmod(int(best[k]), width)
                features[t, first + k], limit[first + k] = j, b
                if b < len(cuts[j]):
                    thresholds[t, first + k] = cuts[j][b]
            node = 2 * node + 1 + (binned[rows, features[t, node]] > limit[node])
        leaf = node - inner
        size = 2**depth
        values[t] = (
            rate
            * np.bincount(leaf, gradient, size)
            / (np.bincount(leaf, curvature, size) + ridge)
        )
        margin += values[t][leaf]
    return Boosted(start, features, thresholds, values)


@dataclass(frozen=True)
class Isotonic:
    """A rising curve through block means; straight between them, flat outside."""

    places: np.ndarray
    heights: np.ndarray

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        return np.interp(margin, self.places, self.heights)


def isotonic(margin: np.ndarray, y: np.ndarray) -> Isotonic:
    """Pools adjacent violators; each block counts one row of one half besides its own."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # label sum, rows, margin sum
    for m, label in zip(margin[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([label, 1.0, m])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    places = np.array([b[2] / b[1] for b in blocks])
    heights = np.array([(b[0] + 0.5) / (b[1] + 1) for b in blocks])
    return Isotonic(places, np.maximum.accumulate(heights))
