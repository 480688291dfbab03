"""Small gradient-boosted trees on binned features (logistic loss)."""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """Complete trees of one depth as arrays: inner nodes in heap order with
    (feature, threshold; go right if greater), then leaf values."""

    def __init__(self, base: float, feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray):
        self.base, self.feature, self.cut, self.leaf = base, feature, cut, leaf

    def parts(self) -> tuple:
        return self.base, self.feature, self.cut, self.leaf

    def margin(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, c, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            while node[0] < len(f) if len(x) else False:
                node = 2 * node + 1 + (x[rows, f[node]] > c[node])
            z += leaf[node - len(f)] if len(x) else 0.0
        return z

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


def weighted_cuts(v: np.ndarray, weight: np.ndarray, bins: int) -> np.ndarray:
    """Values of ``v`` that cut its weight into at most ``bins`` parts, each
    up to and including a cut."""
    return np.unique(np.quantile(v, np.linspace(0, 1, bins + 1)[1:-1], method="inverted_cdf", weights=weight))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2, smooth: float = 1.0,
          weight: np.ndarray | None = None) -> Boosted:
    """Newton boosting; each level of a tree splits all its nodes at the best
    of the binned cuts.  A row of weight w counts as w rows."""
    w = np.ones(len(y)) if weight is None else np.asarray(weight, np.float64)
    cuts = [weighted_cuts(x[:, j], w, BINS) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)])
    p = np.clip(np.average(y, weights=w), 1e-3, 1 - 1e-3)
    base = float(np.log(p / (1 - p)))
    z, inner = np.full(len(y), base), 2 ** depth - 1
    features, thresholds, leaves = [], [], []
    for _ in range(trees):
        prob = 1 / (1 + np.exp(-z))
        g, h = w * (prob - y), w * prob * (1 - prob)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, width = 2 ** level - 1, 2 ** level
            best = np.full(width, 1e-6)
            for j, c in enumerate(cuts):
                if not len(c):
                    continue
                slot = (node - first) * (len(c) + 1) + binned[:, j]
                gs = np.bincount(slot, g, width * (len(c) + 1)).reshape(width, -1).cumsum(axis=1)
                hs = np.bincount(slot, h, width * (len(c) + 1)).reshape(width, -1).cumsum(axis=1)
                gl, hl, ga, ha = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl ** 2 / (hl + smooth) + (ga - gl) ** 2 / (ha - hl + smooth) - ga ** 2 / (ha + smooth)
                k = gain.argmax(axis=1)
                better = gain[np.arange(width), k] > best
                best[better] = gain[np.arange(width), k][better]
                feature[first:first + width][better] = j
                cut[first:first + width][better] = c[k[better]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > cut[node])
        at = node - inner
        leaf = -rate * np.bincount(at, g, inner + 1) / (np.bincount(at, h, inner + 1) + smooth)
        z += leaf[at]
        features.append(feature)
        thresholds.append(cut)
        leaves.append(leaf)
    return Boosted(base, np.array(features), np.array(thresholds), np.array(leaves))
