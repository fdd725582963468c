"""Gradient-boosted trees for binary labels, in numpy: histogram splits, logistic loss."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

BINS = 32


@dataclass
class Trees:
    """Complete trees of one depth as arrays (tree, node): a row goes right where feature > threshold.

    Leaves hold log-odds; base is where they start.
    """

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    @property
    def depth(self) -> int:
        return self.leaf.shape[1].bit_length() - 1

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += leaf[node - (len(leaf) - 1)]
        return out

    def column(self, features: list[Column]) -> Column:
        """The same log-odds as a SQL expression: nested CASEs, one for each tree."""

        def walk(k: int, node: int) -> Column:
            inner = len(self.leaf[k]) - 1
            if node >= inner:
                return F.lit(float(self.leaf[k][node - inner]))
            f, t = int(self.feature[k][node]), float(self.threshold[k][node])
            low, high = 2 * node + 1, 2 * node + 2
            if np.isinf(t):
                return walk(k, low)
            return F.when(features[f] > t, walk(k, high)).otherwise(walk(k, low))

        out = F.lit(float(self.base))
        for k in range(len(self.leaf)):
            out = out + walk(k, 0)
        return out


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2, ridge: float = 2.0, least: int = 10) -> Trees:
    """Newton boosting; each split leaves ``least`` rows at least on both sides."""
    x = np.asarray(x, np.float64)
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)])
    rate0 = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base, inner = float(np.log(rate0 / (1 - rate0))), 2**depth - 1
    logit = np.full(len(y), base)
    out = Trees(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, inner + 1)), base)
    for k in range(trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            gain, best = np.full(width, 1e-6), [None] * width
            local = node - first
            for f, b in enumerate(binned):
                if not len(cuts[f]):
                    continue
                key = local * BINS + b
                sums = [np.cumsum(np.bincount(key, w, width * BINS).reshape(width, BINS), axis=1) for w in (g, h, None)]
                (gl, gt), (hl, ht), (nl, nt) = ((s, s[:, -1:]) for s in sums)
                score = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                score[(nl < least) | (nt - nl < least)] = -1
                at = score[:, : len(cuts[f])].argmax(axis=1)
                for w in np.flatnonzero(score[np.arange(width), at] > gain):
                    gain[w], best[w] = score[w, at[w]], (f, at[w])
            for w, found in enumerate(best):
                if found:
                    out.feature[k, first + w], out.threshold[k, first + w] = found[0], cuts[found[0]][found[1]]
            f, t = out.feature[k, node], out.threshold[k, node]
            node = 2 * node + 1 + (x[np.arange(len(y)), f] > t)
        leaf = node - inner
        out.leaf[k] = rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
        logit += out.leaf[k][leaf]
    return out
