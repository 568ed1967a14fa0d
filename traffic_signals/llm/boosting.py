"""Small learners fitted on the driver from a bounded sample of dense features: boosted trees and isotonic calibration."""

from __future__ import annotations

import numpy as np


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0, least: float = 1.0) -> dict:
    """Gradient-boosted trees for the logistic loss. Trees are complete, stored level by level; splits are at quantiles."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    codes = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T, strict=True)], 1)
    width = bins + 1
    base = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    f = np.full(len(y), np.log(base / (1 - base)))
    trees, start = [], f[0] if len(f) else 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        g, h = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        for level in range(depth):
            first, n = 2**level - 1, 2**level
            best = np.full(n, 1e-9)
            for j in range(x.shape[1]):
                at = node * width + codes[:, j]
                gs = np.bincount(at, g, n * width).reshape(n, width).cumsum(1)
                hs = np.bincount(at, h, n * width).reshape(n, width).cumsum(1)
                gl, hl, gt, ht = gs[:, :-1], hs[:, :-1], gs[:, -1:], hs[:, -1:]
                gain = gl**2 / (hl + ridge) + (gt - gl) ** 2 / (ht - hl + ridge) - gt**2 / (ht + ridge)
                gain[(hl < least) | (ht - hl < least)] = -1
                gain[:, len(edges[j]) :] = -1
                k = gain.argmax(1)
                top = gain[np.arange(n), k]
                for i in np.flatnonzero(top > best):
                    best[i], feature[first + i], cut[first + i] = top[i], j, edges[j][k[i]]
            right = x[np.arange(len(y)), feature[first + node]] > cut[first + node]
            node = node * 2 + right
        leaf = rate * np.bincount(node, g, 2**depth) / (np.bincount(node, h, 2**depth) + ridge)
        f = f + leaf[node]
        trees.append((feature, cut, leaf))
    return {"start": start, "depth": depth, "trees": trees}


def raw_scores(model: dict, x: np.ndarray) -> np.ndarray:
    f = np.full(len(x), model["start"])
    rows = np.arange(len(x))
    for feature, cut, leaf in model["trees"]:
        node = np.zeros(len(x), np.int64)
        for level in range(model["depth"]):
            at = 2**level - 1 + node
            node = node * 2 + (x[rows, feature[at]] > cut[at])
        f += leaf[node]
    return f


def isotonic(scores: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots (score, probability) of the isotonic fit by pooling adjacent violators. Equal scores are pooled first."""
    at, where = np.unique(scores, return_inverse=True)
    blocks: list[list[float]] = []  # weight, sum, last knot
    for s, n, total in zip(at, np.bincount(where), np.bincount(where, y), strict=True):
        blocks.append([n, total, s, s])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            n2, t2, _, hi = blocks.pop()
            blocks[-1] = [blocks[-1][0] + n2, blocks[-1][1] + t2, blocks[-1][2], hi]
    knots = [(s, (t + 0.5) / (n + 1)) for n, t, lo, hi in blocks for s in ((lo, hi) if hi > lo else (lo,))]
    x, p = np.array([k[0] for k in knots]), np.maximum.accumulate([k[1] for k in knots])
    return x, p


def calibrated(knots: tuple[np.ndarray, np.ndarray], scores: np.ndarray) -> np.ndarray:
    """Linear between the knots. A small part of the raw score keeps the order within a level."""
    return np.clip(0.999 * np.interp(scores, *knots) + 0.001 / (1 + np.exp(-scores)), 0, 1)
