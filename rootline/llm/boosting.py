"""Gradient-boosted trees on dense features with logistic loss, and isotonic calibration, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


@dataclass
class Trees:
    """Complete trees of one depth: node i has the children 2i+1 and 2i+2; a value >= the cut goes right."""

    depth: int
    base: float
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    leaf: list[np.ndarray] = field(default_factory=list)

    def raw(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        for f, c, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] >= c[at])
            out += leaf[at - (2**self.depth - 1)]
        return out


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, l2: float = 1.0, least: float = 1.0, bins: int = 48) -> Trees:
    mean = np.clip(y.mean(), 1e-3, 1 - 1e-3) if len(y) else 0.5
    out = Trees(depth, float(np.log(mean / (1 - mean))))
    if len(y) < 2 or y.min() == y.max():
        return out
    cuts = [np.unique(np.quantile(np.unique(c), np.linspace(0, 1, bins + 1)[1:])) if np.unique(c).size > 1 else np.array([np.inf]) for c in x.T]
    code = np.stack([np.searchsorted(c, v, "right") for c, v in zip(cuts, x.T, strict=True)], axis=1)
    raw, width = np.full(len(y), out.base), bins + 2
    for _ in range(rounds):
        p = sigmoid(raw)
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, np.inf)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            nodes = 2**level
            place = at - (nodes - 1)
            best, choice = np.full(nodes, 1e-9), [(0, np.inf, width)] * nodes
            for f in range(x.shape[1]):
                key = place * width + code[:, f]
                gs = np.bincount(key, g, nodes * width).reshape(nodes, width)
                hs = np.bincount(key, h, nodes * width).reshape(nodes, width)
                gl, hl = gs.cumsum(axis=1)[:, :-1], hs.cumsum(axis=1)[:, :-1]
                gt, ht = gs.sum(axis=1, keepdims=True), hs.sum(axis=1, keepdims=True)
                gain = gl**2 / (hl + l2) + (gt - gl) ** 2 / (ht - hl + l2) - gt**2 / (ht + l2)
                gain[(hl < least) | (ht - hl < least)] = -1
                k = gain[:, : len(cuts[f])].argmax(axis=1)
                won = np.flatnonzero(gain[np.arange(nodes), k] > best)
                for n in won.tolist():
                    best[n], choice[n] = gain[n, k[n]], (f, cuts[f][k[n]], int(k[n]))
            where = np.array([c[2] for c in choice])
            feature[nodes - 1 : 2 * nodes - 1] = [c[0] for c in choice]
            cut[nodes - 1 : 2 * nodes - 1] = [c[1] for c in choice]
            at = 2 * at + 1 + (code[np.arange(len(y)), feature[at]] > where[place])
        place = at - (2**depth - 1)
        leaf = -rate * np.bincount(place, g, 2**depth) / (np.bincount(place, h, 2**depth) + l2)
        out.feature.append(feature)
        out.cut.append(cut)
        out.leaf.append(leaf)
        raw += leaf[place]
    return out


def fit_isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of a rising map from scores to probabilities: pooled adjacent violators; each block is level from its least to
    its greatest score, and the map is linear from block to block."""
    order = np.argsort(score, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, weight, least and greatest score
    for s, v in zip(score[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([v, 1.0, s, s])
        while len(blocks) > 1 and (blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1] or blocks[-2][3] == blocks[-1][2]):
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1], blocks[-1][2], last[3]]
    return np.array([s for b in blocks for s in b[2:]]), np.array([b[0] / b[1] for b in blocks for _ in (0, 1)])


def calibrated(raw: np.ndarray, knots: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return np.interp(raw, *knots) if knots[0].size else sigmoid(raw)
