"""Classification trees and forests in numpy, for small labelled tables."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def _best_split(x: np.ndarray, y: np.ndarray, features: np.ndarray, least: int) -> tuple[float, int, float]:
    """(Gini impurity after the split, feature, threshold); the middle between two values."""
    best = (np.inf, -1, 0.0)
    n = len(y)
    for f in features.tolist():
        order = np.argsort(x[:, f], kind="stable")
        v, ones = x[order, f], np.cumsum(y[order])
        at = np.flatnonzero(v[1:] > v[:-1]) + 1
        at = at[(at >= least) & (at <= n - least)]
        if not len(at):
            continue
        left, right = ones[at - 1] / at, (ones[-1] - ones[at - 1]) / (n - at)
        impurity = (at * left * (1 - left) + (n - at) * right * (1 - right)) / n
        k = int(impurity.argmin())
        if impurity[k] < best[0] - 1e-12:
            best = (float(impurity[k]), f, float((v[at[k]] + v[at[k] - 1]) / 2))
    return best


@dataclass
class Tree:
    feature: np.ndarray  # -1: leaf
    threshold: np.ndarray
    below: np.ndarray  # child for values <= threshold; the other one comes right after it
    share: np.ndarray  # of label 1

    @classmethod
    def grow(cls, x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 1, tried: int | None = None, random: np.random.Generator | None = None) -> Tree:
        nodes: list[list] = []
        todo = [(np.arange(len(y)), 0, 0)]
        nodes.append([-1, 0.0, -1, float(y.mean())])
        while todo:
            rows, level, at = todo.pop()
            share = float(y[rows].mean())
            nodes[at][3] = share
            if level >= depth or share in (0.0, 1.0) or len(rows) < 2 * least:
                continue
            features = np.arange(x.shape[1])
            if tried and random is not None:
                features = random.choice(x.shape[1], tried, replace=False)
            impurity, f, t = _best_split(x[rows], y[rows], features, least)
            if f < 0 or impurity >= share * (1 - share) - 1e-9:
                continue
            low = x[rows, f] <= t
            nodes[at][:3] = [f, t, len(nodes)]
            todo += [(rows[low], level + 1, len(nodes)), (rows[~low], level + 1, len(nodes) + 1)]
            nodes += [[-1, 0.0, -1, share], [-1, 0.0, -1, share]]
        f, t, b, s = zip(*nodes, strict=True)
        return cls(np.array(f), np.array(t), np.array(b), np.array(s))

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), dtype=np.int64)
        live = np.flatnonzero(self.feature[at] >= 0)
        while len(live):
            node = at[live]
            at[live] = self.below[node] + (x[live, self.feature[node]] > self.threshold[node])
            live = live[self.feature[at[live]] >= 0]
        return self.share[at]


@dataclass
class Forest:
    trees: list[Tree]

    @classmethod
    def grow(cls, x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 10, seed: int = 5) -> Forest:
        random = np.random.default_rng(seed)
        tried = max(1, round(np.sqrt(x.shape[1])))
        out = []
        for _ in range(trees):
            rows = random.integers(0, len(y), len(y))
            out.append(Tree.grow(x[rows], y[rows], depth, 1, tried, random))
        return cls(out)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.mean([t.predict(x) for t in self.trees], axis=0) if len(x) else np.zeros(0)
