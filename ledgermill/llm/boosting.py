"""Gradient-boosted trees for a bounded table of examples: logistic loss, quantile bins, small depth."""
from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

BINS = 32


@dataclass
class Boosted:
    """Trees as arrays over a complete binary tree of the given depth, and a linear calibration of their sum."""
    edges: list[np.ndarray]
    depth: int
    start: float
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        binned = np.column_stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)])
        total = np.full(len(x), self.start)
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (binned[np.arange(len(x)), feature[node]] > cut[node])
            total += value[node - (2 ** self.depth - 1)]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -30, 30)))

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Slope and shift of the margin by logistic regression on examples the trees have not seen."""
        m = np.column_stack([self.margin(x), np.ones(len(x))])
        w = np.array([1.0, 0.0])
        for _ in range(20):
            p = 1 / (1 + np.exp(-np.clip(m @ w, -30, 30)))
            grad = m.T @ (y - p) - 0.1 * (w - [1, 0])
            w = w + np.linalg.solve((m * (p * (1 - p))[:, None]).T @ m + 0.1 * np.eye(2), grad)
        self.slope, self.shift = max(float(w[0]), 1e-3), float(w[1])


def boost(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> Boosted:
    """Trees fitted to 0/1 labels, each to the gradient the earlier ones leave."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))
             for f in range(x.shape[1])]
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    model = Boosted(edges, depth, float(np.log(share / (1 - share))))
    binned = np.column_stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)])
    total = np.full(len(x), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        g, h = y - p, p * (1 - p)
        inner = 2 ** depth - 1
        feature, cut = np.zeros(inner, np.int64), np.full(inner, BINS + 1)
        node = np.zeros(len(x), np.int64)
        for n in range(inner):
            rows = np.flatnonzero(node == n)
            best = 1e-6
            for f in range(x.shape[1]) if len(rows) else ():
                b = binned[rows, f]
                gs, hs = (np.cumsum(np.bincount(b, v[rows], BINS + 1)) for v in (g, h))
                gain = (gs ** 2 / (hs + ridge) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + ridge) - gs[-1] ** 2 / (hs[-1] + ridge))
                k = int(np.argmax(gain[:-1]))
                if gain[k] > best:
                    best, feature[n], cut[n] = gain[k], f, k
            node[rows] = 2 * n + 1 + (binned[rows, feature[n]] > cut[n])
        leaf = node - inner
        value = np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge) * rate
        model.trees.append((feature, cut, value))
        total += value[leaf]
    return model
