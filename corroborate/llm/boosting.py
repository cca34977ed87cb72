"""Gradient-boosted trees on binned features, small enough to fit on a bounded sample and to ship with a task."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Boosted:
    edges: list[np.ndarray]
    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)  # feature, bin, value by heap position
    platt: tuple[float, float] = (1.0, 0.0)
    threshold: float = 0.5

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="right") for j, e in enumerate(self.edges)], axis=1)

    def margin(self, x: np.ndarray) -> np.ndarray:
        b = self._binned(x)
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            at = np.zeros(len(x), dtype=np.int64)
            while (on := feature[at] >= 0).any():
                go = b[rows[on], feature[at[on]]] > cut[at[on]]
                at[on] = 2 * at[on] + 1 + go
            out += value[at]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        a, c = self.platt
        return 1 / (1 + np.exp(-np.clip(a * self.margin(x) + c, -30, 30)))


def _tree(b: np.ndarray, g: np.ndarray, h: np.ndarray, n_bins: int, depth: int, rate: float, l2: float = 1.0):
    size = 2 ** (depth + 1) - 1
    feature, cut, value = np.full(size, -1), np.zeros(size, dtype=np.int64), np.zeros(size)
    members = {0: np.arange(len(g))}
    for node in range(size):
        rows = members.pop(node, None)
        if rows is None:
            continue
        gs, hs = g[rows].sum(), h[rows].sum()
        value[node] = -rate * gs / (hs + l2)
        if 2 * node + 2 >= size or len(rows) < 8:
            continue
        best = (1e-6, -1, 0)
        for j in range(b.shape[1]):
            gj = np.cumsum(np.bincount(b[rows, j], weights=g[rows], minlength=n_bins))[:-1]
            hj = np.cumsum(np.bincount(b[rows, j], weights=h[rows], minlength=n_bins))[:-1]
            gain = gj**2 / (hj + l2) + (gs - gj) ** 2 / (hs - hj + l2) - gs**2 / (hs + l2)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), j, k)
        if best[1] >= 0:
            feature[node], cut[node] = best[1], best[2]
            right = b[rows, best[1]] > best[2]
            members[2 * node + 1], members[2 * node + 2] = rows[~right], rows[right]
    return feature, cut, value


def _fit(x: np.ndarray, y: np.ndarray, rounds: int, depth: int, rate: float) -> Boosted:
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, 33)[1:-1])) - 1e-9 for j in range(x.shape[1])]
    share = float(np.clip(y.mean(), 1e-4, 1 - 1e-4))
    m = Boosted(edges, float(np.log(share / (1 - share))))
    b = m._binned(x)
    f = np.full(len(y), m.base)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-f))
        m.trees.append(_tree(b, p - y, p * (1 - p), 34, depth, rate))
        feature, cut, value = m.trees[-1]
        at = np.zeros(len(y), dtype=np.int64)
        while (on := feature[at] >= 0).any():
            at[on] = 2 * at[on] + 1 + (b[on, feature[at[on]]] > cut[at[on]])
        f += value[at]
    return m


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.2, precision: float = 0.98, folds: int = 3) -> Boosted | None:
    """Trees, a Platt scale and the least threshold (0.5 at least) of that precision, both found out of fold; None for one class."""
    if len(y) < 10 or y.min() == y.max():
        return None
    fold = np.arange(len(y)) % folds
    out = np.zeros(len(y))
    for f in range(folds):
        train = fold != f
        out[~train] = _fit(x[train], y[train], rounds // 2, depth, rate).margin(x[~train])
    m = _fit(x, y, rounds, depth, rate)
    a, c = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(a * out + c, -30, 30)))
        a, c = a - 0.05 * ((p - y) * out).mean() - 1e-4 * (a - 1), c - 0.2 * (p - y).mean()
    m.platt = (float(a), float(c))
    p = 1 / (1 + np.exp(-np.clip(a * out + c, -30, 30)))
    grid = [t for t in np.linspace(0.5, 0.99, 50) if (p >= t).any() and y[p >= t].mean() >= precision]
    m.threshold = float(grid[0]) if grid else 0.995
    return m
