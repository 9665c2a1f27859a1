"""Gradient-boosted trees over small integer features, fitted to counts and turned into SQL."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Tree:
    """A leaf if ``feature`` is empty; else rows with ``feature <= at`` go to ``low``."""

    value: float = 0.0
    feature: str = ""
    at: int = 0
    low: Tree | None = None
    high: Tree | None = None

    def column(self, row: Column) -> Column:
        if not self.feature:
            return F.lit(self.value)
        return F.when(row[self.feature] <= self.at, self.low.column(row)).otherwise(self.high.column(row))

    def score(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        if not self.feature:
            return np.full(len(x), self.value)
        low = x[:, names.index(self.feature)] <= self.at
        return np.where(low, self.low.score(x, names), self.high.score(x, names))


def _grow(x: np.ndarray, names: list[str], slope: np.ndarray, curve: np.ndarray, depth: int, rate: float, ridge: float) -> Tree:
    """Newton step in the leaves; splits by gain, the first of equal ones."""
    g, h = slope.sum(), curve.sum()
    best = (1e-6, None, None)
    for k in range(x.shape[1]) if depth else ():
        for at in np.unique(x[:, k])[:-1]:
            low = x[:, k] <= at
            gl, hl = slope[low].sum(), curve[low].sum()
            gain = gl**2 / (hl + ridge) + (g - gl) ** 2 / (h - hl + ridge) - g**2 / (h + ridge)
            if gain > best[0] + 1e-9:
                best = (gain, k, int(at))
    _, k, at = best
    if k is None:
        return Tree(value=float(-rate * g / (h + ridge)))
    low = x[:, k] <= at
    parts = (_grow(x[m], names, slope[m], curve[m], depth - 1, rate, ridge) for m in (low, ~low))
    return Tree(0.0, names[k], at, *parts)


def boost(
    x: np.ndarray, ones: np.ndarray, zeros: np.ndarray, names: list[str],
    rounds: int = 20, depth: int = 3, rate: float = 0.4, ridge: float = 1.0,
) -> list[Tree]:
    """Trees whose sum is the log odds of label 1; a row of ``x`` stands for ``ones`` and ``zeros`` cases."""
    trees: list[Tree] = []
    z, total = np.zeros(len(x)), ones + zeros
    for _ in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-z))
        trees.append(_grow(x, names, total * p - ones, total * p * (1 - p), depth, rate, ridge))
        z = z + trees[-1].score(x, names)
    return trees
