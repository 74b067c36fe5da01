"""Gradient-boosted trees for two classes on a small sample, as Spark expressions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Split:
    feature: int
    threshold: float
    low: Split | float  # where the feature is at most the threshold
    high: Split | float


@dataclass(frozen=True)
class Trees:
    names: tuple[str, ...]
    base: float
    trees: tuple[Split | float, ...]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + sum((_apply(t, x) for t in self.trees), np.zeros(len(x)))

    def expression(self, value: Callable[[str], Column]) -> Column:
        """The margin as nested conditions over the columns that ``value`` gives."""
        def of(node: Split | float) -> Column:
            if not isinstance(node, Split):
                return F.lit(float(node))
            return F.when(value(self.names[node.feature]) <= node.threshold, of(node.low)).otherwise(of(node.high))

        out = F.lit(float(self.base))
        for tree in self.trees:
            out = out + of(tree)
        return out


def _apply(node: Split | float, x: np.ndarray) -> np.ndarray:
    if not isinstance(node, Split):
        return np.full(len(x), float(node))
    return np.where(x[:, node.feature] <= node.threshold, _apply(node.low, x), _apply(node.high, x))


def _tree(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int, rate: float) -> Split | float:
    """Newton steps: the split with the largest gain, down to ``depth``."""
    def score(g: float, h: float) -> float:
        return g * g / (h + 1.0)

    g, h = grad[rows].sum(), hess[rows].sum()
    leaf = float(rate * g / (h + 1.0))
    if depth == 0 or len(rows) < 8:
        return leaf
    best, gain = None, 1e-6
    for j in range(x.shape[1]):
        v = x[rows, j]
        cuts = np.unique(np.quantile(v, np.linspace(0, 1, 33)))
        for t in (cuts[1:] + cuts[:-1]) / 2:
            low = v <= t
            gl, hl = grad[rows[low]].sum(), hess[rows[low]].sum()
            now = score(gl, hl) + score(g - gl, h - hl) - score(g, h)
            if now > gain:
                best, gain = (j, float(t)), now
    if best is None:
        return leaf
    low = x[rows, best[0]] <= best[1]
    return Split(*best, _tree(x, grad, hess, rows[low], depth - 1, rate), _tree(x, grad, hess, rows[~low], depth - 1, rate))


def fit(x: np.ndarray, y: np.ndarray, names: tuple[str, ...], *, rounds: int = 16, depth: int = 3,
        rate: float = 0.4) -> Trees:
    share = min(max(y.mean(), 1e-3), 1 - 1e-3)
    model = Trees(names, float(np.log(share / (1 - share))), ())
    margin = np.full(len(x), model.base)
    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = _tree(x, y - p, p * (1 - p), np.arange(len(x)), depth, rate)
        margin = margin + _apply(tree, x)
        trees.append(tree)
    return Trees(names, model.base, tuple(trees))


def threshold(margin: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The lowest margin from which on held-out rows are right with this precision; infinite
    if there is none."""
    order = np.argsort(-margin, kind="stable")
    m, hits = margin[order], np.cumsum(y[order])
    right = hits / np.arange(1, len(m) + 1)
    last = np.append(m[1:] != m[:-1], True)  # rows with one margin are taken together
    fine = np.flatnonzero((right >= precision) & last)
    if not len(fine):
        return float("inf")
    at = fine[-1]
    # Between two seen margins the middle is the least arbitrary cut.
    return float(m[at] if at + 1 == len(m) else (m[at] + m[at + 1]) / 2)
