"""Gradient-boosted trees on small binned features: fitted in numpy, scored in numpy or as a SQL expression."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np


@dataclass
class Node:
    value: float = 0.0
    feature: int = -1
    below: int = 0
    left: "Node | None" = None
    right: "Node | None" = None


@dataclass
class Boosted:
    """Sum of trees; the score is a log-odds."""

    base: float
    trees: list[Node] = field(default_factory=list)

    def log_odds(self, bins: np.ndarray) -> np.ndarray:
        total = np.full(len(bins), self.base)
        for tree in self.trees:
            total += _values(tree, bins)
        return total

    def probability(self, bins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-self.log_odds(bins)))

    def sql(self, names: Sequence[str]) -> str:
        """Log-odds as SQL over the named features."""
        def text(node: Node) -> str:
            if node.feature < 0:
                return f"{node.value:.6f}D"
            return f"IF({names[node.feature]} <= {node.below}, {text(node.left)}, {text(node.right)})"

        return " + ".join([f"{self.base:.6f}D", *map(text, self.trees)])


def _values(node: Node, bins: np.ndarray) -> np.ndarray:
    if node.feature < 0:
        return np.full(len(bins), node.value)
    goes_left = bins[:, node.feature] <= node.below
    out = np.empty(len(bins))
    out[goes_left] = _values(node.left, bins[goes_left])
    out[~goes_left] = _values(node.right, bins[~goes_left])
    return out


def fit(
    bins: np.ndarray,
    labels: np.ndarray,
    weights: np.ndarray,
    trees: int = 30,
    depth: int = 3,
    rate: float = 0.3,
    ridge: float = 1.0,
) -> Boosted:
    """Logistic loss, Newton steps, exact splits over the bins (non-negative small integers)."""
    total = weights.sum()
    share = np.clip((weights * labels).sum() / max(total, 1e-9), 1e-4, 1 - 1e-4) if len(labels) else 0.5
    model = Boosted(float(np.log(share / (1 - share))))
    if not len(labels):
        return model
    scores = np.full(len(labels), model.base)
    for _ in range(trees):
        chance = 1.0 / (1.0 + np.exp(-scores))
        tree = _grow(bins, weights * (labels - chance), weights * chance * (1 - chance) + 1e-9, depth, rate, ridge)
        if tree.feature < 0 and abs(tree.value) < 1e-4:
            break
        model.trees.append(tree)
        scores += _values(tree, bins)
    return model


def _grow(bins: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int, rate: float, ridge: float) -> Node:
    g, h = grad.sum(), hess.sum()
    best, choice = 1e-6, None
    if depth:
        for f in range(bins.shape[1]):
            sums_g, sums_h = np.cumsum(np.bincount(bins[:, f], grad)), np.cumsum(np.bincount(bins[:, f], hess))
            gain = sums_g**2 / (sums_h + ridge) + (g - sums_g) ** 2 / (h - sums_h + ridge) - g * g / (h + ridge)
            at = int(np.argmax(gain[:-1])) if len(gain) > 1 else -1
            if at >= 0 and gain[at] > best:
                best, choice = gain[at], (f, at)
    if choice is None:
        return Node(float(rate * g / (h + ridge)))
    left = bins[:, choice[0]] <= choice[1]
    return Node(
        0.0, choice[0], choice[1],
        _grow(bins[left], grad[left], hess[left], depth - 1, rate, ridge),
        _grow(bins[~left], grad[~left], hess[~left], depth - 1, rate, ridge),
    )


def threshold_for(chances: np.ndarray, labels: np.ndarray, weights: np.ndarray, precision: float) -> float:
    """Least score from which on the weighted precision reaches the wanted one; above every score if none does."""
    order = np.argsort(-chances, kind="stable")
    hits, all_ = np.cumsum((weights * labels)[order]), np.cumsum(weights[order])
    sorted_scores = chances[order]
    last_of_tie = np.append(sorted_scores[1:] != sorted_scores[:-1], True)
    good = np.flatnonzero((hits / np.maximum(all_, 1e-9) >= precision) & last_of_tie)
    return float(sorted_scores[good[-1]]) if len(good) else float(chances.max(initial=1.0) + 1.0)
