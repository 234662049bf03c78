"""Small gradient-boosted trees: fitted with numpy on a bounded sample, scored as a plain SQL expression."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, least: float = 2.0, l2: float = 1.0) -> tuple[float, list]:
    """Trees for the logistic loss: (bias, trees); a tree is a leaf value or (feature, cut, left, right)."""
    mean = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    bias = float(np.log(mean / (1 - mean)))
    score = np.full(len(y), bias)
    cuts = [np.unique((u[1:] + u[:-1]) / 2) if len(u := np.unique(x[:, j])) <= 64 else np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, 48))) for j in range(x.shape[1])]

    def grow(rows: np.ndarray, level: int, grad: np.ndarray, hess: np.ndarray):
        g, h = grad[rows].sum(), hess[rows].sum()
        best = (1e-6, None)
        if level < depth:
            for j, marks in enumerate(cuts):
                v = x[rows, j]
                for c in marks:
                    left = v <= c
                    gl, hl = grad[rows][left].sum(), hess[rows][left].sum()
                    if hl < least / 10 or h - hl < least / 10:
                        continue
                    gain = gl * gl / (hl + l2) + (g - gl) ** 2 / (h - hl + l2) - g * g / (h + l2)
                    if gain > best[0]:
                        best = (gain, (j, float(c), left))
        if best[1] is None:
            return round(float(-rate * g / (h + l2)), 6)
        j, c, left = best[1]
        return (j, c, grow(rows[left], level + 1, grad, hess), grow(rows[~left], level + 1, grad, hess))

    trees = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        tree = grow(np.arange(len(y)), 0, p - y, p * (1 - p))
        trees.append(tree)
        score += predict_tree(tree, x)
    return round(bias, 6), trees


def predict_tree(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    j, c, left, right = tree
    return np.where(x[:, j] <= c, predict_tree(left, x), predict_tree(right, x))


def predict(model: tuple[float, list], x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-(model[0] + sum(predict_tree(t, x) for t in model[1]))))


def threshold_for(scores: np.ndarray, y: np.ndarray, precision: float, odds: float = 1.0) -> float:
    """Least score of a true row from which on the share of true rows is at least ``precision`` on held-out rows,
    where false rows count ``odds`` times; 1 if there is none."""
    order = np.lexsort((y, -scores))  # of equal scores false rows first
    true, false = np.cumsum(y[order]), np.cumsum(1 - y[order])
    good = np.flatnonzero((true >= precision * (true + odds * false)) & (y[order] > 0))
    return float(scores[order][good[-1]]) if len(good) else 1.0


def score_column(model: tuple[float, list], features: Column) -> Column:
    """The model's logit as CASE expressions over an array column of features."""

    def walk(tree) -> Column:
        if not isinstance(tree, tuple):
            return F.lit(tree)
        j, c, left, right = tree
        return F.when(F.get(features, F.lit(j)) <= c, walk(left)).otherwise(walk(right))

    total = F.lit(model[0])
    for t in model[1]:
        total = total + walk(t)
    return total
