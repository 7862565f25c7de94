"""Gradient boosting of small trees from sums per bin, and a logistic fit, for the operators' own classifiers.

A tree's level needs only the sums of slopes and bends per node, feature and bin, which tasks make of their rows and add up.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

ROUNDS, DEPTH, RATE, CUTS = 40, 3, 0.2, 16
#: Sums of slopes are whole multiples of its inverse.
SCALE = 1 << 24

#: A tree is (feature, cut, value) per node in heap order; a leaf has feature -1.
Trees = tuple[float, list[list[tuple[int, float, float]]]]


def _places(nodes: list[tuple[int, float, float]], features: np.ndarray, depth: int) -> np.ndarray:
    """The node that each row has come to after ``depth`` steps."""
    at = np.zeros(len(features), int)
    feature, cut, _ = (np.array(part) for part in zip(*nodes, strict=True))
    for _ in range(depth):
        inner = feature[at] >= 0
        right = features[np.arange(len(at)), np.maximum(feature[at], 0)] > cut[at]
        at = np.where(inner, 2 * at + 1 + right, at)
    return at


def _values(nodes: list[tuple[int, float, float]], features: np.ndarray) -> np.ndarray:
    return np.array([value for _, _, value in nodes])[_places(nodes, features, DEPTH)]


def _probability(score: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(score, -30, 30)))


def bins_of(features: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Per row and feature the number of cuts below the value."""
    return np.stack([np.searchsorted(cut, column) for cut, column in zip(cuts, features.T, strict=True)], axis=1).astype(np.uint8)


def quantile_cuts(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The cuts of a feature with ascending ``values``, each met ``counts`` times."""
    ends = np.cumsum(counts)
    places = np.floor(np.linspace(0, 1, CUTS) * (ends[-1] - 1)).astype(np.int64)
    return np.unique(values[np.searchsorted(ends, places, side="right")])[:-1]


def level_sums(bins: np.ndarray, counts: np.ndarray, ones: np.ndarray, first: float, trees: list, nodes: list, level: int) -> np.ndarray:
    """Slope, bend and number of rows per node of a level, feature and bin, as whole numbers, so that parts add up alike in any order.

    Row i stands for ``counts[i]`` rows of which ``ones[i]`` have the label 1.
    """
    cells = np.zeros((2**level, bins.shape[1], CUTS, 3), np.int64)
    chance = _probability(first + RATE * sum((_values(own, bins) for own in trees), np.zeros(len(bins))))
    sums = np.stack([
        np.rint((ones - counts * chance) * SCALE).astype(np.int64), np.rint(counts * chance * (1 - chance) * SCALE).astype(np.int64), counts
    ], axis=1)
    at = _places(nodes, bins, level) - (2**level - 1)
    inside = at >= 0
    for feature in range(bins.shape[1]):
        np.add.at(cells[:, feature], (at[inside], bins[inside, feature]), sums[inside])
    return cells


def boost(sums: Callable[[float, list, list, int], np.ndarray], cuts: list[np.ndarray], share: float, rounds: int = ROUNDS) -> Trees:
    """Trees for the log-odds of labels of which ``share`` are 1, from ``level_sums`` over all rows: ``sums(first, trees, nodes, level)``."""
    share = float(np.clip(share, 1e-3, 1 - 1e-3))
    first, trees = float(np.log(share / (1 - share))), []
    allowed = np.arange(CUTS)[None, :] < np.array([len(cut) for cut in cuts])[:, None]
    for _ in range(rounds):
        nodes: list[tuple[int, float, float]] = [(-1, 0.0, 0.0)] * (2 ** (DEPTH + 1) - 1)
        for level in range(DEPTH):
            cells = sums(first, trees, nodes, level)
            for place in range(2**level):
                node, whole = 2**level - 1 + place, cells[place, 0].sum(axis=0)
                if not whole[2]:
                    continue
                left = np.cumsum(cells[place], axis=1)
                split = allowed & (left[..., 2] > 0) & (left[..., 2] < whole[2])
                one, one_weight = left[..., 0] / SCALE, left[..., 1] / SCALE + 1.0
                total, weight = whole[0] / SCALE, whole[1] / SCALE + 1.0
                gain = np.where(split, one**2 / one_weight + (total - one) ** 2 / (weight - one_weight + 1.0) - total**2 / weight, 0.0)
                feature, cut = np.unravel_index(np.argmax(gain), gain.shape)
                if gain[feature, cut] <= 1e-6:
                    nodes[node] = (-1, 0.0, total / weight)
                    continue
                nodes[node] = (int(feature), float(cut), 0.0)
                one, one_weight = one[feature, cut], one_weight[feature, cut]
                nodes[2 * node + 1], nodes[2 * node + 2] = (-1, 0.0, one / one_weight), (-1, 0.0, (total - one) / (weight - one_weight + 1.0))
        trees.append(nodes)
        if nodes[0][0] < 0:
            break  # no cut helps, nor will it in the next round
    return first, in_values(trees, cuts)


def in_values(trees: list, cuts: list[np.ndarray]) -> list:
    """Trees over bins as trees over the values that were cut."""
    return [[(feature, float(cuts[feature][int(cut)]) if feature >= 0 else 0.0, value) for feature, cut, value in nodes] for nodes in trees]


def fit_trees(features: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS) -> Trees:
    """Trees for the log-odds of ``labels`` (0 or 1)."""
    cuts = [quantile_cuts(*np.unique(column, return_counts=True)) for column in features.T]
    bins, counts = bins_of(features, cuts), np.ones(len(labels), np.int64)
    return boost(lambda *tree: level_sums(bins, counts, labels, *tree), cuts, labels.mean(), rounds)


def score_trees(model: Trees, features: np.ndarray) -> np.ndarray:
    first, trees = model
    return _probability(first + RATE * sum((_values(nodes, features) for nodes in trees), np.zeros(len(features))))


def precision_threshold(scores: np.ndarray, labels: np.ndarray, precision: float, counts: np.ndarray | None = None) -> float | None:
    """The lowest threshold from which at least ``precision`` of the rows above are 1, if one exists.

    With ``counts`` an entry stands for so many rows, and its label is the number of those that are 1.
    """
    order = np.argsort(-scores, kind="stable")
    right = np.cumsum(labels[order]) / np.cumsum(np.ones(len(order)) if counts is None else counts[order])
    ends = np.flatnonzero(np.append(np.diff(scores[order]) != 0, True))
    good = [end for end in ends if right[end] >= precision]
    # A little lower: sums of the same leaves may differ in the last bit.
    return float(scores[order][good[-1]]) - 1e-9 if good else None


def fit_logistic(features: np.ndarray, labels: np.ndarray, decay: float = 1e-3, steps: int = 30) -> np.ndarray:
    """Weights, the constant last, by Newton's method with a small ridge."""
    design = np.column_stack([features, np.ones(len(features))])
    weights = np.zeros(design.shape[1])
    ridge = decay * len(labels) * np.eye(len(weights))
    ridge[-1, -1] = 1e-9
    for _ in range(steps):
        chance = _probability(design @ weights)
        slope = design.T @ (labels - chance) - ridge @ weights
        bend = (design * (chance * (1 - chance) + 1e-9)[:, None]).T @ design + ridge
        weights = weights + np.linalg.solve(bend, slope)
    return weights


def score_logistic(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    return _probability(np.column_stack([features, np.ones(len(features))]) @ weights)
