"""Histogram gradient-boosted trees for a yes/no label, flattened into arrays for vectorised traversal."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """All trees in one set of arrays; a leaf points to itself, so every row may take ``depth`` steps."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def scores(self, features: np.ndarray) -> np.ndarray:
        """The probability of label 1 for every row of ``features``."""
        rows = np.arange(len(features))[:, None]
        node = np.broadcast_to(self.roots, (len(features), len(self.roots)))
        for _ in range(self.depth):
            goes_left = features[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(goes_left, self.left[node], self.right[node])
        return 1.0 / (1.0 + np.exp(-(self.base + self.value[node].sum(axis=1))))


def _bin_edges(column: np.ndarray, bins: int) -> np.ndarray:
    """Upper edges between bins: middles of distinct values while there are few, quantiles otherwise."""
    distinct = np.unique(column)
    if len(distinct) > bins:
        distinct = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1]))
        return distinct
    return (distinct[1:] + distinct[:-1]) / 2


def trained(
    features: np.ndarray, labels: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
    smallest_leaf: int = 10, ridge: float = 1.0,
) -> Trees:
    """Trees fitted to the logistic loss; one leaf with the share of label 1 if nothing can be split.

    Without rows the trees give one half for everything.
    """
    n, width = features.shape
    share = (labels.sum() + 1.0) / (n + 2.0)
    base = float(np.log(share / (1.0 - share)))
    edges = [_bin_edges(features[:, j], bins) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], features[:, j], side="left") for j in range(width)], axis=1) if n else np.zeros((0, width), np.int64)
    raw = np.full(n, base)
    out: dict[str, list] = {name: [] for name in ("feature", "threshold", "left", "right", "value")}
    roots = []

    def leaf(value: float) -> int:
        node = len(out["value"])
        for name, x in (("feature", 0), ("threshold", np.inf), ("left", node), ("right", node), ("value", value)):
            out[name].append(x)
        return node

    for _ in range(rounds if n else 0):
        p = 1.0 / (1.0 + np.exp(-raw))
        gradient, hessian = p - labels, np.maximum(p * (1.0 - p), 1e-9)
        weigh = lambda rows: -rate * float(gradient[rows].sum() / (hessian[rows].sum() + ridge))
        rows = np.arange(n)
        roots.append(leaf(weigh(rows)))
        level = [(roots[-1], rows)]
        for _ in range(depth):
            following = []
            for node, rows in level:
                split = _best_split(binned, gradient, hessian, rows, edges, smallest_leaf, ridge)
                if split is None:
                    continue
                j, cut = split
                goes_left = binned[rows, j] <= cut
                sides = rows[goes_left], rows[~goes_left]
                children = [leaf(weigh(side)) for side in sides]
                out["feature"][node], out["threshold"][node], out["value"][node] = j, float(edges[j][cut]), 0.0
                out["left"][node], out["right"][node] = children
                following += list(zip(children, sides, strict=True))
            if not following:
                break
            level = following
        tree = _flat(out, [roots[-1]], depth, 0.0)
        raw += _raw(tree, features)
    return _flat(out, roots, depth, base)


def _flat(out: dict, roots: list[int], depth: int, base: float) -> Trees:
    return Trees(
        np.array(out["feature"], np.int32), np.array(out["threshold"], float), np.array(out["left"], np.int32),
        np.array(out["right"], np.int32), np.array(out["value"], float), np.array(roots, np.int32), depth, base,
    )


def _raw(tree: Trees, features: np.ndarray) -> np.ndarray:
    node = np.full(len(features), tree.roots[0])
    for _ in range(tree.depth):
        goes_left = features[np.arange(len(features)), tree.feature[node]] <= tree.threshold[node]
        node = np.where(goes_left, tree.left[node], tree.right[node])
    return tree.value[node]


def _best_split(binned, gradient, hessian, rows, edges, smallest_leaf, ridge):
    """The feature and bin whose split lowers the loss most, by histograms; None if none helps."""
    g, h = gradient[rows], hessian[rows]
    whole = g.sum() ** 2 / (h.sum() + ridge)
    best, found = 1e-6, None
    for j, edge in enumerate(edges):
        if not len(edge):
            continue
        own = binned[rows, j]
        size = len(edge) + 1
        gl = np.bincount(own, g, size).cumsum()[:-1]
        hl = np.bincount(own, h, size).cumsum()[:-1]
        nl = np.bincount(own, minlength=size).cumsum()[:-1]
        gain = gl**2 / (hl + ridge) + (g.sum() - gl) ** 2 / (h.sum() - hl + ridge) - whole
        gain[(nl < smallest_leaf) | (len(rows) - nl < smallest_leaf)] = 0.0
        cut = int(gain.argmax())
        if gain[cut] > best:
            best, found = gain[cut], (j, cut)
    return found
