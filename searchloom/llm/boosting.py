"""Gradient-boosted trees in NumPy: histogram splits, monotone features, flat nodes."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Forest:
    """Trees as arrays: node ``i`` asks ``x[feature[i]] <= threshold[i]``; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities; all rows and trees go down one level at a time."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            below = x[rows, self.feature[at]] <= self.threshold[at]
            at = np.where(below, self.left[at], self.right[at])
        return 1.0 / (1.0 + np.exp(-(self.base + self.value[at].sum(1))))


class _Grower:
    """One tree; ``signs`` are +1, -1 or 0 for rising, falling and free features."""

    def __init__(self, codes, edges, signs, depth, least, ridge):
        self.codes, self.edges, self.signs = codes, edges, signs
        self.depth, self.least, self.ridge = depth, least, ridge
        self.nodes: list[list] = []

    def _split(self, rows, g, h, low, high):
        """The best feature and bin whose leaf values keep the order that a sign asks for."""
        best = (1e-9, None)
        total_g, total_h = g[rows].sum(), h[rows].sum()
        whole = total_g**2 / (total_h + self.ridge)
        for f, cuts in enumerate(self.edges):
            n = len(cuts) + 1
            code = self.codes[rows, f]
            gs = np.cumsum(np.bincount(code, g[rows], n))[:-1]
            hs = np.cumsum(np.bincount(code, h[rows], n))[:-1]
            ns = np.cumsum(np.bincount(code, minlength=n))[:-1]
            left = np.clip(-gs / (hs + self.ridge), low, high)
            right = np.clip(-(total_g - gs) / (total_h - hs + self.ridge), low, high)
            gain = gs**2 / (hs + self.ridge) + (total_g - gs) ** 2 / (total_h - hs + self.ridge) - whole
            fine = (ns >= self.least) & (len(rows) - ns >= self.least)
            fine &= (right - left) * self.signs[f] >= 0
            gain = np.where(fine, gain, -1.0)
            if len(gain) and gain.max() > best[0]:
                cut = int(gain.argmax())
                best = (float(gain[cut]), (f, cut, float(left[cut]), float(right[cut])))
        return best[1]

    def grow(self, rows, g, h, level=0, low=-np.inf, high=np.inf) -> int:
        me = len(self.nodes)
        value = float(np.clip(-g[rows].sum() / (h[rows].sum() + self.ridge), low, high))
        self.nodes.append([0, np.inf, me, me, value])
        found = self._split(rows, g, h, low, high) if level < self.depth else None
        if found is None:
            return me
        f, cut, left_value, right_value = found
        goes_left = self.codes[rows, f] <= cut
        middle = (left_value + right_value) / 2
        bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high),) * 2}
        left_bound, right_bound = bounds[int(self.signs[f])]
        left = self.grow(rows[goes_left], g, h, level + 1, *left_bound)
        right = self.grow(rows[~goes_left], g, h, level + 1, *right_bound)
        self.nodes[me] = [f, float(self.edges[f][cut]), left, right, 0.0]
        return me


def fit_forest(
    x: np.ndarray,
    y: np.ndarray,
    signs: np.ndarray,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.2,
    bins: int = 64,
    least: int = 10,
    ridge: float = 1.0,
) -> Forest:
    """Fit logistic loss by second-order boosting.

    The score does not fall where a feature of sign +1 rises (and does not rise for -1):
    splits that would break the order are refused, and the subtrees of such a split are
    held to either side of its middle.  With one class only, every row gets its share.
    """
    share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    edges = []
    for column in x.T:
        cuts = np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) if len(column) else column
        edges.append(cuts[cuts < column.max()] if len(column) else cuts)
    codes = np.stack([np.searchsorted(e, c, "left") for e, c in zip(edges, x.T)], 1) if len(x) else x.astype(int)
    raw = np.full(len(x), base)
    nodes: list[list] = []
    roots = []
    for _ in range(trees if len(np.unique(y)) > 1 else 0):
        p = 1 / (1 + np.exp(-raw))
        grower = _Grower(codes, edges, signs, depth, least, ridge)
        grower.grow(np.arange(len(x)), p - y, p * (1 - p))
        shift = len(nodes)
        tree = [[f, t, l + shift, r + shift, v * rate] for f, t, l, r, v in grower.nodes]
        roots.append(shift)
        nodes += tree
        one = _arrays(tree, [0], depth, 0.0, -shift)
        raw += one.value[_leaf(one, x)]
    if not roots:
        nodes, roots = [[0, np.inf, 0, 0, 0.0]], [0]
    return _arrays(nodes, roots, depth, base, 0)


def _arrays(nodes: list[list], roots: list[int], depth: int, base: float, shift: int) -> Forest:
    feature, threshold, left, right, value = (np.array(c) for c in zip(*nodes))
    return Forest(
        feature.astype(np.int64),
        threshold.astype(float),
        left.astype(np.int64) + shift,
        right.astype(np.int64) + shift,
        value.astype(float),
        np.array(roots, np.int64),
        depth,
        base,
    )


def _leaf(tree: Forest, x: np.ndarray) -> np.ndarray:
    at = np.zeros(len(x), np.int64)
    rows = np.arange(len(x))
    for _ in range(tree.depth):
        below = x[rows, tree.feature[at]] <= tree.threshold[at]
        at = np.where(below, tree.left[at], tree.right[at])
    return at
