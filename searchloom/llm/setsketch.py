"""SetSketch registers of shingle sets: exponentially spaced, truncated minima.

Every register takes the smallest of independent exponential variables, one per
shingle, and keeps the truncated logarithm of it (Ertl 2021, the variant with
independent registers).  The sketch of a union is the maximum by register, and equal
registers get likelier the more two sets share, so registers can be banded.
"""

from __future__ import annotations

import numpy as np

BASE = 1.02  # ratio of neighbouring register values
RATE = 20.0
TOP = 65534  # values are cut to 0..TOP + 1, 16 bits


def multipliers(m: int) -> np.ndarray:
    """An odd number of 64 bits per register."""
    drawn = np.random.default_rng(42).integers(0, 2**63, m, dtype=np.uint64)
    return drawn * np.uint64(2) + np.uint64(1)


def registers(hashes: np.ndarray, begin: np.ndarray, m: int) -> np.ndarray:
    """Registers ``(sets, m)`` of the sets that begin at ``begin`` in ``hashes``; none is empty."""
    least = np.empty((m, len(begin)), np.uint64)
    step = 1 << 16
    cuts = [0]
    while cuts[-1] < len(begin):  # whole sets, some 64k shingles at a time, stay in cache
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(begin, begin[cuts[-1]] + step))))
    ends = np.append(begin, len(hashes))
    for low, high in zip(cuts, cuts[1:]):
        part = hashes[ends[low] : ends[min(high, len(begin))]]
        at = begin[low:high] - begin[low]
        scratch = np.empty_like(part)
        for i, k in enumerate(multipliers(m)):
            np.multiply(part, k, out=scratch)
            least[i, low:high] = np.minimum.reduceat(scratch, at)
    uniform = (least.T.astype(np.float64) + 0.5) * 2.0**-64
    spaced = np.floor(1.0 - np.log(-np.log1p(-uniform) / RATE) / np.log(BASE))
    return np.clip(spaced, 0, TOP + 1).astype(np.uint16)


def _p(x: np.ndarray) -> np.ndarray:
    """Chance that a register of one set exceeds that of another, from the sets' shares."""
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """The likeliest Jaccard similarity given which registers are larger, smaller and equal.

    ``a`` and ``b`` have one row per pair; sizes are exact.  The likelihood is taken on a
    grid of a two-hundredth and its best point returned.
    """
    above = (a > b).sum(1)[:, None]
    below = (a < b).sum(1)[:, None]
    equal = a.shape[1] - above - below
    total = (size_a + size_b).astype(np.float64)
    u, v = (size_a / total)[:, None], (size_b / total)[:, None]
    j = np.linspace(0, 1, 201)[None, :] * np.minimum(u / v, v / u)
    up, down = _p(np.maximum(u - v * j, 0)), _p(np.maximum(v - u * j, 0))
    tiny = 1e-12
    likely = (
        above * np.log(np.maximum(up, tiny))
        + below * np.log(np.maximum(down, tiny))
        + equal * np.log(np.maximum(1 - up - down, tiny))
    )
    return np.take_along_axis(j, likely.argmax(1)[:, None], 1)[:, 0]


def equal_share(similarity: float, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """The share of registers that two sets of this similarity have equal on average."""
    total = (size_a + size_b).astype(np.float64)
    u, v = size_a / total, size_b / total
    j = np.minimum(similarity, np.minimum(u / v, v / u))
    return 1 - _p(np.maximum(u - v * j, 0)) - _p(np.maximum(v - u * j, 0))
