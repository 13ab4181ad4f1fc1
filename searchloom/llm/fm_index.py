"""A compressed index of sequences of numbers: backward search over a wavelet matrix.

Suffixes are sorted by their first symbols only, as many as a search can be long, which
is all that backward search of patterns up to that length needs.  The transform is kept
as one bit per symbol and level, with counts for every 64 bits.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Ranks in a sequence of symbols from 0 to ``size - 1``, many at a time."""

    def __init__(self, symbols: np.ndarray, size: int):
        self.levels = max(1, int(size - 1).bit_length())
        self.words, self.counts, self.zeros = [], [], []
        current = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = (current >> level) & 1
            padded = np.zeros((len(bit) // 64 + 1) * 64, np.uint8)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(words)
            self.counts.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]).astype(np.int32))
            self.zeros.append(int(len(bit) - bit.sum()))
            current = np.concatenate([current[bit == 0], current[bit == 1]])
        start = np.zeros(size, np.int64)
        self.start = self._follow(np.arange(size), start)

    def _follow(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level in range(self.levels):
            word = at >> 6
            mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.counts[level][word] + np.bitwise_count(self.words[level][word] & mask)
            bit = (symbol >> (self.levels - 1 - level)) & 1
            at = np.where(bit == 1, self.zeros[level] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each place."""
        return self._follow(symbol, at) - self.start[symbol]


class FMIndex:
    """An index over ``symbols`` (1 and up; 0 ends a sequence) for patterns of up to ``longest`` symbols."""

    def __init__(self, symbols: np.ndarray, longest: int):
        self.symbols, self.longest = symbols, longest
        n, size = len(symbols), int(symbols.max()) + 1 if len(symbols) else 1
        rank, reach = symbols.astype(np.int64), 1
        while reach < longest:
            after = np.zeros(n, np.int64)
            after[: n - reach] = rank[reach:] + 1
            rank = np.unique(rank * (after.max() + 1) + after if n else rank, return_inverse=True)[1]
            reach *= 2
        self.suffixes = np.argsort(rank, kind="stable")
        self.before = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=size))])
        self.matrix = WaveletMatrix(symbols[self.suffixes - 1], size)
        self.size = size

    def matching(self, stream: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Matching statistics of a stream at ``ends``.

        For each end the length, up to ``longest``, of the longest stretch that ends with
        it and occurs in the index, and the range of suffixes that begin with it.  Symbols
        of the stream that the index lacks, and 0, match nothing.
        """
        length = np.zeros(len(ends), np.int64)
        low = np.zeros(len(ends), np.int64)
        high = np.full(len(ends), len(self.symbols), np.int64)
        live = np.arange(len(ends))
        for step in range(self.longest):
            at = ends[live] - step
            symbol = np.where(at >= 0, stream[np.maximum(at, 0)], 0)
            known = (symbol > 0) & (symbol < self.size)
            live, symbol = live[known], symbol[known]
            if not len(live):
                break
            new_low, new_high = self.before[symbol], self.before[symbol + 1]
            if step:
                new_low, new_high = (
                    new_low + self.matrix.rank(symbol, edge[live]) for edge in (low, high)
                )
            found = new_low < new_high
            live = live[found]
            low[live], high[live] = new_low[found], new_high[found]
            length[live] = step + 1
        return length, low, high

    def least(self, values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least of ``values`` (one per place) over each range of suffixes; equal or disjoint ranges."""
        by_suffix = np.append(values[self.suffixes], np.iinfo(np.int64).max)
        begin, first, back = np.unique(low, return_index=True, return_inverse=True)
        edges = np.stack([begin, high[first]], 1).ravel()
        return np.minimum.reduceat(by_suffix, edges)[::2][back] if len(begin) else np.zeros(0, np.int64)
