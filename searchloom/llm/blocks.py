"""Whole texts as NumPy arrays: words, line and window hashes of Arrow columns.

Texts stay UTF-8 bytes; a block holds whole rows and about a megabyte, so memory
in a task is bounded by the longest single text.  Hashes are 64 bits of a
polynomial over randomly drawn byte values, finished by a bit mixer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
SMALL_BLOCK_BYTES = 1 << 18  # where what is made of a block is a hundred times its size
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0xD6E8FEB86659FD93)
BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def byte_class(spec: str) -> np.ndarray:
    """A table of 256 flags: ``alnum`` (and all beyond ASCII) or ``space``-separated words."""
    table = np.ones(256, bool)
    if spec == "alnum":
        table[:0x80] = False
        for low, high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
            table[low : high + 1] = True
    elif spec == "space":
        table[0x20] = False
        table[0x09:0x0E] = False
    else:
        raise ValueError(f"unknown word class: {spec}")
    return table


LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20
SAME = np.arange(256, dtype=np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64 bits, in place."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base to the power 0..n-1, and the inverse of each."""
    if len(_powers.get("up", ())) < n:
        size = max(n, BLOCK_BYTES + 1)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 2**64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[name] = np.multiply.accumulate(p)
    up, down = _powers["up"][:n], _powers["down"][:n]
    if len(_powers["up"]) > 4 * BLOCK_BYTES:  # a single huge text; do not keep its tables
        _powers.clear()
    return up, down


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the spans ``starts..ends`` of a sequence of random 64-bit values."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    h = (sums[ends] - sums[starts]) * down[starts]
    return mix(h + (ends - starts).astype(np.uint64))


class Block:
    """Some whole rows: ``data`` bytes, ``offsets`` of the rows, ``first`` row number."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int):
        self.data, self.offsets, self.first = data, offsets, first
        self.rows = len(offsets) - 1

    def text(self, row: int) -> bytes:
        return self.data[self.offsets[row] : self.offsets[row + 1]].tobytes()

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of ``inside`` bytes: starts, ends, and the first run of each row."""
        n = len(self.data)
        if n == 0:
            none = np.zeros(0, np.int64)
            return none, none, np.zeros(self.rows + 1, np.int64)
        cut = np.zeros(n + 1, bool)
        cut[self.offsets] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | cut[1:n]
        stops = inside.copy()
        stops[:-1] &= ~inside[1:] | cut[1:n]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)


class Words:
    """The words of a block: byte spans, hashes, and the first word of each row."""

    def __init__(self, block: Block, words: np.ndarray, fold: np.ndarray = SAME):
        self.starts, self.ends, self.first = block.runs(words[block.data])
        self.hashes = span_hashes(BYTE_VALUES[fold[block.data]], self.starts, self.ends)
        self.counts = np.diff(self.first)

    def windows(self, k: int) -> np.ndarray:
        """Hash of the ``k`` words from each word on; those that run over the row's end are void."""
        h = self.hashes
        n = len(h) - k + 1
        if n <= 0:
            return np.zeros(len(h), np.uint64)
        out = np.zeros(len(h), np.uint64)
        acc = out[:n]
        for j in range(k):
            acc *= _STEP
            acc += h[j : j + n]
        mix(acc)
        return out

    def fits(self, k: int) -> np.ndarray:
        """Whether ``k`` words from each word on lie in its row."""
        row_end = np.repeat(self.first[1:], self.counts)
        return np.arange(len(self.hashes)) + k <= row_end


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a column of texts into blocks of whole rows; null counts as empty."""
    column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(column))
        low, high = offsets[row], offsets[end]
        yield Block(data[low:high], offsets[row : end + 1] - low, row)
        row = end


def segments(counts: np.ndarray) -> np.ndarray:
    """Row numbers repeated by their counts."""
    return np.repeat(np.arange(len(counts)), counts)


def ragged(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """A list column of consecutive slices of ``values``."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
