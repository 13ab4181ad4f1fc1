"""Exact word codes and re-joined words of a block of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from searchloom.llm.blocks import SAME, Block


class Lexicon:
    """The words of a block as codes into a list of its distinct words; no hash decides.

    ``starts`` and ``ends`` are byte spans, ``first`` the first word of each row and of the
    end, ``codes`` the place of each word in ``distinct``, a column of UTF-8 bytes.
    """

    def __init__(self, block: Block, words: np.ndarray, fold: np.ndarray = SAME):
        inside = words[block.data]
        self.starts, self.ends, self.first = block.runs(inside)
        self.counts = np.diff(self.first)
        offsets = np.zeros(len(self.starts) + 1, np.int64)
        np.cumsum(self.ends - self.starts, out=offsets[1:])
        spelt = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(),
            len(self.starts),
            [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(fold[block.data[inside]]))],
        )
        coded = spelt.dictionary_encode()
        self.distinct = coded.dictionary
        self.codes = coded.indices.to_numpy().astype(np.int64)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def joined(block: Block, starts, ends, first, keep: np.ndarray, fold: np.ndarray = SAME) -> tuple[np.ndarray, np.ndarray]:
    """The words to ``keep`` of each row, joined by one space: bytes, and the offsets of the rows.

    The byte behind a word that is not the last kept one of its row is a separator, and
    stands for the space.
    """
    n = len(block.data)
    edges = np.zeros(n + 1, np.int64)
    kept = np.flatnonzero(keep)
    edges[starts[kept]] += 1
    edges[ends[kept]] -= 1  # a word of the next row may start there, in which case they cancel
    chosen = np.cumsum(edges[:-1]) > 0
    row = np.searchsorted(first, kept, "right") - 1
    inner = kept[:-1][row[:-1] == row[1:]] if len(kept) else kept
    out = fold[block.data]
    out[ends[inner]] = 0x20
    chosen[ends[inner]] = True
    before = np.zeros(n + 1, np.int64)
    np.cumsum(chosen, out=before[1:])
    return out[chosen], before[block.offsets]


def text_column(data: np.ndarray, offsets: np.ndarray) -> pa.StringArray:
    """A column of strings from their UTF-8 bytes."""
    return pa.StringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))
    )
