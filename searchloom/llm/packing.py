"""Packing of documents into sequences by best fit and swap-based local search."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from searchloom.llm.blocks import SMALL_BLOCK_BYTES, blocks
from searchloom.llm.tables import id_text, numbered
from searchloom.llm.tokens import tokenizer
from searchloom.session import stage

CAPACITY = 2048
END_ID = 0

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def token_pieces(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The ids of each document and ``end_id``, cut into pieces of ``capacity`` where longer.

    A null or empty text is one piece that holds ``end_id`` alone.
    """

    def cut(batches):
        tokens = tokenizer(path)
        for batch in batches:
            row, start, crc, length = [], [], [], []
            for block in blocks(batch.column(1), SMALL_BLOCK_BYTES):
                for i, ids in enumerate(tokens.encode(block)):
                    ids = np.append(ids, end_id).astype("<u4")
                    for at in range(0, len(ids), capacity):
                        part = ids[at : at + capacity]
                        row.append(block.first + i)
                        start.append(at)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
            start = np.array(start, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array((start // capacity).astype(np.int32)),
                    pa.array(start),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return id_text(docs, id_col, text_col).mapInArrow(cut, PIECES)


class Bins:
    """Open bins, and which documents (by their sizes) lie in them."""

    def __init__(self, sizes: np.ndarray, capacity: int):
        self.sizes, self.capacity = sizes, capacity
        self.bin = np.full(len(sizes), -1, np.int64)
        self.fill = np.zeros(len(sizes), np.int64)
        self.n = 0

    def best_fit(self) -> None:
        """Largest first, each into the fullest bin that takes it."""
        by_space: list[list[int]] = [[] for _ in range(self.capacity + 1)]
        spaces = 0  # bit s is set if a bin has s left
        bins, fills = [0] * len(self.sizes), []
        for doc in np.argsort(-self.sizes, kind="stable").tolist():
            size = int(self.sizes[doc])
            fitting = spaces >> size
            if fitting:
                space = size + (fitting & -fitting).bit_length() - 1
                b = by_space[space].pop()
                if not by_space[space]:
                    spaces &= ~(1 << space)
            else:
                b, space = len(fills), self.capacity
                fills.append(0)
            fills[b] += size
            bins[doc] = b
            left = space - size
            by_space[left].append(b)
            spaces |= 1 << left
        self.bin = np.array(bins, np.int64)
        self.fill = np.array(fills, np.int64)
        self.n = len(fills)

    def least(self) -> int:
        return -(-int(self.sizes.sum()) // self.capacity)

    def _put(self, doc: int, b: int) -> None:
        self.fill[self.bin[doc]] -= self.sizes[doc]
        self.fill[b] += self.sizes[doc]
        self.bin[doc] = b

    def _improve(self, a: int) -> bool:
        """One step that takes as much as possible out of bin ``a`` into a bin at least as full."""
        own = np.flatnonzero(self.bin == a)
        space = self.capacity - self.fill
        space[self.fill < self.fill[a]] = 0
        space[a] = 0
        other = np.flatnonzero(space[self.bin] > 0)
        there, room = self.sizes[other], space[self.bin[other]]
        best, step = 0, None
        for doc in own.tolist():  # move, or exchange one for one
            size = int(self.sizes[doc])
            fits = np.flatnonzero(space >= size)
            if len(fits) and size > best:
                best, step = size, ((doc,), (), int(fits[np.argmin(space[fits])]))
            gain = size - there
            gain[(gain <= 0) | (gain > room)] = 0
            if len(gain) and gain.max() > best:
                i = int(np.argmax(gain))
                best, step = int(gain[i]), ((doc,), (int(other[i]),), int(self.bin[other[i]]))
        distinct, first = np.unique(self.sizes[own], return_index=True)
        if step is None and len(other):  # exchange two for one, sizes being tried once each
            for x in range(len(distinct)):
                for y in range(x, len(distinct)):
                    if x == y:
                        same = own[self.sizes[own] == distinct[x]]
                        if len(same) < 2:
                            continue
                        pair = (int(same[0]), int(same[1]))
                    else:
                        pair = (int(own[first[x]]), int(own[first[y]]))
                    gain = int(distinct[x] + distinct[y]) - there
                    gain[(gain <= 0) | (gain > room)] = 0
                    if gain.max() > best:
                        i = int(np.argmax(gain))
                        best, step = int(gain[i]), (pair, (int(other[i]),), int(self.bin[other[i]]))
        if step is None and len(own):  # exchange one for two of another bin
            step = self._one_for_two(own, other, room)
        if step is None:
            return False
        given, taken, b = step
        for doc in taken:
            self._put(doc, a)
        for doc in given:
            self._put(doc, b)
        return True

    def _one_for_two(self, own, other, room):
        order = np.lexsort((self.sizes[other], self.bin[other]))
        other, room = other[order], room[order]
        of_bin, size = self.bin[other], self.sizes[other]
        # of equal sizes in one bin two do, so that the pairs of a bin number no more than some times its capacity
        third = np.zeros(len(other), bool)
        third[2:] = (of_bin[2:] == of_bin[:-2]) & (size[2:] == size[:-2])
        other, room, of_bin, size = other[~third], room[~third], of_bin[~third], size[~third]
        left, right = [], []
        for apart in range(1, len(other)):
            pairs = np.flatnonzero(of_bin[apart:] == of_bin[:-apart])
            if not len(pairs):
                break
            left.append(pairs)
            right.append(pairs + apart)
        if not left:
            return None
        left, right = np.concatenate(left), np.concatenate(right)
        both, room = size[left] + size[right], room[left]
        for doc in own[np.unique(self.sizes[own], return_index=True)[1]][::-1].tolist():
            gain = self.sizes[doc] - both
            gain[(gain <= 0) | (gain > room)] = 0
            if gain.max() > 0:
                i = int(np.argmax(gain))
                return (doc,), (int(other[left[i]]), int(other[right[i]])), int(of_bin[left[i]])
        return None

    def local_search(self, steps: int | None = None) -> None:
        """Raise the sum of squared fills, the emptiest bins first, until no bin has a step left.

        It ends, as each step raises the sum.  ``steps`` bounds the tries, if it is given.
        """
        stuck = np.zeros(self.n, bool)
        open_bins, moved, tries = self.n, False, 0
        while steps is None or tries < steps:
            tries += 1
            if open_bins <= self.least():
                return
            live = np.flatnonzero((self.fill > 0) & ~stuck)
            if not len(live):
                if not moved:
                    return
                stuck[:], moved = False, False  # what changed may let bins give that could not
                continue
            a = int(live[np.argmin(self.fill[live])])
            if not self._improve(a):
                stuck[a] = True
                continue
            moved = True
            if self.fill[a] == 0:
                open_bins -= 1


def pack(sizes: np.ndarray, capacity: int, steps: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bin, the place in it, and the fill of that bin, for each size."""
    bins = Bins(np.asarray(sizes, np.int64), capacity)
    bins.best_fit()
    bins.local_search(steps)
    order = np.argsort(bins.bin, kind="stable")
    ends = np.cumsum(bins.sizes[order])
    begin = ends - bins.sizes[order]
    of_bin = bins.bin[order]
    first = np.flatnonzero(np.diff(of_bin, prepend=-1))
    offset = np.empty(len(sizes), np.int64)
    offset[order] = begin - np.repeat(begin[first], np.diff(np.append(first, len(order))))
    return bins.bin, offset, bins.fill[bins.bin]


def _packer(capacity: int, base: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row_no", ignore_index=True)
        number, offset, fill = pack(group["length"].to_numpy(), capacity)
        return group.assign(
            sequence_id=(base + group["part"]) * (1 << 24) + number, offset=offset, fill=fill
        )

    return run


def _parts(n: int, per_part: int) -> int:
    return max(1, -(-n // per_part))


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, per_part: int = 8000) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    Pieces are dealt out by a hash of their row number into parts of ``per_part``,
    however many there are, and each part is packed by best fit and then by local
    search until no bin has a step left.  What lies in bins under nine tenths full is
    dealt out and packed once more, so that not every part leaves an open bin.
    ``pieces`` needs a unique ``row_no``.
    """
    columns = [c for c in pieces.columns]
    n = pieces.count()
    parts = _parts(n, per_part)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)
    schema = f"{kinds}, part bigint, sequence_id bigint, offset bigint, fill bigint"

    def packed(rows: DataFrame, into: int, base: int) -> DataFrame:
        dealt = rows.withColumn("part", F.pmod(F.xxhash64("row_no"), F.lit(into)))
        return dealt.groupBy("part").applyInPandas(_packer(capacity, base), schema)

    once = stage(packed(pieces, parts, 0), "packed")
    open_below = capacity * 9 // 10
    rest = once.where(F.col("fill") < open_below).select(*columns)
    again = packed(rest, _parts(rest.count(), per_part), parts)
    wanted = [*columns, "sequence_id", "offset"]
    return once.where(F.col("fill") >= open_below).select(*wanted).unionByName(again.select(*wanted))


def pack_documents(
    docs: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    per_part: int = 8000,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence.

    Rows with equal or null ids are packed each by itself; an empty table gives no
    rows.  Columns other than id and text are not read.  Texts are tokenised once
    and written as lengths and checksums; no ids are shuffled.
    """
    pieces = numbered(token_pieces(docs, path, capacity, end_id, id_col, text_col), "pieces")
    return pack_pieces(pieces, capacity, per_part).drop("row_no")
