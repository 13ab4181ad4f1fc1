"""Random-indexing vectors of words and word shapes, and their means per document."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from searchloom.llm.blocks import BYTE_VALUES, SMALL_BLOCK_BYTES, Block, blocks, mix, span_hashes

BUCKETS = 4096
DIM = 32
NONZERO = 4
REACH = 2  # neighbouring words to either side
RECENT = 4  # words back in which a repeat is noted

_KIND = np.full(256, 3, np.uint8)  # other signs
_KIND[0x80:] = 1
for _low, _high, _kind in ((0x41, 0x5A, 1), (0x61, 0x7A, 1), (0x30, 0x39, 2), (0x09, 0x0D, 0), (0x20, 0x20, 0)):
    _KIND[_low : _high + 1] = _kind
_UPPER = np.zeros(256, bool)
_UPPER[0x41:0x5B] = True


def index_vectors(buckets: int = BUCKETS, dim: int = DIM, nonzero: int = NONZERO) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the few entries of every bucket's index vector."""
    drawn = np.random.default_rng(11)
    places = np.argsort(drawn.random((buckets, dim)), 1)[:, :nonzero]
    return places, drawn.choice([-1.0, 1.0], (buckets, nonzero))


class Units:
    """The runs of letters, digits and signs of a block, as buckets of their spelling and shape."""

    def __init__(self, block: Block, buckets: int = BUCKETS):
        kind = _KIND[block.data]
        n = len(kind)
        new = np.ones(n, bool)
        new[1:] = kind[1:] != kind[:-1]
        new[block.offsets[block.offsets < n]] = True
        begin = np.flatnonzero(new)
        end = np.append(begin[1:], n)
        solid = kind[begin] > 0 if n else np.zeros(0, bool)
        begin, end = begin[solid], end[solid]
        self.first = np.searchsorted(begin, block.offsets)
        self.row = np.repeat(np.arange(block.rows), np.diff(self.first))
        hashes = span_hashes(BYTE_VALUES[block.data], begin, end)
        upper = np.concatenate([[0], np.cumsum(_UPPER[block.data])])
        capitals = upper[end] - upper[begin]
        size = end - begin
        case = np.where(capitals == 0, 0, np.where(capitals == size, 2, np.where(capitals == 1, 1, 3)))
        case[(size == 1) & (capitals == 1)] = 1
        again = np.zeros(len(begin), bool)
        for back in range(1, RECENT + 1):
            again[back:] |= (hashes[back:] == hashes[:-back]) & (self.row[back:] == self.row[:-back])
        k = kind[begin].astype(np.int64) if n else begin
        shape = ((k * 4 + case) * 2 + again) * 16 + np.minimum(size, 15)
        self.words = (hashes % np.uint64(buckets)).astype(np.int64)
        self.shapes = (mix(shape.astype(np.uint64) + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)


def context_sums(docs: DataFrame, buckets: int = BUCKETS, dim: int = DIM) -> np.ndarray:
    """The sums of the index vectors met around each bucket, over all texts of ``docs``.

    A task emits one row per bucket, which are summed by bucket; the result has
    ``buckets * dim`` numbers whatever the data, and as they are whole numbers it does
    not depend on the order of the sums.
    """
    names = [f"d{i}" for i in range(dim)]

    def count(batches):
        places, signs = index_vectors(buckets, dim)
        sums = np.zeros(buckets * dim)

        def add(at: np.ndarray, met: np.ndarray) -> None:
            for i in range(places.shape[1]):
                index = at * dim + places[met, i]
                sums.__iadd__(np.bincount(index, signs[met, i], len(sums)))

        for batch in batches:
            for block in blocks(batch.column(0), SMALL_BLOCK_BYTES):
                u = Units(block, buckets)
                for back in range(1, REACH + 1):
                    same = np.flatnonzero(u.row[back:] == u.row[:-back])
                    left, right = same, same + back
                    add(u.words[left], u.words[right])
                    add(u.words[right], u.words[left])
                    add(u.shapes[left], u.shapes[right])
                    add(u.shapes[right], u.shapes[left])
                    if back == 1:
                        add(u.words[left], u.shapes[right])
                        add(u.words[right], u.shapes[left])
        table = sums.reshape(buckets, dim)
        used = np.flatnonzero(np.abs(table).sum(1))
        columns = [pa.array(used), *[pa.array(table[used, i]) for i in range(dim)]]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", *names])

    schema = "bucket bigint, " + ", ".join(f"{n} double" for n in names)
    summed = docs.select("text").mapInArrow(count, schema).groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names])
    rows = summed.toArrow()  # a row per bucket at most
    out = np.zeros((buckets, dim))
    out[rows["bucket"].to_numpy()] = np.stack([rows[n].to_numpy() for n in names], 1)
    return out


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Vectors of length one for each bucket: its contexts without what all have in common, then its own index."""
    buckets, dim = sums.shape
    lengths = np.linalg.norm(sums, axis=1, keepdims=True)
    met = lengths[:, 0] > 0
    unit = sums / np.maximum(lengths, 1e-12)
    if met.any():
        unit[met] -= unit[met].mean(0)
    places, signs = index_vectors(buckets, dim)
    own = np.zeros((buckets, dim))
    np.put_along_axis(own, places, signs, 1)
    return np.concatenate([unit, own], 1).astype(np.float32)


def pooled(block: Block, vectors: np.ndarray) -> np.ndarray:
    """The means of a row's word and shape vectors, and the logarithm of its length."""
    u = Units(block, len(vectors))
    counts = np.diff(u.first)
    out = np.zeros((block.rows, 2 * vectors.shape[1] + 1), np.float32)
    filled = np.flatnonzero(counts)
    if len(filled):
        begin = u.first[:-1][filled]
        for i, units in enumerate((u.words, u.shapes)):
            sums = np.add.reduceat(vectors[units], begin, axis=0)
            out[filled, i * vectors.shape[1] : (i + 1) * vectors.shape[1]] = sums / counts[filled, None]
    out[:, -1] = np.log1p(counts)
    return out
