"""Sets of hashes as bitmaps of a fixed size: they may hold more, never less."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from searchloom.llm.tables import text_batches


def collect_bitmap(hashes: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of ``2 ** bits`` bits from a column ``hash``.

    Words of 64 bits are put together on the executors; at most ``2 ** (bits - 6)``
    rows of 16 bytes reach the driver, however many hashes there are.
    """
    bit = F.shiftright(F.col("hash"), 64 - bits).bitwiseAND((1 << bits) - 1)
    words = (
        hashes.select(F.shiftright(bit, 6).alias("word"), bit.bitwiseAND(63).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("mask"))
    )
    rows = words.toArrow()
    bitmap = np.zeros(1 << (bits - 6), np.int64)
    bitmap[rows["word"].to_numpy()] = rows["mask"].to_numpy()
    return bitmap.view(np.uint64)


def bits_set(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bitmap may hold each hash."""
    bits = int(len(bitmap)).bit_length() - 1 + 6
    at = hashes >> np.uint64(64 - bits)
    return (bitmap[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def split_by(rows: DataFrame, mark: Column, bitmap: np.ndarray) -> tuple[DataFrame, DataFrame]:
    """The rows whose mark the bitmap lacks, and those whose mark it may hold."""
    pointer = text_batches(rows).sparkSession.sparkContext.broadcast(bitmap)
    name = f"mark_{uuid.uuid4().hex}"
    marked = rows.select("*", mark.alias(name))

    def part(wanted: bool) -> DataFrame:
        def pick(batches):
            for batch in batches:
                marks = batch.column(batch.num_columns - 1).to_numpy().view(np.uint64)
                chosen = batch.filter(pa.array(bits_set(pointer.value, marks) == wanted))
                yield chosen.select(range(batch.num_columns - 1))

        return marked.mapInArrow(pick, rows.schema)

    return part(False), part(True)
