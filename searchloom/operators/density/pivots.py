"""Cells around pivots, and which pairs of blocks can hold a nearer neighbour.

Some points of a topic, drawn by hash, are its pivots, and each point belongs to the cell of
the nearest.  Cells are cut into blocks of bounded size.  By the triangle inequality two points of
two blocks are at least as far apart as their pivots, less both radii; if that is more than
any point of the two still needs to reach, the pair is never looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from searchloom.operators.density.components import look_up
from searchloom.operators.density.tiles import distances, matrix, per_group
from searchloom.session import shuffle_partitions, stage

CHUNK_ROWS = 4_000  # points that meet all pivots of their topic at once
TASK_ROWS = 20_000  # points that a task takes, chunk by chunk
LEAST_PIVOTS = 4
# Bounds are loosened by this share of what they are made of, far more than rounding can do.
SLACK = 1e-6

_CELL = "topic string, rid bigint, copies bigint, embedding array<double>, distinct_points bigint, blocks int"


def _near_pivot(table: pa.Table) -> pa.RecordBatch:
    """The pivot nearest to each point of a chunk; the pivots come first."""
    is_pivot = np.asarray(table["pivot"].combine_chunks().to_numpy(zero_copy_only=False), bool)
    pivots, points = table.filter(pa.array(is_pivot)), table.filter(pa.array(~is_pivot)).drop(["pivot", "chunk"])
    names = pivots["rid"].to_numpy()
    if len(points):
        apart = distances(matrix(points["embedding"]), matrix(pivots["embedding"]))
        nearest = apart.argmin(axis=1)
        away = np.sqrt(apart[np.arange(len(apart)), nearest])
    else:
        nearest, away = np.zeros(0, np.int64), np.zeros(0)
    points = points.append_column("cell", pa.array(names[nearest])).append_column("away", pa.array(away))
    return points.combine_chunks().to_batches()[0] if len(points) else pa.RecordBatch.from_pylist([], points.schema)


def pivot_blocks(points: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Points with their block, the blocks' pivots and radii, and the number of block pairs.

    ``points`` is ``(topic, rid, copies, embedding, distinct_points, blocks, first_rid)`` with the wanted
    number of blocks.  Vectors move once; pivots are sent along with every ``CHUNK_ROWS`` points.
    """
    spark = points.sparkSession
    wanted = F.greatest(F.floor(F.col("blocks") / 2), F.lit(LEAST_PIVOTS))
    drawn = F.pmod(F.xxhash64("rid", F.lit("pivot")), F.col("distinct_points")) < wanted
    chunks = F.ceil(F.col("distinct_points") / CHUNK_ROWS).cast("int")
    kept = ["topic", "rid", "copies", "embedding", "distinct_points", "blocks"]
    own = points.select(
        *kept, F.lit(False).alias("pivot"), F.pmod(F.xxhash64("rid", F.lit("chunk")), chunks).cast("int").alias("chunk")
    )
    pivots = stage(points.where(drawn | (F.col("rid") == F.col("first_rid"))), "pivots")
    everywhere = pivots.select(
        *kept, F.lit(True).alias("pivot"), F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk")
    )
    tasks = max(shuffle_partitions(spark), -(-points.count() // TASK_ROWS))
    dealt = everywhere.unionByName(own).repartition(tasks, "topic", "chunk").sortWithinPartitions("topic", "chunk", "rid")
    celled = stage(
        dealt.mapInArrow(per_group(["topic", "chunk"], _near_pivot), f"{_CELL}, cell bigint, away double"), "cells"
    )
    size = celled.groupBy("topic", "cell").agg(
        F.count(F.lit(1)).alias("n"), F.ceil(F.first("distinct_points") / F.first("blocks")).alias("most")
    )
    parts = F.ceil(F.col("n") / F.col("most")).cast("int")
    before = Window.partitionBy("topic").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = stage(
        size.withColumn("parts", parts)
        .withColumn("first", F.coalesce(F.sum("parts").over(before), F.lit(0)).cast("int"))
        .withColumn("total", F.sum("parts").over(Window.partitionBy("topic")).cast("int"))
        .drop("n", "most"),
        "cell-sizes",
    )
    placed = look_up(celled.drop("blocks"), ["topic", "cell"], cells)
    block = F.col("first") + F.pmod(F.xxhash64("rid"), F.col("parts")).cast("int")
    placed = placed.withColumn("block", block).withColumn("blocks", F.col("total")).drop("first", "parts", "total")
    radii = placed.groupBy("topic", "block").agg(F.max("away").alias("radius"), F.first("cell").alias("cell"))
    centres = pivots.select("topic", F.col("rid").alias("cell"), "embedding")
    facts = stage(radii.join(centres, ["topic", "cell"]).drop("cell"), "block-facts")
    topics = cells.groupBy("topic").agg(F.first("total").alias("b"))
    pairs = topics.agg(F.sum(F.col("b") * (F.col("b") + 1) / 2)).first()[0] or 0
    return placed.drop("cell", "away"), facts, int(pairs)


def near_pairs(facts: DataFrame, reach: DataFrame) -> DataFrame:
    """``(topic, i, j, number)``: the pairs ``i < j`` of blocks that may hold a nearer neighbour.

    ``reach`` is ``(topic, block, reach)``, how far off the farthest neighbour is that any point of
    the block would still give up.  A task holds the pivots of a topic's blocks.
    """
    schema = pa.schema([("topic", pa.string()), ("i", pa.int32()), ("j", pa.int32()), ("number", pa.int64())])

    def bound(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        x = matrix(table["embedding"])
        block, radius, reach = (table[c].to_numpy() for c in ("block", "radius", "reach"))
        apart = np.sqrt(distances(x, x, True))
        both = radius[:, None] + radius[None, :]
        least = apart - both - SLACK * (apart + both)
        i, j = np.nonzero(np.triu(least <= np.maximum(reach[:, None], reach[None, :]), 1))
        topic = pa.array([table["topic"][0].as_py()] * len(i), pa.string())
        places = [pa.array(block[x].astype(np.int32)) for x in (i, j)]
        return pa.Table.from_arrays([topic, *places, pa.array(np.arange(len(i)))], schema=schema)

    joined = facts.join(reach, ["topic", "block"])
    return joined.groupBy("topic").applyInArrow(bound, "topic string, i int, j int, number bigint")
