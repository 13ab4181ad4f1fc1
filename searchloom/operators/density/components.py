"""Look-ups over keys that very many rows may share, and connected components by stars."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from searchloom.operators.density.tiles import per_group
from searchloom.session import shuffle_partitions, stage

# A key that all rows share is still dealt out over this many tasks.
SALTS = 16
# Edges of one key, two numbers each, up to which a task follows them to their roots.
TASK_EDGES = 100_000


def look_up(
    rows: DataFrame, keys: Sequence[str], table: DataFrame, how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Join ``table``, which has one row per key, to ``rows``.

    Rows are dealt out by a hash of all their columns beside the keys, and the table is repeated
    for each of the ``salts`` shares, so that no key is one task, whatever its number of rows.
    """
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    share = F.pmod(F.xxhash64(*rows.columns), F.lit(salts)).cast("int")
    return rows.withColumn("_salt", share).join(repeated, [*keys, "_salt"], how).drop("_salt")


def _least(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The least neighbour of each node, or the node itself if that is less."""
    least = rows.groupBy(*keys, "u").agg(F.min("v").alias("m"))
    return least.withColumn("m", F.least("u", "m"))


def _large_star(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every node sends its larger neighbours to the least of its neighbours and itself."""
    both = edges.unionByName(edges.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))
    met = look_up(both.where(F.col("v") > F.col("u")), [*keys, "u"], _least(both, keys))
    return met.select(*keys, F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every node sends its smaller neighbours and itself to the least of them."""
    least = edges.groupBy(*keys, "u").agg(F.min("v").alias("m"))
    met = look_up(edges, [*keys, "u"], least).where(F.col("v") > F.col("m"))
    moved = met.select(*keys, F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select(*keys, "u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, keys: Sequence[str] = ("topic",)) -> DataFrame:
    """``(*keys, node, root)`` for every node of ``edges (*keys, a, b)``; the root is the least node.

    Keys of up to ``TASK_EDGES`` edges are followed within a task, many keys to a task.  Larger ones go by
    alternating large and small stars (Kiveris et al. 2014): each keeps what hangs
    together, and every second one brings all nodes nearer to their root, until only stars are left.
    So no component is ever more than that in one task: minima are combined before the shuffle,
    and looked up over salted keys.
    """
    keys = list(keys)
    edges = edges.where(F.col("a") != F.col("b"))
    state = stage(
        edges.select(*keys, F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "stars"
    )
    counts = stage(state.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "edge-counts")
    fits = F.col("n") <= TASK_EDGES
    totals = counts.agg(
        F.coalesce(F.sum(F.when(fits, F.col("n"))), F.lit(0)).alias("small"), F.count_if(~fits).alias("large")
    ).first()
    if not totals["large"]:
        return _followed(state, keys, totals["small"])
    marked = look_up(state, keys, counts.select(*keys, fits.alias("fits")))
    large = _starred(stage(marked.where("not fits").drop("fits"), "stars"), keys)
    return large.unionByName(_followed(marked.where("fits").drop("fits"), keys, totals["small"]))


def _followed(edges: DataFrame, keys: Sequence[str], total: int) -> DataFrame:
    """The roots of keys whose ``total`` edges ``(*keys, u, v)`` fit one task each."""
    tasks = max(1, min(shuffle_partitions(edges.sparkSession), -(-total // 1000)), -(-total // max(1, TASK_EDGES)))
    schema = pa.schema([*((k, pa.string()) for k in keys), ("node", pa.int64()), ("root", pa.int64())])

    def follow(table: pa.Table) -> pa.RecordBatch:
        ends = np.concatenate([table["u"].to_numpy(), table["v"].to_numpy()])
        nodes, place = np.unique(ends, return_inverse=True)
        parent = list(range(len(nodes)))
        for x, y in zip(place[: len(table)].tolist(), place[len(table) :].tolist()):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            while parent[y] != y:
                parent[y] = parent[parent[y]]
                y = parent[y]
            parent[max(x, y)] = min(x, y)
        # A parent is never greater than its node, so one pass upwards finds all roots.
        for x, up in enumerate(parent):
            parent[x] = parent[up]
        of = [pa.array([table[k][0].as_py()] * len(nodes), pa.string()) for k in keys]
        return pa.record_batch([*of, pa.array(nodes), pa.array(nodes[parent])], schema=schema)

    fields = ", ".join([*(f"{k} string" for k in keys), "node bigint", "root bigint"])
    dealt = edges.repartition(int(tasks), *keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(per_group(list(keys), follow), fields)


def _starred(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The roots of edges ``(*keys, u, v)`` with ``u > v``, by stars."""
    before = None
    while True:
        mark = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*keys, "u", "v"))).first()
        if mark == before:
            break
        before = mark
        large = stage(_large_star(state, keys), "stars")
        state = stage(_small_star(large, keys), "stars")
    roots = state.select(*keys, F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return roots.unionByName(state.select(*keys, F.col("u").alias("node"), F.col("v").alias("root")))
