"""Connected components by contraction, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from searchloom.session import stage

SALTS = 16


def _look_up(rows: DataFrame, key: str, table: DataFrame, value: str) -> DataFrame:
    """Join ``value`` of ``table (node, value)`` to ``rows`` on ``key``, which may be hot.

    A key is dealt out over ``SALTS`` keys; ``table`` has one row per node.
    """
    salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (
        rows.withColumn("salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
        .join(salted.select(F.col("node").alias(key), "salt", value), [key, "salt"], "left")
        .drop("salt")
    )


def _flatten(parents: DataFrame) -> DataFrame:
    """Follow ``node -> parent`` to the root; every step halves the way."""
    while True:
        above = parents.select("node", F.col("parent").alias("grand"))
        jumped = stage(
            _look_up(parents, "parent", above, "grand").select(
                "node", F.coalesce("grand", "parent").alias("next"), "parent"
            ),
            "parents",
        )
        moved = jumped.where(F.col("next") != F.col("parent")).limit(1).count()
        parents = jumped.select("node", F.col("next").alias("parent"))
        if not moved:
            return parents


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; the root is one node of its component.

    Each round hangs every node on its least neighbour, if that is smaller, follows
    these links to their roots and draws the edges between roots anew.  Edges inside
    what has grown together vanish, so a star of any size is done after one round.
    """
    edges = stage(edges.where(F.col("a") != F.col("b")).distinct(), "edges")
    nodes = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
        roots = _flatten(least.select("node", F.least("node", "least").alias("parent")))
        if nodes is None:
            nodes = roots.withColumnRenamed("parent", "root")
        else:
            table = roots.withColumnRenamed("parent", "up")
            nodes = _look_up(nodes, "root", table, "up").select("node", F.coalesce("up", "root").alias("root"))
            nodes = stage(nodes, "roots")
        left = _look_up(edges, "a", roots, "parent").select(F.col("parent").alias("a"), "b")
        right = _look_up(left, "b", roots, "parent").select("a", F.col("parent").alias("b"))
        edges = stage(right.where(F.col("a") != F.col("b")).distinct(), "edges")
        if edges.limit(1).count() == 0:
            return nodes
