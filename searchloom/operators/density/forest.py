"""Forests held as edge tables: contraction, thinning, and the leaves of condensed trees.

Edges carry ``(topic, a, b, weight, distance)`` and are compared by
``(weight, distance, a, b)``.  Every step is an aggregation that is combined before its shuffle, or a
look-up over salted keys, so a component that holds nearly all points is not one task;
rounds are written to the shared folder, so the lineage stays short and lost
executors cost no earlier round.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from searchloom.operators.density.components import connected_components, look_up
from searchloom.operators.density.splits import ORDER, edge_order, size_splits
from searchloom.operators.density.tiles import contained, leaf_clusters, lightest_forest, per_group
from searchloom.session import shuffle_partitions, stage

# The lightest share of the candidates is contracted first; what it joins drops out of the rest.
LIGHT_SHARE = 0.25
EDGE = "topic string, a bigint, b bigint, weight double, distance double"


def _roots(best: DataFrame) -> DataFrame:
    """The component ``parent`` that each ``c`` goes into: all that hang together by their lightest edges."""
    edges = best.select("topic", F.col("c").alias("a"), F.col("parent").alias("b"))
    met = connected_components(edges)
    return stage(met.select("topic", F.col("node").alias("c"), F.col("root").alias("parent")), "parents")


def with_ends(edges: DataFrame) -> DataFrame:
    """Edges whose ends are components of one point each."""
    return edges.select("topic", *ORDER, F.col("a").alias("ca"), F.col("b").alias("cb"))


def drop_inner(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """``edges`` between the components that theirs have gone into, without those inside one."""

    def renamed(end: str) -> DataFrame:
        return roots.select("topic", F.col("c").alias(end), F.col("parent").alias(f"root_{end}"))

    met = look_up(look_up(edges, ["topic", "ca"], renamed("ca"), "left"), ["topic", "cb"], renamed("cb"), "left")
    ends = [F.coalesce(f"root_{end}", end).alias(end) for end in ("ca", "cb")]
    return met.select("topic", *ORDER, *ends).where(F.col("ca") != F.col("cb"))


def contract(edges: DataFrame) -> tuple[DataFrame | None, DataFrame | None]:
    """Boruvka's algorithm: each round every component takes its lightest edge out.

    ``edges`` are ``(topic, weight, distance, a, b, ca, cb)``, the last two the components of the ends.
    Returns the edges of the minimum spanning forest, and the component ``parent`` that every
    component ``c`` has gone into; nothing for no edges.
    """
    live, joined = edges, None
    taken: list[DataFrame] = []
    while not live.isEmpty():
        ends = live.select("topic", F.col("ca").alias("c"), F.col("cb").alias("other"), *ORDER)
        ends = ends.unionByName(
            live.select("topic", F.col("cb").alias("c"), F.col("ca").alias("other"), *ORDER)
        )
        lightest = F.min(F.struct(*ORDER, F.col("other").alias("parent"))).alias("e")
        best = stage(
            ends.groupBy("topic", "c").agg(lightest).select("topic", "c", "e.*"), "lightest"
        )
        taken.append(best.select("topic", *ORDER))
        roots = _roots(best)
        live = stage(drop_inner(live, roots), "live-edges")
        if joined is None:
            joined = roots
        else:
            up = roots.select("topic", F.col("c").alias("parent"), F.col("parent").alias("up"))
            joined = look_up(joined, ["topic", "parent"], up, "left")
            joined = stage(joined.select("topic", "c", F.coalesce("up", "parent").alias("parent")), "joined")
    if not taken:
        return None, None
    forest = taken[0]
    for more in taken[1:]:
        forest = forest.unionByName(more)
    # Two components may have chosen the same edge.
    return stage(forest.distinct(), "forest"), joined


def thinned_forest(candidates: DataFrame) -> tuple[DataFrame | None, DataFrame]:
    """The minimum spanning forest of very many candidates, and those left after thinning.

    Filter-Kruskal in two steps: the lightest share of each topic's candidates is contracted.
    Of the rest every edge whose ends hang together by then is the heaviest of a cycle, and is
    dropped; what is left is contracted between the components.
    """
    cut = candidates.groupBy("topic").agg(F.percentile_approx("weight", LIGHT_SHARE, 10_000).alias("upto"))
    marked = look_up(with_ends(candidates), ["topic"], stage(cut, "light-weights"))
    light = marked.where(F.col("weight") <= F.col("upto")).drop("upto")
    heavy = marked.where(F.col("weight") > F.col("upto")).drop("upto")
    forest, roots = contract(light)
    left = heavy if roots is None else stage(drop_inner(heavy, roots), "thinned-edges")
    more, _ = contract(left)
    if forest is None or more is None:
        return forest if more is None else more, left
    return forest.unionByName(more), left


def spanning_forest(candidates: DataFrame, task_rows: int) -> DataFrame:
    """Minimum spanning trees of all topics, ``(topic, a, b, weight, distance, error)``.

    Topics of up to ``task_rows`` candidates are solved within a task each, many to a task.
    """
    counts = stage(candidates.groupBy("topic").agg(F.count(F.lit(1)).alias("n")), "candidate-counts")
    totals = counts.agg(
        F.coalesce(F.sum(F.when(F.col("n") <= task_rows, F.col("n"))), F.lit(0)).alias("small"),
        F.count_if(F.col("n") > task_rows).alias("large"),
    ).first()
    marked = look_up(candidates, ["topic"], counts.select("topic", (F.col("n") <= task_rows).alias("fits")))
    columns = ["topic", "a", "b", "weight", "distance"]
    tasks = int(max(shuffle_partitions(candidates.sparkSession), -(-totals["small"] // task_rows)))
    schema = pa.schema([(c, {"topic": pa.string(), "a": pa.int64(), "b": pa.int64()}.get(c, pa.float64())) for c in columns])

    def solve(table: pa.Table) -> pa.RecordBatch:
        found = lightest_forest([tuple(table[c].to_numpy() for c in columns[1:])])
        topic = pa.array([table["topic"][0].as_py()] * len(found[0]), pa.string())
        return pa.record_batch([topic, *map(pa.array, found)], schema=schema)

    small = marked.where("fits").select(columns).repartition(tasks, "topic").sortWithinPartitions("topic")
    forest = small.mapInArrow(per_group(["topic"], contained(solve, schema)), f"{EDGE}, error string")
    if totals["large"]:
        large, _ = thinned_forest(marked.where("not fits").select(columns))
        forest = forest.unionByName(large.select(*columns, F.lit(None).cast("string").alias("error")))
    return stage(forest, "spanning-trees")


def splitting_edges(
    tree: DataFrame, points: DataFrame, min_size: int, min_split: float, task_rows: int
) -> DataFrame:
    """Edges at which the condensed tree splits: both sides already hold ``min_size`` points.

    ``min_split`` is a distance; lighter splits do not count, unless a topic has
    no others, in which case its heaviest split alone does.
    """
    splits = size_splits(tree, points, min_size, task_rows).withColumn(
        "counts", F.col("weight") >= min_split * min_split
    )
    heaviest = splits.groupBy("topic").agg(
        F.max(edge_order()).alias("heaviest"), F.max("counts").alias("any_counts")
    )
    only = edge_order() == F.col("heaviest")
    return (
        look_up(splits, ["topic"], heaviest)
        .where(F.when(F.col("any_counts"), F.col("counts")).otherwise(only))
        .select("topic", *ORDER)
    )


def forest_leaves(
    tree: DataFrame, points: DataFrame, min_size: int, min_split: float, task_rows: int
) -> DataFrame:
    """``(topic, rid, leaf)`` for the points in leaf clusters.

    Without the splitting edges the tree falls apart into pieces, and each piece
    holds exactly one leaf: the part that hangs together below the lightest
    splitting edge at the piece.  (Were there a second, the edge between the two
    would have ``min_size`` points on either side and split the tree itself.)
    """
    splits = stage(splitting_edges(tree, points, min_size, min_split, task_rows), "counted-splits")
    unsplit = stage(tree.join(splits, ["topic", *ORDER], "left_anti"), "unsplit-edges")
    vertices = points.select("topic", F.col("rid").alias("v"))

    def parts(edges: DataFrame, name: str) -> DataFrame:
        """The component of every vertex, itself where it has no edge."""
        roots = connected_components(edges.select("topic", "a", "b")).withColumnRenamed("node", "v")
        met = vertices.join(roots, ["topic", "v"], "left")
        return stage(met.select("topic", "v", F.coalesce("root", "v").alias(name)), name)

    piece = parts(unsplit, "piece")
    ends = splits.select("topic", F.col("a").alias("v"), edge_order().alias("order")).unionByName(
        splits.select("topic", F.col("b").alias("v"), edge_order().alias("order"))
    )
    births = stage(
        look_up(ends, ["topic", "v"], piece)
        .groupBy("topic", "piece")
        .agg(F.min(F.struct("order", "v")).alias("first"))
        .select("topic", "piece", F.col("first.order").alias("birth"), F.col("first.v").alias("seed")),
        "births",
    )
    of_a = piece.select("topic", F.col("v").alias("a"), "piece")
    within = look_up(look_up(unsplit, ["topic", "a"], of_a), ["topic", "piece"], births)
    part = parts(stage(within.where(edge_order() < F.col("birth")), "inner-edges"), "part")
    seeds = births.select("topic", F.col("seed").alias("v"), F.col("piece").alias("leaf"))
    seed_parts = seeds.join(part, ["topic", "v"]).select("topic", "part", "leaf")
    return look_up(part, ["topic", "part"], seed_parts).select("topic", F.col("v").alias("rid"), "leaf")


def tree_labels(tree: DataFrame, points: DataFrame, min_size: int, min_split: float, tasks: int) -> DataFrame:
    """``(topic, rid, label, error)`` of topics whose trees fit one task each; -1 is noise."""
    schema = pa.schema([("topic", pa.string()), ("rid", pa.int64()), ("label", pa.int32())])

    def solve(table: pa.Table) -> pa.RecordBatch:
        is_point = np.asarray(table["copies"].combine_chunks().is_valid())
        here, edges = table.filter(pa.array(is_point)), table.filter(pa.array(~is_point))
        order = np.argsort(here["a"].to_numpy())
        rid, copies = here["a"].to_numpy()[order], here["copies"].to_numpy()[order]
        a, b = (np.searchsorted(rid, edges[c].to_numpy()) for c in ("a", "b"))
        found = leaf_clusters(
            a, b, edges["weight"].to_numpy(), edges["distance"].to_numpy(), copies, min_size, min_split * min_split
        )
        topic = pa.array([table["topic"][0].as_py()] * len(rid), pa.string())
        return pa.record_batch([topic, pa.array(rid), pa.array(numbered_by_first(found), pa.int32())], schema=schema)

    less = [F.lit(None).cast(t).alias(c) for c, t in (("b", "bigint"), ("weight", "double"), ("distance", "double"))]
    rows = points.select("topic", F.col("rid").alias("a"), *less, "copies").unionByName(
        tree.select("topic", "a", "b", "weight", "distance", F.lit(None).cast("bigint").alias("copies"))
    )
    dealt = rows.repartition(tasks, "topic").sortWithinPartitions("topic")
    fields = "topic string, rid bigint, label int, error string"
    return dealt.mapInArrow(per_group(["topic"], contained(solve, schema)), fields)


def numbered_by_first(found: np.ndarray) -> np.ndarray:
    """Cluster numbers of points in their order, counted anew from 0 by where each is met first."""
    _, first, back = np.unique(found, return_index=True, return_inverse=True)
    noise = int((found < 0).any())
    first[:noise] = -1
    return (np.argsort(np.argsort(first)) - noise)[back]
