"""Where a condensed tree splits: component sizes along the merge tree, by halving it.

Edges join components from the lightest on, and one splits the tree if both components hold
enough points when it joins them.  The edges of a part are cut at a pivot.  The lighter
ones fall apart into components, each a part of its own; the heavier ones are
a tree over those components, whose sizes are known by then.  So every edge goes to
one half-sized part, and the number of rounds goes with the logarithm of the tree's size over
that of one task, whatever the size asked for.  Parts end early that hold too few points in all (no
edge splits) or whose nodes all hold enough (all do).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from searchloom.operators.density.components import connected_components, look_up
from searchloom.operators.density.tiles import per_group, splitting_places
from searchloom.session import shuffle_partitions, stage

ORDER = ["weight", "distance", "a", "b"]
PART = ["topic", "part"]
SAMPLE = 64  # edges from which a part's pivot is taken


def edge_order() -> Column:
    return F.struct(*ORDER)


def _measured(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    counted = edges.groupBy(*PART).agg(F.count(F.lit(1)).alias("n"))
    held = nodes.groupBy(*PART).agg(F.sum("held").alias("whole"), F.min("held").alias("least"))
    return stage(counted.join(held, PART), "tree-parts")


def _solved(edges: DataFrame, nodes: DataFrame, min_size: int, tasks: int) -> DataFrame:
    """The splitting edges of parts that fit one task, joined edge by edge there."""
    schema = pa.schema(
        [("topic", pa.string()), ("weight", pa.float64()), ("distance", pa.float64()), ("a", pa.int64()), ("b", pa.int64())]
    )

    def solve(table: pa.Table) -> pa.RecordBatch:
        held = table["held"].combine_chunks()
        is_node = np.asarray(held.is_valid())
        rows = table.filter(pa.array(~is_node))
        ids = table["ca"].to_numpy()[is_node]
        size = held.drop_null().to_numpy()
        order = np.argsort(ids)
        ids, size = ids[order], size[order]
        a, b, weight, distance = (rows[c].to_numpy() for c in ("a", "b", "weight", "distance"))
        left, right = (np.searchsorted(ids, rows[c].to_numpy()) for c in ("ca", "cb"))
        places = splitting_places(left, right, np.lexsort((b, a, distance, weight)), size, min_size)
        topic = pa.array([table["topic"][0].as_py()] * len(places), pa.string())
        return pa.record_batch([topic, *(pa.array(x[places]) for x in (weight, distance, a, b))], schema=schema)

    none = {c: F.lit(None).cast("bigint") for c in ("a", "b", "cb", "held")}
    less = {c: F.lit(None).cast("double") for c in ("weight", "distance")}
    own = edges.select(*PART, *ORDER, "ca", "cb", none["held"].alias("held"))
    of_nodes = nodes.select(
        *PART,
        *[less[c].alias(c) for c in ("weight", "distance")],
        *[none[c].alias(c) for c in ("a", "b")],
        F.col("c").alias("ca"),
        none["cb"].alias("cb"),
        "held",
    )
    dealt = own.unionByName(of_nodes).repartition(tasks, *PART).sortWithinPartitions(*PART)
    return dealt.mapInArrow(
        per_group(PART, solve), "topic string, weight double, distance double, a bigint, b bigint"
    )


def _pivots(edges: DataFrame, level: int) -> DataFrame:
    """An edge near the middle of each part: the median of a sample by hash, or the first by hash."""
    mark = F.xxhash64("a", "b", F.lit(level))
    drawn = F.pmod(mark, F.ceil(F.col("n") / SAMPLE)) == 0
    found = edges.groupBy(*PART).agg(
        F.sort_array(F.collect_list(F.when(drawn, edge_order()))).alias("sample"),
        F.min_by(edge_order(), mark).alias("any"),
    )
    middle = F.try_element_at("sample", (F.size("sample") / 2).cast("int") + 1)
    return found.select(*PART, F.coalesce(middle, "any").alias("pivot"))


def size_splits(tree: DataFrame, points: DataFrame, min_size: int, task_rows: int) -> DataFrame:
    """Edges ``(topic, weight, distance, a, b)`` that join two components of ``min_size`` points or more.

    ``tree`` holds the topics' spanning trees, ``points`` is ``(topic, rid, copies)``.  Parts of up to ``task_rows``
    edges are finished in one task each, many parts per task.
    """
    edges = tree.select("topic", F.lit("").alias("part"), *ORDER, F.col("a").alias("ca"), F.col("b").alias("cb"))
    nodes = points.select("topic", F.lit("").alias("part"), F.col("rid").alias("c"), F.col("copies").alias("held"))
    found, level = [], 0
    while True:
        sizes = _measured(edges, nodes)
        sizes = sizes.where(F.col("whole") >= min_size).withColumn(
            "end", F.when(F.col("least") >= min_size, "all").when(F.col("n") <= task_rows, "task").otherwise("cut")
        )
        counts = {r["end"]: r for r in sizes.groupBy("end").agg(F.sum("n").alias("n")).collect()}
        ends = sizes.select(*PART, "n", "end")
        marked = stage(look_up(edges, PART, ends), "tree-edges")
        held = stage(look_up(nodes, PART, ends.select(*PART, "end")), "tree-nodes")
        if "all" in counts:
            found.append(marked.where(F.col("end") == "all").select("topic", *ORDER))
        if "task" in counts:
            tasks = max(shuffle_partitions(tree.sparkSession), -(-counts["task"]["n"] // task_rows))
            small = [df.where(F.col("end") == "task") for df in (marked, held)]
            found.append(_solved(*small, min_size, int(tasks)))
        if "cut" not in counts:
            break
        edges, nodes = _halved(marked.where(F.col("end") == "cut"), held.where(F.col("end") == "cut"), level)
        level += 1
    if not found:
        return tree.select("topic", *ORDER).limit(0)
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return stage(whole, "size-splits")


def _halved(edges: DataFrame, nodes: DataFrame, level: int) -> tuple[DataFrame, DataFrame]:
    """The parts below and above each part's pivot: their edges and their nodes."""
    cut = stage(look_up(edges.drop("end"), PART, stage(_pivots(edges, level), "pivots")), "cut-edges")
    cut = cut.withColumn("light", edge_order() <= F.col("pivot")).drop("pivot", "n")
    light, heavy = cut.where("light").drop("light"), cut.where("not light").drop("light")
    roots = connected_components(light.select(*PART, F.col("ca").alias("a"), F.col("cb").alias("b")), PART)
    roots = stage(roots, "tree-components")

    def root_of(column: str, name: str) -> DataFrame:
        return roots.select(*PART, F.col("node").alias(column), F.col("root").alias(name))

    below = F.concat("part", F.lit("<"), F.col("root").cast("string"))
    above = F.concat("part", F.lit(">"))
    light = look_up(light, [*PART, "ca"], root_of("ca", "root")).withColumn("part", below).drop("root")
    heavy = look_up(heavy, [*PART, "ca"], root_of("ca", "ra"), "left")
    heavy = look_up(heavy, [*PART, "cb"], root_of("cb", "rb"), "left").select(
        "topic", above.alias("part"), *ORDER, F.coalesce("ra", "ca").alias("ca"), F.coalesce("rb", "cb").alias("cb")
    )
    met = nodes.drop("end").join(root_of("c", "root"), [*PART, "c"], "left")
    inside = met.where(F.col("root").isNotNull()).select("topic", below.alias("part"), "c", "held")
    joined = met.groupBy(*PART, F.coalesce("root", "c").alias("c")).agg(F.sum("held").alias("held"))
    outside = joined.select("topic", above.alias("part"), "c", "held")
    return (
        stage(light.select(heavy.columns).unionByName(heavy), "half-edges"),
        stage(inside.unionByName(outside), "half-nodes"),
    )
