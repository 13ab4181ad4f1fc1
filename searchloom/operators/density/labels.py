"""Core distances, spanning trees and cluster labels of all topics at once."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from searchloom.config import ClusterConfig
from searchloom.functions.vectors import as_doubles, squared_norm
from searchloom.operators.density.blocks import (
    Round,
    block_core_distances,
    block_count,
    block_edges,
    forest_within,
    nearest_in_tiles,
    rounds_of,
    split_errors,
    tiles_of,
    with_groups,
)
from searchloom.operators.density.components import look_up
from searchloom.operators.density.forest import forest_leaves, numbered_by_first, spanning_forest, tree_labels
from searchloom.operators.density.pivots import pivot_blocks
from searchloom.operators.density.tiles import (
    contained,
    core_from_nearest,
    distances,
    leaf_clusters,
    matrix,
    nearest,
    per_group,
    row_reader,
    spanning_tree,
)
from searchloom.session import SMALLEST, passing_stages, shuffle_partitions, stage

MAX_TASKS = 20000
RANK_RANGES = 1024

Solver = Callable[[pa.Table, ClusterConfig], np.ndarray]


@dataclass(frozen=True)
class Prepared:
    """Distinct vectors per topic, split by whether the topic fits one tile."""

    points: DataFrame
    distinct: DataFrame
    small: DataFrame
    large: DataFrame | None
    small_tasks: int
    any_shared: bool
    failed: DataFrame
    squares: float  # of the sizes of the large topics, summed


def prepare(points: DataFrame, config: ClusterConfig) -> Prepared:
    """Collapse equal vectors and measure the topics.

    ``points`` is ``(topic, query_id, copies, embedding)``, one row per topic and
    query.  Equal vectors become one row that stands for all its ``copies``, so a
    vector shared by a large part of a topic costs no more than any other.
    Topics with missing, uneven or non-finite vectors cannot be clustered.
    """
    spark = points.sparkSession
    vec = F.col("embedding")
    points = points.select(
        "topic",
        "query_id",
        F.col("copies").cast("bigint").alias("copies"),
        as_doubles("embedding").alias("embedding"),
    )
    distinct = stage(
        points.groupBy("topic", "embedding").agg(
            F.min("query_id").alias("rid"),
            F.sum("copies").alias("copies"),
            F.count(F.lit(1)).alias("holders"),
        ),
        "distinct-vectors",
        SMALLEST,
    )
    length = squared_norm(vec)
    broken = vec.isNull() | length.isNull() | F.isnan(length) | (length == math.inf)
    measured = distinct.groupBy("topic").agg(
        F.count(F.lit(1)).alias("distinct_points"),
        F.max(broken).alias("broken"),
        F.max(F.col("holders") > 1).alias("shared"),
        F.min("rid").alias("first_rid"),
        F.max(F.size(vec)).alias("dim"),
        (F.max(F.size(vec)) != F.min(F.size(vec))).alias("uneven"),
    )
    topics = stage(
        measured.withColumn(
            "error",
            F.when(F.col("broken"), "missing or non-finite vectors").when(
                F.col("uneven"), "vectors of different lengths"
            ),
        ).withColumn("blocks", block_count(config)),
        "topic-sizes",
    )
    good = F.col("error").isNull()
    large = F.col("distinct_points") > config.tile_rows
    totals = topics.where(good).agg(
        F.count_if(large).alias("large"),
        F.coalesce(F.sum(F.when(~large, F.col("distinct_points"))), F.lit(0)).alias("small"),
        F.coalesce(F.max("shared"), F.lit(False)).alias("shared"),
        F.coalesce(F.sum(F.when(large, F.col("distinct_points").cast("double") ** 2)), F.lit(0.0)).alias("squares"),
    ).first()
    def tasks(wanted: float) -> int:
        return int(min(MAX_TASKS, max(wanted, shuffle_partitions(spark))))

    sized = topics.select("topic", "distinct_points", "blocks", "first_rid", "error")
    rows = distinct.join(sized, "topic").where(good).drop("holders", "error")
    return Prepared(
        points,
        distinct,
        rows.where(~large),
        rows.where(large) if totals["large"] else None,
        tasks(totals["small"] / config.tile_rows),
        totals["shared"],
        topics.where(~good).select("topic", "error"),
        totals["squares"],
    )


def _whole_topics(ready: Prepared) -> DataFrame:
    """Topics of at most one tile, each within one partition."""
    return ready.small.repartition(ready.small_tasks, "topic").sortWithinPartitions("topic", "rid")


def _whole_cores(table: pa.Table, min_samples: int) -> np.ndarray:
    """Squared core distances of one topic."""
    copies = table["copies"].to_numpy()
    near = nearest_in_tiles(row_reader(table["embedding"]), tiles_of(np.arange(len(table))), copies, min_samples)
    return core_from_nearest(*near, copies, min_samples)


def _whole_tree(table: pa.Table, ids: np.ndarray, min_samples: int) -> tuple[np.ndarray, ...]:
    """The spanning tree ``(a, b, weight, distance)`` of one topic, whose points go by ``ids``; weights are squared."""
    places = np.arange(len(table))
    if len(tiles_of(places)) == 1:  # one matrix serves for both
        copies, x = table["copies"].to_numpy(), matrix(table["embedding"])
        d = distances(x, x, True)
        return spanning_tree(d, core_from_nearest(*nearest(d, copies, min_samples, True), copies, min_samples), ids)
    return forest_within(row_reader(table["embedding"]), places, _whole_cores(table, min_samples), ids)


def _topic_column(table: pa.Table, rows: int) -> pa.Array:
    return pa.array([table["topic"][0].as_py()] * rows, pa.string())


def core_distances(points: DataFrame, config: ClusterConfig = ClusterConfig()) -> DataFrame:
    """``(topic, query_id, core)``: distance to the ``min_samples``-th nearest other point."""
    ready = prepare(points, config)
    min_samples = config.min_samples
    fields = [("topic", pa.string()), ("rid", pa.int64()), ("core", pa.float64())]
    schema = pa.schema(fields)

    def tile(table: pa.Table) -> pa.RecordBatch:
        core = np.sqrt(_whole_cores(table, min_samples))
        rid = table["rid"].combine_chunks()
        return pa.record_batch([_topic_column(table, len(rid)), rid, pa.array(core)], schema=schema)

    found = _whole_topics(ready).mapInArrow(
        per_group(["topic"], tile), "topic string, rid bigint, core double"
    )
    if ready.large is not None:
        _, cores, _, failed = _large_cores(ready, config)
        _raise_first(failed)
        found = found.unionByName(
            cores.select("topic", "rid", F.sqrt("core").alias("core"))
        )
    return _to_queries(found, ready)


def spanning_edges(points: DataFrame, config: ClusterConfig = ClusterConfig()) -> DataFrame:
    """``(topic, a, b, weight)``: each topic's minimum spanning tree by mutual reachability.

    The tree joins distinct vectors, each named by its smallest query id.
    """
    ready = prepare(points, config)
    min_samples = config.min_samples
    schema = pa.schema(
        [("topic", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("weight", pa.float64())]
    )

    def tile(table: pa.Table) -> pa.RecordBatch:
        rid = table["rid"].to_numpy()
        a, b, weight, _ = _whole_tree(table, rid, min_samples)
        weight = np.sqrt(weight)
        return pa.record_batch(
            [_topic_column(table, len(a)), pa.array(a), pa.array(b), pa.array(weight)],
            schema=schema,
        )

    edges = _whole_topics(ready).mapInArrow(
        per_group(["topic"], tile), "topic string, a bigint, b bigint, weight double"
    )
    if ready.large is not None:
        tree, _, failed = _large_tree(ready, config)
        _raise_first(failed)
        edges = edges.unionByName(tree.select("topic", "a", "b", F.sqrt("weight").alias("weight")))
    return edges


def _raise_first(failed: DataFrame) -> None:
    first = failed.first()
    if first is not None:
        raise RuntimeError(f"topic {first['topic']}: {first['error']}")


def _large_cores(
    ready: Prepared, config: ClusterConfig
) -> tuple[DataFrame, DataFrame, list[Round], DataFrame]:
    """The large topics' points in their blocks and groups, the same without vectors but with core
    distances, the rounds in which their pairs of groups go, and what failed."""
    spark = ready.large.sparkSession
    tasks = shuffle_partitions(spark)
    with passing_stages(spark) as keep:
        placed, facts, _ = pivot_blocks(ready.large)
        grouped = keep(with_groups(placed, ready.squares, tasks, config), "grouped-vectors")
        facts = keep(facts, "block-facts")
    rounds = rounds_of(grouped, tasks, MAX_TASKS)
    cores, _, failed = block_core_distances(grouped, facts, config, rounds)
    return grouped, cores, rounds, failed


def _large_tree(ready: Prepared, config: ClusterConfig) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Spanning trees of the large topics, their points without the vectors, and what failed."""
    points, cores, rounds, failed = _large_cores(ready, config)
    cored = stage(cores, "core-distances")
    candidates, more = split_errors(block_edges(points, cored, config, rounds))
    tree, most = split_errors(spanning_forest(candidates, config.tree_rows))
    points = cored.select("topic", "rid", "copies", "distinct_points")
    return tree, points, failed.unionByName(more).unionByName(most)


def number_clusters(members: DataFrame) -> DataFrame:
    """Number the clusters of each topic from 0 by their smallest member.

    A topic may hold millions of clusters, so they are not sorted in one window:
    ids are cut into ranges, and each range starts where the counts before it end.
    """
    firsts = members.groupBy("topic", "leaf").agg(F.min("rid").alias("first_rid"))
    span = firsts.groupBy("topic").agg(
        F.min("first_rid").alias("low"), F.max("first_rid").alias("high")
    )
    width = F.floor((F.col("high") - F.col("low")) / RANK_RANGES) + 1
    ranged = firsts.join(span, "topic").withColumn(
        "range", F.floor((F.col("first_rid") - F.col("low")) / width)
    )
    before = Window.partitionBy("topic").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("topic", "range")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("topic", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    place = F.row_number().over(Window.partitionBy("topic", "range").orderBy("first_rid"))
    numbers = ranged.join(offsets, ["topic", "range"]).select(
        "topic", "leaf", (F.col("offset") + place - 1).cast("int").alias("label")
    )
    return members.join(numbers, ["topic", "leaf"]).select("topic", "rid", "label")


def _large_labels(ready: Prepared, config: ClusterConfig) -> DataFrame:
    """Labels from the trees: within a task per topic, or by joins if a tree is larger than that.

    A topic of which a task failed has a row with the error besides.
    """
    tree, points, failed = _large_tree(ready, config)
    sizes = (config.min_cluster_size, config.cluster_selection_epsilon)
    fits = F.col("distinct_points") <= config.tree_rows
    counted = stage(points.groupBy("topic", fits.alias("fits")).agg(F.count(F.lit(1)).alias("n")), "tree-sizes")
    totals = {r["fits"]: r["n"] for r in counted.groupBy("fits").agg(F.sum("n").alias("n")).collect()}
    marked = look_up(tree, ["topic"], counted.select("topic", "fits"))
    found = failed.select("topic", F.lit(None).cast("bigint").alias("rid"), F.lit(-1).alias("label"), "error")
    if True in totals:
        tasks = int(max(shuffle_partitions(tree.sparkSession), totals[True] // config.tree_rows))
        found = found.unionByName(
            tree_labels(marked.where("fits").drop("fits"), points.where(fits), *sizes, tasks)
        )
    if False in totals:
        wide = points.where(~fits)
        leaves = stage(forest_leaves(marked.where("not fits").drop("fits"), wide, *sizes, config.tree_rows), "leaves")
        labels = wide.select("topic", "rid").join(number_clusters(leaves), ["topic", "rid"], "left")
        label = F.coalesce("label", F.lit(-1)).alias("label")
        found = found.unionByName(labels.select("topic", "rid", label, F.lit(None).cast("string").alias("error")))
    return found


def tile_labels(table: pa.Table, config: ClusterConfig) -> np.ndarray:
    """Cluster numbers of one topic's rows ``(rid, copies, embedding)``, sorted by id; -1 is noise."""
    # Rows come sorted by id, so places order the points as their ids do.
    a, b, weight, distance = _whole_tree(table, np.arange(len(table)), config.min_samples)
    least = config.cluster_selection_epsilon
    copies = table["copies"].to_numpy()
    return leaf_clusters(a, b, weight, distance, copies, config.min_cluster_size, least * least)


def _small_labels(ready: Prepared, config: ClusterConfig, solver: Solver) -> DataFrame:
    schema = pa.schema([("topic", pa.string()), ("rid", pa.int64()), ("label", pa.int32())])

    def tile(table: pa.Table) -> pa.RecordBatch:
        label = numbered_by_first(np.asarray(solver(table, config)))
        rid = table["rid"].combine_chunks()
        return pa.record_batch(
            [_topic_column(table, len(rid)), rid, pa.array(label, pa.int32())], schema=schema
        )

    return _whole_topics(ready).mapInArrow(
        per_group(["topic"], contained(tile, schema)), "topic string, rid bigint, label int, error string"
    )


def _to_queries(found: DataFrame, ready: Prepared) -> DataFrame:
    """From distinct vectors back to all queries that hold them."""
    if not ready.any_shared:
        return found.withColumnRenamed("rid", "query_id")
    shared = ready.distinct.where(F.col("holders") > 1).select("topic", "embedding", "rid")
    others = (
        ready.points.join(shared, ["topic", "embedding"])
        .where(F.col("query_id") != F.col("rid"))
        .select("topic", "query_id", "rid")
        .join(found, ["topic", "rid"])
        .drop("rid")
    )
    return found.withColumnRenamed("rid", "query_id").unionByName(others)


def cluster_labels(
    points: DataFrame, config: ClusterConfig = ClusterConfig(), solver: Solver = tile_labels
) -> tuple[DataFrame, DataFrame]:
    """``(topic, query_id, label)``, label -1 for noise, and ``(topic, error)`` of the topics that failed.

    ``solver`` finds the clusters of a topic that fits one tile.  Whatever is raised while a topic is worked
    on is that topic's error; it has no labels then, and the others are as they would be.  Both are
    written; the vectors and distances written on the way are gone afterwards.
    """
    with passing_stages(points.sparkSession) as keep:
        ready = prepare(points, config)
        with passing_stages(points.sparkSession) as keep_found:
            found = _small_labels(ready, config, solver)
            if ready.large is not None:
                found = found.unionByName(_large_labels(ready, config))
            found = keep_found(found, "labels")
        found, errors = split_errors(found)
        failed = ready.failed
        if not errors.isEmpty():
            errors = stage(errors.groupBy("topic").agg(F.min("error").alias("error")), "failed-topics")
            failed = failed.unionByName(errors)
            found = look_up(found, ["topic"], errors, "left").where(F.col("error").isNull()).drop("error")
        return keep(_to_queries(found, ready), "query-labels"), keep(failed, "failed-topics")
