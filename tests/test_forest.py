"""Components, thinning, splits and pivots of the distributed clustering, against direct computation."""

import random
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from bruteforce import clusters
from pyspark.sql import functions as F
from test_density import TOPICS, cloud, found_sets, to_frame

from searchloom.config import ClusterConfig
from searchloom.operators.density import cluster_labels, labels
from searchloom.operators.density.components import SALTS, connected_components, look_up
from searchloom.operators.density.forest import drop_inner, contract, thinned_forest, with_ends
from searchloom.operators.density.pivots import near_pairs, pivot_blocks
from searchloom.operators.density.splits import size_splits
from searchloom.operators.density.tiles import lightest_forest, splitting_places

EDGES = "topic string, a bigint, b bigint, weight double, distance double"


def roots_of(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {x: find(x) for x in parent}


def random_graph(seed):
    """A star, a long path, a clique, and single edges."""
    draw = random.Random(seed)
    names = draw.sample(range(10**6), 400)
    star = [(names[0], x) for x in names[1:150]]
    path = list(zip(names[150:260], names[151:261]))
    clique = [(a, b) for a in names[261:271] for b in names[261:271] if a != b]
    return star + path + clique + [(names[i], names[i + 1]) for i in range(280, 399, 2)]


@pytest.mark.parametrize("seed", range(2))
def test_components(spark, seed):
    graphs = {"x": random_graph(seed), "y": random_graph(seed + 50), "loop": [(3, 3)]}
    rows = [(t, a, b) for t, g in graphs.items() for a, b in g]
    found = connected_components(spark.createDataFrame(rows, "topic string, a bigint, b bigint")).collect()
    for topic in ("x", "y"):
        assert {r.node: r.root for r in found if r.topic == topic} == roots_of(graphs[topic])
    assert not [r for r in found if r.topic == "loop"]


def test_a_giant_component_is_no_single_task(spark):
    """Nine tenths of the rows share one key; without adaptive splits no task gets over a quarter of them."""
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(40_000).select(
            F.lit("t").alias("topic"), F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(7).alias("c"), "id"
        )
        table = rows.select("topic", "c").distinct().withColumn("parent", F.col("c") + 1)
        joined = look_up(rows, ["topic", "c"], table)
        shares = joined.groupBy(F.spark_partition_id()).count().collect()
        assert joined.count() == 40_000
        assert max(r["count"] for r in shares) <= 40_000 * max(0.25, 4 / SALTS)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def random_edges(seed, nodes, count, ties):
    draw = random.Random(seed)
    seen = {}
    for i in range(1, nodes):
        seen[draw.randrange(i), i] = 0
    while len(seen) < count:
        a, b = sorted(draw.sample(range(nodes), 2))
        seen[a, b] = 0
    return [("t", a, b, float(draw.randint(1, ties)), float(draw.randint(1, ties))) for a, b in seen]


@pytest.mark.parametrize("ties", [3, 10**6])
def test_thinning_keeps_the_forest_and_drops_edges(spark, ties):
    rows = random_edges(ties, 120, 1500, ties)
    frame = spark.createDataFrame(rows, EDGES)
    forest, left = thinned_forest(frame)
    expected = lightest_forest([tuple(map(np.array, zip(*[r[1:] for r in rows])))])
    assert sorted((r.a, r.b) for r in forest.collect()) == sorted(zip(expected[0].tolist(), expected[1].tolist()))
    if ties > 3:
        assert left.count() < len(rows) / 4  # of three quarters that were not light


def test_contract_tells_where_components_went(spark):
    rows = random_edges(8, 60, 100, 50)
    forest, joined = contract(with_ends(spark.createDataFrame(rows, EDGES)))
    assert forest.count() == 59 and joined.select("parent").distinct().count() == 1
    assert drop_inner(with_ends(spark.createDataFrame(rows, EDGES)), joined).count() == 0
    assert contract(with_ends(spark.createDataFrame([], EDGES))) == (None, None)


def direct_splits(rows, sizes, least):
    parent, held, found = {v: v for v in sizes}, dict(sizes), set()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for _, a, b, w, d in sorted(rows, key=lambda r: (r[3], r[4], r[1], r[2])):
        x, y = find(a), find(b)
        if held[x] >= least and held[y] >= least:
            found.add((a, b))
        parent[y] = x
        held[x] += held[y]
    return found


@pytest.mark.parametrize("least, task_rows", [(3, 1000), (3, 40), (30, 25), (100, 40), (2, 12)])
def test_splits_do_not_depend_on_halving(spark, least, task_rows):
    trees = {}
    for topic, seed in (("p", 1), ("q", 2), ("chain", None)):
        draw = random.Random(seed)
        n = 260
        ends = [(i - 1 if seed is None else draw.randrange(i), i) for i in range(1, n)]
        weight = (lambda i: float(i)) if seed is None else (lambda i: float(draw.randint(1, 9)))
        trees[topic] = [(topic, a, b, weight(b), 1.0) for a, b in ends]
    rows = [r for t in trees.values() for r in t]
    sizes = {t: {v: 1 + v % 3 for v in range(260)} for t in trees}
    points = spark.createDataFrame(
        [(t, v, c) for t, held in sizes.items() for v, c in held.items()], "topic string, rid bigint, copies bigint"
    )
    found = size_splits(spark.createDataFrame(rows, EDGES), points, least, task_rows).collect()
    for topic, tree in trees.items():
        assert {(r.a, r.b) for r in found if r.topic == topic} == direct_splits(tree, sizes[topic], least)


def test_splitting_places_of_a_single_edge():
    assert splitting_places(np.array([0]), np.array([1]), np.array([0]), np.array([2, 3]), 2).tolist() == [0]
    assert splitting_places(np.array([0]), np.array([1]), np.array([0]), np.array([2, 1]), 2).tolist() == []


def test_labels_through_joins_alone(spark):
    """Blocks, thinning, halving and stars, with no tree solved whole."""
    config = replace(ClusterConfig(), tile_rows=40, tree_rows=25)
    topics = {k: TOPICS[k] for k in ("plain", "copies", "ties", "tight")}
    found = found_sets(cluster_labels(to_frame(spark, topics), config)[0])
    for topic, points in topics.items():
        assert found.get(topic, set()) == clusters(points)[0], topic


def far_apart(seed):
    """Ten tight groups, a hundred times their width from each other."""
    return {
        g * 100 + i: [x + 50.0 * (g % 4), y + 50.0 * (g // 4)]
        for g in range(10)
        for i, (x, y) in enumerate(cloud(seed + g, 60, 2, groups=1, spread=0.05).values())
    }


def prepared(spark, points, config):
    return labels.prepare(to_frame(spark, {"t": points}), config)


def test_pivots_rule_out_pairs_of_distant_blocks(spark, monkeypatch):
    points = far_apart(3)
    config = replace(ClusterConfig(), tile_rows=40)
    placed, facts, pairs = pivot_blocks(prepared(spark, points, config).large)
    rows = {r.rid: r for r in placed.collect()}
    assert sorted(rows) == sorted(points)
    radius = {r.block: (r.embedding, r.radius) for r in facts.collect()}
    assert len(radius) * (len(radius) + 1) // 2 == pairs
    for rid, row in rows.items():
        centre, r = radius[row.block]
        assert np.linalg.norm(np.array(points[rid]) - centre) <= r + 1e-9
    reach = facts.select("topic", "block", F.lit(3.0).alias("reach"))
    kept = {(r.i, r.j) for r in near_pairs(facts, reach).collect()}
    assert len(kept) < 0.7 * pairs
    for a in rows.values():
        for b in rows.values():
            if a.block < b.block and np.linalg.norm(np.array(points[a.rid]) - points[b.rid]) <= 3.0:
                assert (a.block, b.block) in kept
    found = found_sets(cluster_labels(to_frame(spark, {"t": points}), config)[0])
    assert found["t"] == clusters(points)[0]


def test_a_failing_topic_fails_alone(spark):
    def fragile(table: pa.Table, config: ClusterConfig):
        if table["topic"][0].as_py() == "ties":
            raise ArithmeticError("planted")
        return labels.tile_labels(table, config)

    topics = {k: TOPICS[k] for k in ("plain", "ties", "tight")}
    found, failed = cluster_labels(to_frame(spark, topics), solver=fragile)
    assert [tuple(r) for r in failed.collect()] == [("ties", "ArithmeticError: planted")]
    sets = found_sets(found)
    assert set(sets) <= {"plain", "tight"}
    for topic in ("plain", "tight"):
        assert sets.get(topic, set()) == clusters(topics[topic])[0]


def test_a_failing_block_fails_its_topic_alone(spark, monkeypatch):
    from searchloom.operators.density import blocks

    honest = blocks.crossing_tree

    def fragile(d, core, ids):
        if ids.min() < 1000:
            raise FloatingPointError("planted")
        return honest(d, core, ids)

    monkeypatch.setattr(blocks, "crossing_tree", fragile)
    topics = {"low": TOPICS["plain"], "high": {i + 5000: v for i, v in TOPICS["tight"].items()}}
    found, failed = cluster_labels(to_frame(spark, topics), replace(ClusterConfig(), tile_rows=40))
    assert [tuple(r) for r in failed.collect()] == [("low", "FloatingPointError: planted")]
    assert {r.topic for r in found.select("topic").distinct().collect()} == {"high"}
    assert found_sets(found).get("high", set()) == clusters(topics["high"])[0]
