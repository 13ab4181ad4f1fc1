"""What a task holds of a matrix of distances, and how often a vector is sent."""

import tracemalloc
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_density import TOPICS, cloud, found_sets, to_frame

from bruteforce import clusters
from searchloom.config import ClusterConfig
from searchloom.operators.density import blocks, cluster_labels, components, labels
from searchloom.operators.density.pivots import pivot_blocks
from searchloom.operators.density.tiles import distances


@pytest.mark.parametrize("same", [True, False])
def test_distances_hold_one_matrix(same):
    x = np.random.default_rng(3).normal(size=(2500, 16))
    other = x if same else x[::-1].copy()
    tracemalloc.start()
    try:
        d = distances(x, other, same)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2.2 * d.nbytes
    rows = [0, 511, 512, 2499]
    assert np.allclose(d[rows], ((x[rows, None] - other[None]) ** 2).sum(2), rtol=1e-9, atol=0)
    if same:
        assert (d == d.T).all() and not d.diagonal().any()


def test_a_vector_is_sent_a_few_times_however_many_blocks(spark):
    config = replace(ClusterConfig(), tile_rows=40)
    ready = labels.prepare(to_frame(spark, {"t": cloud(3, 700, 2), "u": cloud(4, 100, 2)}), config)
    placed, _, _ = pivot_blocks(ready.large)
    grouped = blocks.with_groups(placed, ready.squares, 4, config)
    assert grouped.where("topic = 't'").select("block").distinct().count() >= 18
    sent = {r.topic: r.n / r.points for r in (
        blocks.pair_up(grouped.select("topic", "rid", "group", "groups"), 4)
        .groupBy("topic").agg(F.count("*").alias("n"), F.countDistinct("rid").alias("points")).collect()
    )}
    assert sent == {"t": 3, "u": 1}
    tight = replace(config, block_bytes=100 * 16)
    more = blocks.with_groups(placed, ready.squares, 4, tight).groupBy("topic", "group").count().collect()
    assert len([r for r in more if r.topic == "t"]) == 7


def test_groups_and_tiles_within_them_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(blocks, "LEAST_SIDE", 7)
    monkeypatch.setattr(blocks, "GROUP_ROWS", 25)
    monkeypatch.setattr(blocks, "EDGES_HELD", 20)
    topics = {k: TOPICS[k] for k in ("plain", "ties", "copies")}
    found = found_sets(cluster_labels(to_frame(spark, topics), replace(ClusterConfig(), tile_rows=12))[0])
    for topic, points in topics.items():
        assert found.get(topic, set()) == clusters(points)[0], topic


@pytest.mark.parametrize("most", [1, 3, 150])
def test_components_within_tasks_and_by_stars(spark, monkeypatch, most):
    monkeypatch.setattr(components, "TASK_EDGES", most)
    graphs = {"path": [(i, i + 1) for i in range(100, 0, -1)], "star": [(0, i) for i in range(1, 200)], "pair": [(9, 4)]}
    rows = [(t, "<1", a, b) for t, g in graphs.items() for a, b in g] + [("pair", "<1", 3, 3), ("pair", "<2", 8, 9)]
    jobs = []
    monkeypatch.setattr(components, "_starred", lambda *a, own=components._starred: jobs.append(1) or own(*a))
    edges = spark.createDataFrame(rows, "topic string, part string, a bigint, b bigint")
    found = components.connected_components(edges, ["topic", "part"]).collect()
    expected = {("path", "<1", i): 1 for i in range(1, 102)} | {("star", "<1", i): 0 for i in range(200)}
    expected |= {("pair", "<1", 4): 4, ("pair", "<1", 9): 4, ("pair", "<2", 8): 8, ("pair", "<2", 9): 8}
    assert {(r.topic, r.part, r.node): r.root for r in found} == expected and len(found) == len(expected)
    assert len(jobs) == 1
    monkeypatch.setattr(components, "TASK_EDGES", 1000)
    again = components.connected_components(edges, ["topic", "part"]).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, found)) and len(jobs) == 1
