"""What a task of the clustering holds at once: some tiles, whatever the size of its topic."""

import tracemalloc
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from test_density import TOPICS, cloud, found_sets, to_frame

from bruteforce import clusters
from searchloom.config import ClusterConfig
from searchloom.operators.density import blocks, cluster_labels, labels, tiles
from searchloom.operators.density.labels import core_distances, spanning_edges

TILE = 8 * 2000 * 2000


def peak_of(work):
    tracemalloc.start()
    try:
        return work(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def one_topic(x):
    n = len(x)
    vectors = pa.array(list(x), pa.list_(pa.float64()))
    return pa.table({"topic": ["t"] * n, "rid": range(n), "copies": [1] * n, "embedding": vectors})


def test_a_whole_topic_takes_the_memory_of_two_tiles(monkeypatch):
    rng = np.random.default_rng(5)
    table = one_topic(rng.normal(size=(4500, 8)) + 4 * rng.integers(0, 40, size=(4500, 1)))
    found, peak = peak_of(lambda: labels.tile_labels(table, ClusterConfig()))
    assert peak < 2.5 * TILE
    monkeypatch.setattr(blocks, "LEAST_SIDE", 5000)
    assert (found == labels.tile_labels(table, ClusterConfig())).all() and found.max() > 10


@pytest.mark.parametrize("side", [5, 13])
def test_whole_topics_in_tiles_equal_direct(spark, monkeypatch, side):
    points = to_frame(spark, TOPICS)
    cores = {(r.topic, r.query_id): r.core for r in core_distances(points).collect()}
    weights = sorted((r.topic, round(r.weight, 9)) for r in spanning_edges(points).collect())
    monkeypatch.setattr(blocks, "LEAST_SIDE", side)
    monkeypatch.setattr(blocks, "EDGES_HELD", 20)
    found = found_sets(cluster_labels(points)[0])
    for topic, vectors in TOPICS.items():
        assert found.get(topic, set()) == clusters(vectors)[0], topic
    assert {(r.topic, r.query_id): r.core for r in core_distances(points).collect()} == pytest.approx(cores)
    assert sorted((r.topic, round(r.weight, 9)) for r in spanning_edges(points).collect()) == weights


def test_a_pair_of_groups_is_read_a_tile_at_a_time(spark, monkeypatch):
    honest = tiles.matrix

    def bounded(column):
        if len(column) > 30:
            raise MemoryError(f"{len(column)} vectors at once")
        return honest(column)

    monkeypatch.setattr(blocks, "LEAST_SIDE", 30)
    monkeypatch.setattr(tiles, "matrix", bounded)
    monkeypatch.setattr(blocks, "matrix", bounded, raising=False)
    topics = {"one": cloud(3, 300, 2), "two": cloud(4, 150, 2)}
    found, failed = cluster_labels(to_frame(spark, topics), replace(ClusterConfig(), tile_rows=40))
    assert failed.collect() == []
    sets = found_sets(found)
    for topic, vectors in topics.items():
        assert sets.get(topic, set()) == clusters(vectors)[0], topic


def test_rows_are_read_where_they_lie():
    x = np.random.default_rng(2).normal(size=(50, 3))
    column = pa.chunked_array([pa.array(list(x[a:b])) for a, b in ((0, 7), (7, 8), (8, 50))])
    rows = tiles.row_reader(column)
    for places in ([0], [49, 3], [5, 6, 7, 8, 9], [1, 2, 6, 7, 30, 31, 32, 40], range(50)):
        assert (rows(np.array(places)) == x[list(places)]).all()


def test_a_forest_makes_no_list_of_all_edges():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 2000, 200_000), rng.integers(2000, 4000, 200_000)
    edges = (a, b, rng.random(len(a)), rng.random(len(a)))
    found, peak = peak_of(lambda: tiles.lightest_forest([edges]))
    assert len(found[0]) == 3999 and peak < 120 * len(a)
