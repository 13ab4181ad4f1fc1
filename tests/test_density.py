"""Density clustering against a direct computation, in one tile and in many blocks."""

import math
import random
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from bruteforce import clusters

from searchloom.config import ClusterConfig
from searchloom.operators.density import blocks, cluster_labels, labels
from searchloom.operators.density.labels import core_distances, spanning_edges
from searchloom.operators.density.tiles import (
    core_from_nearest,
    distances,
    leaf_clusters,
    nearest,
    spanning_tree,
)


def cloud(seed, n, dim, groups=4, spread=0.05, copies=0, lattice=False):
    rng = random.Random(seed)
    centres = [[rng.uniform(-1, 1) for _ in range(dim)] for _ in range(groups)]
    points = {}
    for i in range(n):
        c = rng.choice(centres)
        if rng.random() < 0.2:
            v = [rng.uniform(-1, 1) for _ in range(dim)]
        else:
            v = [x + rng.gauss(0, spread) for x in c]
        points[i] = [round(x * 8) / 8 for x in v] if lattice else v
    for i in range(copies):
        points[n + i] = list(points[rng.randrange(n)])
    return points


def solve_one_tile(points, min_size, min_samples, epsilon):
    """As a task does it: equal vectors collapsed, one matrix."""
    reps, copies, holders = {}, {}, {}
    for i in sorted(points):
        rep = reps.setdefault(tuple(points[i]), i)
        copies[rep] = copies.get(rep, 0) + 1
        holders.setdefault(rep, []).append(i)
    ids = sorted(copies)
    x = np.array([points[i] for i in ids])
    m = np.array([copies[i] for i in ids])
    d = distances(x, x, True)
    core = core_from_nearest(*nearest(d, m, min_samples, True), m, min_samples)
    a, b, w, dist = spanning_tree(d, core, np.arange(len(ids)))
    label = leaf_clusters(a, b, w, dist, m, min_size, epsilon * epsilon)
    found = {}
    for i, k in zip(ids, label):
        if k >= 0:
            found.setdefault(k, set()).update(holders[i])
    return {frozenset(s) for s in found.values()}


@pytest.mark.parametrize("seed", range(6))
def test_a_shift_or_an_outlier_changes_nothing(seed):
    points = cloud(seed, 60, 8, groups=5, spread=0.1)
    expected, _ = clusters(points, 3, 2, 0.1)
    for by in (1e3, 1e5):
        moved = {i: [x + by for x in v] for i, v in points.items()}
        assert solve_one_tile(moved, 3, 2, 0.1) == expected
    for far in (1e5, 1e6, 1e7):
        with_one = points | {60: [far] + [0.0] * 7}
        assert solve_one_tile(with_one, 3, 2, 0.1) == clusters(with_one, 3, 2, 0.1)[0]


def test_distances_do_not_depend_on_the_tile():
    x = np.array(list(cloud(1, 90, 5, copies=20).values())) + 1000.0
    whole = distances(x, x, True)
    direct = ((x[:, None] - x[None]) ** 2).sum(2)
    assert (whole == whole.T).all() and np.allclose(whole, direct, rtol=1e-11, atol=0)
    assert np.allclose(distances(x[:30], x[30:]), whole[:30, 30:], rtol=2.0**-37, atol=0)


@pytest.mark.parametrize("seed", range(40))
def test_one_tile_equals_direct(seed):
    rng = random.Random(1000 + seed)
    points = cloud(
        seed,
        rng.randint(4, 120),
        rng.randint(1, 6),
        groups=rng.randint(1, 6),
        spread=rng.choice([0.01, 0.05, 0.3]),
        copies=rng.choice([0, 0, 5, 30]),
        lattice=rng.random() < 0.4,
    )
    for min_size in (2, 3, 5):
        for min_samples in (1, 2, 4):
            for epsilon in (0.0, 0.1, 0.5):
                expected, _ = clusters(points, min_size, min_samples, epsilon)
                assert solve_one_tile(points, min_size, min_samples, epsilon) == expected


def to_frame(spark, topics):
    rows = [
        (topic, i, 1, [float(x) for x in v])
        for topic, points in topics.items()
        for i, v in points.items()
    ]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(
        rows, "topic string, query_id bigint, copies int, embedding array<double>"
    )


def found_sets(labels):
    sets, numbers = {}, {}
    for r in labels.collect():
        if r.label >= 0:
            sets.setdefault((r.topic, r.label), set()).add(r.query_id)
            numbers.setdefault(r.topic, set()).add(r.label)
    for topic, seen in numbers.items():
        assert seen == set(range(len(seen)))
        firsts = [min(sets[topic, k]) for k in sorted(seen)]
        assert firsts == sorted(firsts)
    out = {}
    for (topic, _), members in sets.items():
        out.setdefault(topic, set()).add(frozenset(members))
    return out


TOPICS = {
    "plain": cloud(1, 150, 3),
    "copies": cloud(2, 60, 2, copies=60),
    "ties": cloud(3, 120, 2, lattice=True),
    "tight": cloud(4, 90, 4, groups=2, spread=0.005),
    "tiny": cloud(5, 4, 2),
    "same": {i: [0.5, 0.5] for i in range(12)},
}


# One tile; a block per tile; blocks of several tiles each.
LAYOUTS = [{}, {"tile_rows": 40}, {"tile_rows": 12, "block_bytes": 1000}]


@pytest.fixture
def two_usual_blocks(monkeypatch):
    monkeypatch.setattr(blocks, "USUAL_BLOCKS", 2)


@pytest.mark.parametrize("layout", LAYOUTS, ids=str)
def test_spark_equals_direct(spark, layout, two_usual_blocks):
    config = replace(ClusterConfig(), **layout)
    labels, failed = cluster_labels(to_frame(spark, TOPICS), config)
    found = found_sets(labels)
    for topic, points in TOPICS.items():
        assert found.get(topic, set()) == clusters(points)[0], topic
    assert labels.count() == sum(map(len, TOPICS.values()))
    assert failed.count() == 0


def test_tree_weight_does_not_depend_on_blocks(spark, two_usual_blocks):
    topics = {k: TOPICS[k] for k in ("plain", "tight")}
    for layout in LAYOUTS:
        config = replace(ClusterConfig(), **layout)
        edges = spanning_edges(to_frame(spark, topics), config).toPandas()
        for topic, points in topics.items():
            total = edges[edges.topic == topic].weight.sum()
            assert total == pytest.approx(clusters(points)[1], abs=1e-4)


def test_topics_with_bad_vectors_become_noise_alone(spark):
    topics = {"good": TOPICS["plain"], "nan": {1: [0.0, float("nan")], 2: [1.0, 1.0], 3: [0.0, 1.0]}}
    topics["uneven"] = {1: [0.0], 2: [1.0, 1.0], 3: [0.0, 1.0]}
    labels, failed = cluster_labels(to_frame(spark, topics))
    assert {r.topic for r in failed.collect()} == {"nan", "uneven"}
    assert found_sets(labels)["good"] == clusters(TOPICS["plain"])[0]
    assert {r.topic for r in labels.select("topic").distinct().collect()} == {"good"}


def test_core_distances_in_blocks(spark, two_usual_blocks):
    topics = {k: TOPICS[k] for k in ("copies", "ties", "tight")}
    expected = None
    for min_samples in (1, 4):
        for layout in LAYOUTS:
            config = replace(ClusterConfig(), min_samples=min_samples, **layout)
            found = core_distances(to_frame(spark, topics), config).toPandas()
            found = found.sort_values(["topic", "query_id"]).reset_index(drop=True).round(9)
            if layout:
                assert found.equals(expected)
            expected = found
        for row in expected.itertuples():
            points = topics[row.topic]
            others = sorted(
                math.dist(points[row.query_id], v) for i, v in points.items() if i != row.query_id
            )
            assert row.core == pytest.approx(others[min_samples - 1], abs=1e-5)


def test_clusters_are_numbered_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(labels, "RANK_RANGES", 7)
    rng = random.Random(4)
    ids = {t: sorted(rng.sample(range(10**9), 60)) for t in "ab"}
    ids["one"] = [5]
    rows = [(t, i, f"{t}{i}") for t, members in ids.items() for i in members]
    rows += [(t, i + 1, leaf) for t, i, leaf in rows]
    found = labels.number_clusters(spark.createDataFrame(rows, "topic string, rid bigint, leaf string"))
    numbers = {(r.topic, r.rid): r.label for r in found.collect()}
    assert len(numbers) == len(rows)
    for t, members in ids.items():
        assert [numbers[t, i] for i in members] == list(range(len(members)))


def test_groups_may_span_batches():
    from searchloom.operators.density.tiles import per_group

    table = pa.table({"k": ["a"] * 5 + ["b"] + ["c"] * 7, "v": list(range(13))})
    schema = pa.schema([("k", pa.string()), ("n", pa.int64())])

    def work(group):
        return pa.record_batch([[group["k"][0].as_py()], [len(group)]], schema=schema)

    for size in (1, 2, 3, 5, 20):
        got = [b.to_pylist()[0] for b in per_group(["k"], work)(iter(table.to_batches(size)))]
        assert [(g["k"], g["n"]) for g in got] == [("a", 5), ("b", 1), ("c", 7)]
