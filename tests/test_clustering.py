"""Capping, validation, noise and the first-topic rule on hand-traced rows."""

import random
from dataclasses import replace

import pytest

from searchloom.config import ClusterConfig
from searchloom.operators import validation
from searchloom.operators.clustering import (
    cluster_queries,
    finish_clusters,
    topic_members,
)
from searchloom.operators.topics import explode_topics, topic_sizes

EMBEDDED = "query_id bigint, query string, user string, topics array<string>, embedding array<double>"
LABELS = "topic string, query_id bigint, label int"

HAND_MADE = [
    (1, "a", "u1", [1.0, 0.0, 0.0]),
    (2, "b", "u2", [0.9, 0.1, 0.0]),
    (3, "c", "u3", [0.95, 0.05, 0.0]),
    (4, "d", "u1", [0.8, 0.3, 0.0]),
    (5, "e", None, [0.97, 0.0, 0.1]),
    (6, "f", "u2", [0.0, 1.0, 0.0]),
]


def finish(spark, rows, labels, **params):
    config = replace(ClusterConfig(), **params)
    queries = spark.createDataFrame(rows, EMBEDDED)
    given = spark.createDataFrame(labels, LABELS)
    return finish_clusters(queries, topic_members(queries, config), given, config)


def test_hand_made_cluster(spark):
    rows = [(i, q, u, ["T"], v) for i, q, u, v in HAND_MADE]
    result = finish(spark, rows, [("T", i, 0) for i in range(1, 7)])
    (meta,) = result.metadata.collect()
    assert meta.asDict() == {
        "topic": "T", "cluster_label": "T_0", "n_queries": 5, "avg_similarity": 0.9758,
        "unique_users": 4, "most_central_query": "b", "seo_candidate": "true",
        "rejection_reasons": None,
    }
    assert {r.query: r.cluster for r in result.clustered.collect()} == {q: "T_0" for q in "abcde"}
    assert result.rejected.count() == 0


def test_first_topic_wins(spark):
    topics = {1: ["A", "B"], 2: ["B"], 3: ["B", "A"], 4: ["C", "B"], 5: []}
    rows = [(i, f"q{i}", f"u{i}", t, [1.0, i / 100]) for i, t in topics.items()]
    labels = [("A", 1, -1), ("A", 3, -1), ("C", 4, -1), *[("B", i, 0) for i in (1, 2, 3, 4)]]
    result = finish(spark, rows, labels, min_cluster_size=2)
    found = {r.query: r.cluster for r in result.clustered.collect()}
    assert found == {"q1": "A_-1", "q3": "A_-1", "q2": "B_0", "q4": "B_0"}
    (meta,) = result.metadata.collect()
    assert (meta.cluster_label, meta.n_queries) == ("B_0", 4)


def test_equal_queries_with_equal_topics_come_out_once(spark):
    rows = [(i, "same", f"u{i}", ["A"], [1.0, i / 100]) for i in range(3)]
    rows.append((7, "same", "u7", ["A", "B"], [1.0, 0.5]))
    result = finish(spark, rows, [("A", i, 0) for i in (0, 1, 2, 7)])
    found = sorted((r.user, tuple(r.topics), r.cluster) for r in result.clustered.collect())
    assert [f[1:] for f in found] == [(("A",), "A_0"), (("A", "B"), "A_0")]


def test_reasons(spark):
    near, far = [[1.0, 0.0], [1.0, 0.01], [0.99, 0.0]], [[1.0, 0.0], [0.0, 1.0], [-1.0, 0.0]]
    groups = {
        0: (near, ["u1", "u2", "u3"]),
        1: (near, ["u1", "u1", "u1"]),
        2: (far, ["u1", "u2", "u3"]),
        3: (near[:2], ["u1", "u2"]),
        4: (far[::2], ["u1", "u1"]),
    }
    rows, labels = [], []
    for label, (vectors, users) in groups.items():
        for vector, user in zip(vectors, users):
            i = len(rows)
            rows.append((i, f"q{i}", user, ["T"], vector))
            labels.append(("T", i, label))
    result = finish(spark, rows, labels)
    assert [r.cluster_label for r in result.metadata.collect()] == ["T_0"]
    reasons = {r.cluster_label: r.rejection_reasons for r in result.rejected.collect()}
    assert reasons == {
        "T_1": ["not enough unique users: 1 (min 3)"],
        "T_2": ["low avg similarity: -0.3333 (min 0.6)"],
        "T_3": ["too few queries: 2 (min 3)", "not enough unique users: 2 (min 3)"],
        "T_4": [
            "too few queries: 2 (min 3)",
            "low avg similarity: -1.0000 (min 0.6)",
            "not enough unique users: 1 (min 3)",
        ],
    }
    found = {r.query: r.cluster for r in result.clustered.collect()}
    assert {q for q, c in found.items() if c == "T_0"} == {"q0", "q1", "q2"}
    assert len(found) == len(rows) and set(found.values()) == {"T_0", "T_-1"}


def test_large_clusters_are_capped_in_salted_parts(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, f"q{i}", f"u{i}", ["T"], [1.0, rng.random(), rng.random()]) for i in range(200)]
    labels = [("T", i, 0 if i < 150 else 1) for i in range(200)]
    expected = finish(spark, rows, labels, min_cluster_similarity=0.0)
    expected = sorted(map(str, expected.assignments.collect()))
    assert len(expected) == 10
    monkeypatch.setattr(validation, "HOT_ROWS", 20)
    monkeypatch.setattr(validation, "MOST_HOT", 50)
    salted = finish(spark, rows, labels, min_cluster_similarity=0.0)
    assert sorted(map(str, salted.assignments.collect())) == expected


def test_cap_of_one_has_no_cohesion(spark):
    rows = [(i, q, u, ["T"], v) for i, q, u, v in HAND_MADE]
    result = finish(spark, rows, [("T", i, 0) for i in range(1, 7)], max_cluster_size=1)
    (meta,) = result.rejected.collect()
    assert meta.n_queries == 1 and meta.seo_candidate == "false"
    assert str(meta.avg_similarity) == "nan"


def test_small_topics_are_noise_and_no_topics_vanish(spark):
    rows = [
        (1, "a", "u", ["S"], [1.0, 0.0]),
        (2, "b", "u", ["S"], [1.0, 0.0]),
        (3, "c", "u", [], [1.0, 0.0]),
        (4, "d", "u", [""], [1.0, 0.0]),
    ]
    result = cluster_queries(spark.createDataFrame(rows, EMBEDDED))
    assert {r.query: r.cluster for r in result.clustered.collect()} == {
        "a": "S_-1", "b": "S_-1", "d": "_-1",
    }
    assert result.metadata.count() == 0 and result.metadata.columns[0] == "topic"


def test_topic_rows(spark):
    rows = [(1, "a", "u", ["x", "y", "x"], [1.0]), (2, "b", "u", ["y"], [1.0])]
    queries = spark.createDataFrame(rows, EMBEDDED)
    exploded = explode_topics(queries)
    assert sorted((r.query_id, r.topic, r.pos, r.first_pos) for r in exploded.collect()) == [
        (1, "x", 0, 0), (1, "x", 2, 0), (1, "y", 1, 1), (2, "y", 0, 0),
    ]
    sizes = {r.topic: tuple(r)[1:] for r in topic_sizes(exploded).collect()}
    assert sizes == {"x": (2, 1, 0), "y": (2, 1, 1)}
    text = spark.createDataFrame([(1, "a", "u", "x, ,y")], "query_id int, query string, user string, topics string")
    assert [r.topic for r in explode_topics(text).collect()] == ["x", "y"]


def planted(seed=3, n=60):
    """Three tight groups and scattered rest, under two topics."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if i < 18:
            base = [1.0 if k == i % 3 else 0.0 for k in range(6)]
            v = [x + rng.gauss(0, 0.01) for x in base]
        else:
            v = [rng.gauss(0, 1) for _ in range(6)]
        topics = [["A"], ["A", "B"], ["B", "A"]][rng.randrange(3)]
        rows.append((i, f"q{i}", f"u{i % 7}", topics, v))
    return rows


def as_sets(result):
    found = {}
    for r in result.clustered.collect():
        found.setdefault(r.cluster, set()).add(r.query)
    return found


@pytest.mark.parametrize("tile_rows", [6000, 30])
def test_invariants_whatever_the_layout(spark, tile_rows):
    rows = planted()
    queries = spark.createDataFrame(rows, EMBEDDED)
    expected = as_sets(cluster_queries(queries))
    assert {c for c in expected if not c.endswith("-1")} >= {"A_0", "A_1", "A_2"}
    random.Random(1).shuffle(rows)
    other = spark.createDataFrame(rows, EMBEDDED).repartition(5)
    result = cluster_queries(other, tile_rows=tile_rows)
    assert as_sets(result) == expected
    assert all(len(m) <= 5 for c, m in expected.items() if not c.endswith("-1"))
    queries_out = [r.query for r in result.clustered.collect()]
    assert len(queries_out) == len(set(queries_out))


def test_a_topic_with_bad_vectors_does_not_stop_the_others(spark):
    rows = planted()
    rows += [(100 + i, f"bad{i}", "u", ["bad"], [float("nan")] * 6) for i in range(4)]
    result = cluster_queries(spark.createDataFrame(rows, EMBEDDED))
    found = as_sets(result)
    assert found["bad_-1"] == {f"bad{i}" for i in range(4)}
    assert "A_0" in found
    assert [r.topic for r in result.failed_topics.collect()] == ["bad"]


def test_topics_as_text(spark):
    rows = [(i, q, u, ", ".join(t), v) for i, q, u, t, v in planted()]
    text = spark.createDataFrame(rows, EMBEDDED.replace("topics array<string>", "topics string"))
    lists = spark.createDataFrame(planted(), EMBEDDED)
    found = cluster_queries(text).clustered
    assert found.schema["topics"].dataType.simpleString() == "array<string>"
    expected = cluster_queries(lists).clustered
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_parameters_are_checked(spark):
    queries = spark.createDataFrame(planted(), EMBEDDED)
    with pytest.raises(TypeError, match="min_size"):
        cluster_queries(queries, min_size=2)
    with pytest.raises(ValueError, match="min_cluster_size"):
        cluster_queries(queries, min_cluster_size=1)
    vectors = queries.select("query_id", "embedding").where("query_id > 3")
    with pytest.raises(ValueError, match="do not belong"):
        cluster_queries(queries.drop("embedding"), vectors)
