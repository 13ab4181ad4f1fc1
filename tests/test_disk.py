"""What a run leaves on disk while it goes on: stages, shuffles, and copies of vectors."""

import time
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_density import cloud, to_frame

from searchloom.config import ClusterConfig
from searchloom.operators.density import blocks, cluster_labels
from searchloom.operators.language import train_language_model
from searchloom.session import passing_stages, stage, stages_of_a_run


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def left_over(spark, before):
    """New shuffle files, once those being removed had time to go."""
    for _ in range(40):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.25)
    return left


def test_a_stage_leaves_no_shuffle(spark):
    before = shuffle_files(spark)
    written = stage(spark.range(1000).repartition(3, "id").groupBy(F.col("id") % 7).count(), "counted")
    assert not left_over(spark, before)
    assert written.agg(F.sum("count")).first()[0] == 1000


def test_training_leaves_no_shuffle(spark):
    texts = spark.createDataFrame([("the house", "en"), ("das haus", "de")] * 20, "text string, lang string")
    before = shuffle_files(spark)
    train_language_model(texts.repartition(3, "text"))
    assert not left_over(spark, before)


def test_passing_stages_keep_only_what_is_named(spark):
    with stages_of_a_run(spark) as run:
        with passing_stages(spark) as keep:
            first = stage(spark.range(5), "first")
            kept = keep(first.select((F.col("id") + 1).alias("id")), "kept")
        assert [p.rsplit("/", 1)[1].split("-")[0] for p in run] == ["kept"]
        assert kept.agg(F.sum("id")).first()[0] == 15
        with pytest.raises(Exception):
            first.count()


def test_clustering_leaves_labels_alone(spark):
    config = replace(ClusterConfig(), tile_rows=40)
    with stages_of_a_run(spark) as run:
        labels, failed = cluster_labels(to_frame(spark, {"t": cloud(3, 200, 2), "u": cloud(4, 20, 2)}), config)
        assert {p.rsplit("/", 1)[1].rsplit("-", 1)[0] for p in run} == {"query-labels", "failed-topics"}
        assert labels.count() == 220 and failed.isEmpty()


def test_rounds_send_a_vector_twice_and_meet_every_pair_once(spark, monkeypatch):
    monkeypatch.setattr(blocks, "ROUND_BYTES", 0)
    points = spark.createDataFrame(
        [(f"t{n}", 10 * g + k, g, n, [0.0]) for n in range(1, 8) for g in range(n) for k in range(2)],
        "topic string, rid bigint, group int, groups int, embedding array<double>",
    )
    met = Counter()
    for r in blocks.rounds_of(points, 2, 100):
        sent = blocks.pair_up(points.drop("embedding"), r.tasks, r.low, r.high)
        dealt = sent.withColumn("task", F.spark_partition_id())
        rows = dealt.collect()
        assert max(Counter((x.topic, x.rid) for x in rows).values()) <= 2
        assert all(x.group in (x.gi, x.gj) and x.gi <= x.gj for x in rows)
        pairs = {(x.topic, x.gi, x.gj, x.task) for x in rows}
        met.update(p[:3] for p in pairs)
    assert met == Counter((f"t{n}", i, j) for n in range(1, 8) for j in range(n) for i in range(j + 1))
