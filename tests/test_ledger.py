"""Answers of plugged-in models are kept as they come, and runs that broke off go on."""

import os

import pytest

from searchloom.operators import embedding, seo
from searchloom.operators.embedding import embed_queries
from searchloom.session import remove_path, stage, stages_of_a_run


def logged(path):
    return sorted(path.read_text().split()) if path.exists() else []


def test_a_run_that_died_asks_only_for_what_is_missing(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(embedding, "CALLS_PER_WAVE", 1)
    calls, broken = tmp_path / "calls", tmp_path / "broken"
    queries = spark.createDataFrame([(i, f"q{i}") for i in range(64)], "query_id bigint, query string")

    def embedder(texts):
        with open(calls, "a") as f:
            f.write("".join(f"{t}\n" for t in texts))
        if not broken.exists() and sum(1 for _ in open(calls)) > 40:
            broken.touch()
            os._exit(1)  # the worker dies, and its task with it
        return [[float(t[1:]), 1.0] for t in texts]

    ledger = f"{tmp_path}/ledger"
    with pytest.raises(Exception, match="."):
        embed_queries(queries, 2, embedder, ledger=ledger)
    before = logged(calls)
    kept = {r.query_id for r in spark.read.parquet(f"{ledger}/wave=*").select("query_id").collect()}
    assert kept and len(before) < 64
    found = embed_queries(queries, 2, embedder, ledger=ledger)
    assert {r.query_id: r.embedding[0] for r in found.collect()} == {i: float(i) for i in range(64)}
    again = logged(calls)
    assert all(again.count(f"q{i}") == 1 for i in kept)
    assert max(again.count(f"q{i}") for i in range(64)) <= 2
    embed_queries(queries, 2, embedder, ledger=ledger).count()
    assert logged(calls) == again


def test_generator_answers_are_kept(spark, tmp_path):
    calls = tmp_path / "calls"
    prompts = spark.createDataFrame(
        [(f"c{i}", i, f"p{i}") for i in range(30)], "cluster string, cluster_size bigint, prompt string"
    )

    def generator(prompt):
        with open(calls, "a") as f:
            f.write(f"{prompt}\n")
        if prompt == "p7":
            raise ValueError("no answer")
        return prompt.upper()

    for _ in range(2):
        found = seo.run_generator(prompts, generator, f"{tmp_path}/ledger").collect()
        assert len(found) == 30
        assert {(r.cluster, r.answer, r.error) for r in found if r.cluster in ("c7", "c8")} == {
            ("c7", None, "ValueError: no answer"),
            ("c8", "P8", None),
        }
    assert logged(calls) == sorted(f"p{i}" for i in range(30))


def test_no_rows_make_no_calls(spark):
    none = spark.createDataFrame([], "query_id bigint, query string")
    assert embed_queries(none, 2, lambda texts: [[1.0]] * len(texts)).count() == 0


def test_stages_of_a_run_are_removed(spark, tmp_path):
    rows = spark.range(10)

    def there(path):
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)

    with stages_of_a_run(spark) as outer:
        first = stage(rows, "first")
        with stages_of_a_run(spark) as inner:
            assert stage(first, "second").count() == 10
        assert len(inner) == 1 and not there(inner[0]) and there(outer[0])
        assert first.count() == 10
    assert len(outer) == 1 and not there(outer[0])
    with pytest.raises(KeyError), stages_of_a_run(spark) as failed:
        stage(rows, "third")
        raise KeyError
    assert there(failed[0])
    remove_path(spark, failed[0])
    assert not there(failed[0])
