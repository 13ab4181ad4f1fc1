"""Sources, sinks, the report and whole runs."""

import json

import pytest
from pyspark.sql import functions as F

from searchloom import schemas
from searchloom.config import PERMISSIVE, ClusterConfig, PipelineConfig, get_pipeline_config
from searchloom.operators.report import cluster_report, generate_cluster_report
from searchloom.plans import adapters
from searchloom.plans.pipeline import run_pipeline, run_pipeline_from_notebook
from searchloom.session import shared_dir
from searchloom.sources import (
    load_queries_from_table,
    read_csv_dbfs,
    read_json_dbfs,
    write_csv_dbfs,
    write_json_dbfs,
)

SMALL = "/root/testdata/sf0.001"

ODD = [
    (1, 'say "hi", then go', "a,b", "u1"),
    (2, "two\nlines", None, None),
    (3, "  blanks  ", "", "NA"),
    (4, "é ñ 日本 \\ back", " ", "null"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, schemas.RAW_QUERIES)


def test_csv_round_trip(spark, odd, tmp_path):
    path = f"{tmp_path}/deep/er/log.csv"
    write_csv_dbfs(odd, path)
    back = read_csv_dbfs(spark, path, schemas.RAW_QUERIES)
    missing = [tuple(v or None for v in row) for row in ODD]
    assert sorted(map(tuple, back.collect())) == missing
    write_csv_dbfs(odd.limit(1).withColumn("topics", F.split("topic", ",")), path)
    (row,) = read_csv_dbfs(spark, path).collect()
    assert json.loads(row.topics) == ["a", "b"] and row.query_id == "1"
    write_csv_dbfs(odd, path, sep=";")
    assert read_csv_dbfs(spark, path, schemas.RAW_QUERIES, sep=";").count() == 4


def test_json_round_trip(spark, odd, tmp_path):
    path = f"{tmp_path}/deep/log.json"
    write_json_dbfs(odd, path)
    back = read_json_dbfs(spark, path, schemas.RAW_QUERIES)
    assert sorted(map(tuple, back.collect())) == sorted(ODD)
    assert "日本" in "".join(r.value for r in spark.read.text(path).collect())
    (tmp_path / "one.json").write_text(json.dumps([{"a": 1}, {"a": 2}], indent=2))
    one = read_json_dbfs(spark, f"{tmp_path}/one.json", "a int", multi_line=True)
    assert [r.a for r in one.collect()] == [1, 2]


def test_table_source(spark, odd):
    odd.createOrReplaceTempView("odd_log")
    first = load_queries_from_table(spark, "odd_log", limit=2)
    assert first.columns == ["query_id", "query", "topic", "user_id"]
    assert sorted(r.query_id for r in first.collect()) == [1, 2]
    last = spark.table("odd_log").withColumn("at", -F.col("query_id")).drop("query_id")
    last.createOrReplaceTempView("odd_log_by_at")
    by_at = load_queries_from_table(spark, "odd_log_by_at", 2, order_col="at")
    assert sorted(r.query_id for r in by_at.collect()) == [-4, -3]
    assert sorted(r.query_id for r in load_queries_from_table(spark, "odd_log", 10**9).collect()) == sorted(
        r[0] for r in ODD
    )
    assert load_queries_from_table(spark, "odd_log", 0).count() == 0
    wide = spark.range(3000).select((F.col("id") * 1_000_003 - 7).alias("query_id"), *[F.lit("x").alias(c) for c in ("query", "topic", "user_id")])
    wide.createOrReplaceTempView("wide_log")
    some = load_queries_from_table(spark, "wide_log", 1234)
    assert some.agg(F.count("*"), F.max("query_id")).first() == (1234, 1233 * 1_000_003 - 7)
    last.drop("at").createOrReplaceTempView("odd_log_bare")
    with pytest.raises(ValueError, match="order_col"):
        load_queries_from_table(spark, "odd_log_bare")


def test_configs():
    assert get_pipeline_config()["clustering"] == {
        "min_cluster_size": 2, "max_cluster_size": 5, "min_cluster_similarity": 0.1,
        "min_seo_similarity": 0.3, "min_unique_users": 1,
    }
    assert PERMISSIVE.cluster.min_unique_users == 1
    assert ClusterConfig().min_cluster_similarity == 0.6
    assert PipelineConfig().with_params(dim=8, min_length=1).embed.dim == 8
    with pytest.raises(TypeError, match="colour"):
        PipelineConfig().with_params(colour="red")


def test_report(spark, tmp_path):
    rows = [
        ("A", "A_1", 3, 0.9, 3, "first", "true", None),
        ("A", "A_0", 4, 0.7, 3, "second", "false", None),
    ]
    meta = spark.createDataFrame(rows, schemas.CLUSTER_METADATA)
    order = ["section", "cluster_label", "line_number"]
    lines = [r.line for r in cluster_report(meta, "now").orderBy(*order).collect()]
    assert lines[:7] == [
        "=" * 60, "CLUSTER ANALYSIS REPORT", "=" * 60, "Generated: now", "",
        "=== SEO CANDIDATE CLUSTERS ===", "",
    ]
    assert lines[7:13] == [
        "\U0001F4C8 SEO Candidate: A_1", "   Topic: A", "   Queries: 3", "   Avg Similarity: 0.9",
        "   Unique Users: 3", "   Representative: first",
    ]
    assert lines[13:15] == ["", "Total SEO Candidates: 1"]
    assert lines[-8:] == [
        "", "=== Cluster A_1 ===", "Number of queries: 3", "Average similarity: 0.9",
        "Unique users: 3", "Representative: first", "", "Total Valid Clusters: 2",
    ]
    assert "=== Cluster A_0 ===" in lines
    generate_cluster_report(meta, f"{tmp_path}/report.txt")
    written = [r.value for r in spark.read.text(f"{tmp_path}/report.txt").collect()]
    assert "Generated: now" not in written and "Total Valid Clusters: 2" in written


def planted_log(spark):
    """Three groups of near-equal questions and some single ones."""
    subjects = ["treating early stage diabetes", "air purifiers against asthma", "reading old maps"]
    rows = []
    for s, subject in enumerate(subjects):
        for i in range(5):
            rows.append((f"what is known about {subject} and similar matters part{i}" , f"T{s % 2},Z", f"u{i}"))
    for i in range(12):
        words = " ".join(f"w{i * 17 + k}x{k * i}" for k in range(9))
        rows.append((words, "T0,Z", f"u{i}"))
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "query_id bigint, query string, topic string, user_id string"
    )


def test_run_to_a_table(spark, tmp_path):
    planted_log(spark).createOrReplaceTempView("planted_log")
    result = run_pipeline(
        "planted_log", "planted_seo", queries_per_cluster=2, output_path=f"{tmp_path}/seo", language_filter=False
    )
    stats = result.statistics.first()
    assert stats.total_queries == 27 and stats.valid_clusters >= 3
    assert stats.total_seo_queries == spark.table("planted_seo").count()
    seo = {r.cluster for r in spark.table("planted_seo").collect()}
    clustered = {r.query: r.cluster for r in result.clustered_queries.collect()}
    diabetes = {c for q, c in clustered.items() if "diabetes" in q}
    assert len(diabetes) == 1 and diabetes <= seo
    assert result.cluster_metadata.schema.fieldNames() == schemas.CLUSTER_METADATA.fieldNames()
    assert result.clustered_queries.schema.simpleString() == schemas.CLUSTERED_QUERIES.simpleString()
    spark.sql("DROP TABLE planted_seo")


def test_run_on_a_frame_writes_all_outputs(spark, tmp_path):
    result = run_pipeline_from_notebook(
        planted_log(spark), f"{tmp_path}/out", generator=lambda prompt: "a question\nanother", language_filter=False
    )
    assert {r.seo_query for r in result.seo_queries.collect()} == {"a question"}
    clustered = read_csv_dbfs(spark, f"{tmp_path}/out/clustered_queries.csv")
    assert clustered.count() == 27
    audit = result.audit.first()
    assert audit.final == 27 == audit.original - audit.removed_duplicates - audit.removed_length
    assert result.failed_topics.count() == 0
    assert result.assignments.count() == 27 and "query_id" in result.assignments.columns
    meta = read_json_dbfs(
        spark, f"{tmp_path}/out/cluster_metadata.json", schemas.CLUSTER_METADATA
    )
    assert meta.count() == result.statistics.first().valid_clusters
    for name in ("filtered_queries.csv", "seo_queries.csv", "cluster_report.txt"):
        assert spark.read.text(f"{tmp_path}/out/{name}").count() > 0


def test_run_without_clusters_and_without_rows(spark, tmp_path):
    log = adapters.doc_log(spark, SMALL)
    result = run_pipeline(
        df=log, output_table="no_seo", output_path=f"{tmp_path}/seo", language_filter=False
    )
    assert tuple(result.statistics.first()) == (result.filtered_queries.count(), 0, 0, 0)
    assert spark.table("no_seo").count() == 0
    spark.sql("DROP TABLE no_seo")
    assert {r.cluster for r in result.clustered_queries.select("cluster").distinct().collect()} == {
        "en_-1", "fr_-1", "de_-1", "es_-1",
    }
    with pytest.raises(ValueError, match="No queries remain"):
        run_pipeline(df=log, min_length=10**9, language_filter=False)
    with pytest.raises(ValueError, match="input_table or df"):
        run_pipeline()
    with pytest.raises(TypeError, match="batchsize"):
        run_pipeline(df=log, batchsize=3)


class Settings:
    """A session reduced to what the choice of a folder looks at."""

    def __init__(self, **settings):
        self.settings = {k.replace("_", "."): v for k, v in settings.items()}
        self.conf = self.sparkContext = self
        self.applicationId = "app"

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_shared_folder_comes_from_the_session():
    assert shared_dir(Settings(spark_checkpoint_dir="s3://a/b/", spark_master="yarn")) == "s3://a/b"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Settings(spark_master="yarn"))
    local = Settings(spark_master="local[2]")
    assert shared_dir(local) == shared_dir(local)
