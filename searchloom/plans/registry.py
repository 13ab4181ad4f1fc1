"""Named queries over the sample tables, one or more per operator.

Each takes a session and the folder of the tables and reads whole tables.
Lists are joined to strings and doubles rounded, so that results can be compared
with other engines value by value.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from searchloom import schemas
from searchloom.config import ClusterConfig, LoadConfig
from searchloom.functions.text import clean_query, parse_topics, parse_topics_no_blanks
from searchloom.operators import clustering, embedding, filters, language, profile, seo, topics
from searchloom.operators import validation
from searchloom.operators.density import cluster_labels, core_distances
from searchloom.operators.density.labels import spanning_edges, tile_labels
from searchloom.operators.report import cluster_report
from searchloom.plans import adapters
from searchloom.plans.pipeline import run_pipeline, run_pipeline_from_notebook, run_statistics
from searchloom.session import new_path, stage
from searchloom.sources import files, tables

Query = Callable[[SparkSession, str], DataFrame]

NO_LANGUAGE = LoadConfig(language_filter=False)
# Thresholds under which the sample vectors give valid and rejected clusters of every kind.
SAMPLE_CLUSTERS = ClusterConfig(
    min_cluster_similarity=0.0, min_seo_similarity=0.05, min_unique_users=4
)


def joined(column: Column | str, by: str = "|") -> Column:
    return F.array_join(column, by)


def round6(column: Column | str) -> Column:
    return F.round(column, 6)


# Sources and sinks


def table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    adapters.doc_log(spark, sf_dir).createOrReplaceTempView("searchloom_doc_log")
    return tables.load_queries_from_table(spark, "searchloom_doc_log", limit=100)


def table_scan_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    adapters.doc_log(spark, sf_dir).createOrReplaceTempView("searchloom_doc_log")
    return tables.load_queries_from_table(spark, "searchloom_doc_log")


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "csv")
    files.write_csv_dbfs(adapters.doc_log(spark, sf_dir), path)
    return files.read_csv_dbfs(spark, path, schemas.RAW_QUERIES)


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "json")
    files.write_json_dbfs(adapters.conv_log(spark, sf_dir), path)
    return files.read_json_dbfs(spark, path, schemas.RAW_QUERIES)


def json_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, one array of records per file, written and read back."""
    path = new_path(spark, "json-documents")
    files.write_json_documents(adapters.conv_log(spark, sf_dir), path)
    return files.read_json_dbfs(spark, path, schemas.RAW_QUERIES, multi_line=True)


def csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks, written as CSV of which every line is a row."""
    path = new_path(spark, "csv-lines")
    docs = adapters.documents(spark, sf_dir)
    broken = docs.select("doc_id", F.regexp_replace("text", "([.,]) ", "$1\\\\\n").alias("text"), "lang")
    files.write_csv_dbfs(broken, path)
    back = files.read_csv_dbfs(spark, path, "doc_id bigint, text string, lang string")
    lines = spark.read.text(path).where(~F.col("value").startswith("doc_id,"))
    return back.crossJoin(lines.agg(F.count(F.lit(1)).alias("n_lines")))


def table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "table")
    name = "searchloom_" + path.rsplit("-", 1)[1]
    tables.write_table(adapters.conv_log(spark, sf_dir), name, path)
    return spark.table(name)


# Filters


def _filtered(log: DataFrame, config: LoadConfig = NO_LANGUAGE) -> DataFrame:
    return filters.filter_queries(log, config).withColumn("topics", joined("topics"))


def filter_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(adapters.doc_log_multi(spark, sf_dir))


def filter_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _filtered(adapters.conv_log(spark, sf_dir))


def filter_without_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = LoadConfig(min_length=0, require_topics=False, language_filter=False)
    return _filtered(adapters.conv_log(spark, sf_dir).drop("topic", "user_id"), config)


def filter_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.train_language_model(adapters.documents(spark, sf_dir))
    kept = filters.filter_queries(adapters.doc_log(spark, sf_dir), LoadConfig(), model)
    return kept.withColumn("topics", joined("topics"))


def drop_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = filters.mark_drops(adapters.conv_log(spark, sf_dir), NO_LANGUAGE)
    return marked.select("query_id", "drop_reason")


def audit_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = filters.filter_audit(adapters.doc_log(spark, sf_dir), NO_LANGUAGE)
    return audit.withColumn("retention", round6("retention"))


def drop_reasons_with_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.train_language_model(adapters.documents(spark, sf_dir))
    marked = filters.mark_drops(adapters.doc_log(spark, sf_dir), LoadConfig(), model)
    return marked.select("query_id", "drop_reason")


def audit_with_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.train_language_model(adapters.documents(spark, sf_dir))
    audit = filters.filter_audit(adapters.doc_log(spark, sf_dir), LoadConfig(), model)
    return audit.withColumn("retention", round6("retention"))


def audit_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = filters.filter_audit(adapters.conv_log(spark, sf_dir), NO_LANGUAGE)
    return audit.withColumn("retention", round6("retention"))


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.documents(spark, sf_dir).select(
        "doc_id", clean_query("text").alias("query_clean")
    )


def parse_topic_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = adapters.documents(spark, sf_dir)
    return docs.select(
        "doc_id",
        F.size(parse_topics("text")).alias("n_topics"),
        F.size(parse_topics_no_blanks("text")).alias("n_filled"),
        joined(parse_topics("text")).alias("topics"),
        joined(parse_topics_no_blanks("text")).alias("filled"),
    )


# Language and profile


def detect_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = adapters.documents(spark, sf_dir)
    model = language.train_language_model(docs)
    found = language.detect_language(docs, model, "text")
    return found.select("doc_id", "language", (F.col("language") == "en").alias("is_english"))


def detect_with_saved_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`detect_languages`, with a model that was saved and loaded."""
    docs = adapters.documents(spark, sf_dir)
    path = new_path(spark, "language-model")
    language.save_language_model(spark, language.train_language_model(docs), path)
    model = language.load_language_model(spark, path)
    english = language.is_english(docs, model, "text").select("doc_id", "is_english")
    return language.detect_language(docs, model, "text").select("doc_id", "language").join(english, "doc_id")


def language_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = adapters.documents(spark, sf_dir)
    model = language.train_language_model(docs)
    return language.language_distribution(docs, model, "text")


def trigram_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.trigram_counts(adapters.documents(spark, sf_dir), "text", "lang")


def profile_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filters.filter_queries(adapters.doc_log(spark, sf_dir), NO_LANGUAGE)
    stats = profile.validate_query_data(kept)
    return stats.withColumn("avg_query_length", round6("avg_query_length"))


def profile_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = language.train_language_model(adapters.documents(spark, sf_dir))
    kept = filters.filter_queries(adapters.doc_log(spark, sf_dir), NO_LANGUAGE)
    stats = profile.validate_query_data(kept, model)
    return stats.select("total_queries", F.explode("languages").alias("language", "n_queries"))


# Embedding


def tfidf_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filters.filter_queries(adapters.doc_log(spark, sf_dir), NO_LANGUAGE)
    vectors = embedding.embed_queries(stage(kept, "filtered-queries"))
    return (
        vectors.select("query_id", F.posexplode("embedding").alias("bucket", "weight"))
        .where(F.col("weight") != 0)
        .withColumn("weight", round6("weight"))
    )


def text_shape(texts: list[str]) -> Sequence[Sequence[float]]:
    """A stand-in for a model: length, blanks and commas of a text."""
    return [[len(t), t.count(" "), t.count(",")] for t in texts]


def embed_with_plugin(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries = adapters.conv_log(spark, sf_dir)
    vectors = embedding.embed_queries(queries, batch_size=16, embedder=text_shape)
    attached = embedding.add_embeddings_to_df(queries, vectors)
    return attached.select(
        "query_id",
        "user_id",
        *[F.col("embedding")[k].alias(n) for k, n in enumerate(("length", "blanks", "commas"))],
    )


def vector_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = embedding.validate_embeddings(adapters.read(spark, sf_dir, "embeddings", "vec_id"))
    return stats.select(
        "count",
        "dimension",
        *[round6(c).alias(c) for c in ("mean_norm", "std_norm", "min_norm", "max_norm")],
    )


# Clustering


def topic_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = filters.filter_queries(adapters.doc_log_multi(spark, sf_dir), NO_LANGUAGE)
    rows = topics.size_topics(topics.explode_topics(kept), 30)
    return rows.select(
        "topic",
        "query_id",
        "pos",
        "topic_rows",
        "topic_first_id",
        "topic_first_pos",
        "clusterable",
    )


def _vector_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapters.vec_log(spark, sf_dir).select(
        F.col("topics")[0].alias("topic"), "query_id", F.lit(1).alias("copies"), "embedding"
    )


def core_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = core_distances(_vector_points(spark, sf_dir))
    return found.withColumn("core", F.round("core", 5))


def core_distance_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = core_distances(_vector_points(spark, sf_dir), ClusterConfig(tile_rows=40))
    return found.withColumn("core", F.round("core", 5))


def _tree_weights(edges: DataFrame) -> DataFrame:
    return edges.groupBy("topic", F.round("weight", 5).alias("weight")).agg(
        F.count(F.lit(1)).alias("n_edges")
    )


def tree_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tree_weights(spanning_edges(_vector_points(spark, sf_dir)))


def tree_weights_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = ClusterConfig(tile_rows=40)
    return _tree_weights(spanning_edges(_vector_points(spark, sf_dir), config))


def density_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_labels(_vector_points(spark, sf_dir))[0]


def density_labels_with_epsilon(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = ClusterConfig(min_cluster_size=2, cluster_selection_epsilon=1.2)
    return cluster_labels(_vector_points(spark, sf_dir), config)[0]


def density_labels_in_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_labels(_vector_points(spark, sf_dir), ClusterConfig(tile_rows=40))[0]


def density_labels_shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every coordinate moved by 1,000: the labels do not change."""
    moved = F.transform("embedding", lambda x: x + 1000.0)
    return cluster_labels(_vector_points(spark, sf_dir).withColumn("embedding", moved))[0]


def density_labels_with_outlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors of the ids divisible by 97 ten million times as long as the others."""
    far = F.when(F.col("query_id") % 97 == 0, 1e7).otherwise(1.0)
    points = _vector_points(spark, sf_dir).withColumn("embedding", F.transform("embedding", lambda x: x * far))
    return cluster_labels(points, ClusterConfig(tile_rows=40))[0]


def density_labels_of_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors under one topic, in two halves far apart; clusters of a hundred, through joins alone."""
    side = F.pmod(F.element_at(F.split("topic", "t"), -1).cast("int"), F.lit(2)) * 10.0
    points = _vector_points(spark, sf_dir).withColumn("embedding", F.transform("embedding", lambda x: x + side))
    config = ClusterConfig(min_cluster_size=100, tile_rows=80, tree_rows=250)
    return cluster_labels(points.withColumn("topic", F.lit("t")), config)[0]


def failing_solver(table: pa.Table, config: ClusterConfig) -> np.ndarray:
    """A solver that fails for some topics."""
    if table["topic"][0].as_py() in ("t3", "t8"):
        raise ArithmeticError("planted")
    return tile_labels(table, config)


def contained_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exception inside two topics: the others are labelled, these are named."""
    labels, failed = cluster_labels(_vector_points(spark, sf_dir), solver=failing_solver)
    return labels.unionByName(failed, allowMissingColumns=True)


def sample_members(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Vectors under two or three topics each, with labels that are given, not found."""
    vec_id = F.col("query_id")
    first = F.array(F.concat(F.lit("w"), (vec_id % 250).cast("string")))
    last = F.array(F.concat(F.lit("u"), (vec_id % 3).cast("string")))
    queries = adapters.vec_log(spark, sf_dir).withColumn(
        "topics",
        F.when(vec_id % 125 == 0, F.concat(first, "topics", last)).otherwise(
            F.concat("topics", last)
        ),
    )
    members = stage(
        clustering.topic_members(queries, SAMPLE_CLUSTERS), "sample-members"
    )
    modulus = F.when(F.col("topic").startswith("t"), 8).otherwise(11)
    labels = members.select(
        "topic", "query_id", (vec_id % modulus - 1).cast("int").alias("label")
    ).distinct()
    return queries.drop("embedding"), members, labels


def sample_clustering(spark: SparkSession, sf_dir: str) -> clustering.Clustering:
    return clustering.finish_clusters(*sample_members(spark, sf_dir), SAMPLE_CLUSTERS)


def capped_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, members, labels = sample_members(spark, sf_dir)
    labelled = members.where("clusterable").join(labels, ["topic", "query_id"])
    capped = validation.cap_clusters(labelled, SAMPLE_CLUSTERS)
    return capped.select("topic", "label", "query_id", "pos", "rank")


def capped_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_clustering(spark, sf_dir).capped_out


def failed_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics that hold a missing vector."""
    missing = F.when(F.col("query_id") % 250 != 7, F.col("embedding"))
    return cluster_labels(_vector_points(spark, sf_dir).withColumn("embedding", missing))[1]


def cluster_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, members, labels = sample_members(spark, sf_dir)
    labelled = members.where("clusterable").join(labels, ["topic", "query_id"])
    measured = validation.measure_clusters(validation.cap_clusters(labelled, SAMPLE_CLUSTERS))
    return measured.select(
        "topic", "label", "n_queries", round6("cohesion").alias("cohesion"), "unique_users"
    )


def valid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sample_clustering(spark, sf_dir).metadata.drop("rejection_reasons")


def rejected_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rejected = sample_clustering(spark, sf_dir).rejected
    return rejected.withColumn("rejection_reasons", joined("rejection_reasons", "; "))


def first_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered = sample_clustering(spark, sf_dir).clustered
    return clustered.withColumn("topics", joined("topics"))


# Generated queries, report, whole runs


def central_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seo.generate_seo_queries(sample_clustering(spark, sf_dir).assignments, 2)


def prompt_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prompts = seo.cluster_prompts(sample_clustering(spark, sf_dir).assignments, 2)
    lines = F.filter(F.split("prompt", "\n"), lambda t: t.startswith("- "))
    return prompts.select(
        "cluster",
        "cluster_size",
        seo.cluster_topic("cluster").alias("topic"),
        joined(F.transform(lines, lambda t: F.substr(t, F.lit(3))), "|").alias("examples"),
    )


def echo_examples(prompt: str) -> str:
    """A stand-in for a model: the examples of the prompt, or nothing for some topics."""
    if "Topic: u" in prompt:
        return " \n"
    return "\n".join(line[1:] for line in prompt.split("\n") if line.startswith("- "))


def generate_with_plugin(spark: SparkSession, sf_dir: str) -> DataFrame:
    assignments = sample_clustering(spark, sf_dir).assignments
    return seo.generate_seo_queries(assignments, 3, echo_examples)


def parsed_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = seo.parse_answer("text", 3)
    docs = adapters.documents(spark, sf_dir).select("doc_id", lines.alias("lines"))
    return docs.select(
        "doc_id", F.posexplode("lines").alias("pos", "line")
    ).select("doc_id", (F.col("pos") + 1).alias("query_number"), "line")


def fallbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat("lang", F.lit("_"), "source", F.lit("_0"))
    labels = adapters.documents(spark, sf_dir).select(
        F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("_"), label))
        .otherwise(label)
        .alias("cluster")
    )
    return labels.distinct().select(
        "cluster",
        F.posexplode(seo.fallback_queries(seo.cluster_topic("cluster"), 2)).alias(
            "pos", "seo_query"
        ),
    )


def seo_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    generated = seo.generate_seo_queries(sample_clustering(spark, sf_dir).assignments, 2)
    stats = seo.analyze_seo_results(generated)
    doubles = ("avg_cluster_size", "queries_per_cluster", "avg_query_length")
    return stats.select(
        "total_queries", "unique_clusters", *[round6(c).alias(c) for c in doubles]
    )


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_report(sample_clustering(spark, sf_dir).metadata)


def sample_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    queries, members, labels = sample_members(spark, sf_dir)
    result = clustering.finish_clusters(queries, members, labels, SAMPLE_CLUSTERS)
    generated = seo.generate_seo_queries(result.assignments, 2)
    return run_statistics(queries, result.metadata, generated)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run on all documents; one row per query with its cluster."""
    result = run_pipeline(df=adapters.doc_log(spark, sf_dir), language_filter=False)
    return result.clustered_queries.withColumn("topics", joined("topics"))


def flagship_one_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run with all documents under one topic, larger than a tile and than a task's tree."""
    log = adapters.doc_log(spark, sf_dir).withColumn("topic", F.lit("all"))
    result = run_pipeline(df=log, language_filter=False, tile_rows=150, tree_rows=500)
    return result.clustered_queries.withColumn("topics", joined("topics"))


def flagship_generated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole run on English documents under two topics each; generated queries."""
    model = language.train_language_model(adapters.documents(spark, sf_dir))
    result = run_pipeline(
        df=adapters.doc_log_multi(spark, sf_dir), language_model=model, queries_per_cluster=2
    )
    return result.seo_queries


def flagship_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of a whole run on conversations with the permissive thresholds."""
    return run_pipeline(
        df=adapters.conv_log(spark, sf_dir),
        language_filter=False,
        min_cluster_size=2,
        min_cluster_similarity=0.1,
        min_seo_similarity=0.3,
        min_unique_users=1,
    ).statistics


def _notebook_run(spark: SparkSession, sf_dir: str) -> str:
    """Run on conversations with the permissive thresholds, and where the outputs are."""
    path = new_path(spark, "notebook")
    run_pipeline_from_notebook(
        adapters.conv_log(spark, sf_dir),
        path,
        language_filter=False,
        min_cluster_size=2,
        min_cluster_similarity=0.1,
        min_seo_similarity=0.3,
        min_unique_users=1,
    )
    return path


def notebook_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that writes its five outputs, and how many rows three of them read back as."""
    path = _notebook_run(spark, sf_dir)
    metadata = files.read_json_dbfs(spark, f"{path}/cluster_metadata.json", schemas.CLUSTER_METADATA)
    return run_statistics(
        files.read_csv_dbfs(spark, f"{path}/filtered_queries.csv"),
        metadata,
        files.read_csv_dbfs(spark, f"{path}/seo_queries.csv"),
    )


def notebook_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five outputs of a run, read back and laid one below the other."""
    path = _notebook_run(spark, sf_dir)

    def shown(name: str, df: DataFrame, columns: Sequence[Column | str]) -> DataFrame:
        cells = [F.col(c) if isinstance(c, str) else c for c in columns]
        cells += [F.lit(None)] * (5 - len(cells))
        named = [c.cast("string").alias(f"c{i}") for i, c in enumerate(cells)]
        return df.select(F.lit(name).alias("output"), *named)

    def topics() -> Column:
        return joined(F.from_json("topics", "array<string>"))

    metadata = files.read_json_dbfs(spark, f"{path}/cluster_metadata.json", schemas.CLUSTER_METADATA)
    parts = [
        shown(
            "filtered_queries",
            files.read_csv_dbfs(spark, f"{path}/filtered_queries.csv"),
            ["query_id", "query", "user", topics()],
        ),
        shown(
            "clustered_queries",
            files.read_csv_dbfs(spark, f"{path}/clustered_queries.csv"),
            ["query", "user", topics(), "cluster"],
        ),
        shown(
            "cluster_metadata",
            metadata,
            [
                "cluster_label",
                "n_queries",
                F.format_string("%.4f", "avg_similarity"),
                "unique_users",
                F.concat_ws("/", "topic", "most_central_query", "seo_candidate"),
            ],
        ),
        shown(
            "seo_queries",
            files.read_csv_dbfs(spark, f"{path}/seo_queries.csv"),
            ["cluster", "seo_query", "query_number", "cluster_size"],
        ),
        shown("cluster_report", spark.read.text(f"{path}/cluster_report.txt"), ["value"]),
    ]
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    return rows


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        table_scan,
        table_scan_whole,
        csv_round_trip,
        json_round_trip,
        json_document,
        csv_lines,
        table_round_trip,
        filter_documents,
        filter_conversations,
        filter_without_topics,
        filter_by_language,
        drop_reasons,
        drop_reasons_with_language,
        audit_with_language,
        audit_documents,
        audit_conversations,
        clean_text,
        parse_topic_lists,
        detect_languages,
        detect_with_saved_model,
        language_counts,
        trigram_totals,
        profile_queries,
        profile_languages,
        tfidf_weights,
        embed_with_plugin,
        vector_statistics,
        topic_rows,
        core_distance,
        core_distance_in_blocks,
        tree_weights,
        tree_weights_in_blocks,
        density_labels,
        density_labels_with_epsilon,
        density_labels_in_blocks,
        density_labels_shifted,
        density_labels_of_halves,
        contained_failures,
        density_labels_with_outlier,
        capped_members,
        capped_out,
        failed_topics,
        cluster_measures,
        valid_clusters,
        rejected_clusters,
        first_topic,
        central_queries,
        prompt_inputs,
        generate_with_plugin,
        parsed_answers,
        fallbacks,
        seo_statistics,
        report_lines,
        sample_statistics,
        flagship,
        flagship_one_topic,
        flagship_generated,
        flagship_statistics,
        notebook_outputs,
        notebook_contents,
    )
}
