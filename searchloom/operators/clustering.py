"""Clustering of embedded queries, from topic groups to one cluster per query."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame, functions as F

from searchloom import constants as C, schemas
from searchloom.config import ClusterConfig
from searchloom.operators.assignment import first_topic_wins, places
from searchloom.operators.density import cluster_labels
from searchloom.operators.embedding import add_embeddings_to_df
from searchloom.operators.topics import explode_topics, size_topics, with_topic_lists
from searchloom.operators.validation import (
    cap_clusters,
    central_members,
    describe_clusters,
    judge_clusters,
    measure_clusters,
)
from searchloom.session import SMALLEST, stage


@dataclass(frozen=True)
class Clustering:
    """``clustered`` and ``metadata`` are the results proper.

    ``assignments`` is ``clustered`` with the query id, the member's rank and its
    distance to the centroid; ``rejected`` holds the clusters that were turned
    down, with reasons; ``failed_topics`` those whose vectors could not be used;
    ``capped_out`` the members that the cap took out of their clusters.
    """

    clustered: DataFrame
    metadata: DataFrame
    rejected: DataFrame
    assignments: DataFrame
    failed_topics: DataFrame | None = None
    capped_out: DataFrame | None = None


def topic_members(embedded: DataFrame, config: ClusterConfig) -> DataFrame:
    """One row per query and mention of a topic, without the text."""
    return size_topics(
        explode_topics(embedded.select("query_id", "user", "topics", "embedding")),
        config.min_cluster_size,
    )


def label_members(members: DataFrame, config: ClusterConfig) -> tuple[DataFrame, DataFrame]:
    """Density labels ``(topic, query_id, label)`` of all topics large enough."""
    mentions = F.size(F.filter("topics", lambda t: t == F.col("topic")))
    points = members.where(
        F.col("clusterable") & (F.col("pos") == F.col("first_pos"))
    ).select("topic", "query_id", mentions.alias("copies"), "embedding")
    return cluster_labels(points, config)


def finish_clusters(
    queries: DataFrame,
    members: DataFrame,
    labels: DataFrame,
    config: ClusterConfig,
    distinct_texts: bool = False,
) -> Clustering:
    """Everything after the labels: cap, validate, describe, assign."""
    mentions = members.drop("embedding", "topics")
    labelled = mentions.join(labels, ["topic", "query_id"], "left").withColumn(
        "label",
        F.when(F.col("clusterable"), F.coalesce("label", F.lit(C.NOISE_LABEL))).otherwise(
            C.NOISE_LABEL
        ),
    )
    # Vectors are needed for members of clusters only; noise is most of a log.
    in_clusters = labels.where(F.col("label") >= 0)
    in_clusters = members.where("clusterable").join(in_clusters, ["topic", "query_id"])
    capped = stage(cap_clusters(in_clusters, config), "capped-clusters")
    measured = measure_clusters(capped)
    central = central_members(capped, measured)
    judged = stage(judge_clusters(measured, central, config), "judged-clusters")
    described = describe_clusters(judged, queries)
    metadata_columns = schemas.CLUSTER_METADATA.fieldNames()

    placed = places(labelled, capped, judged)
    distances = central.select(
        F.concat("topic", F.lit("_"), F.col("label").cast("string")).alias("cluster"),
        "query_id",
        F.col("rank").alias("member_rank"),
        "away",
    )
    assigned = first_topic_wins(queries, placed, distinct_texts, distances)
    assignments = stage(
        assigned.select("cluster", "query_id", "member_rank", "query", "user", "topics", "away"),
        "assignments",
        SMALLEST,
    )
    return Clustering(
        assignments.select(*schemas.CLUSTERED_QUERIES.fieldNames()),
        described.where("is_valid").select(*metadata_columns),
        described.where("not is_valid").select(*metadata_columns),
        assignments,
        capped_out=in_clusters.select("topic", "label", "query_id", "pos").join(
            capped.select("topic", "label", "query_id", "pos"), ["topic", "label", "query_id", "pos"], "left_anti"
        ),
    )


def cluster_embedded(
    queries: DataFrame, embedded: DataFrame, config: ClusterConfig, distinct_texts: bool = False
) -> Clustering:
    """As :func:`cluster_queries`, with vectors ``(query_id, user, topics, embedding)`` at hand.

    Texts are taken from ``queries`` only for the results.
    """
    members = topic_members(embedded, config)
    labels, failed = label_members(members, config)
    result = finish_clusters(queries, members, labels, config, distinct_texts)
    return replace(result, failed_topics=failed)


def cluster_queries(
    queries: DataFrame,
    embeddings: DataFrame | None = None,
    config: ClusterConfig | None = None,
    **params: object,
) -> Clustering:
    """Cluster queries per topic and give each query one cluster.

    ``queries`` is ``(query_id, query, user, topics)``; vectors come from
    ``embeddings`` ``(query_id, embedding)`` or from a column of that name.
    Parameters may be given singly or as a config.
    """
    known = {f.name for f in fields(ClusterConfig)}
    unknown = set(params) - known
    if unknown:
        raise TypeError(f"unknown clustering parameters: {sorted(unknown)}")
    if config is not None and params:
        raise ValueError("give either a config or single parameters")
    queries = with_topic_lists(queries)
    embedded = queries if embeddings is None else add_embeddings_to_df(queries, embeddings)
    return cluster_embedded(queries, embedded, config or ClusterConfig(**params))
