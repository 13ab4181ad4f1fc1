"""Capping, measuring and judging clusters whose labels are known."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from searchloom import constants as C
from searchloom.config import ClusterConfig
from searchloom.functions.vectors import distance, mean_vector, norm, sum_vector, unit
from searchloom.session import stage

CLUSTER = ["topic", "label"]
# Clusters of more members than this, or than one in MOST_HOT of all members, are salted.
HOT_ROWS = 1_000_000
MOST_HOT = 10_000
# Distances are compared after rounding: sums over partitions may differ in the last bits.
DIGITS = 12


def _salt(members: DataFrame, sizes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spread the members of very large clusters, and repeat their facts as often.

    The list of such clusters is broadcast: each holds more than one in
    ``MOST_HOT`` of all members, so it cannot have more than ``MOST_HOT`` rows.
    """
    total = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    share = max(HOT_ROWS, math.ceil(total / MOST_HOT))
    salts = F.ceil(F.col("size") / share).cast("int")
    hot = sizes.where(F.col("size") > share).select(*CLUSTER, salts.alias("salts"))
    salted = members.join(F.broadcast(hot), CLUSTER, "left").withColumn(
        "salt", F.pmod(F.xxhash64("query_id"), F.coalesce("salts", F.lit(1))).cast("int")
    )
    repeated = sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted.drop("salts"), repeated


def cap_clusters(labelled: DataFrame, config: ClusterConfig = ClusterConfig()) -> DataFrame:
    """Keep the members nearest to the centroid, at most ``max_cluster_size`` per cluster.

    ``labelled`` is ``(topic, label, query_id, pos, user, embedding)``.  Members
    beyond the cap are dropped.  ``rank`` is the order of the members: by
    distance where the cap cut, by place in the log elsewhere.  Very large
    clusters are cut down to the cap in salted parts before the parts meet.
    """
    members = labelled.where(F.col("label") >= 0)
    sizes = stage(
        members.groupBy(*CLUSTER).agg(
            F.count(F.lit(1)).alias("size"), mean_vector(F.col("embedding")).alias("centroid")
        ),
        "cluster-sizes",
    )
    members, sizes = _salt(members, sizes)
    cut = F.col("size") > config.max_cluster_size
    away = F.when(cut, F.round(distance(F.col("embedding"), F.col("centroid")), DIGITS))
    order = ["away", "query_id", "pos"]
    in_part = Window.partitionBy(*CLUSTER, "salt").orderBy(*order)
    in_cluster = Window.partitionBy(*CLUSTER).orderBy(*order)
    return (
        members.join(sizes, [*CLUSTER, "salt"])
        .withColumn("away", F.coalesce(away, F.lit(0.0)))
        .withColumn("rank", F.row_number().over(in_part))
        .where(F.col("rank") <= config.max_cluster_size)
        .withColumn("rank", F.row_number().over(in_cluster))
        .where(F.col("rank") <= config.max_cluster_size)
        .select(*CLUSTER, "query_id", "pos", "user", "embedding", "rank")
    )


def measure_clusters(capped: DataFrame) -> DataFrame:
    """Size, cohesion, distinct users and centroid of every capped cluster.

    The mean cosine over all pairs follows from the length of the sum of the
    unit vectors, without forming a pair.  A missing user counts as one user.
    """
    vec = F.col("embedding")
    n = F.col("n_queries")
    total = F.col("unit_sum")
    pairs = F.aggregate(total, F.lit(0.0), lambda acc, x: acc + x * x) - n
    return (
        capped.groupBy(*CLUSTER)
        .agg(
            F.count(F.lit(1)).alias("n_queries"),
            sum_vector(unit(vec, norm(vec))).alias("unit_sum"),
            mean_vector(vec).alias("centroid"),
            F.collect_set("user").alias("users"),
            F.max(F.col("user").isNull()).alias("user_missing"),
        )
        .select(
            *CLUSTER,
            "n_queries",
            F.when(n > 1, pairs / (n * (n - 1))).otherwise(F.lit(math.nan)).alias("cohesion"),
            (F.size("users") + F.col("user_missing").cast("int")).cast("bigint").alias("unique_users"),
            "centroid",
        )
    )


def central_members(capped: DataFrame, measured: DataFrame) -> DataFrame:
    """Add each member's distance to the centroid of the capped cluster."""
    centroids = measured.select(*CLUSTER, "centroid")
    return capped.join(centroids, CLUSTER).select(
        *CLUSTER,
        "query_id",
        "rank",
        F.round(distance(F.col("embedding"), F.col("centroid")), DIGITS).alias("away"),
    )


def rejection_reasons(config: ClusterConfig) -> Column:
    """The list of all reasons against a cluster, or null."""
    cohesion = F.col("cohesion")
    reasons = F.array_compact(
        F.array(
            F.when(
                F.col("n_queries") < config.min_cluster_size,
                F.format_string(
                    C.REASON_SIZE, F.col("n_queries"), F.lit(str(config.min_cluster_size))
                ),
            ),
            F.when(
                cohesion < config.min_cluster_similarity,
                F.format_string(
                    C.REASON_COHESION, cohesion, F.lit(str(config.min_cluster_similarity))
                ),
            ),
            F.when(
                F.col("unique_users") < config.min_unique_users,
                F.format_string(
                    C.REASON_USERS, F.col("unique_users"), F.lit(str(config.min_unique_users))
                ),
            ),
        )
    )
    return F.when(F.size(reasons) > 0, reasons)


def judge_clusters(
    measured: DataFrame, central: DataFrame, config: ClusterConfig = ClusterConfig()
) -> DataFrame:
    """One row per cluster: label text, numbers, central query id, verdict and reasons."""
    middle = central.groupBy(*CLUSTER).agg(
        F.min_by("query_id", F.struct("away", "rank")).alias("central_id")
    )
    cohesion = F.col("cohesion")
    candidate = ~F.isnan(cohesion) & (cohesion >= config.min_seo_similarity)
    reasons = rejection_reasons(config)
    return measured.join(middle, CLUSTER).select(
        *CLUSTER,
        F.concat("topic", F.lit("_"), F.col("label").cast("string")).alias("cluster_label"),
        "n_queries",
        "cohesion",
        F.round("cohesion", 4).alias("avg_similarity"),
        "unique_users",
        "central_id",
        candidate.cast("string").alias("seo_candidate"),
        reasons.alias("rejection_reasons"),
        reasons.isNull().alias("is_valid"),
    )


def describe_clusters(judged: DataFrame, queries: DataFrame) -> DataFrame:
    """Metadata rows, with the text of the most central query."""
    texts = queries.select(
        F.col("query_id").alias("central_id"), F.col("query").alias("most_central_query")
    )
    return judged.join(texts, "central_id").select(
        "topic",
        "cluster_label",
        "n_queries",
        "avg_similarity",
        "unique_users",
        "most_central_query",
        "seo_candidate",
        "rejection_reasons",
        "label",
        "is_valid",
    )
