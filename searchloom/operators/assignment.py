"""One cluster per query: noise, and the rule that the first topic wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from searchloom import constants as C

# What decides between a query's places: the topic mentioned first in the whole
# log, then its clusters by number, then its noise; inside, the order of the rows.
PRIORITY = ["topic_first_id", "topic_first_pos", "is_noise", "label", "rank", "query_id", "pos"]


def places(members: DataFrame, capped: DataFrame, judged: DataFrame) -> DataFrame:
    """Every place a query has in a topic, with its cluster and priority.

    Members of a rejected cluster go to the noise of their topic, as do rows with
    label -1 and all rows of topics too small to cluster.  Members beyond the cap
    have no place.
    """
    noise = F.concat("topic", F.lit(C.NOISE_SUFFIX))
    topics = ["topic_first_id", "topic_first_pos"]
    unlabelled = members.where(F.col("label") == C.NOISE_LABEL).select(
        *topics,
        F.lit(1).alias("is_noise"),
        "label",
        F.lit(0).alias("rank"),
        "query_id",
        "pos",
        noise.alias("cluster"),
    )
    verdicts = judged.select("topic", "label", "cluster_label", "is_valid")
    firsts = members.where(F.col("label") >= 0).select("topic", "query_id", "pos", *topics)
    clustered = (
        capped.select("topic", "label", "query_id", "pos", "rank")
        .join(verdicts, ["topic", "label"])
        .join(firsts, ["topic", "query_id", "pos"])
        .select(
            *topics,
            F.lit(0).alias("is_noise"),
            "label",
            "rank",
            "query_id",
            "pos",
            F.when(F.col("is_valid"), F.col("cluster_label")).otherwise(noise).alias("cluster"),
        )
    )
    return clustered.unionByName(unlabelled)


def first_topic_wins(
    queries: DataFrame,
    placed: DataFrame,
    distinct_texts: bool = False,
    distances: DataFrame | None = None,
) -> DataFrame:
    """One row per ``(query, topics)``, at its place of highest priority.

    Places are reduced per query id, and get their ``away`` from the ``distances``
    ``(cluster, query_id, member_rank, away)`` if any are given, before any text is shuffled; rows
    with the same text and topics under different ids are reduced afterwards, unless the
    texts are known to be distinct.
    """
    best = placed.groupBy("query_id").agg(
        F.min(F.struct(*PRIORITY, "cluster")).alias("place")
    )
    found = ["place"]
    if distances is not None:
        keys = {"cluster": "place.cluster", "member_rank": "place.rank"}
        best = best.select("*", *[F.col(c).alias(k) for k, c in keys.items()])
        best = best.join(distances, ["cluster", "query_id", "member_rank"], "left").drop(*keys)
        found.append("away")
    rows = queries.select("query_id", "query", "user", "topics").join(best, "query_id")
    if not distinct_texts:
        first = F.min_by(F.struct("query_id", "user", *found), "place").alias("first")
        rows = rows.groupBy("query", "topics").agg(first).select("query", "topics", "first.*")
    return rows.select(
        "query_id",
        "query",
        "user",
        "topics",
        F.col("place.cluster").alias("cluster"),
        F.col("place.rank").alias("member_rank"),
        *found[1:],
    )
