"""Topic groups: one row per query and topic it lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from searchloom.functions.text import parse_topics_no_blanks
from searchloom.session import stage


def with_topic_lists(queries: DataFrame) -> DataFrame:
    """Split topics given as comma-separated text, without blanks; leave lists alone."""
    if isinstance(queries.schema["topics"].dataType, T.StringType):
        return queries.withColumn("topics", parse_topics_no_blanks("topics"))
    return queries


def explode_topics(queries: DataFrame) -> DataFrame:
    """Put every query into every topic it lists, once per mention.

    ``pos`` is the place of the mention in the list and ``first_pos`` that of
    the first mention of the same topic.  Queries without topics disappear.
    """
    return with_topic_lists(queries).select("*", F.posexplode("topics").alias("pos", "topic")).withColumn(
        "first_pos", (F.array_position("topics", F.col("topic")) - 1).cast("int")
    )


def topic_sizes(members: DataFrame) -> DataFrame:
    """Rows per topic and the place where the topic is mentioned first."""
    return members.groupBy("topic").agg(
        F.count(F.lit(1)).alias("topic_rows"),
        F.min("query_id").alias("topic_first_id"),
        F.min_by("first_pos", "query_id").alias("topic_first_pos"),
    )


def size_topics(members: DataFrame, min_cluster_size: int) -> DataFrame:
    """Add the topic's size and first mention, and whether it is large enough to cluster."""
    facts = stage(topic_sizes(members), "topic-facts")
    return members.join(facts, "topic").withColumn(
        "clusterable", F.col("topic_rows") >= min_cluster_size
    )
