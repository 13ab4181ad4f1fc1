"""Counts and lengths that describe a set of filtered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from searchloom import constants as C
from searchloom.operators.filters import text_digest
from searchloom.operators.language import LanguageModel, detect_language


def validate_query_data(df: DataFrame, language_model: LanguageModel | None = None) -> DataFrame:
    """One row of query statistics (nulls are not counted as queries or users).

    With a language model ``languages`` maps each language met to its number of queries.
    """
    languages = []
    if language_model is not None:
        df = detect_language(df, language_model, "query", "_language")
        counts = [
            part
            for code in (*language_model.languages, C.UNKNOWN_LANGUAGE)
            for part in (F.lit(code), F.count_if(F.col("_language") == code))
        ]
        languages = [F.map_filter(F.create_map(*counts), lambda _, n: n > 0).alias("languages")]
    length = F.length("query")
    with_topics = (
        F.count_if(F.size("topics") > 0) if "topics" in df.columns else F.lit(0).cast("bigint")
    )
    return df.agg(
        F.count(F.lit(1)).alias("total_queries"),
        F.count_distinct(text_digest("query")).alias("unique_queries"),
        F.count_distinct("user").alias("unique_users"),
        F.avg(length).alias("avg_query_length"),
        F.min(length).cast("bigint").alias("min_query_length"),
        F.max(length).cast("bigint").alias("max_query_length"),
        with_topics.alias("queries_with_topics"),
        *languages,
    )
