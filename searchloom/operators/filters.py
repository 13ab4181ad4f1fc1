"""From the raw log to filtered, cleaned, de-duplicated queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from searchloom import constants as C
from searchloom.config import LoadConfig
from searchloom.functions.text import clean_query, has_alnum, has_topic, is_blank, parse_topics
from searchloom.operators.language import LanguageModel, detect_language
from searchloom.session import SMALLEST, stage
from searchloom.sources.tables import load_queries_from_table, require_unique_ids, with_query_id


def require_columns(df: DataFrame, names: tuple[str, ...] = ("query",)) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"the log lacks columns: {missing}")


def cheap_filters(raw: DataFrame, config: LoadConfig) -> tuple[list, list]:
    """Names and conditions of the filters before and after the language filter.

    Length is that of the raw text in code points.  A null text fails the first.
    """
    before, after = [], []
    if config.min_length > 0:
        before.append((C.DROP_LENGTH, F.length("query") >= config.min_length))
    before.append((C.DROP_BLANK, ~is_blank("query")))
    before.append((C.DROP_NO_ALNUM, has_alnum("query")))
    if config.require_topics and "topic" in raw.columns:
        after.append((C.DROP_TOPICS, has_topic("topic")))
    return before, after


def _first_failed(reason: Column, checks: list) -> Column:
    for name, passes in checks:
        reason = reason.when(~F.coalesce(passes, F.lit(False)), name)
    return reason


def require_model(config: LoadConfig, model: LanguageModel | None) -> None:
    if config.language_filter and model is None:
        raise ValueError("the language filter needs a language_model; give one or set language_filter=False")


def mark_drops(
    raw: DataFrame, config: LoadConfig, model: LanguageModel | None = None
) -> DataFrame:
    """Add ``drop_reason``, the first filter a row fails, and ``query_clean`` for the rest."""
    require_columns(raw)
    require_model(config, model)
    before, after = cheap_filters(raw, config)
    nothing = F.when(F.lit(False), F.lit(None).cast("string"))
    passed = F.col("drop_reason").isNull()
    marked = raw.withColumn("drop_reason", _first_failed(nothing, before))
    marked = marked.withColumn("query_clean", F.when(passed, clean_query("query")))
    reason = F.when(~passed, F.col("drop_reason"))
    if config.language_filter:
        # Only texts that got this far are scored.
        marked = detect_language(marked, model, text_col="query_clean", cleaned=True)
        reason = reason.when(F.col("language") != C.DEFAULT_LANGUAGE, C.DROP_LANGUAGE)
    return marked.withColumn("drop_reason", _first_failed(reason, after))


def user_column(df: DataFrame) -> Column:
    """``user_id``, else ``user``, else a fixed marker."""
    for name in ("user_id", "user"):
        if name in df.columns:
            return F.col(name).cast("string")
    return F.lit(C.UNKNOWN_USER)


def text_digest(column: str) -> Column:
    """Thirty-two bytes that stand for a text where texts are compared."""
    return F.unhex(F.sha2(F.col(column).cast("binary"), 256))


def deduplicate(rows: DataFrame, digest: str, order: str) -> DataFrame:
    """One row per ``digest``, the one of the smallest ``order``, which is unique.

    Digests and ids alone are aggregated, by hash and combined before the shuffle, so
    a text that makes up a large part of the log sends one row per task; the rows that
    stay are then picked by id.  ``rows`` are read twice, so they should lie in files.
    """
    first = rows.groupBy(digest).agg(F.min(order).alias(order))
    return rows.drop(digest).join(first.select(order), order, "left_semi")


def filter_queries(
    raw: DataFrame, config: LoadConfig = LoadConfig(), model: LanguageModel | None = None
) -> DataFrame:
    """Apply all filters in order and keep the first row of each cleaned text.

    Cleaned rows are written to the shared folder, so the log is read when this is called.
    """
    require_columns(raw)
    require_model(config, model)
    before, after = cheap_filters(raw, config)
    kept = raw
    # The topic test is the cheapest and can be left to the scan; which rows are
    # kept does not depend on the order of the tests.
    for _, passes in [*after, *before]:
        kept = kept.where(passes)
    kept = kept.withColumn("query_clean", clean_query("query"))
    topics = (
        parse_topics("topic")
        if "topic" in raw.columns
        else F.array().cast("array<string>")
    )
    # The log is scanned and cleaned once; what follows reads digests, then texts.
    rows = stage(
        kept.select(
            "query_id",
            "query_clean",
            user_column(raw).alias("user"),
            topics.alias("topics"),
            text_digest("query_clean").alias("digest"),
        ),
        "cleaned-queries",
        SMALLEST,
    )
    # Equal texts have one language, so only the first of each is looked at.
    first = deduplicate(rows, "digest", "query_id")
    if config.language_filter:
        first = detect_language(first, model, text_col="query_clean", cleaned=True)
        first = first.where(F.col("language") == C.DEFAULT_LANGUAGE)
    return first.select("query_id", F.col("query_clean").alias("query"), "user", "topics")


def filter_audit(
    raw: DataFrame, config: LoadConfig = LoadConfig(), model: LanguageModel | None = None
) -> DataFrame:
    """One row: how many queries came in, fell to each filter, and are left."""
    marked = mark_drops(raw, config, model)
    reason = F.col("drop_reason")
    counted = marked.agg(
        F.count(F.lit(1)).alias("original"),
        *[
            F.count_if(reason == name).alias(f"removed_{name}")
            for name in (
                C.DROP_LENGTH,
                C.DROP_BLANK,
                C.DROP_NO_ALNUM,
                C.DROP_LANGUAGE,
                C.DROP_TOPICS,
            )
        ],
        F.count_if(reason.isNull()).alias("kept"),
        F.count_distinct(F.when(reason.isNull(), text_digest("query_clean"))).alias("final"),
    )
    return counted.select(
        "original",
        *[c for c in counted.columns if c.startswith("removed_")],
        (F.col("kept") - F.col("final")).alias(f"removed_{C.DROP_DUPLICATES}"),
        "final",
        F.try_divide(F.col("final").cast("double"), F.col("original")).alias("retention"),
    )


def load_log(
    table_name: str | None,
    df: DataFrame | None,
    limit: int | None = None,
    order_col: str | None = None,
    spark: SparkSession | None = None,
) -> DataFrame:
    """The raw log with ids, from a DataFrame or else from a table."""
    if df is not None:
        require_columns(df)
        return with_query_id(df, order_col)
    if table_name is None:
        raise ValueError("give a log: table_name or df")
    return load_queries_from_table(spark or SparkSession.active(), table_name, limit, order_col)


def load_and_filter_queries(
    table_name: str | None = None,
    df: DataFrame | None = None,
    limit: int | None = None,
    min_length: int = 30,
    require_topics: bool = True,
    language_filter: bool = True,
    language_model: LanguageModel | None = None,
    order_col: str | None = None,
    spark: SparkSession | None = None,
) -> DataFrame:
    """Load a log from a table or a DataFrame (which wins) and filter it.

    ``limit`` applies to the table only; by default nothing is cut off.  Ids must be
    unique.  The language filter needs a model: see ``train_language_model``.
    """
    df = load_log(table_name, df, limit, order_col, spark)
    config = LoadConfig(min_length, require_topics, language_filter)
    require_model(config, language_model)
    require_unique_ids(df)
    return filter_queries(df, config, language_model)
