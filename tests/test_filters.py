"""Cleaning, filters, audit, language and profile on hand-traced rows."""

import re

import pytest
from pyspark.sql import functions as F

from searchloom import schemas
from searchloom.config import LoadConfig
from searchloom.functions.text import (
    clean_query,
    is_blank,
    parse_topics,
    parse_topics_no_blanks,
    strip,
)
from searchloom.operators.filters import (
    filter_audit,
    filter_queries,
    load_and_filter_queries,
    mark_drops,
)
from searchloom.operators.language import (
    detect_language,
    is_english,
    language_distribution,
    train_language_model,
)
from searchloom.operators.profile import validate_query_data
from searchloom.plans import adapters

NO_LANGUAGE = LoadConfig(language_filter=False)

ROWS = [
    (1, "How does diabetes affect the body?", "Medicine,Health", "u1"),
    (2, "  how DOES  diabetes\taffect the body? ", "Medicine", "u2"),
    (3, "short query", "Medicine", "u3"),
    (4, " " * 40, "Medicine", "u4"),
    (5, "¿" * 35, "Medicine", "u5"),
    (6, None, "Medicine", "u6"),
    (7, "what are the early symptoms of asthma", "", "u7"),
    (8, "what are the late symptoms of asthma x", None, "u8"),
    (9, "which vitamins help against tiredness", " ", "u9"),
    (10, "how to read a scientific paper quickly", "a,,b, a", "u1"),
    (11, "   padded text       with 12 words   ", "Health", None),
    (12, "a" * 29, "Health", "u2"),
    (13, "b" * 30, "Health", "u2"),
]

WHITESPACE = [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]


@pytest.fixture(scope="module")
def log(spark):
    return spark.createDataFrame(ROWS, schemas.RAW_QUERIES)


def test_reasons_and_survivors(log):
    reasons = {r.query_id: r.drop_reason for r in mark_drops(log, NO_LANGUAGE).collect()}
    assert reasons == {
        1: None, 2: None, 3: "length", 4: "blank", 5: "no_alnum", 6: "length", 7: "topics",
        8: "topics", 9: None, 10: None, 11: None, 12: "length", 13: None,
    }
    kept = {r.query_id: r for r in filter_queries(log, NO_LANGUAGE).collect()}
    assert sorted(kept) == [1, 9, 10, 11, 13]
    assert kept[1].query == "how does diabetes affect the body?"
    assert kept[1].topics == ["Medicine", "Health"]
    assert kept[9].topics == [""]
    assert kept[10].topics == ["a", "", "b", "a"]
    assert (kept[11].query, kept[11].user) == ("padded text with 12 words", None)


def test_audit(log):
    audit = filter_audit(log, NO_LANGUAGE).first().asDict()
    assert audit == {
        "original": 13, "removed_length": 3, "removed_blank": 1, "removed_no_alnum": 1,
        "removed_language": 0, "removed_topics": 2, "removed_duplicates": 1, "final": 5,
        "retention": 5 / 13,
    }
    empty = filter_audit(log.where("false"), NO_LANGUAGE).first()
    assert (empty.original, empty.final, empty.retention) == (0, 0, None)


def test_the_first_row_survives_whatever_the_partitioning(log):
    expected = sorted(map(str, filter_queries(log, NO_LANGUAGE).collect()))
    for parts in (1, 3, 11):
        shuffled = log.orderBy(F.rand(parts)).repartition(parts)
        assert sorted(map(str, filter_queries(shuffled, NO_LANGUAGE).collect())) == expected


def test_whitespace_and_case(spark):
    spaces = [(f"x{chr(c)}{chr(c)} y{chr(c)}", f"{chr(c)}t{chr(c)}", chr(c) * 2) for c in WHITESPACE]
    df = spark.createDataFrame(spaces, "q string, t string, b string")
    for r in df.select(clean_query("q"), strip("t"), is_blank("b")).collect():
        assert tuple(r) == ("x y", "t", True)
    others = [0x200B, 0xFEFF, 0x180E, 0x08, 0x0E, 0x1B]
    df = spark.createDataFrame([(f"x{chr(c)}y",) for c in others], "q string")
    assert [r[0] for r in df.select(clean_query("q")).collect()] == [f"x{chr(c)}y" for c in others]
    words = ["ΟΔΟΣ", "İSTANBUL", "ẞ", "ÀÉ  Ö", "  Zwei 　Worte\n"]
    df = spark.createDataFrame([(w,) for w in words], "q string")
    expected = [re.sub(r"\s+", " ", w.strip()).lower() for w in words]
    assert [r[0] for r in df.select(clean_query("q")).collect()] == expected


def test_topic_lists(spark):
    texts = ["a, b", "a,,b, a", " ", "", None, ",", " x "]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(parse_topics("t"), parse_topics_no_blanks("t")).collect()
    assert [r[0] for r in rows] == [
        ["a", "b"], ["a", "", "b", "a"], [""], [], [], ["", ""], ["x"],
    ]
    assert [r[1] for r in rows] == [["a", "b"], ["a", "b", "a"], [], [], [], [], ["x"]]


def test_optional_columns_and_switches(spark, log):
    bare = load_and_filter_queries(df=log.select("query_id", "query"), language_filter=False)
    rows = {r.query_id: r for r in bare.collect()}
    assert sorted(rows) == [1, 7, 8, 9, 10, 11, 13]
    assert rows[1].user == "unknown" and rows[1].topics == []
    named = log.select("query_id", "query", "topic", F.col("user_id").alias("user"))
    assert {r.user for r in load_and_filter_queries(df=named, language_filter=False).collect()} == {"u1", "u9", "u2", None}
    everything = LoadConfig(min_length=0, require_topics=False, language_filter=False)
    reasons = {r.query_id: r.drop_reason for r in mark_drops(log, everything).collect()}
    assert {k: v for k, v in reasons.items() if v} == {4: "blank", 5: "no_alnum", 6: "no_alnum"}


def test_errors(spark, log):
    with pytest.raises(ValueError, match="table_name or df"):
        load_and_filter_queries()
    with pytest.raises(ValueError, match="lacks columns.*query"):
        load_and_filter_queries(df=log.drop("query"))
    with pytest.raises(ValueError, match="order column"):
        load_and_filter_queries(df=log, order_col="nothing")


def test_rows_need_unique_ids(spark, log):
    with pytest.raises(ValueError, match="query_id"):
        load_and_filter_queries(df=log.drop("query_id"), language_filter=False)
    for bad in (log.unionByName(log.limit(1)), log.withColumn("query_id", F.nullif("query_id", F.lit(3)))):
        with pytest.raises(ValueError, match="unique and not null"):
            load_and_filter_queries(df=bad, language_filter=False)


def test_language_filter_needs_a_model(spark, log):
    for run in (lambda: load_and_filter_queries(df=log), lambda: filter_queries(log), lambda: filter_audit(log)):
        with pytest.raises(ValueError, match="language_model"):
            run()


def test_language_model(spark):
    docs = adapters.read(spark, "/root/testdata/sf0.01", "documents")
    model = train_language_model(docs.where("doc_id % 2 = 0"))
    assert model.languages == ("de", "en", "es", "fr")
    tested = detect_language(docs.where("doc_id % 2 = 1"), model, "text")
    right = tested.agg(F.avg((F.col("lang") == F.col("language")).cast("double"))).first()[0]
    assert right > 0.98
    odd = spark.createDataFrame([("ab",), ("",), (None,), ("the and of the",)], "query string")
    assert [r.language for r in detect_language(odd, model).collect()] == [
        "unknown", "unknown", None, "en",
    ]
    assert [r.is_english for r in is_english(odd, model).collect()] == [False, False, None, True]
    counts = {r.language: r.n_queries for r in language_distribution(odd, model).collect()}
    assert counts == {"unknown": 2, None: 1, "en": 1}
    # Without a model every text passes for English.
    assert {r.language for r in detect_language(odd, None).collect()} == {"en"}


def test_language_filter_is_counted(spark):
    log = adapters.doc_log(spark, "/root/testdata/sf0.001")
    model = train_language_model(adapters.documents(spark, "/root/testdata/sf0.001"))
    with_model = filter_audit(log, LoadConfig(), model).first()
    assert with_model.removed_language > 0
    assert filter_queries(log, LoadConfig(), model).count() == with_model.final
    assert filter_audit(log, NO_LANGUAGE).first().removed_language == 0


def test_profile(spark, log):
    stats = validate_query_data(filter_queries(log, NO_LANGUAGE)).first().asDict()
    lengths = [34, 37, 38, 25, 30]
    assert stats == {
        "total_queries": 5, "unique_queries": 5, "unique_users": 3,
        "avg_query_length": sum(lengths) / 5, "min_query_length": 25, "max_query_length": 38,
        "queries_with_topics": 5,
    }
