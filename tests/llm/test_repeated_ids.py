"""One id on many rows: what reaches the driver is bounded, and what stays is determined."""

import itertools

from searchloom.llm import quality
from searchloom.llm.near_dedup import drop_near_duplicates


def test_labelled_rows_on_the_driver_are_bounded(spark, monkeypatch):
    seen = []

    def fit(x, y):
        seen.append(len(x))
        return None

    monkeypatch.setattr(quality, "fit_network", fit)
    docs = spark.createDataFrame([(1, f"some words {i} of one id") for i in range(3000)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    held = docs.limit(1).select(quality.held_out()).first()[0]
    quality.fit_quality(docs, labels, sample=10)
    assert seen == [0 if held else 10]


def test_which_of_equal_texts_stays_is_determined(spark):
    text = "the very same words again and again in one text of two rows"
    rows = [(5, text, "fr", "b"), (5, text, "en", "z"), (5, text, "en", "c"), (7, text, "aa", "a"), (9, "another text", "x", "y")]
    for order in itertools.islice(itertools.permutations(rows), 0, 120, 41):
        docs = spark.createDataFrame(list(order), "doc_id bigint, text string, lang string, source string").repartition(3)
        assert sorted(map(tuple, drop_near_duplicates(docs).collect())) == [(5, text, "en", "c"), (9, "another text", "x", "y")]
