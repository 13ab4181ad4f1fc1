"""Divergence of sources against brute force and against its SQL."""

import random

import brute
import duckdb
import pytest

from searchloom.llm import divergence, queries as Q
from searchloom.llm.divergence import source_divergence

SMALL = "/root/testdata/sf0.001"
SHOWN = ["lang", "source", "part", "item", "value", "rank"]


def found(docs, **params):
    return sorted(map(tuple, source_divergence(docs, **params).select(*SHOWN).collect()))


def made(spark, rows):
    """With columns whose names the operator uses itself."""
    rows = [(lang, source, text, 1, 2, "t", 3, 4) for lang, source, text in rows]
    schema = "lang string, source string, text string, n int, g int, term string, slot int, doc_id bigint"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(3)
    words = [f"{a}{b}" for a in "abcdefgh" for b in "ijklmnop"] + ["ÉTÉ", "été", "Straße", "ii"]
    rows = []
    for n in range(160):
        lang, source = draw.choice("xyz"), f"s{draw.randint(0, 8)}"
        weights = [1 + (hash_ % (3 + len(source) + n % 7)) for hash_ in range(len(words))]
        text = " ".join(draw.choices(words, weights, k=draw.randint(0, 120))).upper() + " 12_ab;cd"
        rows.append((lang, source, text))
    rows += [("x", "hot", "ai ai aj " * 4000)] * 3  # a hot group with repeated rows and large counts
    rows += [(None, None, "one two"), (None, "s1", None), ("", "s1", "one two"), ("x", None, "one two ai")]
    rows += [("alone", "s", "aa bb"), ("none", "s", ""), ("none", "t", None)]
    return rows


def test_brute_force(spark, corpus):
    assert found(made(spark, corpus)) == sorted(brute.divergence(corpus))


def test_blocks_of_groups_and_columns(spark, corpus, monkeypatch):
    """Many blocks of sources, terms and columns give the same."""
    monkeypatch.setattr(divergence, "GROUPS", 3)
    monkeypatch.setattr(divergence, "TERMS", 20)
    assert found(made(spark, corpus), columns=8, least_docs=2, top_terms=7) == sorted(
        brute.divergence(corpus, least_docs=2, top=7)
    )


def test_ties_go_by_item(spark):
    rows = [("x", s, "Zz aa éé") for s in "abc"] + [("x", "d", "Zz Zz aa aa éé éé bb")]
    assert found(made(spark, rows)) == sorted(brute.divergence(rows))


@pytest.mark.parametrize("count, total, terms", [(0, 0, 1), (10**13, 10**14, 10**9), (7, 10**15, 3)])
def test_probabilities_are_exact(spark, count, total, terms):
    row = spark.createDataFrame([(count, total, terms)], "n bigint, total bigint, terms bigint")
    expected = 1 + 10**9 * (count + 1) // (total + terms)
    assert row.select(divergence.probability("n", "total", "terms").alias("p")).first()["p"] == expected


@pytest.mark.parametrize("case", ["small", "odd"])
def test_sql(spark, tmp_path, odd_docs, case):
    where = SMALL
    if case == "odd":
        odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
        where = str(tmp_path)
    con = duckdb.connect()
    path = f"{where}/documents.parquet" + ("/*.parquet" if case == "odd" else "")
    con.execute(f"create view documents as select * from '{path}'")
    expected = con.execute(Q.ORACLES["op12_source_divergence"]).fetchall()
    assert sorted(map(tuple, Q.op12_source_divergence(spark, where).collect())) == sorted(expected)
