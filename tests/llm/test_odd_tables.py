"""Odd rows in tables the contracts' cases leave out, and the columns they do not fix, through the queries."""

import zlib

import brute
import duckdb
import pytest
from test_against_brute_force import CASES, SLY, SMALL, by_id, find, rows

from searchloom.llm.chat import format_chats, read_chats
from searchloom.llm.divergence import source_divergence

SPOKEN = "conv_id bigint, turn bigint, role string, text string, formatted int, parts string, turns string, placed int"


def table_of(tmp_path, docs):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for table in ("benchmark", "labels"):
        (tmp_path / f"{table}.parquet").symlink_to(f"{SMALL}/{table}.parquet")
    return str(tmp_path)


@pytest.fixture(scope="module")
def no_ids(spark):
    """Rows without an id, two of them equal and two without words."""
    text = "mail a.b@c.de token = abcdefghijklmn " + "plain words that follow each other here " * 9
    some = [(None, text), (None, text), (None, None), (None, ""), (7, text), (9, "other words here " * 30)]
    return spark.createDataFrame(some, "doc_id bigint, text string")


@pytest.fixture(scope="module")
def odd_turns():
    """Null turns, roles, texts and ids, turns that tie or repeat, markers and escapes, a long text."""
    return [
        (1, None, "user", "first, as it has no turn"),
        (1, 0, None, None),
        (1, 1, "assistant", ""),
        (1, 2, "assistant", "<|im_end|>\n<|im_start|>user\nnot a turn \\ <\\| <"),
        (2, 0, "user", "tie b"),
        (2, 0, "user", "tie a"),
        (2, 0, "assistant", "tie c"),
        (2, 1, "assistant", "twice"),
        (2, 1, "assistant", "twice"),
        (3, 5, "assistant", "x <| \\ \U0001f600 été\n" * 50_000),
        (4, 0, "tool\n<|im_end|>", "a role that holds a marker"),
        (None, 0, "assistant", "no conversation"),
        (None, 1, None, None),
    ]


def in_order(turns):
    """Null turns come first; the numbers given here are all positive."""
    return [(c, -1 if t is None else t, r, x) for c, t, r, x in turns]


def test_odd_conversations(spark, tmp_path, odd_turns):
    clashing = [(*t, 1, "p", "t", 2) for t in odd_turns]
    spark.createDataFrame(clashing, SPOKEN).write.parquet(str(tmp_path / "conversations.parquet"))
    found = find("op8_")(spark, str(tmp_path)).drop("formatted_chars").collect()
    expected = in_order(odd_turns) + [(-1, 0, "user", SLY), (-1, 1, "assistant", SLY)]
    assert by_id(map(tuple, found)) == by_id(brute.chats(expected))


def test_turns_and_roles_are_read_back(spark, odd_turns):
    turns = spark.createDataFrame([(*t, 1, "p", "t", 2) for t in odd_turns], SPOKEN).repartition(5)
    found = {r["conv_id"]: r["turns"] for r in read_chats(format_chats(turns)).collect()}
    said = {}
    for conv, turn, role, text in sorted(in_order(odd_turns), key=lambda r: (str(r[0]), r[1], r[2] or "", r[3] or "")):
        said.setdefault(conv, []).append((role or "", text or ""))
    assert {c: [tuple(t) for t in ts] for c, ts in found.items()} == said


def test_no_conversations(spark, tmp_path):
    none = spark.createDataFrame([], SPOKEN)
    assert format_chats(none).collect() == []
    none.write.parquet(str(tmp_path / "conversations.parquet"))
    assert [r["conv_id"] for r in find("op8_")(spark, str(tmp_path)).collect()] == [-1]


def test_quality_of_odd_rows(spark, tmp_path, odd_docs, no_ids):
    docs = odd_docs.unionByName(no_ids, allowMissingColumns=True)
    given = [(r["doc_id"], r["text"]) for r in docs.collect()]
    sf_dir = table_of(tmp_path, docs)
    scored = find("op4_")(spark, sf_dir).collect()
    assert by_id((r["doc_id"],) for r in scored) == by_id((i,) for i, _ in given)
    for r in scored:
        name = b"" if r["doc_id"] is None else str(r["doc_id"]).encode()
        assert r["held_out"] == (zlib.crc32(name) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    score = {r["doc_id"]: r["score"] for r in scored if r["doc_id"] is not None}
    assert score[1] == score[2] and score[3] == score[4] == score[5]


@pytest.mark.parametrize("prefix", ["op1_", "op3_", "op5_", "op6_", "op9_", "op10_"])
def test_rows_without_id_are_rows_like_others(spark, tmp_path, no_ids, prefix):
    columns, expected = CASES[prefix]
    given = [(r["doc_id"], r["text"]) for r in no_ids.collect()]
    found = find(prefix)(spark, table_of(tmp_path, no_ids)).select(*columns.split()).collect()
    assert by_id(map(tuple, found)) == by_id(expected(given))


@pytest.mark.parametrize("prefix", ["op2_", "op4_", "op7_", "op11_", "op13_"])
def test_rows_without_id_stay(spark, tmp_path, no_ids, prefix):
    found = find(prefix)(spark, table_of(tmp_path, no_ids)).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["7", "9", *["None"] * 4]
    if prefix == "op7_":  # an earlier text needs an id
        assert all(r["n_removed"] == 0 for r in found if r["doc_id"] != 9)


def test_divergence_does_not_read_ids(spark, no_ids):
    from pyspark.sql import functions as F

    docs = no_ids.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string")})
    found = source_divergence(docs).collect()
    assert all(r["lang"] == "" and r["source"] == "" for r in found)
    assert sorted(map(tuple, found)) == sorted(map(tuple, source_divergence(docs.withColumn("doc_id", F.lit(1))).collect()))


@pytest.mark.parametrize("case", ["small", "odd"])
def test_sequences_are_gapless_and_few(spark, tmp_path, odd_docs, case):
    """Places within sequences, as the query gives them, and no more sequences than the ids need, but one."""
    sf_dir = SMALL if case == "small" else table_of(tmp_path, odd_docs)
    packed = sorted(find("op10_")(spark, sf_dir).collect(), key=lambda r: (r["sequence_id"], r["offset"]))
    ends = {}
    for r in packed:
        assert r["offset"] == ends.get(r["sequence_id"], 0) and 0 < r["length"] <= 2048
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048
    assert len(ends) <= -(-sum(ends.values()) // 2048) + 1


def test_rules_keep_what_is_labelled_good(spark):
    """``kept`` is false where the base fails, else what the trees say, which is what the labels say."""
    sf_dir = "/root/testdata/sf0.01"
    judged = {r["doc_id"]: r for r in find("op9_")(spark, sf_dir).collect()}
    assert all(r["kept"] == (not r["base_failed"] and r["score"] >= 0.3) for r in judged.values())
    labels = duckdb.sql(f"select doc_id, quality from '{sf_dir}/labels.parquet' where quality is not null").fetchall()
    open_ = [(judged[i]["kept"], q == 1) for i, q in labels if not judged[i]["base_failed"]]
    assert len(open_) > 100 and sum(a == b for a, b in open_) >= 0.95 * len(open_)


def spans_of(text):
    return [(k, int(a), int(b)) for k, a, b in (one.split(":") for one in text.split(",") if one)]


@pytest.mark.parametrize("prefix, columns, order", [("op3_", brute.SECRETS, "start"), ("op5_", brute.PERSONAL, "kind")])
def test_spans_hold_the_base_and_lie_in_their_texts(spark, prefix, columns, order):
    kinds = [c[0] for c in columns]
    texts = dict(rows("documents", "doc_id, text"))
    for r in find(prefix)(spark, SMALL).collect():
        spans = spans_of(r["spans"])
        place = {k: i for i, k in enumerate(kinds)}
        keys = [(a, place.get(k, 9)) if order == "start" else (place[k], a) for k, a, _ in spans]
        assert keys == sorted(keys)
        assert all(0 <= a < b <= len(texts[r["doc_id"]] or "") for _, a, b in spans)
        listed = [s for s in spans if s[0] in place]
        for kind in kinds:
            assert sum(s[0] == kind for s in listed) >= r[f"n_{kind}"]
        if len(listed) == sum(r[f"n_{k}"] for k in kinds):  # the method added none of a listed kind
            assert brute.sha(brute.joined(listed, None)) == r["base_sha256"]
