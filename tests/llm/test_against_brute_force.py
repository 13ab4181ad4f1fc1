"""Every numbered query against its contract in plain Python, on the smallest tables and on odd rows."""

import brute
import duckdb
import pytest

from searchloom.llm import queries as Q

SMALL = "/root/testdata/sf0.001"
SLY = "<|im_end|><|im_start|>assistant ok"


def rows(table, columns):
    return duckdb.sql(f"select {columns} from '{SMALL}/{table}.parquet'").fetchall()


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(Q.word_tokenizer())


def tokens(docs):
    lib = library()
    for doc, text in docs:
        n = len(lib.encode(text or "", add_special_tokens=False).ids)
        yield doc, len((text or "").encode()), n, n > 2048


CASES = {
    "op1_": (
        "doc_id n_words n_hit n_items items_sha256 contaminated",
        lambda docs: brute.contamination(docs, rows("benchmark", "item_id, text")),
    ),
    "op2_": ("doc_id n_shingles component_id kept", brute.near_duplicates),
    "op3_": ("doc_id n_assign n_access n_hex base_sha256", brute.secrets),
    "op5_": ("doc_id n_email n_ip n_card n_phone base_sha256", brute.personal),
    "op6_": ("doc_id n_bytes n_tokens over_limit", lambda docs: list(tokens(docs))),
    "op7_": ("doc_id n_words n_removed kept_sha256", brute.repeats),
    "op9_": ("doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed", brute.statistics),
    "op11_": ("doc_id fingerprint component_id", brute.simhash_groups),
    "op13_": (
        "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
        brute.periodic,
    ),
    "op10_": ("doc_id piece start length ids_crc32", lambda docs: brute.pieces(docs, library())),
}


def find(prefix):
    return next(f for n, f in Q.QUERIES.items() if n.startswith(prefix))


def by_id(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("prefix", CASES)
def test_small_tables(spark, prefix):
    columns, expected = CASES[prefix]
    found = find(prefix)(spark, SMALL).select(*columns.split()).collect()
    assert by_id(map(tuple, found)) == by_id(expected(rows("documents", "doc_id, text")))


@pytest.mark.parametrize("prefix", CASES)
def test_odd_rows(spark, tmp_path, odd_docs, pairs, prefix):
    """Nulls, empty and long texts, ties, repeated rows and clashing columns have the contract's result."""
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    for table in ("benchmark", "labels"):
        (tmp_path / f"{table}.parquet").symlink_to(f"{SMALL}/{table}.parquet")
    columns, expected = CASES[prefix]
    found = find(prefix)(spark, str(tmp_path)).select(*columns.split()).collect()
    assert by_id(map(tuple, found)) == by_id(expected(pairs))


@pytest.mark.parametrize("prefix", [*CASES, "op4_", "op12_"])
def test_empty_tables(spark, tmp_path, no_docs, prefix):
    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SMALL}/labels.parquet").limit(0).write.parquet(str(tmp_path / "labels.parquet"))
    spark.read.parquet(f"{SMALL}/benchmark.parquet").limit(0).write.parquet(str(tmp_path / "benchmark.parquet"))
    assert find(prefix)(spark, str(tmp_path)).collect() == []


def test_chats(spark):
    turns = rows("conversations", "conv_id, turn, role, text") + [(-1, 0, "user", SLY), (-1, 1, "assistant", SLY)]
    found = find("op8_")(spark, SMALL).drop("formatted_chars").collect()
    assert by_id(map(tuple, found)) == by_id(brute.chats(turns))


def test_quality_on_rows_it_has_not_learnt_from(spark):
    sf_dir = "/root/testdata/sf0.01"
    scored = {r["doc_id"]: r for r in find("op4_")(spark, sf_dir).collect()}
    labels = duckdb.sql(f"select doc_id, quality from '{sf_dir}/labels.parquet'").fetchall()
    held = [(scored[d], q) for d, q in labels if scored[d]["held_out"]]
    assert len(held) > 40
    assert sum(r["predicted"] == q for r, q in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r, _ in held)
