"""The stages of the pipeline, each judged on its own input."""

import brute
import corpus_pipeline
import duckdb
import pytest
from test_against_brute_force import by_id, library, rows

SMALL = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_order_of_the_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality", "near_dedup", "decontamination", "personal_data", "packing",
    ]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_quality_keeps_good_documents(spark, documents):
    kept = STAGES["quality"](spark, documents, SMALL)
    assert kept.columns == documents.columns
    ids = {i for i, _ in texts(kept)}
    labels = dict(rows("labels", "doc_id, quality"))
    assert sum((i in ids) == (q == 1) for i, q in labels.items()) >= 0.95 * len(labels)


def test_one_document_of_each_group_stays(spark, documents):
    kept = STAGES["near_dedup"](spark, documents, SMALL)
    expected = [i for i, _, _, keep in brute.near_duplicates(texts(documents), 5) if keep]
    assert kept.columns == documents.columns
    assert sorted(kept.collect()) == sorted(r for r in documents.collect() if r["doc_id"] in set(expected))


def test_contaminated_documents_go(spark, documents):
    kept = STAGES["decontamination"](spark, documents, SMALL)
    hit = {r[0] for r in brute.contamination(texts(documents), rows("benchmark", "item_id, text")) if r[-1]}
    assert hit and sorted(kept.collect()) == sorted(r for r in documents.collect() if r["doc_id"] not in hit)


def test_personal_data_is_replaced(spark, documents):
    cleaned = STAGES["personal_data"](spark, documents, SMALL)
    before = dict(texts(documents))
    found = {r[0] for r in brute.personal(list(before.items())) if sum(r[1:5])}
    assert found and cleaned.columns == documents.columns
    for row in cleaned.collect():
        assert not sum(brute.personal([(0, row["text"])])[0][1:5])
        assert row["n_chars"] == len(row["text"])
        if row["doc_id"] not in found:
            assert row["text"] == before[row["doc_id"]]


def test_the_whole_run(spark):
    packed = corpus_pipeline.run(spark, SMALL).collect()
    assert packed and {r["doc_id"] for r in packed} <= {i for i, _ in rows("documents", "doc_id, text")}
    ends = {}
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048
    assert len(ends) <= -(-sum(ends.values()) // 2048) + 1


def _sf_dir(tmp_path):
    for table in ("benchmark", "labels"):
        (tmp_path / f"{table}.parquet").symlink_to(f"{SMALL}/{table}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", STAGES)
def test_odd_rows_and_clashing_columns(spark, tmp_path, odd_docs, pairs, name):
    """Nulls, empty texts, copies, repeated rows and ids: no crash, all columns, and the defined result."""
    out = STAGES[name](spark, odd_docs, _sf_dir(tmp_path))
    if name == "packing":
        found = out.select("doc_id", "piece", "start", "length", "ids_crc32").collect()
        assert by_id(map(tuple, found)) == by_id(brute.pieces(pairs, library()))
        return
    assert out.columns == odd_docs.columns
    left = sorted(i for i, _ in texts(out))
    if name == "near_dedup":
        assert left == [1, 3, 4, 5, 6, 8, 9, 11, 12, 13, 14]
    elif name == "decontamination":
        hit = [r[-1] for r in brute.contamination(pairs, rows("benchmark", "item_id, text"))]
        assert left == sorted(i for (i, _), h in zip(pairs, hit) if not h)
    elif name == "personal_data":
        assert left == sorted(i for i, _ in pairs)
        changed = dict(texts(out))[12]
        assert changed == "mail [EMAIL] or [IP] or [PHONE] or [CARD]"
        assert {i: t for i, t in texts(out) if i not in (12, 13)} == {i: t for i, t in pairs if i not in (12, 13)}


@pytest.mark.parametrize("name", STAGES)
def test_null_ids(spark, tmp_path, name):
    docs = spark.createDataFrame(
        [(None, "a b c d e f g h " * 9), (None, "a b c d e f g h " * 9), (None, None), (5, "other words here " * 30)],
        "doc_id bigint, text string",
    )
    out = STAGES[name](spark, docs, _sf_dir(tmp_path)).collect()
    if name == "near_dedup":
        assert sorted(str(r["doc_id"]) for r in out) == ["5", "None", "None"]
    elif name != "quality":
        assert len(out) == 4


@pytest.mark.parametrize("name", STAGES)
def test_no_documents(spark, tmp_path, no_docs, name):
    assert STAGES[name](spark, no_docs, _sf_dir(tmp_path)).collect() == []


def test_entry_works_without_this_part(tmp_path):
    """With the folders and the pipeline gone, the other queries are all there."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    top = Path(corpus_pipeline.__file__).parent
    shutil.copy(top / "__spark_entry__.py", tmp_path)
    shutil.copytree(top / "searchloom", tmp_path / "searchloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = (
        "from __spark_entry__ import oracle_sql, queries\n"
        "assert not any(n.startswith('op') or n == 'pipeline' for n in queries()), list(queries())\n"
        "assert set(queries()) == set(oracle_sql())\n"
        "print(len(queries()))"
    )
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path)
    assert done.returncode == 0 and int(done.stdout.split()[-1]) > 40, done.stderr
