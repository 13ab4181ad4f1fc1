"""Keys behind prefixes and inside paths are tested apart from what stands before them."""

import random

from conftest import prose
from pyspark.sql import functions as F

from searchloom.llm.secrets import KINDS, RANDOM, _with_pieces, find_secrets

BASE62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
FORMS = {
    "bare": ("{}", BASE62 + "+/"),
    "sk-": ("sk-{}", BASE62 + "+/"),
    "pk_live_": ("pk_live_{}", BASE62 + "+/"),
    "url": ("https://api.some-host.example/v1/session/keys/{}", BASE62),
    "query": ("https://host.example/get?id={}&n=2", BASE62 + "-_"),
}


def test_prefixed_keys_are_found(spark):
    draw = random.Random(11)
    rows, planted = [], []
    for form, (shape, alphabet) in FORMS.items():
        for _ in range(100):
            key = "".join(draw.choices(alphabet, k=40))
            text = prose(len(rows), 60) + " " + shape.format(key) + " " + prose(len(rows) + 7, 20)
            rows.append((len(rows), text))
            planted.append((form, text.index(key), text.index(key) + 40))
    common = ["well-known/self-explanatory_responsibilities", "/usr/share/documentation/internationalization-notes"]
    rows += [(len(planted) + i, prose(i, 30) + " " + word) for i, word in enumerate(common)]
    found = {r["doc_id"]: r["spans"] for r in find_secrets(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    caught = dict.fromkeys(FORMS, 0)
    for doc, (form, a, b) in enumerate(planted):
        spans = [(s["start"], s["end"]) for s in found[doc] if s["kind_no"] == KINDS.index(RANDOM)]
        assert not any(x <= p and q <= y and (x, y) != (p, q) for x, y in spans for p, q in spans)
        caught[form] += any(min(b, y) - max(a, x) >= 32 for x, y in spans)
    assert all(n >= 90 for n in caught.values()), caught
    assert not any(s["kind_no"] == KINDS.index(RANDOM) for i in range(len(common)) for s in found[len(planted) + i])


def test_pieces_lie_where_they_stand(spark):
    text = "sk-" + "a" * 16 + "/" + "b" * 20 + "_" + "c" * 3
    runs = spark.createDataFrame([(7, 3, 5, text)], "row_no bigint, kind_no int, start bigint, whole string")
    rows = _with_pieces(runs).collect()
    assert {r["run"] for r in rows} == {5} and all(r["end"] - r["start"] == len(r["whole"]) for r in rows)
    assert all(text[r["start"] - 5 : r["end"] - 5] == r["whole"] == r["part"] for r in rows)
    assert sorted(r["whole"] for r in rows) == sorted(
        [text, "a" * 16 + "/" + "b" * 20, "sk-" + "a" * 16, "b" * 20 + "_ccc", "a" * 16, "b" * 20]
    )
