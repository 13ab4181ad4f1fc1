"""Frequent lines and copies, with every anchor of three documents counted as hot."""

import brute
import numpy as np

from searchloom.llm import substrings


def test_hot_anchors_give_the_same_result(spark, monkeypatch):
    drawn = np.random.default_rng(4)

    def words(n):
        return [f"w{x}" for x in drawn.integers(0, 60, n)]

    line, passage = words(9), words(40)
    docs = []
    for i in range(60):
        parts = [words(int(drawn.integers(0, 40))), line, words(20)]
        if i % 3 == 0:
            parts.append(passage[int(drawn.integers(0, 20)) :])
        docs.append((i if i % 7 else 7 * (i // 14), "  ".join(w for p in parts for w in p)))
    docs += [(200 + i, docs[5][1]) for i in range(8)] + [(300, "x " * 100), (301, "y\n" + "x " * 30)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    for hot, shard in ((2000, 12_000), (3, 10)):
        monkeypatch.setattr(substrings, "HOT", hot)
        left = substrings.deduplicate_substrings(frame, shard=shard)
        found = sorted((r.doc_id, r.n_words, r.n_removed, brute.sha(r.kept_text)) for r in left.collect())
        assert found == sorted(brute.repeats(docs))
