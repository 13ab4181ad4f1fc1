"""Groups whose links run through several components of one bucket."""

import brute
import numpy as np

from searchloom.llm.near_dedup import near_duplicates


def test_chains_of_edits_are_followed(spark):
    """Each text differs from the next by little and from the first by much."""
    drawn = np.random.default_rng(9)
    docs = []
    for family in range(6):
        words = [f"w{x}" for x in drawn.integers(0, 5000, 200)]
        for step in range(40):
            docs.append((len(docs), " ".join(words)))
            for _ in range(1 + family % 3):
                words[int(drawn.integers(0, 200))] = f"v{drawn.integers(0, 5000)}"
    docs += [(len(docs) + i, docs[i * 7][1]) for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    for tile in (1000, 16):
        found = near_duplicates(frame, shingle=4, tile=tile)
        rows = sorted(tuple(r) for r in found.select("doc_id", "n_shingles", "component_id", "kept").collect())
        assert rows == sorted(brute.near_duplicates(docs))
