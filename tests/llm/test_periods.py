"""Periodic runs against their definition."""

import random

import brute
import numpy as np
import pytest

from searchloom.llm.periods import find_runs, periodic_runs


def repetitive(draw):
    letters = draw.choice(["a", "ab", "abc", "abcdefgh"])
    words = []
    for _ in range(draw.randint(0, 6)):
        words += [draw.choice(letters) for _ in range(draw.randint(1, 7))] * draw.randint(1, 9)
        if draw.random() < 0.3:
            words += words[-draw.randint(1, 20) :] * draw.randint(1, 5)
    return words


@pytest.mark.parametrize("seed", range(8))
@pytest.mark.parametrize("least, power", [(6, 4), (1, 3)])
def test_random_rows(seed, least, power):
    draw = random.Random(seed)
    for _ in range(60):
        rows = [repetitive(draw) for _ in range(draw.randint(0, 4))]
        codes = np.array([ord(w) for row in rows for w in row], np.int64)
        first = np.cumsum([0] + [len(row) for row in rows])
        start, end, period = find_runs(codes, first, least, power)
        expected = [
            (a + f, a + f + n, q)
            for row, f in zip(rows, first.tolist())
            for a, n, q in brute.periodic_stretches(row, least, power)
        ]
        assert list(zip(start.tolist(), end.tolist(), period.tolist())) == expected


def test_two_periods_are_refused():
    with pytest.raises(ValueError):
        find_runs(np.zeros(4, np.int64), np.array([0, 4]), 4, 2)


def test_long_texts_of_one_word_and_one_passage(spark):
    """Half a million words: the cost does not go with the square of a word's count."""
    passage = " ".join(f"w{i}" for i in range(1000))
    rows = [(1, "so " * 500_000, 7), (2, " ".join([passage] * 500), 7), (3, "so \t so\nso so so so", 7), (4, "so " * 5, 7)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, runs int")
    found = {r["doc_id"]: r for r in periodic_runs(docs).collect()}
    assert [tuple(x) for x in found[1]["runs"]] == [(0, 500_000, 1)] and found[1]["collapsed"] == "so"
    assert [tuple(x) for x in found[2]["runs"]] == [(0, 500_000, 1000)] and found[2]["collapsed"] == passage
    assert [tuple(x) for x in found[3]["runs"]] == [(0, 6, 1)] and found[3]["n_words"] == 6
    assert found[4]["runs"] == [] and found[4]["collapsed"] == "so so so so so"
