"""Packing goes on until no bin has a step left, at the size of a part too."""

from itertools import combinations

import numpy as np
import pytest

from searchloom.llm.packing import CAPACITY, pack, pack_pieces


def steps_left(sizes, bins, capacity):
    """Moves and exchanges of one or two pieces that empty a bin into one at least as full."""
    held = {b: sizes[bins == b].tolist() for b in np.unique(bins)}
    for a, b in ((a, b) for a in held for b in held if a != b and sum(held[b]) >= sum(held[a])):
        room = capacity - sum(held[b])
        for n_given, n_taken in ((1, 0), (1, 1), (2, 1), (1, 2)):
            for given in combinations(held[a], n_given):
                for taken in combinations(held[b], n_taken):
                    if 0 < sum(given) - sum(taken) <= room:
                        yield a, b, given, taken


@pytest.mark.parametrize("seed", range(8))
def test_no_step_is_left(seed):
    sizes = np.random.default_rng(seed).integers(180, 480, 90)
    bins, _, fill = pack(sizes, 1000, 10**6)
    if len(np.unique(bins)) > -(-sizes.sum() // 1000):
        assert next(steps_left(sizes, bins, 1000), None) is None


def test_a_part_of_full_size_is_searched_to_its_end(spark):
    sizes = np.random.default_rng(0).integers(400, 1201, 8000)
    frame = spark.createDataFrame([(i, int(n)) for i, n in enumerate(sizes)], "row_no bigint, length bigint")
    rows = pack_pieces(frame).collect()
    fills = {}
    for row in rows:
        fills[row["sequence_id"]] = fills.get(row["sequence_id"], 0) + row["length"]
    assert len(rows) == 8000 and max(fills.values()) <= CAPACITY
    assert len(fills) <= 3145
