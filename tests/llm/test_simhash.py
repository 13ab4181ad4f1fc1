"""Balls of fingerprints that meet half way, against all pairs."""

import random

import brute
import pytest

from searchloom.llm.components import components
from searchloom.llm.simhash import ball_links, other_masks, simhash_duplicates


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def planted(seed, count):
    """Fingerprints at 0 to 5 bits from each other, chains, and the ends of the range."""
    draw = random.Random(seed)
    out = {0, 2**64 - 1, 2**63, 1}
    for _ in range(count):
        x = draw.getrandbits(64)
        out.add(x)
        for _ in range(draw.randint(0, 4)):
            for bit in draw.sample(range(64), draw.randint(1, 5)):
                x ^= 1 << bit
            out.add(x)
    return out


@pytest.mark.parametrize("radius, crowd", [(0, 9), (1, 9), (2, 9), (3, 10**6), (3, 3), (4, 9)])
def test_links_join_what_is_near(spark, radius, crowd):
    prints = planted(radius, 60)
    # Many that share a half, so that it is cut.
    draw = random.Random(7)
    prints |= {(draw.getrandbits(5) << 40 | draw.getrandbits(3)) ^ (1 << draw.randrange(64)) for _ in range(80)}
    table = spark.createDataFrame([(signed(p),) for p in prints], "fingerprint bigint")
    links = [(a % 2**64, b % 2**64) for a, b in ball_links(table, radius, crowd=crowd).collect()]
    assert all(0 < (a ^ b).bit_count() <= radius for a, b in links)
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    expected = brute.connected(prints, radius)
    ours = {frozenset(p for p in prints if find(p) == r) for r in map(find, prints)}
    theirs = {frozenset(p for p in prints if expected[p] == r) for r in expected.values()}
    assert ours == theirs


def test_masks():
    near, far = other_masks(3)
    assert [len(m) for m in near] == [33, 1] and len(far) == 496
    with pytest.raises(ValueError):
        other_masks(6)


def test_dense_cluster_is_linear(spark):
    """Fingerprints that are all near to each other cost stars, not pairs."""
    prints = [1 << a | 1 << b for a in range(40) for b in range(a)]
    table = spark.createDataFrame([(p,) for p in prints], "fingerprint bigint")
    links = ball_links(table)
    assert links.count() < 200 * len(prints)
    assert components(links).select("root").distinct().count() == 1


def test_hot_copies_null_ids_and_clashing_columns(spark):
    rows = [(i, "the same few words again and again", 1, 2, 3) for i in range(3000)]
    rows += [(None, "some other words that stand alone here", 1, 2, 3)] * 2 + [(9000, None, 1, 2, 3), (9001, " ", 1, 2, 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, fingerprint int, root int, salt int")
    found = simhash_duplicates(docs).select("doc_id", "component_id", "kept").collect()
    assert sorted((r["doc_id"] for r in found if r["kept"] and r["doc_id"] is not None)) == [0, 9000]
    assert [tuple(r) for r in found if r["doc_id"] is None] == [(None, None, True)] * 2
    assert {r["component_id"] for r in found if r["doc_id"] is not None and r["doc_id"] < 3000} == {0}
