"""What tiles leave out by products in single precision, against all distances."""

import numpy as np
import pytest

from searchloom.operators.density import blocks, tiles
from searchloom.operators.density.tiles import core_from_nearest, distances, lightest_forest, nearest, spanning_tree


def scattered(shift=0.0, size=1.0, far=0.0):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 9)) + 5 * rng.integers(0, 6, size=(400, 1))
    x[::5] = x[::5].round()
    x = np.unique(x, axis=0)
    rng.shuffle(x)
    x = x * size + shift
    x[3] += far
    return x, rng.integers(1, 3, len(x))


def keyed(edges):
    return sorted(zip(*(column.tolist() for column in edges)))


ODD = [{}, {"shift": 1e6}, {"far": 1e9}, {"size": 1e-22}, {"size": 1e25}]


@pytest.mark.parametrize("odd", ODD)
@pytest.mark.parametrize("k", [1, 2, 6])
def test_tiles_find_the_same_neighbours_and_trees(monkeypatch, odd, k):
    monkeypatch.setattr(blocks, "LEAST_SIDE", 37)
    monkeypatch.setattr(tiles, "STRIP_ROWS", 16)
    x, copies = scattered(**odd)
    n, rows = len(x), lambda places: x[places]
    whole = distances(x, x, True)
    core = core_from_nearest(*nearest(whole, copies, k, True), copies, k)
    first, second = np.arange(n // 3), np.arange(n // 3, n)
    met = [*blocks.tiles_of(first), *blocks.tiles_of(second)]
    own = core_from_nearest(*blocks.nearest_in_tiles(rows, met, copies, k), copies, k)
    near = blocks.nearest_in_tiles(rows, [*met, *blocks.tiles_of(first, second)], copies, k, own)
    assert np.allclose(core_from_nearest(*near, copies, k), core, rtol=2.0**-37, atol=0)
    ids = np.arange(n)[::-1] * 3 + 7
    expected = lightest_forest([spanning_tree(whole, core, ids)])
    assert np.allclose(np.sort(blocks.forest_within(rows, np.arange(n), core, ids)[2]), np.sort(expected[2]), rtol=2.0**-37)
    trees = tuple(map(np.concatenate, zip(*(blocks.forest_within(rows, p, core, ids) for p in (first, second)))))
    between = blocks.forest_between(rows, first, second, trees, core, ids)
    found = lightest_forest([trees, between])
    assert np.allclose(found[2], expected[2], rtol=2.0**-37)
    if not odd:
        assert keyed(found) == keyed(expected) and 0 < len(between[0]) < n // 2


def test_few_pairs_of_a_tile_get_their_distance(monkeypatch):
    rng = np.random.default_rng(1)
    x, asked = rng.normal(size=(3000, 32)), []
    honest = tiles.pair_distances

    def counted(a, b, i, j):
        asked.append(len(i))
        return honest(a, b, i, j)

    monkeypatch.setattr(tiles, "pair_distances", counted)
    monkeypatch.setattr(blocks, "LEAST_SIDE", 1000)
    near = blocks.nearest_in_tiles(lambda p: x[p], blocks.tiles_of(np.arange(3000)), np.ones(3000, int), 2)
    assert sum(asked) < 3000 * 3000 / 2 / 10
    asked.clear()
    blocks.forest_within(lambda p: x[p], np.arange(3000), near[0][:, 1], np.arange(3000))
    assert sum(asked) < 3000 * 3000 / 2 / 50


def test_an_order_of_a_tree_tells_what_joins_two_points():
    rng = np.random.default_rng(6)
    x = rng.normal(size=(60, 3))
    d = distances(x, x, True)
    a, b, weight, _ = spanning_tree(d, np.zeros(60), np.arange(60))
    order, gap = tiles.tree_order(60, a, b, weight)
    joined = tiles.joined_by(gap)
    heaviest = d.copy()
    for via in range(60):
        heaviest = np.minimum(heaviest, np.maximum(heaviest[:, [via]], heaviest[via]))
    assert sorted(order) == list(range(60))
    assert np.allclose(2 * joined, heaviest[np.ix_(order, order)], rtol=1e-6, atol=1e-30)
