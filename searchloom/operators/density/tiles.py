"""NumPy work on one bounded tile of points, and its feeding from Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

STRIP_ROWS = 128
# Half squared lengths that single precision can take the products of; others go in double precision.
SINGLE = (1e-25, 1e30)
TINY = 1e-35  # more than products lose that are too small for single precision
LIST_ROWS = 10_000


def per_group(
    keys: list[str], work: Callable[[pa.Table], pa.RecordBatch]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Run ``work`` on each group of an input sorted by ``keys``.

    One pass over the partition, holding one group at a time: many small groups
    cost no Python call of their own in Spark, and a group may span batches.
    """

    def cuts(table: pa.Table) -> list[int]:
        if len(table) < 2:
            return []
        changed = np.zeros(len(table) - 1, dtype=bool)
        for key in keys:
            column = table[key].combine_chunks()
            differs = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1))
            changed |= differs.to_numpy(zero_copy_only=False)
        return (np.flatnonzero(changed) + 1).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not len(table):
                continue
            if held and any(held[-1][k][-1] != table[k][0] for k in keys):
                yield work(pa.concat_tables(held))
                held = []
            start = 0
            for end in cuts(table):
                yield work(pa.concat_tables([*held, table.slice(start, end - start)]))
                held, start = [], end
            held.append(table.slice(start))
        if held:
            yield work(pa.concat_tables(held))

    return run


def contained(
    work: Callable[[pa.Table], pa.RecordBatch], schema: pa.Schema
) -> Callable[[pa.Table], pa.RecordBatch]:
    """``work`` on a topic's rows, so that whatever it raises stays with that topic.

    Its batches get a null column ``error``; a failure is one row with nothing but the topic and the
    text of the error.
    """
    marked = schema.append(pa.field("error", pa.string()))

    def run(table: pa.Table) -> pa.RecordBatch:
        try:
            found = work(table)
            return pa.record_batch([*found.columns, pa.nulls(len(found), pa.string())], schema=marked)
        except Exception as e:  # a topic's failure is its own
            row = {"topic": table["topic"][0].as_py(), "error": f"{type(e).__name__}: {e}"}
            return pa.RecordBatch.from_pylist([row], schema=marked)

    return run


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A column of equally long vectors as a matrix."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(len(column), -1), dtype=np.float64)


def row_reader(column: pa.ChunkedArray) -> Callable[[np.ndarray], np.ndarray]:
    """What gives the vectors at some places of a column as a matrix, without a copy of all the others."""
    chunks = [c for c in column.chunks if len(c)]
    parts = [c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1) for c in chunks]
    starts = np.cumsum([0, *map(len, chunks)])

    def rows(places: np.ndarray) -> np.ndarray:
        found = np.empty((len(places), parts[0].shape[1]))
        chunk = np.searchsorted(starts, places, side="right") - 1
        for c in np.unique(chunk).tolist():
            here = np.flatnonzero(chunk == c)
            found[here] = parts[c][places[here] - starts[c]]
        return found

    return rows


def _keep_bits(d: np.ndarray) -> np.ndarray:
    """Round to the first 38 bits of each number, whatever its size."""
    wide = d * (2.0**15 + 1)
    return wide - (wide - d)


def distances(a: np.ndarray, b: np.ndarray, same: bool = False) -> np.ndarray:
    """Squared distances between the rows of ``a`` and of ``b``, which are ``a`` if ``same``.

    A matrix product of the vectors less their common mean gives all of them; where
    the lengths cancel, so that a distance is small against its two vectors, it is
    taken anew from the differences.  What is left has a relative error far below
    the rounding that makes equal distances compare equal in whichever tile.
    """
    centre = (a.sum(axis=0) + b.sum(axis=0)) / (len(a) + len(b))
    left, right = a - centre, b - centre
    long_left, long_right = (left * left).sum(axis=1), (right * right).sum(axis=1)
    step = max(1, (1 << 20) // max(1, a.shape[1]))
    d = np.empty((len(a), len(b)))
    # A strip at a time, so that the matrix itself is all that is held of its size.
    for start in range(0, len(a), STRIP_ROWS):
        strip = d[start : start + STRIP_ROWS]
        np.matmul(left[start : start + STRIP_ROWS], right.T, out=strip)
        lengths = long_left[start : start + STRIP_ROWS, None] + long_right[None, :]
        strip *= -2.0
        strip += lengths
        lengths *= 0.0625
        i, j = np.nonzero(strip < lengths)
        for at in range(0, len(i), step):
            rows, columns = i[at : at + step], j[at : at + step]
            apart = a[start + rows] - b[columns]
            strip[rows, columns] = (apart * apart).sum(axis=1)
        strip[...] = _keep_bits(np.maximum(strip, 0.0, out=strip))
    if same:
        for start in range(0, len(a), STRIP_ROWS):
            across = d[start : start + STRIP_ROWS, start:]
            down = d[start:, start : start + STRIP_ROWS]
            across[...] = np.maximum(across, down.T)
            down[...] = across.T
    return d


def pair_distances(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Squared distances between rows ``i`` of ``x`` and ``j`` of ``y``, pair by pair, from the differences;
    the same for two vectors whichever tiles they lie in."""
    step = max(1, (1 << 20) // max(1, x.shape[1]))
    d = np.empty(len(i))
    for at in range(0, len(i), step):
        apart = x[i[at : at + step]]
        apart -= y[j[at : at + step]]
        apart *= apart
        d[at : at + step] = apart.sum(axis=1)
    return _keep_bits(d)


def _screens(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two matrices whose product is at most half the squared distance of each row of ``x`` and of ``y``, by little.

    In single precision, less what rounding can add, that of distances to 38 bits too, so that a threshold on
    the product tells which few pairs need their distance.
    """
    some = [part[:: max(1, len(part) // 32)] for part in (x, y)]
    centre = np.median(np.concatenate(some), axis=0)  # which a far outlier does not move
    sides = [x - centre, y - centre]
    halves = [0.5 * (side * side).sum(axis=1) for side in sides]
    longest = max(half.max(initial=0.0) for half in halves)
    kind = np.float32 if SINGLE[0] < longest < SINGLE[1] else np.float64
    dim = x.shape[1]
    less = 1.0 - (4 * dim + 32) * float(np.finfo(kind).eps) - 2.0**-36
    found = [np.ones((len(side), dim + 2), kind) for side in sides]
    for to, side, half, own, sign in zip(found, sides, halves, (dim, dim + 1), (-1.0, 1.0)):
        to[:, :dim] = sign * side
        to[:, own] = less * half
    return found[0], found[1]


def _upwards(squares: np.ndarray, kind: type = np.float32) -> np.ndarray:
    """Half of each number, rounded up."""
    with np.errstate(over="ignore"):
        return np.nextafter((0.5 * squares + TINY).astype(kind), kind(np.inf))


def _cold_reach(
    bound: np.ndarray, k: int, of: Callable[[np.ndarray, np.ndarray], np.ndarray]
) -> np.ndarray:
    """For each row of ``bound`` what its ``k`` nearest are not farther than; ``of`` gives distances by row and column."""
    if bound.shape[1] < k:
        return np.full(len(bound), np.inf)
    place = np.argpartition(bound, k - 1, axis=1)[:, :k]
    rows = np.repeat(np.arange(len(bound)), k)
    d = of(rows, place.ravel()).reshape(-1, k)
    d[np.isnan(np.take_along_axis(bound, place, axis=1))] = np.inf
    return d.max(axis=1)


def nearest_in_tile(
    x: np.ndarray,
    y: np.ndarray,
    same: bool,
    best: tuple[np.ndarray, np.ndarray],
    p: np.ndarray,
    q: np.ndarray,
    copies: np.ndarray,
    limit: np.ndarray,
) -> None:
    """Keep in ``best`` what the points ``p``, with the vectors ``x``, and ``q``, with ``y``, find nearer in each other.

    What is farther from a point than its ``limit`` may be left out.  Of each strip only the pairs get their distance that a product in single precision does not rule out.
    """
    left, right = _screens(x, y)
    kind, k = left.dtype.type, best[0].shape[1]
    for start in range(0, len(x), STRIP_ROWS):
        skip = start if same else 0
        bound = left[start : start + STRIP_ROWS] @ right[skip:].T
        rows, columns = p[start : start + STRIP_ROWS], q[skip:]
        if same:  # every pair once; nothing compares with nan
            bound[:, : len(rows)][np.tril_indices(len(rows))] = np.nan

        def apart(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            return pair_distances(x, y, start + i, skip + j)

        reach_rows, reach_columns = (np.minimum(best[0][ends, -1], limit[ends]) for ends in (rows, columns))
        cold = np.flatnonzero(np.isinf(reach_rows))
        if len(cold):
            reach_rows[cold] = _cold_reach(bound[cold], k, lambda i, j: apart(cold[i], j))
        cold_too = np.flatnonzero(np.isinf(reach_columns))
        if len(cold_too):
            turned = np.ascontiguousarray(bound[:, cold_too].T)
            reach_columns[cold_too] = _cold_reach(turned, k, lambda j, i: apart(i, cold_too[j]))
        near = bound <= _upwards(reach_rows, kind)[:, None]
        near |= bound <= _upwards(reach_columns, kind)
        i, j = np.divmod(np.flatnonzero(near), near.shape[1])
        if len(i):
            d = apart(i, j)
            ends, others = np.concatenate([rows[i], columns[j]]), np.concatenate([columns[j], rows[i]])
            _keep_nearest(best, ends, np.concatenate([d, d]), copies[others])


def _keep_nearest(
    best: tuple[np.ndarray, np.ndarray], points: np.ndarray, dist: np.ndarray, count: np.ndarray
) -> None:
    """Merge newly found neighbours, one to a place of ``points``, into the best known ones."""
    k = best[0].shape[1]
    touched, back = np.unique(points, return_inverse=True)
    back = np.concatenate([back, np.repeat(np.arange(len(touched)), k)])
    dist = np.concatenate([dist, best[0][touched].ravel()])
    count = np.concatenate([count, best[1][touched].ravel()])
    order = np.lexsort((dist, back))
    firsts = np.searchsorted(back[order], np.arange(len(touched)))
    kept = order[firsts[:, None] + np.arange(k)]
    best[0][touched], best[1][touched] = dist[kept], count[kept]


def nearest(
    d: np.ndarray, copies: np.ndarray, k: int, skip_diagonal: bool
) -> tuple[np.ndarray, np.ndarray]:
    """For each row of ``d`` its ``k`` smallest distances and how many points lie at each.

    Rows with fewer neighbours are filled up with infinite distances.
    """
    dist = np.full((len(d), k), np.inf)
    count = np.zeros((len(d), k), dtype=np.int64)
    for start in range(0, len(d), STRIP_ROWS):
        strip = np.array(d[start : start + STRIP_ROWS], order="C")
        rows = np.arange(len(strip))
        if skip_diagonal:
            strip[rows, start + rows] = np.inf
        for step in range(min(k, d.shape[1] - skip_diagonal)):
            place = strip.argmin(axis=1)
            dist[start + rows, step] = strip[rows, place]
            count[start + rows, step] = copies[place]
            strip[rows, place] = np.inf
    return dist, count


def core_from_nearest(
    dist: np.ndarray, count: np.ndarray, copies: np.ndarray, k: int
) -> np.ndarray:
    """Distance to the ``k``-th other point; the farthest if there are fewer."""
    core = np.zeros(len(copies))
    reached = copies - 1
    for step in range(dist.shape[1]):
        open_ = (reached < k) & np.isfinite(dist[:, step])
        core[open_] = dist[open_, step]
        reached = reached + count[:, step]
    return core


def _grow_tree(
    ids: np.ndarray,
    core: np.ndarray,
    reachable: Callable[[int], tuple[slice, np.ndarray]],
) -> tuple[np.ndarray, ...]:
    """Prim's algorithm under the order ``(weight, distance, a, b)`` of the point ids.

    ``reachable`` gives the points a point has edges to, and their distances.
    """
    n = len(ids)
    a, b = np.empty(n - 1, dtype=np.int64), np.empty(n - 1, dtype=np.int64)
    weight, distance = np.empty(n - 1), np.empty(n - 1)
    # Best edge into each point outside the tree; a weight of nan marks those inside,
    # since nothing compares with it.
    best_w, best_d = np.full(n, np.inf), np.full(n, np.inf)
    source = np.zeros(n, dtype=np.int64)
    best_w[0] = np.nan
    current = 0
    for step in range(n - 1):
        where, dist = reachable(current)
        seen_w, seen_d, seen_source = best_w[where], best_d[where], source[where]
        w = np.maximum(dist, core[where])
        np.maximum(w, core[current], out=w)
        better = w < seen_w
        tied = np.flatnonzero(w == seen_w)
        if len(tied):
            new, old = dist[tied], seen_d[tied]
            nearer = (new < old) | ((new == old) & (ids[current] < seen_source[tied]))
            better[tied[nearer]] = True
        np.copyto(seen_w, w, where=better)
        np.copyto(seen_d, dist, where=better)
        np.copyto(seen_source, ids[current], where=better)
        chosen = np.flatnonzero(best_w == np.fmin.reduce(best_w))
        if len(chosen) > 1:
            chosen = chosen[best_d[chosen] == best_d[chosen].min()]
            if len(chosen) > 1:
                ends, own = source[chosen], ids[chosen]
                chosen = chosen[np.lexsort((np.maximum(ends, own), np.minimum(ends, own)))]
        v = chosen[0]
        a[step], b[step] = min(source[v], ids[v]), max(source[v], ids[v])
        weight[step], distance[step] = best_w[v], best_d[v]
        best_w[v] = np.nan
        current = v
    return a, b, weight, distance


def spanning_tree(d: np.ndarray, core: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Edges ``(a, b, weight, distance)`` of the minimum spanning tree by mutual reachability."""
    everywhere = slice(0, len(ids))
    return _grow_tree(ids, core, lambda i: (everywhere, d[i]))


def tree_order(n: int, a: np.ndarray, b: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``n`` points of a spanning tree in an order, and the gap before each.

    Of any two points the largest gap between them is the heaviest edge on their way through the
    tree: joining components lie side by side, with the weight of their edge in between.
    """
    parent, last, after = list(range(n)), list(range(n)), [-1] * n
    gap = np.full(n, np.inf)
    order = np.argsort(weight, kind="stable")
    for w, x, y in zip(weight[order].tolist(), a[order].tolist(), b[order].tolist()):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        # A component starts with its root.
        parent[y] = x
        after[last[x]], last[x] = y, last[y]
        gap[y] = w
    places = []
    for start in (i for i, up in enumerate(parent) if up == i):
        while start >= 0:
            places.append(start)
            start = after[start]
    found = np.array(places, dtype=np.int64)
    return found, gap[found]


@dataclass(frozen=True)
class Crossing:
    """The vectors of points and of others, and for each two of the others half of what their tree joins them by."""

    left: np.ndarray
    right: np.ndarray
    joined: np.ndarray


def joined_by(gap: np.ndarray) -> np.ndarray:
    """For each two places half the largest gap between them, rounded up."""
    half = _upwards(gap)
    found = np.zeros((len(gap), len(gap)), half.dtype)
    for place in range(len(gap) - 1):
        np.maximum.accumulate(half[place + 1 :], out=found[place, place + 1 :])
    for start in range(0, len(gap), STRIP_ROWS):
        end = start + STRIP_ROWS
        found[end:, start:end] = found[start:end, end:].T
        own = found[start:end, start:end]
        np.maximum(own, own.T.copy(), out=own)
    return found


def crossing_tree(met: Crossing, core: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Edges between the first ``len(met.left)`` points and the rest, with all of these that a spanning tree can hold.

    An edge is left out if it is the heaviest of a cycle: heavier than another edge of the same point and all
    that joins the other ends of the two in their own tree.  A product in single precision tells most of them.
    """
    split = len(met.left)
    left, right = _screens(met.left, met.right)
    kind = left.dtype.type
    floor = np.nextafter((0.5 * core[split:]).astype(kind), kind(-np.inf))
    found = []
    for start in range(0, split, STRIP_ROWS):
        bound = left[start : start + STRIP_ROWS] @ right.T
        np.maximum(bound, floor, out=bound)
        rows, first = np.arange(start, start + len(bound)), bound.argmin(axis=1)
        weight = np.maximum(core[rows], core[split + first])
        np.maximum(weight, pair_distances(met.left, met.right, rows, first), out=weight)
        upto = np.maximum(met.joined[first], _upwards(weight, kind)[:, None])
        i, j = np.divmod(np.flatnonzero(bound <= upto), bound.shape[1])
        found.append((start + i, j))
    i, j = (np.concatenate(side) for side in zip(*found))
    distance = pair_distances(met.left, met.right, i, j)
    weight = np.maximum(np.maximum(core[i], core[split + j]), distance)
    ends, others = ids[i], ids[split + j]
    return np.minimum(ends, others), np.maximum(ends, others), weight, distance


def _in_parts(column: np.ndarray) -> Iterator[int]:
    """The numbers of a column as Python's own, which take five times as much, some of them at a time."""
    for start in range(0, len(column), LIST_ROWS):
        yield from column[start : start + LIST_ROWS].tolist()


def lightest_forest(edges: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """The minimum spanning forest of the given edges, lightest edge first."""
    a, b, weight, distance = (np.concatenate(column) for column in zip(*edges))
    order = np.lexsort((b, a, distance, weight))
    points = np.unique(np.concatenate([a, b]))
    first, second = (np.searchsorted(points, ends).astype(np.int32)[order] for ends in (a, b))
    parent = list(range(len(points)))
    kept = []
    for edge, x, y in zip(*map(_in_parts, (order, first, second))):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if x != y:
            parent[y] = x
            kept.append(edge)
    return a[kept], b[kept], weight[kept], distance[kept]


def leaf_clusters(
    a: np.ndarray,
    b: np.ndarray,
    weight: np.ndarray,
    distance: np.ndarray,
    copies: np.ndarray,
    min_size: int,
    min_split: float,
) -> np.ndarray:
    """Cluster number of each point, -1 for none; edges name points by their place.

    Edges join components from the lightest on.  Where two components of at
    least ``min_size`` points meet, the tree splits; either side that holds no
    split of its own is a leaf.  Splits below ``min_split`` do not count, unless
    there are no others: then the last one alone does.
    """
    n = len(copies)
    order = np.lexsort((b, a, distance, weight))

    def sweep(counts: Callable[[int], bool]) -> tuple[np.ndarray, int]:
        parent = list(range(n))
        size = copies.tolist()
        members = [[i] for i in range(n)]
        split = [False] * n
        label = np.full(n, -1, dtype=np.int64)
        leaves, last = 0, -1

        def root(i: int) -> int:
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for place, edge in enumerate(_in_parts(order)):
            x, y = root(a[edge]), root(b[edge])
            if size[x] >= min_size and size[y] >= min_size:
                last = place
                if counts(place):
                    for side in (x, y):
                        if not split[side]:
                            label[members[side]] = leaves
                            leaves += 1
                            split[side] = True
            if len(members[x]) < len(members[y]):
                x, y = y, x
            parent[y] = x
            size[x] += size[y]
            split[x] = split[x] or split[y]
            # Once split, a component can start no further leaf.
            if split[x]:
                members[x] = members[y] = []
            else:
                members[x].extend(members[y])
        return label, last

    label, last = sweep(lambda place: weight[order[place]] >= min_split)
    if last >= 0 and label.max(initial=-1) < 0:
        label, _ = sweep(lambda place: place == last)
    return label


def splitting_places(
    left: np.ndarray, right: np.ndarray, order: np.ndarray, size: np.ndarray, min_size: int
) -> np.ndarray:
    """Which edges of a tree join two components of ``min_size`` points, taken in ``order``.

    Edges name their ends by the place of a node, ``size`` holds the points of each node.
    """
    parent, held = list(range(len(size))), size.tolist()
    found = []
    for edge, x, y in zip(*map(_in_parts, (order, left[order], right[order]))):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        while parent[y] != y:
            parent[y] = parent[parent[y]]
            y = parent[y]
        if held[x] >= min_size and held[y] >= min_size:
            found.append(edge)
        if held[x] < held[y]:
            x, y = y, x
        parent[y] = x
        held[x] += held[y]
    return np.array(found, dtype=np.int64)
