"""Exact neighbour and spanning-tree stages for topics larger than one tile.

A large topic is cut into blocks around pivots, and its blocks into a few groups.  Each point is
sent to the pairs of groups it takes part in: all for spanning trees, for core distances those with
a block that may hold a nearer neighbour.  A task holds the two groups of its pair, works through
them in tiles of bounded size, and emits a few numbers per point.  Every pair of points meets in
exactly one task.  Pairs of groups are gone through in rounds, each written before the next, so that
the copies of a vector do not all lie on disk at once.  So a topic is cut as finely as pivots can tell its parts apart, while a vector
is sent only as often as parallel work and memory ask for.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from searchloom.config import ClusterConfig
from searchloom.operators.density.components import look_up
from searchloom.operators.density.pivots import near_pairs
from searchloom.operators.density.tiles import (
    Crossing,
    contained,
    crossing_tree,
    distances,
    joined_by,
    lightest_forest,
    nearest_in_tile,
    pair_distances,
    per_group,
    row_reader,
    spanning_tree,
    tree_order,
)
from searchloom.session import shuffle_partitions, stage

GROUP_PAIR = ["topic", "gi", "gj"]
# A topic gets this many blocks if its size allows, for pivots to tell apart; more only if
# they would not fit in memory.
USUAL_BLOCKS = 32
# Tiles have this many rows: of smaller ones the calls take longer than the numbers, and larger
# ones only take more memory (32 MB a matrix, of which a task holds two).
LEAST_SIDE = 2000
GROUP_ROWS = 30_000  # points of one group of blocks at most, that tasks stay short
EDGES_HELD = 200_000  # edges from which on a task thins those of its tiles
ROUND_BYTES = 256 << 20  # of vectors sent at once, or else each of them twice
FARTHEST = 2**31 - 1  # beyond any two groups
OWN_ROWS = 20_000  # points that a task compares within their blocks


def block_count(config: ClusterConfig) -> Column:
    """Blocks of a topic, from its number of points and dimensions."""
    points = F.col("distinct_points")
    fit_tile = F.ceil(points / config.tile_rows)
    fit_memory = F.ceil(points * F.col("dim") * 8 / config.block_bytes)
    return F.least(fit_tile, F.greatest(fit_memory, F.lit(USUAL_BLOCKS))).cast("int")


def with_groups(points: DataFrame, squares: float, tasks: int, config: ClusterConfig) -> DataFrame:
    """Add ``groups``, into how many a topic's blocks are put together, and the ``group`` of each point.

    ``squares`` is the sum of the squared sizes of all topics, which goes with the work.  Together
    the topics get some ``tasks`` pairs of groups, each by its share, and more only where a group
    would be too large.
    """
    n = F.col("distinct_points")
    fit_memory = n * F.size("embedding") * 8 / config.block_bytes
    wanted = F.ceil(F.greatest(n * (2.0 * tasks / max(squares, 1.0)) ** 0.5, n / GROUP_ROWS, fit_memory))
    groups = F.least(wanted, F.col("blocks")).cast("int")
    group = F.floor(F.col("block") * F.col("groups") / F.col("blocks")).cast("int")
    return points.withColumn("groups", groups).withColumn("group", group)


@dataclass(frozen=True)
class Round:
    """The pairs of groups that lie ``low`` to ``high`` apart on the circle of their topic's groups, and
    how many tasks work on them.

    With one such distance a group is in two pairs at most, so a round sends a vector twice.
    """

    low: int
    high: int
    tasks: int

    def others(self) -> Column:
        """The groups that ``group`` meets in this round."""
        group, groups = F.col("group"), F.col("groups")
        last = F.least(F.lit(self.high), F.floor(groups / 2).cast("int"))
        apart = F.sequence(F.lit(self.low), last)
        sides = [F.transform(apart, lambda d: F.pmod(group + sign * d, groups)) for sign in (1, -1)]
        return F.when(last >= self.low, F.array_distinct(F.concat(*sides)))

    def apart(self) -> Column:
        between = F.col("gj") - F.col("gi")
        return F.least(between, F.col("groups") - between)

    def number(self) -> Column:
        """Counts a topic's pairs of this round."""
        start = F.when(F.col("gj") - F.col("gi") == self.apart(), F.col("gi")).otherwise(F.col("gj"))
        return (self.apart() - self.low) * F.col("groups") + start


def rounds_of(grouped: DataFrame, least: int, most: int) -> list[Round]:
    """How to go through all pairs of groups, so that what is shuffled at once stays a few times the vectors.

    A round has at least one distance, and as many more as ``ROUND_BYTES`` of vectors allow.  It
    gets a task per pair, from ``least`` to ``most``.
    """
    topics = grouped.groupBy("topic").agg(
        F.first("groups").alias("groups"),
        F.sum(F.size("embedding").cast("bigint") * 8).alias("bytes"),
    )
    sizes = topics.groupBy("groups").agg(F.count(F.lit(1)).alias("topics"), F.sum("bytes").alias("bytes")).collect()
    held = sum(r["bytes"] for r in sizes)
    widest = max((r["groups"] for r in sizes), default=0) // 2
    step = max(1, int(ROUND_BYTES // max(2 * held, 1)))

    def pairs(groups: int, d: int) -> int:
        if 2 * d > groups:
            return 0
        return groups // 2 if 2 * d == groups else groups

    found = []
    for low in range(0, widest + 1, step):
        high = min(low + step - 1, widest)
        here = sum(r["topics"] * pairs(r["groups"], d) for r in sizes for d in range(low, high + 1))
        found.append(Round(low, high, int(min(most, max(here, least)))))
    return found


def _dealt(rows: DataFrame, number: Column, tasks: int, order: Sequence[Column | str]) -> DataFrame:
    """Pairs of groups are numbered and dealt out in turn; hashing them would leave some tasks with
    several pairs and others with none.  The rows of a pair come in ``order``."""
    task = F.pmod(F.xxhash64("topic") % tasks + number, F.lit(tasks)).cast("int")
    return (
        rows.withColumn("task", task)
        .repartitionById(tasks, "task")
        .drop("task")
        .sortWithinPartitions(*GROUP_PAIR, *order)
    )


def pair_up(
    points: DataFrame,
    tasks: int,
    low: int = 0,
    high: int = FARTHEST,
    order: Sequence[Column | str] = ("rid",),
    kept: Sequence[str] = (),
) -> DataFrame:
    """Send every point to the pairs of groups ``gi <= gj`` it belongs to, or to those of one round.

    Its ``groups`` are dropped unless they are ``kept``.
    """
    met = Round(low, high, tasks)
    paired = (
        points.withColumn("other", F.explode(met.others()))
        .withColumn("gi", F.least("group", "other"))
        .withColumn("gj", F.greatest("group", "other"))
    )
    dropped = {"groups", "other"} - set(kept)
    return _dealt(paired, met.number(), met.tasks, order).drop(*dropped)


Tile = tuple[np.ndarray, np.ndarray, bool]
Rows = Callable[[np.ndarray], np.ndarray]
Edges = tuple[np.ndarray, ...]


def _cut(places: np.ndarray) -> list[np.ndarray]:
    return [places[k : k + LEAST_SIDE] for k in range(0, len(places), LEAST_SIDE)]


def tiles_of(first: np.ndarray, second: np.ndarray | None = None) -> list[Tile]:
    """Which places to compare with which, tile by tile, and whether they are the same.

    The ``first`` are compared with the ``second``, or among themselves.
    """
    if second is not None:
        return [(p, q, False) for p in _cut(first) for q in _cut(second)]
    own = _cut(first)
    return [(p, q, p is q) for n, p in enumerate(own) for q in own[n:]]


def nearest_in_tiles(
    rows: Rows, tiles: Iterable[Tile], copies: np.ndarray, k: int, limit: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """For each point its ``k`` smallest distances within the ``tiles`` and how many points lie at each.

    ``rows`` gives the vectors at some places.  One tile's are held at a time.  What is farther from a point
    than its ``limit`` may be left out.
    """
    limit = np.full(len(copies), np.inf) if limit is None else limit
    best = np.full((len(copies), k), np.inf), np.zeros((len(copies), k), dtype=np.int64)
    for p, q, same in tiles:
        x = rows(p)
        nearest_in_tile(x, x if same else rows(q), same, best, p, q, copies, limit)
    return best


class _Forest:
    """The minimum spanning forest of the edges put in, thinned now and then."""

    def __init__(self, points: int) -> None:
        self.edges, self.held, self.most = [], 0, max(EDGES_HELD, 4 * points)

    def add(self, edges: Edges) -> None:
        self.edges.append(edges)
        self.held += len(edges[0])
        if self.held > self.most:
            self.edges = [self.lightest()]
            self.held = len(self.edges[0][0])

    def lightest(self) -> Edges:
        if len(self.edges) == 1:
            return lightest_forest(self.edges)
        return lightest_forest(self.edges) if self.edges else (np.empty(0),) * 4


def _cross(rows: Rows, forest: _Forest, first: list[np.ndarray], q: np.ndarray, gap: np.ndarray, core, ids) -> None:
    """Put in what joins the points ``q``, in the order of a tree that has the ``gap`` before each, to those of some tiles."""
    right, joined = rows(q), joined_by(gap)
    for p in first:
        both = np.concatenate([p, q])
        forest.add(crossing_tree(Crossing(rows(p), right, joined), core[both], ids[both]))


def forest_within(rows: Rows, places: np.ndarray, core: np.ndarray, ids: np.ndarray) -> Edges:
    """The minimum spanning tree by mutual reachability of the points at some places.

    Every tile has a tree of its own, which tells what edges to tiles before it matter.
    """
    forest, tiles = _Forest(len(places)), _cut(places)
    for n, q in enumerate(tiles):
        x = rows(q)
        d = distances(x, x, True)
        near, far, _, _ = spanning_tree(d, core[q], ids[q])
        del d  # before the next tile's
        named = np.argsort(ids[q])
        a, b = (named[np.searchsorted(ids[q], ends, sorter=named)] for ends in (near, far))
        distance = pair_distances(x, x, a, b)
        weight = np.maximum(np.maximum(core[q][a], core[q][b]), distance)
        forest.add((near, far, weight, distance))
        if n:
            order, gap = tree_order(len(q), a, b, weight)
            _cross(rows, forest, tiles[:n], q[order], gap, core, ids)
    return forest.edges[0] if len(tiles) == 1 else forest.lightest()


def forest_between(
    rows: Rows, first: np.ndarray, second: np.ndarray, trees: Edges, core: np.ndarray, ids: np.ndarray
) -> Edges:
    """The edges between the ``first`` and the ``second`` places in the minimum spanning tree of both,
    whose own ``trees`` are given."""
    forest, named = _Forest(len(first) + len(second)), np.argsort(ids)

    def places(ends: np.ndarray) -> np.ndarray:
        return named[np.searchsorted(ids, ends, sorter=named)]

    late = np.zeros(len(ids), dtype=bool)
    late[second] = True
    number = np.zeros(len(ids), dtype=np.int64)
    number[second] = np.arange(len(second))
    a, b = (places(ends) for ends in trees[:2])
    own = late[a]
    if len(a) != len(first) + len(second) - 2 or own.sum() != len(second) - 1:
        raise RuntimeError("groups without a tree")
    forest.add(trees)
    order, gap = tree_order(len(second), number[a[own]], number[b[own]], trees[2][own])
    tiles = _cut(first)
    for q, before in zip(_cut(second[order]), _cut(gap)):
        _cross(rows, forest, tiles, q, before, core, ids)
    found = forest.lightest()
    crossing = late[places(found[0])] != late[places(found[1])]
    return tuple(column[crossing] for column in found)


def _own_blocks(points: DataFrame, tasks: int) -> DataFrame:
    """Every block with itself."""
    met = points.withColumn("partners", F.array("block"))
    return met.repartition(tasks, "topic", "block").sortWithinPartitions("topic", "block", "rid")


def _kept_pairs(points: DataFrame, pairs: DataFrame, met_in: Round) -> DataFrame:
    """Every row of a point in those pairs of groups of a round that its block has partners in, given the pairs
    ``(topic, i, j)``; rows with a ``limit`` come last."""
    blocks = points.select("topic", "block", "group", "groups").distinct()

    def of(side: str, group: str) -> DataFrame:
        return blocks.select("topic", F.col("block").alias(side), F.col("group").alias(group), "groups")

    met = pairs.join(of("i", "g_i"), ["topic", "i"]).join(of("j", "g_j").drop("groups"), ["topic", "j"])
    met = met.select(
        "topic", "i", "j", "groups", F.least("g_i", "g_j").alias("gi"), F.greatest("g_i", "g_j").alias("gj")
    )
    met = met.where(met_in.apart().between(met_in.low, met_in.high)).withColumn("number", met_in.number())
    sides = [
        met.select("topic", F.col(a).alias("block"), F.col(b).alias("partner"), "gi", "gj", "number")
        for a, b in (("i", "j"), ("j", "i"))
    ]
    listed = (
        sides[0]
        .unionByName(sides[1])
        .groupBy("topic", "block", "gi", "gj", "number")
        .agg(F.sort_array(F.collect_list("partner")).alias("partners"))
        .groupBy("topic", "block")
        .agg(F.collect_list(F.struct("gi", "gj", "number", "partners")).alias("pairs"))
    )
    # Written, so that its size is known: a small one is sent to where the vectors lie.
    met = look_up(points.drop("group", "groups"), ["topic", "block"], stage(listed, "block-partners"))
    met = met.withColumn("pair", F.explode("pairs")).drop("pairs")
    met = met.select("*", "pair.gi", "pair.gj", "pair.partners")
    return _dealt(met, F.col("pair.number"), met_in.tasks, [F.col("limit").isNotNull(), "block", "rid"]).drop("pair")


def block_core_distances(
    points: DataFrame, facts: DataFrame, config: ClusterConfig, rounds: list[Round]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``points`` without their vectors, with ``core``: each task reports its nearest few per point,
    the least of all win.

    ``core`` is a squared distance.  Blocks are compared with themselves first; how far a
    point's neighbours are by then tells which other pairs ``(topic, i, j)`` are looked at, returned beside, as are the
    topics that failed.  It is sent along, so that only what is nearer is looked for there.
    """
    min_samples = config.min_samples
    schema = pa.schema(
        [("topic", pa.string()), ("rid", pa.int64()), ("dist", pa.float64()), ("count", pa.int64())]
    )

    def compared(table: pa.Table) -> Iterator[Tile]:
        """Each block with itself or with its later partners, whichever it is to meet."""
        block = table["block"].to_numpy()
        for own in np.unique(block).tolist():
            places = np.flatnonzero(block == own)
            partners = table["partners"][int(places[0])].as_py()
            if partners == [own]:
                yield from tiles_of(places)
            elif later := [p for p in partners if p > own]:
                yield from tiles_of(places, np.flatnonzero(np.isin(block, later)))

    def near(table: pa.Table) -> pa.RecordBatch:
        split = table["limit"].null_count
        here, reached = table.slice(0, split), table.slice(split)
        limit = reached["limit"].to_numpy() if len(reached) else None
        if limit is not None and not np.array_equal(here["rid"].to_numpy(), reached["rid"].to_numpy()):
            raise RuntimeError("points without a limit")
        copies = here["copies"].to_numpy()
        best = nearest_in_tiles(row_reader(here["embedding"]), compared(here), copies, min_samples, limit)
        found = np.isfinite(best[0])
        rid = np.repeat(here["rid"].to_numpy(), found.sum(axis=1))
        topic = [table["topic"][0].as_py()] * len(rid)
        return pa.record_batch(
            [
                pa.array(topic, pa.string()),
                pa.array(rid),
                pa.array(best[0][found]),
                pa.array(best[1][found]),
            ],
            schema=schema,
        )

    def reports(dealt: DataFrame, keys: list[str], name: str) -> DataFrame:
        fields = "topic string, rid bigint, dist double, count bigint, error string"
        return stage(dealt.mapInArrow(per_group(keys, contained(near, schema)), fields), name)

    kept = ["topic", "rid", "copies", "block", "group", "groups"]
    slim = points.select(*kept, "embedding", F.lit(None).cast("double").alias("limit"))
    own_tasks = max(shuffle_partitions(points.sparkSession), -(-points.count() // OWN_ROWS))
    own = _own_blocks(slim.drop("group", "groups"), own_tasks)
    own, failed = split_errors(reports(own, ["topic", "block"], "own-neighbours"))
    bare = points.drop("embedding")
    needed = F.when(F.col("reached") >= min_samples, F.col("core")).otherwise(math.inf)
    limits = _with_core(bare.select(*kept), own, min_samples).withColumn("limit", needed)
    limits = stage(limits.select(*kept, F.lit(None).cast("array<double>").alias("embedding"), "limit"), "limits")
    reach = limits.groupBy("topic", "block").agg(F.sqrt(F.max("limit")).alias("reach"))
    sent = slim.unionByName(limits)
    pairs = stage(near_pairs(facts, reach), "near-pairs")
    others, more = split_errors(
        reduce(
            DataFrame.unionByName,
            [reports(_kept_pairs(sent, pairs, r), GROUP_PAIR, "other-neighbours") for r in rounds],
        )
    )
    cored = _with_core(bare, own.unionByName(others), min_samples).drop("reached")
    return cored, pairs, failed.unionByName(more)


def _with_core(points: DataFrame, reports: DataFrame, min_samples: int) -> DataFrame:
    """Add ``core``, where ``min_samples`` other points are ``reached``, from reports of neighbours."""
    merged = reports.groupBy("topic", "rid").agg(
        F.sort_array(F.collect_list(F.struct("dist", "count"))).alias("near")
    )
    # The fold walks outwards until min_samples other points are covered.
    start = F.struct((F.col("copies") - 1).alias("reached"), F.lit(0.0).alias("core"))
    fold = F.aggregate(
        F.coalesce("near", F.array().cast("array<struct<dist:double,count:bigint>>")),
        start,
        lambda acc, n: F.when(acc["reached"] >= min_samples, acc).otherwise(
            F.struct((acc["reached"] + n["count"]).alias("reached"), n["dist"].alias("core"))
        ),
    )
    met = points.join(merged, ["topic", "rid"], "left").withColumn("fold", fold)
    return met.select("*", "fold.reached", "fold.core").drop("near", "fold")


def split_errors(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What tasks found, and ``(topic, error)`` of those that failed."""
    good = F.col("error").isNull()
    return found.where(good).drop("error"), found.where(~good).select("topic", "error")


def block_edges(
    points: DataFrame, cored: DataFrame, config: ClusterConfig, rounds: list[Round]
) -> DataFrame:
    """Candidate edges, with a column ``error``: the spanning trees of all groups and what joins each two, written round by round.

    Together these hold the topic's own spanning tree, since an edge that is not
    the heaviest on any cycle of the whole is not so on a cycle of a part.  ``cored`` are the
    ``points`` without their vectors, with ``core``; both are sent to the tasks, which lay them side by side.
    The trees of the groups come first and are sent along with their points.
    """
    ends = [("a", pa.int64()), ("b", pa.int64()), ("weight", pa.float64()), ("distance", pa.float64())]
    schema = pa.schema([("topic", pa.string()), ("group", pa.int32()), ("groups", pa.int32()), *ends])
    names = [name for name, _ in ends]

    def forest(table: pa.Table) -> pa.RecordBatch:
        # The points come first, then their core distances, so neither part is a copy.
        edges = len(table) - table["b"].null_count
        split = len(table) - edges - (len(table) - table["core"].null_count)
        here, cores = table.slice(0, split), table.slice(split, len(table) - edges - split)
        rid, core, group = here["rid"].to_numpy(), cores["core"].to_numpy(), here["group"].to_numpy()
        if not np.array_equal(rid, cores["rid"].to_numpy()):
            raise RuntimeError("points without a core distance")
        i, j = table["gi"][0].as_py(), table["gj"][0].as_py()
        first, second = np.flatnonzero(group == i), np.flatnonzero(group == j)
        rows = row_reader(here["embedding"])
        if i == j:
            found = forest_within(rows, first, core, rid)
        else:
            trees = table.slice(len(table) - edges)
            trees = tuple(trees[c].to_numpy() for c in ("rid", *names[1:]))
            found = forest_between(rows, first, second, trees, core, rid)
        size = len(found[0])
        of = [pa.array([value] * size, kind) for value, kind in (
            (table["topic"][0].as_py(), pa.string()),
            (i if i == j else None, pa.int32()),
            (table["groups"][0].as_py(), pa.int32()),
        )]
        columns = [pa.array(column.astype(kind.to_pandas_dtype())) for column, (_, kind) in zip(found, ends)]
        return pa.record_batch([*of, *columns], schema=schema)

    def part(df: DataFrame, **columns: Column | str) -> DataFrame:
        """Rows of one of the three kinds that a task is sent."""
        whole = {
            "rid": "bigint", "embedding": "array<double>", "core": "double",
            "b": "bigint", "weight": "double", "distance": "double",
        }
        kept = [F.col(columns[c]).alias(c) if c in columns else F.lit(None).cast(t).alias(c) for c, t in whole.items()]
        return df.select("topic", "group", "groups", *kept)

    fields = "topic string, group int, groups int, a bigint, b bigint, weight double, distance double, error string"
    work = per_group(GROUP_PAIR, contained(forest, schema))
    order = [F.col("b").isNotNull(), F.col("core").isNotNull(), "group", "rid"]

    def met(rows: DataFrame, r: Round) -> DataFrame:
        paired = pair_up(rows, r.tasks, r.low, r.high, order, ["groups"])
        return stage(paired.mapInArrow(work, fields), "candidate-edges")

    rows = part(points, rid="rid", embedding="embedding").unionByName(part(cored, rid="rid", core="core"))
    own = met(rows, Round(0, 0, rounds[0].tasks))
    trees = part(own.where(F.col("error").isNull()), rid="a", b="b", weight="weight", distance="distance")
    rows = rows.unionByName(trees)
    others = [met(rows, replace(r, low=max(r.low, 1))) for r in rounds if r.high]
    return reduce(DataFrame.unionByName, [own, *others]).drop("group", "groups")
