"""Near-duplicate documents: banded SetSketch registers, likelihood estimates, exact checks."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from searchloom.llm.bitmap import bits_set, collect_bitmap, split_by
from searchloom.llm.blocks import LOWER, Block, Words, blocks, byte_class
from searchloom.llm.components import components
from searchloom.llm.setsketch import equal_share, estimate, registers
from searchloom.llm.tables import id_text, numbered, text_key
from searchloom.session import stage

BANDS, ROWS = 24, 4
SHARE = 80  # per cent of the union that two linked sets share at least
SLACK = 0.22  # five standard errors of the estimate at 96 registers
TILE = 1000
SALTS = 32
BITMAP_BITS = 24

_SPACE = byte_class("space")
_HEAD = "head_of_group_" + "f" * 8  # a name no table has


def shingle_sets(block: Block, k: int) -> list[np.ndarray]:
    """The distinct hashes of each row's shingles of ``k`` words, or of all its words if fewer."""
    words = Words(block, _SPACE, LOWER)
    whole = words.windows(k)
    short = {n: words.windows(n) for n in np.unique(words.counts) if 0 < n < k}
    sets = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        n = b - a
        if n >= k:
            sets.append(np.unique(whole[a : b - k + 1]))
        else:
            sets.append(short[n][a:b][:1] if n else whole[:0])
    return sets


def _digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def sketches(docs: DataFrame, k: int, bands: int, rows: int) -> DataFrame:
    """``doc_id, text_key, n, node, bands``: set size, digest of the set, and band values of its registers.

    A band's value is its ``rows`` registers of 16 bits as one number, so it is exact.
    Empty sets have neither node nor bands.
    """
    if rows != 4:
        raise ValueError("a band is four registers of 16 bits")

    def sketch(batches):
        for batch in batches:
            n, node, values, counts = [], [], [np.zeros((0, bands), np.int64)], []
            for block in blocks(batch.column(2)):
                sets = shingle_sets(block, k)
                n += [len(s) for s in sets]
                node += [_digest(s) if len(s) else None for s in sets]
                filled = [s for s in sets if len(s)]
                counts += [bands if len(s) else 0 for s in sets]
                if filled:
                    begin = np.concatenate([[0], np.cumsum([len(s) for s in filled])[:-1]])
                    drawn = registers(np.concatenate(filled), begin, bands * rows)
                    values.append(np.ascontiguousarray(drawn).view(np.int64))
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n, pa.int64()),
                    pa.array(node, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values).ravel())),
                ],
                names=["doc_id", "text_key", "n", "node", "bands"],
            )

    schema = "doc_id bigint, text_key bigint, n bigint, node binary, bands array<bigint>"
    return docs.select("doc_id", text_key().alias("text_key"), "text").mapInArrow(sketch, schema)


def sets_of(docs: DataFrame, k: int, marked: np.ndarray) -> DataFrame:
    """``node, hashes`` of the documents whose (node, id) the bitmap marks, once per node."""
    pointer = docs.sparkSession.sparkContext.broadcast(marked)

    def pick(batches):
        bitmap = pointer.value
        for batch in batches:
            node, hashes = [], []
            ids = batch.column(0).to_pylist()
            for block in blocks(batch.column(1)):
                for row, found in enumerate(shingle_sets(block, k)):
                    if not len(found):
                        continue
                    digest = _digest(found)
                    if bits_set(bitmap, _marks([digest], [ids[block.first + row]]))[0]:
                        node.append(digest)
                        hashes.append(found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.binary()), pa.array(hashes, pa.binary())], names=["node", "hashes"]
            )

    return docs.mapInArrow(pick, "node binary, hashes binary").dropDuplicates(["node"])


def _marks(digests: list[bytes], ids: list[int | None]) -> np.ndarray:
    """A hash of a set's digest and the id of the document that stands for it."""
    texts = [d + str(i).encode() for d, i in zip(digests, ids)]
    return np.array(
        [int.from_bytes(hashlib.blake2b(t, digest_size=8).digest(), "little") for t in texts], np.uint64
    )


def _node_marks(nodes: DataFrame) -> DataFrame:
    def marks(batches):
        for batch in batches:
            found = _marks(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["hash"])

    return nodes.select("node", "first_id").mapInArrow(marks, "hash bigint")


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    return len(a) + len(b) - len(np.union1d(a, b))


def verified(pairs: DataFrame, sets: DataFrame, share: int) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets share ``share`` per cent of their union."""
    with_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("set_b")), "b")
    with_both = with_b.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("set_a")), "a")

    def check(batches):
        for batch in batches:
            holds = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = _shared(x, y)
                holds.append(100 * both >= share * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(holds, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"]
            )

    return with_both.select("a", "b", "set_a", "set_b").mapInArrow(check, "a binary, b binary")


def _registers(column: pa.Array | pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks().flatten() if isinstance(column, pa.ChunkedArray) else column.flatten()
    return np.asarray(flat, np.int64).reshape(rows, -1).view(np.uint16)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """Equal values as equal numbers."""
    return np.unique(np.array(column.to_pylist(), object), return_inverse=True)[1]


def _promising(share: int, slack: float):
    """The members of one tile that have a likely partner in another component."""

    def run(group: pa.Table) -> pa.Table:
        drawn, sizes = _registers(group["bands"], group.num_rows), group["n"].to_numpy()
        root, base = _numbers(group["root"]), group["base"].to_numpy()
        wanted = np.zeros(group.num_rows, bool)
        for i in np.flatnonzero(~base):
            fits = 100 * np.minimum(sizes, sizes[i]) >= share * np.maximum(sizes, sizes[i])
            others = np.flatnonzero((root != root[i]) & fits)
            equal = (drawn[others] == drawn[i]).mean(1)
            likely = others[equal >= equal_share(share / 100 - slack, sizes[i], sizes[others])]
            wanted[likely] = True
            wanted[i] |= len(likely) > 0
        return group.select(["band", "value", "tile", "node", "root", "base"]).filter(pa.array(wanted))

    return run


def _links(share: int, columns: int = 2048):
    """Links between the components of one tile, enough to join those that are linked.

    Shared shingles of all pairs are counted as products of a matrix of members by
    shingles, over those shingles that two members hold.
    """

    def run(group: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x, np.uint64) for x in group["hashes"].to_pylist()]
        root, base, nodes = _numbers(group["root"]), group["base"].to_numpy(), group["node"].to_pylist()
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, element, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        twice = held[element] > 1
        owner, element = owner[twice], np.unique(element[twice], return_inverse=True)[1]
        order = np.argsort(element, kind="stable")
        owner, element = owner[order], element[order]
        left = np.flatnonzero(~base)
        place = np.full(len(sets), -1)
        place[left] = np.arange(len(left))
        shared = np.zeros((len(left), len(sets)), np.float32)  # whole numbers below 2^24
        for low in range(0, int(element[-1]) + 1 if len(element) else 0, columns):
            a, b = np.searchsorted(element, (low, low + columns))
            held_by = np.zeros((len(sets), columns), np.float32)
            held_by[owner[a:b], element[a:b] - low] = 1.0
            shared += held_by[left] @ held_by.T
        union = sizes[left][:, None] + sizes[None, :] - shared
        linked = (100.0 * shared >= share * union) & (root[left][:, None] != root[None, :])
        x, y = np.nonzero(linked)
        x = left[x]
        low, high = np.minimum(root[x], root[y]), np.maximum(root[x], root[y])
        _, first = np.unique(low * (root.max() + 1) + high, return_index=True)
        parent = list(range(int(root.max()) + 1))

        def top(r: int) -> int:
            while parent[r] != r:
                parent[r] = parent[parent[r]]
                r = parent[r]
            return r

        found = []
        for i in first.tolist():
            p, q = top(int(low[i])), top(int(high[i]))
            if p != q:
                parent[max(p, q)] = min(p, q)
                found.append((nodes[x[i]], nodes[y[i]]))
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _cross_links(mixed: DataFrame, sets: DataFrame, share: int, slack: float, tile: int) -> DataFrame:
    """Links across the components of each bucket, checked on full sets.

    In a bucket the members of its largest component are the base, dealt out in tiles
    of about ``tile``; the others meet every tile of the base and each other, also in tiles.
    Registers come first: only members with a likely partner elsewhere bring their sets.
    """
    bucket = ["band", "value"]
    sizes = mixed.groupBy(*bucket, "root").agg(F.count(F.lit(1)).alias("size"))
    largest = sizes.groupBy(*bucket).agg(
        F.max(F.struct("size", "root")).alias("top"), F.sum("size").alias("whole")
    )
    plan = largest.select(
        *bucket,
        F.col("top.root").alias("top_root"),
        F.ceil(F.col("top.size") / tile).cast("int").alias("base_tiles"),
        F.ceil((F.col("whole") - F.col("top.size")) / tile).cast("int").alias("other_tiles"),
    )
    salted = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(7))))
    tiles = F.when(F.col("base"), F.col("base_tiles")).otherwise(F.col("other_tiles"))
    rows = (
        mixed.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(8)).cast("int"))
        .join(salted, [*bucket, "salt"])
        .drop("salt")
        .withColumn("base", F.col("root") == F.col("top_root"))
        .withColumn("mine", F.pmod(F.hash("node"), tiles))
    )

    def name(kind: int, x, y):
        return (F.lit(kind).cast("bigint") * (1 << 60) + x.cast("bigint") * (1 << 30) + y.cast("bigint"))

    others = F.sequence(F.lit(0), F.col("other_tiles") - 1)
    mine = F.col("mine")
    with_base = F.transform(F.sequence(F.lit(0), F.col("base_tiles") - 1), lambda t: name(0, t, mine))
    among = F.transform(others, lambda t: name(1, F.least(t, mine), F.greatest(t, mine)))
    as_base = F.transform(others, lambda t: name(0, mine, t))
    placed = rows.withColumn("tile", F.explode(F.when(F.col("base"), as_base).otherwise(F.concat(with_base, among))))
    key = [*bucket, "tile"]
    promising = stage(
        placed.select(*key, "node", "root", "n", "bands", "base")
        .groupBy(*key)
        .applyInArrow(_promising(share, slack), "band int, value bigint, tile bigint, node binary, root binary, base boolean"),
        "promising",
    )
    return promising.join(sets, "node").groupBy(*key).applyInArrow(_links(share), "a binary, b binary").distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    share: int = SHARE,
    bands: int = BANDS,
    bitmap_bits: int = BITMAP_BITS,
    tile: int = TILE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``row_no, doc_id, text_key, n_shingles, component_id, kept, group``.

    A document's set holds its distinct shingles of ``shingle`` words (ASCII letters
    lower-cased, words between white space); with fewer words, the sequence of all.
    Documents are linked if ``100 * intersection >= share * union``; ``component_id`` is
    the smallest id that can be reached, ``kept`` marks the rows that bear it, ``group`` names
    groups of two rows or more.  Null and empty texts have an empty set and are linked with nothing.  Rows with one set are one
    node, so copies cost one row each; rows that share an id are told apart; null ids come
    last, and a component of null ids alone has a null ``component_id`` and keeps its
    rows.  Columns other than id and text are not read.

    1. One scan draws ``4 * bands`` SetSketch registers; a link at ``share`` = 80 has no
       equal band with a chance of (1 - 0.8^4)^24 = 3e-6, at 90 per cent of 1e-11.
    2. In each bucket of equal bands nodes meet the least node of their part of it.
       Pairs the registers make likely are checked on full sets, which a second scan
       fetches for nodes in some bucket of two or more.
    3. Buckets that still hold several components are gone through in tiles: members that
       the registers give a likely partner in another component bring their full sets, and
       a task counts what they share.  So no link found by a band is lost; pairs are not
       formed within what has grown together, and no more links than components come out.

    Hot keys: buckets are joined over salted keys and their hubs split with their size;
    copies of one set over ``SALTS`` keys.
    """
    source = id_text(docs, id_col, text_col)
    drawn = numbered(sketches(source, shingle, bands, ROWS), "sketches")
    filled = drawn.where(F.col("node").isNotNull())
    classes = stage(
        filled.groupBy("node").agg(
            F.min("doc_id").alias("first_id"), F.min("row_no").alias("first_row"), F.count(F.lit(1)).alias("copies")
        ),
        "classes",
    )
    heads = classes.select(F.col("first_row").alias("row_no"), "first_id").join(
        filled.select("row_no", "node", "n", "bands"), "row_no"
    )
    heads = stage(heads.drop("row_no"), "class-sketches")

    buckets = heads.select("node", F.posexplode("bands").alias("band", "value"))
    several = (
        buckets.groupBy("band", "value")
        .agg(F.count(F.lit(1)).alias("size"))
        .where(F.col("size") > 1)
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(7))))
    )
    shared = stage(
        buckets.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(8)).cast("int"))
        .join(several, ["band", "value", "salt"])
        .drop("salt"),
        "buckets",
    )
    members = stage(
        shared.select("node").distinct().join(heads, "node").select("node", "first_id", "n", "bands"), "candidates"
    )
    marked = collect_bitmap(_node_marks(members), bitmap_bits)
    sets = stage(sets_of(source, shingle, marked), "sets")

    pairs = _likely(_hub_pairs(shared, tile), members, share)
    edges = stage(verified(pairs, sets, share), "links")
    roots = components(edges)
    mixed = stage(_mixed(shared, roots, members), "mixed")
    found = stage(_cross_links(mixed, sets, share, SLACK, tile), "links")
    if not found.isEmpty():
        roots = components(edges.unionByName(found))

    named = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"), F.sum("copies").alias("rows"))
    salted = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    by_root = least.where(F.col("rows") > 1).select("root", "component_id", salted)
    salt = F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")
    table = named.withColumn("salt", salt).join(by_root, ["root", "salt"]).select("node", "root", "component_id", salted)
    # rows alone in their group are not in the table
    looked_up = drawn.withColumn("salt", F.pmod(F.xxhash64("row_no"), F.lit(SALTS)).cast("int")).join(
        table, ["node", "salt"], "left"
    )
    component = F.when(F.col("root").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id"))
    return looked_up.select(
        "row_no",
        "doc_id",
        "text_key",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc_id")).alias("kept"),
        F.col("root").alias("group"),
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, share: int = SHARE, bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """``docs`` with one row of each group: that of the smallest id (null last), then text key.

    Only rows of groups, as a bitmap of fixed size tells them, are joined and moved.
    Rows without words stay.  Of rows that share the id and the text that stay, the least in
    its other columns stays.  All columns stay as they are.
    """
    found = near_duplicates(docs, shingle, share)
    grouped = stage(found.where(F.col("group").isNotNull()).select("group", "doc_id", "text_key"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")).alias("first")
    heads = grouped.groupBy("group").agg(first).select("first.doc_id", "first.text_key", F.lit(True).alias("head"))
    members = grouped.select("doc_id", "text_key").distinct()
    same = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_key"] == b["text_key"])
    decided = members.join(heads, same(members, heads), "left").select(
        members["doc_id"].alias("group_id"), members["text_key"].alias("group_key"), F.coalesce("head", F.lit(False)).alias("head")
    )
    mark = F.xxhash64("doc_id", "text_key")
    marked = collect_bitmap(members.select(mark.alias("hash")), bitmap_bits)
    doc_id, key = docs["doc_id"].cast("bigint"), text_key(docs["text"].cast("string"))
    alone, maybe = split_by(docs, F.xxhash64(doc_id, key), marked)
    here = maybe["doc_id"].cast("bigint").eqNullSafe(decided["group_id"]) & (
        text_key(maybe["text"].cast("string")) == decided["group_key"]
    )
    met = maybe.join(decided, here, "left").select(*[maybe[c] for c in docs.columns], decided["head"].alias(_HEAD))
    free = met.where(F.col(_HEAD).isNull()).drop(_HEAD)
    kept = least_rows(met.where(F.col(_HEAD)).drop(_HEAD), ["doc_id", "text"])
    return alone.unionByName(free).unionByName(kept)


def least_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: of those that share it the least, column by column.

    Columns that have no order, such as maps, decide nothing; they come from the row chosen.
    """
    others = [f for f in rows.schema.fields if f.name not in keys]
    ordered = [f.name for f in others if not re.search("map<|variant", f.dataType.simpleString())]
    if not others:
        return rows.dropDuplicates(keys)
    place = F.struct(*[F.col(f"`{c}`") for c in ordered]) if ordered else F.lit(0)
    names = [f"`{f.name}`" for f in others]
    chosen = rows.groupBy(*keys).agg(F.min_by(F.struct(*names), place).alias(_HEAD))
    back = [f"`{_HEAD}`.{n}" for n in names]
    return chosen.select(*keys, *back).select(*[f"`{c}`" for c in rows.columns])


def _hub_pairs(shared: DataFrame, part: int) -> DataFrame:
    """Each node with the least node of its part of a bucket, and those parts' hubs in turn."""
    parts = F.ceil(F.col("size") / part).cast("int")
    cut = shared.withColumn("part", F.pmod(F.hash("node"), parts))
    first = Window.partitionBy("band", "value", "part").orderBy("node")
    hubs = cut.withColumn("hub", F.first("node").over(first))
    inner = hubs.where(F.col("hub") != F.col("node")).select(F.col("hub").alias("a"), F.col("node").alias("b"))
    tops = hubs.where((F.col("hub") == F.col("node")) & (F.col("size") > part))
    top = Window.partitionBy("band", "value").orderBy("node")
    outer = (
        tops.withColumn("top", F.first("node").over(top))
        .where(F.col("top") != F.col("node"))
        .select(F.col("top").alias("a"), F.col("node").alias("b"))
    )
    return inner.unionByName(outer).distinct()


def _likely(pairs: DataFrame, members: DataFrame, share: int) -> DataFrame:
    """Pairs whose estimated similarity is within the slack of ``share``."""
    left = members.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("bands").alias("bands_a"))
    right = members.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("bands").alias("bands_b"))
    joined = pairs.join(right, "b").join(left, "a")

    def keep(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            a, b = (
                np.asarray(batch.column(i).flatten(), np.int64).reshape(batch.num_rows, -1).view(np.uint16)
                for i in (4, 5)
            )
            n_a, n_b = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            likely = estimate(a, b, n_a, n_b) >= share / 100 - SLACK
            likely &= 100 * np.minimum(n_a, n_b) >= share * np.maximum(n_a, n_b)
            yield pa.RecordBatch.from_arrays(
                [c.filter(pa.array(likely)) for c in batch.columns[:2]], names=["a", "b"]
            )

    wanted = joined.select("a", "b", "n_a", "n_b", "bands_a", "bands_b")
    return stage(wanted.mapInArrow(keep, "a binary, b binary"), "likely")


def _mixed(shared: DataFrame, roots: DataFrame, members: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component, with their registers.

    A bucket of two has had its only pair checked, and of buckets with the same members
    one is enough.
    """
    larger = shared.where(F.col("size") > 2)
    rows = larger.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = (
        rows.groupBy("band", "value")
        .agg(
            F.min("root").alias("low"),
            F.max("root").alias("high"),
            F.count(F.lit(1)).alias("size"),
            F.bit_xor(F.xxhash64("node")).alias("mark"),
            F.sum(F.hash("node").cast("bigint")).alias("sum"),
        )
        .where(F.col("low") != F.col("high"))
        .groupBy("size", "mark", "sum")
        .agg(F.min(F.struct("band", "value")).alias("one"))
        .select("one.band", "one.value", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("salt"))
    )
    mixed = rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(8)).cast("int")).join(
        several, ["band", "value", "salt"], "left_semi"
    )
    return mixed.select("band", "value", "node", "root").join(members.select("node", "n", "bands"), "node")
