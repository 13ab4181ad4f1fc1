"""SimHash near duplicates: balls around fingerprints that meet in the middle.

Two fingerprints within ``radius`` bits meet half way.  Each has the ball of radius
``radius // 2`` around it (*near* variants).  If the radius is odd, fingerprints with an odd
number of ones also have variants one bit further out (*far* ones): at a distance of
exactly ``radius`` one of two fingerprints has an odd number of ones.  Of those bits one half of
the word holds at least ``(radius + 1) / 2``, so far variants that change bits of one half only
are enough.  For a radius of 3 that is 65 variants, and 992 more for every second
fingerprint, where the whole ball of radius 2 has 2,081.

At one variant two near fingerprints, or a near and a far one, are within the radius by the triangle
inequality.  So the least near fingerprint of a variant is linked with all others there: a star that
joins what any link there would, without forming pairs.

Variants are shuffled by one half of theirs, once by the upper and once by the lower.  Variants
that differ in the other half alone travel as one row and are told apart in the task: 66 rows
of two numbers for 561 variants on average.  A half that very many fingerprints share is cut by
the other half of the variants, so no half is one task.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from searchloom.llm.blocks import LOWER, Block, blocks, byte_class
from searchloom.llm.components import components
from searchloom.llm.lexicon import joined
from searchloom.llm.tables import id_text
from searchloom.session import shuffle_partitions, stage

RADIUS, SHINGLE, SEED = 3, 3, 42
ROWS_A_TASK = 1 << 21
ROWS_AT_ONCE = 1 << 13  # rows laid out into variants together
CROWD = 1 << 12  # fingerprints around one half beyond which it is cut
FEW_HALVES = 100_000  # rows of 24 bytes that may be broadcast
SPREAD = 0x3C6EF35F
SALTS = 32

_SPACE = byte_class("space")
_SLICE = 1 << 16


def shingle_hashes(block: Block, k: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of every shingle of ``k`` words of each row, repeats included, and their number per row.

    ASCII letters are lower-cased and words joined by one space; a row of fewer words has one
    shingle, all its words.
    """
    starts, ends, first = block.runs(_SPACE[block.data])
    data, _ = joined(block, starts, ends, first, np.ones(len(starts), bool), LOWER)
    counts = np.diff(first)
    # The place of each word in the joined bytes: rows of words lose the space at their end.
    gaps = np.repeat(np.cumsum(counts > 0) - (counts > 0), counts)
    stop = np.cumsum(ends - starts + 1) - 1 - gaps
    begin = stop - (ends - starts)
    size = np.minimum(counts, k)
    number = np.where(counts > 0, counts - size + 1, 0)
    word = np.repeat(first[:-1] - (np.cumsum(number) - number), number) + np.arange(number.sum())
    last = word + np.repeat(size, number) - 1
    text, digest = data.tobytes(), xxhash.xxh64_intdigest
    hashes = [digest(text[a:b], seed) for a, b in zip(begin[word].tolist(), stop[last].tolist())]
    return np.array(hashes, np.uint64), number


def majority(hashes: np.ndarray, number: np.ndarray) -> np.ndarray:
    """The bits that over half of each row's hashes have; zero for rows without any."""
    ones = np.zeros((len(number), 64), np.int64)
    row = np.repeat(np.arange(len(number)), number)
    for low in range(0, len(hashes), _SLICE):
        part, rows = hashes[low : low + _SLICE], row[low : low + _SLICE]
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        begin = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
        ones[rows[begin]] += np.add.reduceat(bits, begin, axis=0, dtype=np.int64)
    over = np.packbits(2 * ones > number[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(over).view("<u8")[:, 0] if len(number) else np.zeros(0, np.uint64)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id, fingerprint`` of ``(doc_id, text)``: 64 bits as a signed number.  Nothing is shuffled."""

    def draw(batches):
        for batch in batches:
            found = [majority(*shingle_hashes(block, shingle, seed)) for block in blocks(batch.column(1))]
            bits = np.concatenate([np.zeros(0, np.uint64), *found]).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits)], names=["doc_id", "fingerprint"])

    return docs.mapInArrow(draw, "doc_id bigint, fingerprint bigint")


def half_masks(size: int) -> list[int]:
    """All ways to change ``size`` bits of half a word."""
    return [sum(1 << b for b in chosen) for chosen in combinations(range(32), size)]


def other_masks(radius: int) -> tuple[list[np.ndarray], np.ndarray]:
    """What variants change in the other half: near ones by the bits spent on this half, and far ones."""
    if not 0 <= radius <= 5:
        raise ValueError("a radius of 0 to 5 bits is supported")
    half = radius // 2
    near = [[m for size in range(half - spent + 1) for m in half_masks(size)] for spent in range(half + 1)]
    return [np.array(m, np.int64) for m in near], np.array(half_masks(half + 1) if radius % 2 else [], np.int64)


def _share(other, parts):
    """Which of the ``parts`` of a shared half a variant's other half belongs to."""
    return (other * SPREAD >> 16) % parts


def _meet(radius: int):
    """Links of each variant's least near fingerprint with the others there.

    Rows ``(side, half, share, parts, fingerprint)`` come sorted by the first three.  Halves with a single
    row are skipped; the rows of the others are laid out into variants some millions at a time.
    """
    near, far = other_masks(radius)

    def stars(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        group, side, half, share, parts, prints = rows
        unsigned = prints.view(np.uint64)
        halves = (unsigned & np.uint64(0xFFFFFFFF)).astype(np.int64), (unsigned >> np.uint64(32)).astype(np.int64)
        own, other = np.where(side == 0, halves[0], halves[1]), np.where(side == 0, halves[1], halves[0])
        spent = np.bitwise_count((own ^ half).view(np.uint64))
        odd = np.bitwise_count(unsigned) % 2 == 1
        sets = [(np.flatnonzero(spent == c), masks, 0) for c, masks in enumerate(near)]
        sets.append((np.flatnonzero((spent == 0) & odd), far, 1))
        place = np.concatenate([np.repeat(at, len(masks)) for at, masks, _ in sets])
        variant = np.concatenate([(other[at][:, None] ^ masks[None, :]).ravel() for at, masks, _ in sets])
        is_far = np.concatenate([np.full(len(at) * len(masks), kind, np.int8) for at, masks, kind in sets])
        mine = _share(variant, parts[place]) == share[place]
        place, variant, is_far = place[mine], variant[mine], is_far[mine]
        key = (group[place] << 32) | variant
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        met = np.zeros(len(order), bool)
        met[1:] |= same
        met[:-1] |= same
        order = order[met]
        order = order[np.lexsort((prints[place[order]], is_far[order], key[order]))]
        key, is_far, prints = key[order], is_far[order], prints[place[order]]
        new = np.append(True, key[1:] != key[:-1])[: len(key)]
        begin = np.flatnonzero(new)[np.cumsum(new) - 1]
        edge = ~new & (is_far[begin] == 0)
        return prints[begin][edge], prints[edge]

    def run(batches):
        carried = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [c.to_numpy().astype(np.int64) for c in batch.columns]
            if carried is not None:
                rows = [np.concatenate(pair) for pair in zip(carried, rows)]
            new = np.append(True, np.any([c[1:] != c[:-1] for c in rows[:3]], axis=0))
            last = int(np.flatnonzero(new)[-1])
            carried = [c[last:] for c in rows]
            yield from linked([c[:last] for c in rows], new[:last])
        if carried is not None:
            yield from linked(carried, np.arange(len(carried[0])) == 0)

    def linked(rows, new):
        group = np.cumsum(new) - 1
        size = np.bincount(group, minlength=1)
        several = np.flatnonzero(size[group] > 1) if len(group) else group
        rows = [group[several], *(c[several] for c in rows)]
        # Whole groups, as many as make some millions of variants.
        cuts = np.flatnonzero(np.append(True, rows[0][1:] != rows[0][:-1])[: len(several)])
        low = 0
        ends = np.append(cuts[1:], len(several))
        while low < len(several):
            fits = ends[(ends > low) & (ends <= low + ROWS_AT_ONCE)]
            high = int(fits[-1]) if len(fits) else int(ends[ends > low][0])
            a, b = stars([c[low:high] for c in rows])
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
            low = high

    return run


def _halves(prints: DataFrame, flips: list[int]) -> DataFrame:
    """``side, half, fingerprint``: each half of a fingerprint and what near variants make of it."""
    low = F.col("fingerprint").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fingerprint", 32)
    sides = F.array(*[F.struct(F.lit(n).alias("side"), h.alias("own")) for n, h in enumerate((low, high))])
    rows = prints.select("fingerprint", F.inline(sides)).select("*", F.explode(F.lit(np.array(flips, np.int64))).alias("flip"))
    return rows.select("side", F.col("own").bitwiseXOR(F.col("flip")).alias("half"), "fingerprint", "flip")


def _crowded(prints: DataFrame, flips: list[int], most: int) -> DataFrame:
    """``side, half, parts`` of the halves around which more than ``most`` fingerprints lie."""
    own = _halves(prints, [0]).groupBy("side", "half").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    around = own.select("side", "half", "n", F.explode(F.lit(np.array(flips, np.int64))).alias("flip")).select(
        "side",
        F.col("half").bitwiseXOR(F.col("flip")).alias("half"),
        F.when(F.col("flip") == 0, F.col("n")).otherwise(F.col("n") / 16).alias("n"),
    )
    parts = F.ceil(F.sum("n") / most).alias("parts")
    return around.groupBy("side", "half").agg(parts).where(F.col("parts") > 1)


def ball_links(prints: DataFrame, radius: int = RADIUS, size: int | None = None, crowd: int = CROWD) -> DataFrame:
    """Links ``a, b`` that join all of the distinct ``fingerprint`` values within ``radius`` bits.

    Every link is within the radius, and what is within the radius is joined by links.
    ``size`` is the number of fingerprints, if known; halves around which more than ``crowd`` lie are cut.
    """
    near, far = other_masks(radius)
    flips = [m for spent in range(radius // 2 + 1) for m in half_masks(spent)]
    size = prints.count() if size is None else size
    tasks = max(shuffle_partitions(prints.sparkSession), -(-2 * size * len(flips) // ROWS_A_TASK))
    rows = _halves(prints, flips)
    crowded = stage(_crowded(prints, flips, crowd), "crowded-halves")
    n = crowded.count()
    if n:
        rows = rows.join(F.broadcast(crowded) if n <= FEW_HALVES else crowded, ["side", "half"], "left")
        rows = rows.withColumn("parts", F.coalesce("parts", F.lit(1)))
        other = F.when(F.col("side") == 0, F.shiftrightunsigned("fingerprint", 32)).otherwise(
            F.col("fingerprint").bitwiseAND(F.lit(0xFFFFFFFF))
        )
        spent, odd = F.bit_count("flip"), F.bit_count("fingerprint") % 2 == 1
        changes = F.lit(near[0])
        for c, masks in enumerate(near[1:], 1):
            changes = F.when(spent == c, F.lit(masks)).otherwise(changes)
        if len(far):
            changes = F.when((spent == 0) & odd, F.lit(np.concatenate([near[0], far]))).otherwise(changes)

        def share(mask):
            return F.pmod(F.shiftright(other.bitwiseXOR(mask) * F.lit(SPREAD), 16), F.col("parts"))

        shares = F.when(F.col("parts") > 1, F.array_distinct(F.transform(changes, share))).otherwise(F.array(F.lit(0).cast("bigint")))
        rows = rows.withColumn("share", F.explode(shares))
    else:
        rows = rows.withColumns({"share": F.lit(0).cast("bigint"), "parts": F.lit(1).cast("bigint")})
    key = ["side", "half", "share"]
    dealt = rows.select(*key, F.col("parts").cast("bigint"), "fingerprint").repartition(tasks, *key)
    links = dealt.sortWithinPartitions(*key).mapInArrow(_meet(radius), "a bigint, b bigint").distinct()
    return links.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def simhash_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, fingerprint, component_id, kept``.

    A text's words lie between ASCII white space, ASCII letters lower-cased; a fingerprint
    has the bits that over half the XXH64 hashes of its shingles have, repeats included.  Fewer words than
    a shingle are one shingle; null, empty and blank texts have the fingerprint zero,
    which links like any other.  Rows are linked at ``radius`` differing bits or fewer;
    ``component_id`` is the smallest id that can be reached and ``kept`` marks rows that bear it.
    Repeated rows and ids stay rows of their own; null ids count last, and a component of
    null ids alone has a null ``component_id`` and keeps its rows.  Other columns are not read.

    Copies are one fingerprint, so they are shuffled once; the fingerprints' components are
    looked up over salted keys.
    """
    drawn = stage(fingerprints(id_text(docs, id_col, text_col), shingle, seed), "fingerprints")
    classes = stage(
        drawn.groupBy("fingerprint").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies")),
        "fingerprint-classes",
    )
    links = stage(ball_links(classes.select("fingerprint"), radius, classes.count()), "fingerprint-links")
    roots = components(links).withColumnRenamed("node", "fingerprint")
    named = classes.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"), F.sum("copies").alias("rows"))
    several = least.where(F.col("rows") > 1).select("root", "component_id")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")

    def salted(rows: DataFrame, key: str) -> DataFrame:
        return rows.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))

    # Neither a component of very many fingerprints nor a fingerprint of very many rows is one key.
    table = salted(named.select("fingerprint", "root"), "fingerprint").join(several.select("*", salts), ["root", "salt"])
    table = table.select("fingerprint", "component_id", F.lit(True).alias("grouped"), salts)
    met = salted(drawn, "doc_id").join(table, ["fingerprint", "salt"], "left")
    component = F.when(F.col("grouped"), F.col("component_id")).otherwise(F.col("doc_id"))
    return met.select(
        "doc_id", "fingerprint", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept")
    )


def hex_print(fingerprint: str = "fingerprint"):
    """Sixteen lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
