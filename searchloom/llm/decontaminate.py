"""Benchmark decontamination: a prefix-filtered join of item windows with documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from searchloom.llm.bitmap import bits_set, collect_bitmap, split_by
from searchloom.llm.blocks import LOWER, Words, blocks, byte_class
from searchloom.llm.tables import id_text, numbered, text_key
from searchloom.session import stage

WINDOW = 10
SHINGLE = 5
SALTS = 32
BITMAP_BITS = 24

_ALNUM = byte_class("alnum")


def _word_lists(block, words: Words) -> list[list[str]]:
    text = LOWER[block.data].tobytes()
    spelled = [text[a:b].decode("utf-8", "replace") for a, b in zip(words.starts.tolist(), words.ends.tolist())]
    return [spelled[a:b] for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist())]


def item_words(items: DataFrame) -> DataFrame:
    """``item_id, words``: lower-cased words of each item."""

    def split(batches):
        for batch in batches:
            rows = []
            for block in blocks(batch.column(1)):
                rows += _word_lists(block, Words(block, _ALNUM, LOWER))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.string()))], names=["item_id", "words"]
            )

    return items.mapInArrow(split, "item_id string, words array<string>")


def item_windows(items: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows ``(window_id, words, n)`` and which items own them.

    An item shorter than ``size``, but not empty, is one window.
    """
    owned = (
        item_words(items)
        .where(F.size("words") > 0)
        .withColumn("last", F.greatest(F.size("words") - size, F.lit(0)))
        .select("item_id", "words", F.explode(F.sequence(F.lit(0), "last")).alias("at"))
        .select("item_id", F.slice("words", F.col("at") + 1, F.lit(size)).alias("words"))
        .distinct()
    )
    owned = stage(owned, "item-windows")
    windows = numbered(owned.select("words").distinct(), "windows", "window_id")
    owners = owned.join(windows, "words").select("window_id", "item_id")
    return windows.withColumn("n", F.size("words")), owners


def window_shingles(windows: DataFrame, k: int) -> DataFrame:
    """``window_id, at, k, shingle``: the runs of ``k`` words of each window, or all its words."""
    sized = windows.withColumn("k", F.least(F.lit(k), F.col("n")))
    return sized.select(
        "window_id", "k", "words", F.explode(F.sequence(F.lit(0), F.col("n") - F.col("k"))).alias("at")
    ).select(
        "window_id",
        "at",
        "k",
        F.array_join(F.slice("words", F.col("at") + 1, F.col("k")), " ").alias("shingle"),
    )


def scan(docs: DataFrame, marked, lengths: list[tuple[int, int]]) -> DataFrame:
    """``doc_id, text_key, n_words, runs``, one row per document.

    ``marked`` flags hashes of item shingles; it may flag others too.  ``lengths`` holds
    the shingle length and the fewest successive shingles a window of it has.  A run is
    a stretch of words covered by at least that many marked shingles on end: every
    window that occurs lies in one run.
    """
    pointer = docs.sparkSession.sparkContext.broadcast(marked)

    def find(batches):
        bitmap = pointer.value
        for batch in batches:
            counts, run_of, run_at, run_k, run_words = [], [], [], [], []
            for block in blocks(batch.column(2)):
                words = Words(block, _ALNUM, LOWER)
                counts.append(words.counts)
                text = None
                for k, least in lengths:
                    hit = bits_set(bitmap, words.windows(k)) & words.fits(k)
                    step = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
                    # a row's last shingles do not fit, so no run reaches the next row, but for k = 1
                    begin, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
                    if k == 1 and len(begin):
                        begin, end = _cut(begin, end, words.first)
                    long = end - begin >= least
                    begin, end = begin[long], end[long]
                    if not len(begin):
                        continue
                    text = LOWER[block.data].tobytes() if text is None else text
                    rows = np.searchsorted(words.first, begin, "right") - 1
                    for row, a, b in zip(rows.tolist(), begin.tolist(), (end + k - 1).tolist()):
                        run_of.append(block.first + row)
                        run_at.append(a - int(words.first[row]))
                        run_k.append(k)
                        run_words.append(
                            [
                                text[x:y].decode("utf-8", "replace")
                                for x, y in zip(words.starts[a:b].tolist(), words.ends[a:b].tolist())
                            ]
                        )
            n_words = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            order = np.argsort(np.array(run_of, np.int64), kind="stable")
            per_row = np.bincount(np.array(run_of, np.int64), minlength=len(n_words))
            offsets = np.concatenate([[0], np.cumsum(per_row)]).astype(np.int32)
            runs = pa.StructArray.from_arrays(
                [
                    pa.array([run_at[i] for i in order], pa.int32()),
                    pa.array([run_k[i] for i in order], pa.int32()),
                    pa.array([run_words[i] for i in order], pa.list_(pa.string())),
                ],
                names=["at", "k", "words"],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n_words, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), runs),
                ],
                names=["doc_id", "text_key", "n_words", "runs"],
            )

    schema = "doc_id bigint, text_key bigint, n_words bigint, runs array<struct<at:int,k:int,words:array<string>>>"
    return docs.select("doc_id", text_key().alias("text_key"), "text").mapInArrow(find, schema)


def _cut(begin: np.ndarray, end: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cut runs of positions where a row ends."""
    sizes = end - begin
    at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    row = np.searchsorted(first, at, "right")
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (np.diff(row) > 0)
    starts = np.flatnonzero(new)
    return at[starts], at[np.append(starts[1:], len(at)) - 1] + 1


def marked_shingles(shingles: DataFrame, bits: int) -> np.ndarray:
    """The item shingles' hashes as a bitmap of ``2 ** bits`` bits, whatever their number."""

    def hashes(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows, np.uint64)
            lengths = batch.column(0).to_numpy()
            for block in blocks(batch.column(1)):
                words = Words(block, byte_class("space"))
                for k in np.unique(lengths[block.first : block.first + block.rows]):
                    rows = np.flatnonzero(lengths[block.first : block.first + block.rows] == k)
                    out[block.first + rows] = words.windows(int(k))[words.first[rows]]
            yield pa.RecordBatch.from_arrays([pa.array(out.view(np.int64))], names=["hash"])

    return collect_bitmap(shingles.select("k", "shingle").distinct().mapInArrow(hashes, "hash bigint"), bits)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    bitmap_bits: int = BITMAP_BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``row_no, doc_id, text_key, n_words, n_hit, spans, items``.

    A window is ``window`` consecutive words of an item, or all words of a shorter one;
    words are runs of ASCII letters and digits (lower-cased) and of characters beyond
    ASCII.  A document word inside any occurrence of a window is hit; ``spans`` are the
    occurrences as ``(start, stop)`` in words, ``items`` the ids of their items as
    sorted strings.

    The join.  A window is the set of its shingles of ``shingle`` words.  A scan keeps of
    each document the runs of words that only consist of item shingles (by a bitmap of
    fixed size).  Shingles are counted over the runs of all documents; as a window must be
    contained whole, its prefix is one shingle, the rarest, and one that never occurs drops
    its window.  Documents meet windows on prefix shingles alone, written out as words;
    the place of the shingle in the window bounds where the window starts, the run bounds
    its length, and what is left is compared word by word.

    Skew: a shingle in a third of all documents is dealt out over ``SALTS`` keys, windows
    being the small side; the counts are combined before their shuffle; items meet distinct
    sets of windows, not documents.  Null and empty texts have no words.  Rows with equal
    or null ids are looked at each by itself; null item ids are left out of ``items``;
    with no items nothing is hit.  Columns other than id and text are not read.
    """
    texts = items.select(F.col(f"`{item_id_col}`").cast("string"), F.col(f"`{item_text_col}`").cast("string"))
    windows, owners = item_windows(texts.toDF("item_id", "text"), window)
    shingles = window_shingles(windows, shingle)
    shapes = (
        windows.select(F.least(F.lit(shingle), "n").alias("k"), "n")
        .groupBy("k")
        .agg(F.min(F.col("n") - F.col("k") + 1).alias("least"))
    )
    lengths = sorted((r["k"], r["least"]) for r in shapes.collect())  # one row per shingle length
    bitmap = marked_shingles(shingles, bitmap_bits)
    scanned = numbered(scan(id_text(docs, id_col, text_col), bitmap, lengths), "runs")

    runs = scanned.where(F.size("runs") > 0).select("row_no", F.posexplode("runs").alias("run_no", "run"))
    met = runs.select(
        "row_no",
        "run_no",
        "run.k",
        F.explode(F.sequence(F.lit(0), F.size("run.words") - F.col("run.k"))).alias("at"),
        "run.words",
    ).select("row_no", "run_no", "k", "at", _joined("words", "at", "k").alias("shingle"))
    counts = met.groupBy("shingle").agg(F.count(F.lit(1)).alias("seen"))
    rarity = shingles.join(counts, "shingle", "left")
    prefix = (
        rarity.groupBy("window_id")
        .agg(
            F.min_by(F.struct("at", "shingle", "k"), F.struct(F.coalesce("seen", F.lit(0)), "at")).alias("p"),
            F.min(F.coalesce("seen", F.lit(0))).alias("seen"),
        )
        .where(F.col("seen") > 0)
        .select("window_id", "p.*")
        .join(windows, "window_id")
        .withColumnsRenamed({"at": "prefix_at", "words": "window_words"})
    )
    salted = prefix.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = (
        runs.select("row_no", "run", F.col("run.k").alias("k"))
        .select(
            "row_no",
            "run",
            "k",
            F.explode(F.sequence(F.lit(0), F.size("run.words") - F.col("k"))).alias("at"),
        )
        .select(
            "row_no",
            "at",
            "k",
            F.col("run.at").alias("run_at"),
            _joined("run.words", "at", "k").alias("shingle"),
            # the words a window around this shingle may take
            F.slice("run.words", F.greatest(F.col("at") - window, F.lit(0)) + 1, F.lit(2 * window + shingle)).alias(
                "near"
            ),
            (F.col("at") - F.greatest(F.col("at") - window, F.lit(0))).alias("in_near"),
            F.pmod(F.xxhash64("row_no"), F.lit(SALTS)).cast("int").alias("salt"),
        )
    )
    start = F.col("in_near") - F.col("prefix_at")
    found = (
        dealt.join(salted, ["shingle", "k", "salt"])
        .where((start >= 0) & (start + F.col("n") <= F.size("near")))
        .where(F.slice("near", start + 1, F.col("n")) == F.col("window_words"))
        .select(
            "row_no",
            "window_id",
            (F.col("run_at") + F.col("at") - F.col("prefix_at")).alias("start"),
            (F.col("run_at") + F.col("at") - F.col("prefix_at") + F.col("n")).alias("stop"),
        )
    )
    hits = stage(
        found.groupBy("row_no").agg(
            F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("spans"),
            F.array_sort(F.collect_set("window_id")).alias("windows"),
        ),
        "hits",
    )
    hits = hits.withColumn("set_key", F.sha2(F.array_join("windows", ","), 256))
    sets = (
        hits.groupBy("set_key")
        .agg(F.first("windows").alias("windows"))
        .select("set_key", F.explode("windows").alias("window_id"))
        .join(owners, "window_id")
        .groupBy("set_key")
        .agg(F.array_sort(F.collect_set("item_id")).alias("items"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    named = (
        hits.withColumn("salt", F.pmod(F.xxhash64("row_no"), F.lit(SALTS)).cast("int"))
        .join(sets, ["set_key", "salt"])
        .select("row_no", "spans", "items")
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).alias("upto")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(x["stop"] - F.greatest(x["start"], s["upto"]), F.lit(0))).alias("n"),
            F.greatest(s["upto"], x["stop"]).alias("upto"),
        ),
        lambda s: s["n"],
    )
    out = scanned.select("row_no", "doc_id", "text_key", "n_words").join(named, "row_no", "left")
    return out.select(
        "row_no",
        "doc_id",
        "text_key",
        "n_words",
        F.coalesce(F.when(F.col("spans").isNotNull(), covered), F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,stop:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _joined(words: str, at: str, k: str):
    return F.array_join(F.slice(words, F.col(at) + 1, F.col(k)), " ")


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, bitmap_bits: int = BITMAP_BITS) -> DataFrame:
    """``docs`` without the rows that hold a window of an item; all columns stay as they are.

    Only rows that a bitmap of fixed size marks are joined and moved.
    """
    hit = contaminated(docs, items, window).where(F.col("n_hit") > 0)
    hit = stage(hit.select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).distinct(), "contaminated")
    marked = collect_bitmap(hit.select(F.xxhash64("hit_id", "hit_key").alias("hash")), bitmap_bits)
    key = text_key(docs["text"].cast("string"))
    clean, maybe = split_by(docs, F.xxhash64(docs["doc_id"].cast("bigint"), key), marked)
    same = maybe["doc_id"].cast("bigint").eqNullSafe(hit["hit_id"]) & (
        text_key(maybe["text"].cast("string")) == hit["hit_key"]
    )
    return clean.unionByName(maybe.join(hit, same, "left_anti"))
