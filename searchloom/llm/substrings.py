"""Substring de-duplication: passages that an earlier document holds, by FM-indexes per shard."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from searchloom.llm.bitmap import bits_set, collect_bitmap, split_by
from searchloom.llm.blocks import Block, Words, blocks, byte_class
from searchloom.llm.fm_index import FMIndex
from searchloom.llm.tables import id_text, text_key
from searchloom.session import shuffle_partitions, stage

WINDOW = 13
ANCHOR = 4
HOT = 2000  # documents from which on an anchor's windows go to shards one by one
SHARD = 12_000  # segments in a shard, equal ones counted as often as they occur
SALTS = 64
HELD_ANCHORS, HELD_SEGMENTS = 2_000_000, 150_000  # what a task combines at a time
ANCHOR_BITS, HOT_BITS, DOC_BITS = 26, 20, 24

_SPACE = byte_class("space")


class Anchors:
    """The windows of a block and the anchor each is dealt out by.

    The anchor of a window is the run of ``k`` words in it with the least hash, the first
    of equals, so equal windows have equal anchors wherever they occur.
    """

    def __init__(self, block: Block, window: int, k: int):
        self.words = Words(block, _SPACE)
        fits = np.flatnonzero(self.words.fits(window))
        grams = self.words.windows(k)
        best, at = grams[fits], fits.copy()
        for shift in range(1, window - k + 1):
            other = grams[fits + shift]
            less = other < best
            best = np.where(less, other, best)
            at = np.where(less, fits + shift, at)
        new = np.ones(len(fits), bool)
        new[1:] = (at[1:] != at[:-1]) | (np.diff(fits) > 1)
        starts = np.flatnonzero(new)
        self.first = fits[starts]  # first window of each segment
        self.last = fits[np.append(starts[1:], len(fits)) - 1] if len(fits) else fits
        self.hash = best[starts]
        self.row = np.searchsorted(self.words.first, self.first, "right") - 1


def anchor_counts(docs: DataFrame, window: int, k: int) -> DataFrame:
    """``anchor, n``: in how many documents an anchor occurs, some two million anchors at a time."""

    def counted(hashes: list[np.ndarray]) -> pa.RecordBatch:
        anchor, n = np.unique(np.concatenate(hashes), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(n)], names=["anchor", "n"])

    def count(batches):
        hashes = [np.zeros(0, np.uint64)]
        for batch in batches:
            valid = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for block in blocks(batch.column(2)):
                found = Anchors(block, window, k)
                use = valid[block.first + found.row]
                row, own = found.row[use], found.hash[use]
                order = np.lexsort((own, row))
                row, own = row[order], own[order]
                new = np.ones(len(own), bool)
                new[1:] = (np.diff(row) > 0) | (own[1:] != own[:-1])
                hashes.append(own[new])
            if sum(map(len, hashes)) > HELD_ANCHORS:
                yield counted(hashes)
                hashes = [np.zeros(0, np.uint64)]
        yield counted(hashes)

    return docs.mapInArrow(count, "anchor bigint, n bigint")


def segments(
    docs: DataFrame,
    repeated: np.ndarray,
    hot: np.ndarray,
    window: int,
    k: int,
    places: tuple[np.ndarray, np.ndarray] | None = None,
) -> DataFrame:
    """Text around anchors of several documents: ``shard_key, segment, low, high, n``.

    A segment holds the successive windows of one anchor, its words joined by spaces.
    Windows of hot anchors are segments of their own and dealt out by all their words,
    so that what surrounds a very frequent line does not meet in one shard.  Equal
    segments of a task, as far as it can hold them, are one row with the least and greatest
    id and their number.

    With ``places`` it is ``doc_id, text_key, start, digest, salt``: where the segments lie
    that the first bitmap marks; those the second marks are dealt out over salts.
    """
    pointer = docs.sparkSession.sparkContext.broadcast((repeated, hot, places))

    def cut(batches):
        marked, frequent, wanted = pointer.value
        held: dict[bytes, list[int]] = {}

        def rows_held() -> pa.RecordBatch:
            numbers = list(zip(*held.values())) or [(), (), (), ()]
            columns = [pa.array(numbers[0], pa.int64()), pa.array(list(held), pa.binary())]
            columns += [pa.array(c, pa.int64()) for c in numbers[1:]]
            held.clear()
            return pa.RecordBatch.from_arrays(columns, names=["shard_key", "segment", "low", "high", "n"])

        for batch in batches:
            row, key, start, text = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], []
            valid = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for block in blocks(batch.column(2)):
                found = Anchors(block, window, k)
                words = found.words
                use = bits_set(marked, found.hash) & valid[block.first + found.row]
                single = use & bits_set(frequent, found.hash)
                many = use & ~single
                whole = words.windows(window)
                sizes = (found.last - found.first + 1)[single]
                each = np.repeat(found.first[single] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
                first = np.concatenate([found.first[many], each])
                last = np.concatenate([found.last[many], each]) + window
                rows = np.searchsorted(words.first, first, "right") - 1
                spaced = np.where(_SPACE[block.data], block.data, 0x20).astype(np.uint8).tobytes()
                pieces = [
                    spaced[a:b] for a, b in zip(words.starts[first].tolist(), words.ends[last - 1].tolist())
                ]
                if b"  " in spaced:
                    pieces = [b" ".join(p.split()) if b"  " in p else p for p in pieces]
                text += [hashlib.md5(p).digest() for p in pieces] if wanted else pieces
                start.append(first - words.first[rows])
                row += (block.first + rows).tolist()
                key.append(np.concatenate([found.hash[many], whole[each]]))
            ids = batch.column(0).take(pa.array(row, pa.int64()))
            if wanted:
                mark = _mark(text)
                row, at = np.array(row, np.int64), np.concatenate(start)
                spread = (row * 7919 + at) % SALTS
                columns = [
                    ids,
                    batch.column(1).take(pa.array(row)),
                    pa.array(at.astype(np.int32)),
                    pa.array(text, pa.binary()),
                    pa.array(np.where(bits_set(wanted[1], mark), spread, 0).astype(np.int32)),
                ]
                found_places = pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_key", "start", "digest", "salt"])
                yield found_places.filter(pa.array(bits_set(wanted[0], mark)))
                continue
            for piece, doc, shard_key in zip(text, ids.to_pylist(), np.concatenate(key).view(np.int64).tolist()):
                one = held.setdefault(piece, [shard_key, doc, doc, 0])
                one[1], one[2], one[3] = min(one[1], doc), max(one[2], doc), one[3] + 1
            if len(held) > HELD_SEGMENTS:
                yield rows_held()
        if held:
            yield rows_held()

    schema = "shard_key bigint, segment binary, low bigint, high bigint, n bigint"
    at_places = "doc_id bigint, text_key bigint, start int, digest binary, salt int"
    return docs.mapInArrow(cut, at_places if places else schema)


def _index_shard(window: int):
    """Index a shard's segments, stream them over it, and report the earliest holder of each window."""

    def run(shard: pa.Table) -> pa.Table:
        texts = shard["segment"].combine_chunks()
        owners = shard["low"].to_numpy()
        parts = [(block, Words(block, _SPACE)) for block in blocks(texts, 1 << 22)]
        hashes = np.concatenate([w.hashes for _, w in parts])
        counts = np.concatenate([w.counts for _, w in parts])
        symbols = np.unique(hashes, return_inverse=True)[1] + 1
        # every segment is followed by a 0
        ends = np.cumsum(counts + 1)
        text = np.zeros(int(ends[-1]), np.int64)
        of = np.repeat(np.arange(len(counts)), counts)
        text[np.arange(len(symbols)) + of] = symbols
        index = FMIndex(text, window)
        begins = ends - counts - 1
        windows = counts - window + 1
        places = np.repeat(begins - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
        length, low, high = index.matching(text, places + window - 1)
        if not (length >= window).all():
            raise RuntimeError("a window is not found in its own shard")
        earliest = index.least(np.repeat(owners, counts + 1), low, high)
        offsets = np.concatenate([[0], np.cumsum(windows)]).astype(np.int32)
        digests = [hashlib.md5(t).digest() for t in texts.to_pylist()]
        return pa.table(
            {
                "digest": pa.array(digests, pa.binary()),
                "mark": pa.array(_mark(digests).view(np.int64)),
                "earliest": pa.ListArray.from_arrays(pa.array(offsets), pa.array(earliest)),
                "high": shard["high"].combine_chunks(),
                "n": shard["n"].combine_chunks(),
            }
        )

    return run


def _mark(digests: list[bytes]) -> np.ndarray:
    """The first half of each digest, as a hash for bitmaps."""
    return np.frombuffer(b"".join(d[:8] for d in digests), np.uint64)


def _salts_of(rows: DataFrame, hot: np.ndarray) -> DataFrame:
    """Repeat rows whose mark the bitmap holds under every ``salt``; the others have salt 0."""
    plain, frequent = split_by(rows, F.col("mark"), hot)
    every = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    return plain.withColumn("salt", F.lit(0)).unionByName(frequent.withColumn("salt", every))


def repeated_windows(docs: DataFrame, window: int = WINDOW, k: int = ANCHOR, shard: int = SHARD) -> DataFrame:
    """``doc_id, text_key, starts``: the windows of each document that start in one of a smaller id.

    ``starts`` is a set of ``(start, mask)``: bit i of the mask stands for the window at
    word ``start + i``.  ``docs`` has ``doc_id, text_key, text``.
    """
    counts = anchor_counts(docs, window, k).groupBy("anchor").agg(F.sum("n").alias("n"))
    several = stage(counts.where(F.col("n") > 1).select(F.col("anchor").alias("hash"), "n"), "anchors")
    repeated = collect_bitmap(several.select("hash"), ANCHOR_BITS)
    hot = collect_bitmap(several.where(F.col("n") >= HOT).select("hash"), HOT_BITS)
    # a segment per anchor and document at most, where no anchor is hot
    total = several.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard))
    tasks = max(shuffle_partitions(docs.sparkSession), -(-shards // 8))
    # one exchange, by shard, serves both the aggregation and the index
    found = (
        segments(docs, repeated, hot, window, k)
        .withColumn("shard", F.pmod(F.xxhash64("shard_key"), F.lit(shards)))
        .drop("shard_key")
        .repartition(tasks, "shard")
        .groupBy("shard", "segment")
        .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
        .groupBy("shard")
        .applyInArrow(_index_shard(window), "digest binary, mark bigint, earliest array<bigint>, high bigint, n bigint")
    )
    useful = stage(found.where(F.array_min("earliest") < F.col("high")), "earliest")
    marks = useful.select(F.col("mark").alias("hash"), "n")
    wanted = collect_bitmap(marks.select("hash"), ANCHOR_BITS)
    frequent = collect_bitmap(marks.where(F.col("n") >= HOT).select("hash"), HOT_BITS)
    here = segments(docs, repeated, hot, window, k, (wanted, frequent))
    there = _salts_of(useful.select("digest", "earliest", "mark"), frequent).drop("mark")
    # bit i of the mask: the window i words on has an earlier holder
    mask = F.aggregate(
        F.reverse("earliest"),
        F.lit(0).cast("bigint"),
        lambda m, holder: m * 2 + F.when(holder < F.col("doc_id"), F.lit(1)).otherwise(F.lit(0)),
    )
    met = here.join(there, ["digest", "salt"]).select("doc_id", "text_key", "start", mask.alias("mask"))
    return (
        met.where(F.col("mask") != 0)
        .groupBy("doc_id", "text_key")
        .agg(F.collect_set(F.struct("start", "mask")).alias("starts"))
    )


def _kept_rows(texts, starts, window: int) -> tuple[list[int], list[int], list[bytes]]:
    """Words, removed words and what is left, for the rows of one batch."""
    n_words, n_removed, left_over = [], [], []
    for block in blocks(texts):
        for row in range(block.rows):
            words = block.text(row).split()  # bytes are split at ASCII white space
            own = starts[block.first + row].as_py() if starts is not None else None
            n_words.append(len(words))
            if own:
                start = np.array([x["start"] for x in own])
                mask = np.array([x["mask"] for x in own])
                gone = np.zeros(len(words) + 1, np.int64)
                for shift in range(int(mask.max()).bit_length()):
                    at = start[(mask >> shift) & 1 == 1] + shift
                    np.add.at(gone, at, 1)
                    np.subtract.at(gone, at + window, 1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()]
            n_removed.append(n_words[-1] - len(words))
            left_over.append(b" ".join(words))
    return n_words, n_removed, left_over


def deduplicate_substrings(
    docs: DataFrame,
    window: int = WINDOW,
    anchor: int = ANCHOR,
    shard: int = SHARD,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_text``, one row per row of ``docs``.

    Words lie between white space and are compared as they are.  A word goes if it lies
    in a window of ``window`` words that also starts in a document with a smaller id;
    windows are those of the input.  ``kept_text`` joins what is left by single spaces.

    1. Every window has an anchor in it (``Anchors``); anchors are counted over all
       documents, and a window whose anchor occurs in one document only cannot repeat.
    2. The text around the other anchors is cut into segments; equal segments become one,
       with the smallest id.  Segments of an anchor meet in one shard, whose FM-index holds
       them all; their windows are streamed over it, and the documents of the suffixes
       found give the earliest holder of each.
    3. What is found goes back to the segments' places, and documents are read once more.

    Shards grow in number, not in size, with the input.  Frequent segments are one row each
    in a shard; their places are joined over ``SALTS`` keys.  The anchors in several
    documents are marked in a bitmap of fixed size: where many hashes share it, more text
    is cut and looked at, and the result stays the same.

    Null and empty texts have no words.  Rows without an id lose nothing and are not
    looked at for others.  Rows that share an id do not count as earlier than each other.
    Columns other than id and text are not read.
    """
    source = id_text(docs, id_col, text_col).select("doc_id", text_key().alias("text_key"), "text")
    hits = stage(repeated_windows(source, window, anchor, shard), "repeated-windows")
    row_mark = F.xxhash64("doc_id", "text_key")
    marked = collect_bitmap(hits.select(row_mark.alias("hash")), DOC_BITS)
    pointer = docs.sparkSession.sparkContext.broadcast(marked)
    schema = "doc_id bigint, text_key bigint, n_words bigint, n_removed bigint, kept_text string"

    def flagged(batch: pa.RecordBatch) -> pa.Array:
        return pa.array(bits_set(pointer.value, batch.column(3).to_numpy().view(np.uint64)))

    def untouched(batches):
        """Documents without repeated windows need no join."""
        for batch in batches:
            batch = batch.filter(pc.invert(flagged(batch)))
            n_words, n_removed, kept = _kept_rows(batch.column(2), None, window)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "text_key", "n_words", "n_removed", "kept_text"],
            )

    def touched(batches):
        for batch in batches:
            yield batch.filter(flagged(batch))

    def cut_out(batches):
        for batch in batches:
            n_words, n_removed, kept = _kept_rows(batch.column(2), batch.column(3), window)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                ],
                names=["doc_id", "text_key", "n_words", "n_removed", "kept_text"],
            )

    marked_rows = source.withColumn("mark", row_mark)
    open_rows = marked_rows.mapInArrow(touched, "doc_id bigint, text_key bigint, text string, mark bigint")
    shortened = (
        open_rows.drop("mark")
        .join(hits, ["doc_id", "text_key"], "left")
        .select("doc_id", "text_key", "text", "starts")
        .mapInArrow(cut_out, schema)
    )
    return marked_rows.mapInArrow(untouched, schema).unionByName(shortened).drop("text_key")
