"""Periodic runs of words, by a sparse dynamic programme over the diagonals (lags) of a text.

A diagonal is a lag ``d``; its match length at a word counts the words up to there that
equal the word ``d`` earlier.  A run of period ``d`` is a stretch in which that length
grows by one with each word, and it is given out when the diagonal ends.

Following every earlier occurrence of a word would cost the square of its count.  Two facts
make one diagonal per word and power of two enough.  In a run of smallest period ``q``
the ``k`` words from any place on, ``k >= q``, stand ``q`` words earlier too, and nowhere
between: otherwise two periods ``d < q`` would hold over ``d + q`` words, hence their common
divisor over the run.  So for periods in ``(k/2, k]`` only the *nearest* earlier occurrence of
``k`` words can carry the smallest period, and its lag is compared with the lag of the
word before.  Multiples of ``q`` never show up, so nothing has to be weeded out.  A text of
``n`` words costs ``n log n`` at most, whatever it repeats; where no ``k`` words come twice,
longer ones are not looked at.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from searchloom.llm.blocks import blocks, byte_class
from searchloom.llm.lexicon import Lexicon, joined, text_column
from searchloom.llm.tables import id_text

LEAST_LENGTH, LEAST_POWER = 6, 4

_SPACE = byte_class("space")
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def find_runs(
    codes: np.ndarray, first: np.ndarray, least: int = LEAST_LENGTH, power: int = LEAST_POWER
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``start, end, period`` of all runs in the rows ``first[i]:first[i + 1]`` of word codes.

    A run is at least ``least`` words and ``power`` periods long; places count over all
    rows, and runs are sorted by start, then period.  With three periods or more, ``k < 2q``
    words fit behind the first period, so each run is met.
    """
    if power < 3:
        raise ValueError("runs of fewer than three periods are not found")
    counts = np.diff(first)
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(len(codes))
    gram = row * (int(codes.max(initial=0)) + 1) + codes
    longest = int(counts.max(initial=0)) // power
    found = [(at[:0], at[:0], at[:0])]
    k = 1
    while len(at):
        order = np.argsort(gram, kind="stable")
        sorted_at, sorted_gram = at[order], gram[order]
        again = np.flatnonzero(sorted_gram[1:] == sorted_gram[:-1]) + 1
        here, lag = sorted_at[again], sorted_at[again] - sorted_at[again - 1]
        fits = (lag > k // 2) & (lag <= k)
        here, lag = here[fits], lag[fits]
        by_place = np.argsort(here)
        here, lag = here[by_place], lag[by_place]
        # The active lag goes on where the next word has the same; elsewhere its diagonal ends.
        stops = np.flatnonzero((here[1:] != here[:-1] + 1) | (lag[1:] != lag[:-1]))
        if len(here):
            low, high = np.append(0, stops + 1), np.append(stops, len(here) - 1)
            start, end, period = here[low] - lag[low], here[high] + k, lag[low]
            enough = end - start >= np.maximum(least, power * period)
            found.append((start[enough], end[enough], period[enough]))
        if k >= longest:
            break
        # Words that come twice, numbered; twice as many words come twice only where both halves do.
        twice = np.zeros(len(at), bool)
        twice[again] = True
        twice[again - 1] = True
        number = np.full(len(codes), -1)
        number[sorted_at[twice]] = np.cumsum(np.append(True, sorted_gram[1:] != sorted_gram[:-1]))[twice]
        half = np.sort(sorted_at[twice])
        half = half[half + k < len(codes)]
        half = half[(number[half + k] >= 0) & (row[half + k] == row[half])]
        at, gram = half, number[half] * (int(number.max(initial=0)) + 1) + number[half + k]
        k *= 2
    start, end, period = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def periodic_runs(
    docs: DataFrame,
    least: int = LEAST_LENGTH,
    power: int = LEAST_POWER,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, runs, collapsed``.

    ``runs`` are all maximal stretches of words (between ASCII white space, as they are
    spelt) with a smallest period ``period`` and at least ``least`` words and ``power``
    periods, by start, then period; words count from 0.  ``collapsed`` are the words that no
    run holds behind its first period, joined by one space.

    Null, empty and blank texts have no words, no runs and an empty ``collapsed``.  Rows that
    repeat, or share an id, are treated one by one; null ids stay null.  Other columns are
    not read.  Nothing is shuffled; a task holds a megabyte of text, or one longer text,
    and some dozen numbers per word of it.
    """
    struct = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches):
        for batch in batches:
            for block in blocks(batch.column(1)):
                words = Lexicon(block, _SPACE)
                start, end, period = find_runs(words.codes, words.first, least, power)
                cover = np.zeros(len(words.codes) + 1, np.int64)
                np.add.at(cover, start + period, 1)
                np.add.at(cover, end, -1)
                keep = np.cumsum(cover[:-1]) == 0
                row = np.searchsorted(words.first, start, "right") - 1
                held = np.searchsorted(row, np.arange(block.rows + 1)).astype(np.int32)
                runs = pa.StructArray.from_arrays(
                    [pa.array(x) for x in (start - words.first[row], end - start, period)], fields=list(struct)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.first, block.rows),
                        pa.array(words.counts.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(held), runs),
                        text_column(*joined(block, words.starts, words.ends, words.first, keep)),
                    ],
                    names=["doc_id", "n_words", "runs", "collapsed"],
                )

    return id_text(docs, id_col, text_col).mapInArrow(
        search, f"doc_id bigint, n_words bigint, runs {RUNS}, collapsed string"
    )


def steadiest(runs: str | Column = "runs") -> Column:
    """The run of the greatest length per period, the first of equals; null if there is none.

    Fractions are compared as products of whole numbers.
    """
    none = F.lit(None).cast("bigint")
    start = F.struct(none.alias("start"), none.alias("length"), none.alias("period"))
    return F.aggregate(
        runs,
        start,
        lambda best, r: F.when(
            F.coalesce(r["length"] * best["period"] > best["length"] * r["period"], F.lit(True)), r
        ).otherwise(best),
    )


def plant_runs(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, where the tail of one text in ten goes round in a circle.

    With ``h`` the CRC-32 of the id in decimal and ``g = h // 10``: if ``h % 10 = 0``, each of
    the ``n`` words from ``a = g % n`` on becomes the word ``a + (i - a) % p`` of before, ``p = 1 +
    (n - a) // (3 + g % 8)``.  Such a text's words are then joined by one space; others,
    also those with a null id, stay as they are.
    """

    def circle(doc_id: int | None, text: str | None) -> str | None:
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        words = (text or "").encode().split() if h % 10 == 0 else []
        if not words:
            return text
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        turn = words[a : a + p]
        return b" ".join(words[:a] + (turn * -(-(n - a) // p))[: n - a]).decode()

    def plant(batches):
        for batch in batches:
            texts = [circle(i, t) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return id_text(docs).mapInArrow(plant, "doc_id bigint, text string")
