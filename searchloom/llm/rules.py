"""Quality rules: statistics of whole documents, fixed limits, and boosted trees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from searchloom.llm.blocks import BYTE_VALUES, Block, Words, blocks, byte_class, span_hashes
from searchloom.llm.boosting import Forest, fit_forest
from searchloom.llm.tables import bounded_sample, id_text, text_key
from searchloom.session import stage

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent of the words
REPEAT = 3
SAMPLE = 20_000  # labelled documents the trees are fitted on at most

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_chars", "n_lines", "n_distinct", "n_upper", "n_digits", "n_punct", "n_stops", "n_single")

#: Features, and whether the score must not fall (1) or not rise (-1) with them.
FEATURES = (
    ("words", 0),
    ("word_length", 0),
    ("symbols_per_word", -1),
    ("dup_lines", -1),
    ("repeat_words", -1),
    ("distinct_words", 0),
    ("upper", -1),
    ("digits", -1),
    ("punctuation", 0),
    ("stops_per_word", 0),
    ("words_per_line", 0),
    ("single", 0),
)

_SPACE = byte_class("space")


def _flags(members: bytes | range) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(members)] = True
    return table


_SYMBOL = _flags(SYMBOLS)
_UPPER, _DIGIT = _flags(range(0x41, 0x5B)), _flags(range(0x30, 0x3A))
_PUNCT = _flags(b"!\"'(),-./:;?[\\]_`{}~+=@^")
_STOP = _flags(b".!?")


def _per_row(flags: np.ndarray, block: Block) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return np.diff(sums[block.offsets])


def block_statistics(block: Block) -> dict[str, np.ndarray]:
    """All counts of each row of a block."""
    words = Words(block, _SPACE)
    lead = (block.data & 0xC0) != 0x80
    points = np.concatenate([[0], np.cumsum(lead)])
    lengths = points[words.ends] - points[words.starts]
    sums = np.concatenate([[0], np.cumsum(lengths)])
    out = {
        "n_words": words.counts,
        "word_chars": np.diff(sums[words.first]),
        "n_symbols": _per_row(_SYMBOL[block.data], block),
        "n_chars": np.diff(points[block.offsets]),
        "n_upper": _per_row(_UPPER[block.data], block),
        "n_digits": _per_row(_DIGIT[block.data], block),
        "n_punct": _per_row(_PUNCT[block.data], block),
        "n_stops": _per_row(_STOP[block.data], block),
        "n_single": np.diff(np.concatenate([[0], np.cumsum(lengths == 1)])[words.first]),
    }
    starts, ends, first = block.runs(block.data != 0x0A)  # lines that are not empty
    worded = np.searchsorted(words.starts, ends) > np.searchsorted(words.starts, starts)
    lines = span_hashes(BYTE_VALUES[block.data], starts, ends)
    triples = words.windows(REPEAT)
    dup, repeat, distinct, n_lines = (np.zeros(block.rows, np.int64) for _ in range(4))
    for row in range(block.rows):
        a, b = first[row], first[row + 1]
        own = lines[a:b][worded[a:b]]
        n_lines[row] = len(own)
        dup[row] = len(own) - len(np.unique(own))
        a, b = words.first[row], words.first[row + 1]
        distinct[row] = len(np.unique(words.hashes[a:b]))
        if b - a >= REPEAT:
            _, back, count = np.unique(triples[a : b - REPEAT + 1], return_inverse=True, return_counts=True)
            twice = count[back] > 1
            covered = np.zeros(b - a, bool)
            for shift in range(REPEAT):
                covered[shift : shift + len(twice)] |= twice
            repeat[row] = covered.sum()
    return out | {"n_dup_lines": dup, "n_repeat_words": repeat, "n_distinct": distinct, "n_lines": n_lines}


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key`` and the counts of ``COUNTS`` and ``MORE``, one row per row of ``docs``.

    Words lie between white space; lines are cut at line feeds and count if they hold a
    word.  Hashes of 64 bits stand for lines and words.  Null and empty texts count 0.
    Nothing is shuffled and only id and text are read.
    """
    names = (*COUNTS, *MORE)

    def count(batches):
        for batch in batches:
            parts = {n: [np.zeros(0, np.int64)] for n in names}
            for block in blocks(batch.column(2)):
                for name, values in block_statistics(block).items():
                    parts[name].append(values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(np.concatenate(parts[n]), pa.int64()) for n in names]],
                names=["doc_id", "text_key", *names],
            )

    schema = "doc_id bigint, text_key bigint, " + ", ".join(f"{n} bigint" for n in names)
    rows = id_text(docs, id_col, text_col)
    return rows.select("doc_id", text_key().alias("text_key"), "text").mapInArrow(count, schema)


def base_failed() -> F.Column:
    """Too few words, or too many in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def features(columns: dict[str, np.ndarray]) -> np.ndarray:
    """The features of ``FEATURES`` from the counts; rows without words get zeros."""
    c = {k: np.asarray(v, np.float64) for k, v in columns.items()}
    words, chars, lines = (np.maximum(c[k], 1) for k in ("n_words", "n_chars", "n_lines"))
    return np.stack(
        [
            np.log1p(c["n_words"]),
            c["word_chars"] / words,
            c["n_symbols"] / words,
            c["n_dup_lines"] / lines,
            c["n_repeat_words"] / words,
            c["n_distinct"] / words,
            c["n_upper"] / chars,
            c["n_digits"] / chars,
            c["n_punct"] / chars,
            c["n_stops"] / words,
            words / lines,
            c["n_single"] / words,
        ],
        1,
    )


def fit_rules(counted: DataFrame, labels: DataFrame, sample: int = SAMPLE, label_col: str = "quality") -> Forest:
    """Fit the trees on at most ``sample`` labelled documents, those of the smallest hashes.

    Labels that are null, or of ids that have several, are not used; without any the
    score is a half.
    """
    judged = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .where(F.col("label").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .where(F.col("label") == F.col("most"))
        .drop("most")
    )
    rows = bounded_sample(counted.join(judged, "doc_id"), F.xxhash64("doc_id", "text_key"), sample)
    chosen = rows.select("label", *COUNTS, *MORE).toArrow()
    x = features({n: chosen[n].to_numpy() for n in (*COUNTS, *MORE)})
    y = (chosen["label"].to_numpy() > 0).astype(float)
    return fit_forest(x, y, np.array([s for _, s in FEATURES]))


def score_rules(counted: DataFrame, forest: Forest) -> DataFrame:
    """Add ``score``, the probability of good quality, to counted documents."""
    names = counted.columns

    def score(batches):
        for batch in batches:
            at = {n: batch.column(names.index(n)).to_numpy() for n in (*COUNTS, *MORE)}
            scores = forest.score(features(at)) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*names, "score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counted.schema)
    return counted.mapInArrow(score, f"{kinds}, score double")


def quality_rules(
    docs: DataFrame, labels: DataFrame, least_score: float = 0.3, sample: int = SAMPLE
) -> DataFrame:
    """Counts, ``base_failed``, ``score`` and ``kept`` for every row of ``docs``.

    A document is kept if it passes the fixed limits and the trees give it at least
    ``least_score``.  The counts are written once and read for the fit and the scores.
    """
    counted = stage(statistics(docs), "document-statistics")
    scored = score_rules(counted, fit_rules(counted, labels, sample))
    return scored.withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= least_score)
    )
