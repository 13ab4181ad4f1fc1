"""Quality classifier: random-indexing vectors, pooled, and a calibrated two-layer network."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from searchloom.llm.blocks import SMALL_BLOCK_BYTES, blocks
from searchloom.llm.network import Network, fit_network
from searchloom.llm.random_index import context_sums, pooled, word_vectors
from searchloom.llm.tables import bounded_sample, id_text, text_batches
from searchloom.session import stage

SAMPLE = 20_000  # labelled documents the network is fitted on at most
LEAST = 0.3


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learnt: a checksum of the id; null counts as empty."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5 == 0


def labelled_sample(labels: DataFrame, sample: int, label_col: str) -> DataFrame:
    """At most ``sample`` ids with their label, those of the smallest hashes.

    Ids that are null, held out, without a label or with several are left out.
    """
    judged = labels.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label")
    )
    known = (
        judged.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("most"))
        .where(F.col("label") == F.col("most"))
        .select("doc_id", "label")
    )
    return bounded_sample(known, F.xxhash64("doc_id"), sample)


class QualityModel:
    """Word vectors and the network over their means."""

    def __init__(self, vectors: np.ndarray, network: Network):
        self.vectors, self.network = vectors, network

    def score_column(self, column: pa.Array) -> np.ndarray:
        parts = blocks(column, SMALL_BLOCK_BYTES)
        scores = [self.network.score(pooled(b, self.vectors).astype(np.float64)) for b in parts]
        return np.concatenate(scores) if scores else np.zeros(0)


def fit_quality(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label_col: str = "quality"
) -> QualityModel:
    """Learn word vectors from all texts and the network from a bounded sample of labels.

    The vectors are 4,096 by 64 numbers, and at most ``sample`` rows of 129 numbers reach
    the driver, whatever the input and however many rows share an id.  Only texts are
    inputs of the score.
    """
    texts = id_text(docs)
    vectors = word_vectors(context_sums(texts))
    chosen = F.broadcast(labelled_sample(labels, sample, label_col))  # bounded by the sample

    def pool(batches):
        for batch in batches:
            means = [pooled(b, vectors) for b in blocks(batch.column(2), SMALL_BLOCK_BYTES)]
            flat = np.concatenate(means) if means else np.zeros((0, 2 * vectors.shape[1] + 1), np.float32)
            offsets = np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]
            values = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), values], names=["doc_id", "label", "x"])

    met = texts.join(chosen, "doc_id").select("doc_id", "label", "text")
    means = stage(met.mapInArrow(pool, "doc_id bigint, label int, x array<float>"), "labelled-means")
    rows = bounded_sample(means, F.xxhash64("doc_id", "x"), sample).toArrow()
    width = 2 * vectors.shape[1] + 1
    x = rows["x"].combine_chunks().flatten().to_numpy().astype(np.float64).reshape(-1, width)
    order = np.lexsort((*x.T[:3], rows["doc_id"].to_numpy()))
    y = (rows["label"].to_numpy() > 0).astype(np.float64)
    return QualityModel(vectors, fit_network(x[order], y[order]))


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``quality_score`` from 0 to 1; a column of that name is replaced."""
    pointer = text_batches(docs).sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("quality_score")
    names = kept.columns
    at = names.index(text_col)

    def score(batches):
        for batch in batches:
            scores = pa.array(pointer.value.score_column(batch.column(at)), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*names, "quality_score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return kept.mapInArrow(score, f"{kinds}, quality_score double")


def keep_quality(docs: DataFrame, model: QualityModel, least: float = LEAST, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` the model gives at least ``least``; all columns stay as they are."""
    pointer = text_batches(docs).sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def keep(batches):
        for batch in batches:
            yield batch.filter(pa.array(pointer.value.score_column(batch.column(at)) >= least))

    return docs.mapInArrow(keep, docs.schema)


def classify_quality(
    docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, least: float = LEAST, label_col: str = "quality"
) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs``.

    Null and empty texts get the score of a document without words.  Ids may repeat or
    be null.  Without labels of both kinds the score is the share of label 1, a half
    without any.  Columns other than id and text are not read.
    """
    model = fit_quality(docs, labels, sample, label_col)
    scored = score_quality(id_text(docs), model)
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= least).cast("int").alias("predicted"),
    )
