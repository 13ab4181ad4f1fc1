"""The corpus pipeline: from raw documents to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as
Parquet and read again as the ``docs`` of the next one.  All but the last return the
columns of their input, whatever these are besides ``doc_id`` and ``text``.
"""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from searchloom.llm.decontaminate import drop_contaminated  # noqa: E402
from searchloom.llm.near_dedup import drop_near_duplicates  # noqa: E402
from searchloom.llm.packing import pack_documents  # noqa: E402
from searchloom.llm.pii import fit_personal, redact_personal  # noqa: E402
from searchloom.llm.quality import fit_quality, keep_quality  # noqa: E402
from searchloom.llm.queries import word_tokenizer  # noqa: E402
from searchloom.llm.tables import read  # noqa: E402
from searchloom.session import stage  # noqa: E402


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier rejects go."""
    return keep_quality(docs, fit_quality(docs, read(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, four fifths) stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words on end of a benchmark item go."""
    return drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the text."""
    cleaned = redact_personal(docs, fit_personal(docs))
    if "n_chars" not in docs.columns:
        return cleaned
    kind = docs.schema["n_chars"].dataType
    return cleaned.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left is cut and packed into sequences of 2,048 tokens."""
    return pack_documents(docs, word_tokenizer())


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

# No stage but the decontamination can be written in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
