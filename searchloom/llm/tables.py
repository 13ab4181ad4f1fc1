"""The tables as they lie, and keys for rows whose ids may repeat or be null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from searchloom.session import stage

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def text_batches(df: DataFrame) -> DataFrame:
    """Hand texts to Python some 2 MB at a time, unless the session says otherwise."""
    conf = df.sparkSession.conf
    if conf.get(BATCH_BYTES, None) is None:
        conf.set(BATCH_BYTES, str(2 << 20))
    return df


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id, as a long, and the text, whatever else the table holds."""
    return text_batches(docs).select(
        docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text")
    )


def text_key(text: str | Column = "text") -> Column:
    """Tells rows of one id with different texts apart, and is the same on every scan."""
    text = F.col(text) if isinstance(text, str) else text
    return F.xxhash64(text)


def numbered(df: DataFrame, name: str, column: str = "row_no") -> DataFrame:
    """Number rows and write them out, so that the numbers never change."""
    return stage(df.withColumn(column, F.monotonically_increasing_id()), name)


def hex_sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def bounded_sample(rows: DataFrame, mark: Column, size: int) -> DataFrame:
    """At most ``size`` rows, those of the smallest marks, whatever the number of tasks.

    ``mark`` is a hash.  A top-k alone would send ``size`` rows from every task; so rows
    are first cut to about twice the sample by their marks, and then to the sample.
    """
    place = F.pmod(mark, F.lit(1 << 30))
    n = rows.count()
    if n > size:
        rows = rows.where(place < int(min(1.0, (2.0 * size + 50) / n) * (1 << 30)))
    return rows.orderBy(place, mark).limit(size)
