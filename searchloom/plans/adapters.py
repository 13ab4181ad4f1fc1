"""The sample tables seen as query logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from searchloom.session import shuffle_partitions


def read(spark: SparkSession, sf_dir: str, table: str, key: str | None = None) -> DataFrame:
    """A table as it lies, or with ``key`` dealt out by it: a sample file is one row group,
    which one task would read."""
    df = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return df if key is None else df.repartition(shuffle_partitions(spark), key)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents", "doc_id")


def doc_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as queries; the language is the topic, the source the user."""
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("query_id"),
        F.col("text").alias("query"),
        F.col("lang").alias("topic"),
        F.col("source").alias("user_id"),
    )


def doc_log_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As :func:`doc_log`, each query under its language and its source."""
    log = doc_log(spark, sf_dir)
    return log.withColumn("topic", F.concat("topic", F.lit(","), "user_id"))


def conv_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns as queries; some topics are null, some are empty."""
    conv = F.col("conv_id")
    topic = (
        F.when(conv % 5 == 0, F.lit(None))
        .when(conv % 5 == 1, F.lit(""))
        .otherwise(F.concat(F.lit("t"), (conv % 3).cast("string")))
    )
    return (
        read(spark, sf_dir, "conversations", "conv_id")
        .where(F.col("role") == "user")
        .select(
            (conv * 1000 + F.col("turn")).alias("query_id"),
            F.col("text").alias("query"),
            topic.alias("topic"),
            conv.cast("string").alias("user_id"),
        )
    )


def vec_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as embedded queries with one topic each."""
    vec_id = F.col("vec_id")
    return read(spark, sf_dir, "embeddings", "vec_id").select(
        vec_id.alias("query_id"),
        F.concat(F.lit("q"), vec_id.cast("string")).alias("query"),
        (vec_id % 7).cast("string").alias("user"),
        F.array(F.concat(F.lit("t"), F.col("label").cast("string"))).alias("topics"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
