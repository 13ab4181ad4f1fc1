"""Declared schemas of the tables that pass between stages."""

from pyspark.sql import types as T

RAW_QUERIES = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("query", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("user_id", T.StringType()),
    ]
)

FILTERED_QUERIES = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("query", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("topics", T.ArrayType(T.StringType())),
    ]
)

EMBEDDINGS = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.DoubleType())),
    ]
)

CLUSTERED_QUERIES = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("user", T.StringType()),
        T.StructField("topics", T.ArrayType(T.StringType())),
        T.StructField("cluster", T.StringType()),
    ]
)

CLUSTER_METADATA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("cluster_label", T.StringType()),
        T.StructField("n_queries", T.LongType()),
        T.StructField("avg_similarity", T.DoubleType()),
        T.StructField("unique_users", T.LongType()),
        T.StructField("most_central_query", T.StringType()),
        T.StructField("seo_candidate", T.StringType()),
        T.StructField("rejection_reasons", T.ArrayType(T.StringType())),
    ]
)

SEO_QUERIES = T.StructType(
    [
        T.StructField("cluster", T.StringType()),
        T.StructField("seo_query", T.StringType()),
        T.StructField("query_number", T.IntegerType()),
        T.StructField("cluster_size", T.LongType()),
    ]
)

RUN_STATISTICS = T.StructType(
    [
        T.StructField("total_queries", T.LongType()),
        T.StructField("valid_clusters", T.LongType()),
        T.StructField("seo_candidates", T.LongType()),
        T.StructField("total_seo_queries", T.LongType()),
    ]
)
