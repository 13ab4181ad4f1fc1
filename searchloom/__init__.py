"""Mining of search-query logs with Spark: filter, embed, cluster, summarise."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers travel whole, so executors need no installed
# copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from searchloom.config import ClusterConfig, PipelineConfig, get_pipeline_config  # noqa: E402
from searchloom.functions.text import clean_query  # noqa: E402
from searchloom.operators.clustering import cluster_queries  # noqa: E402
from searchloom.operators.embedding import (  # noqa: E402
    add_embeddings_to_df,
    embed_queries,
    validate_embeddings,
)
from searchloom.operators.filters import load_and_filter_queries  # noqa: E402
from searchloom.operators.language import (  # noqa: E402
    detect_language,
    is_english,
    load_language_model,
    save_language_model,
    train_language_model,
)
from searchloom.operators.profile import validate_query_data  # noqa: E402
from searchloom.operators.report import generate_cluster_report  # noqa: E402
from searchloom.operators.seo import analyze_seo_results, generate_seo_queries  # noqa: E402
from searchloom.plans.pipeline import run_pipeline, run_pipeline_from_notebook  # noqa: E402
from searchloom.session import stages_of_a_run  # noqa: E402
from searchloom.sources import (  # noqa: E402
    load_queries_from_table,
    read_csv_dbfs,
    read_json_dbfs,
    write_csv_dbfs,
    write_json_dbfs,
    write_json_documents,
)

__all__ = [
    "ClusterConfig",
    "PipelineConfig",
    "add_embeddings_to_df",
    "analyze_seo_results",
    "clean_query",
    "cluster_queries",
    "detect_language",
    "embed_queries",
    "generate_cluster_report",
    "generate_seo_queries",
    "get_pipeline_config",
    "is_english",
    "load_and_filter_queries",
    "load_language_model",
    "load_queries_from_table",
    "read_csv_dbfs",
    "read_json_dbfs",
    "run_pipeline",
    "run_pipeline_from_notebook",
    "save_language_model",
    "stages_of_a_run",
    "train_language_model",
    "validate_embeddings",
    "validate_query_data",
    "write_csv_dbfs",
    "write_json_dbfs",
    "write_json_documents",
]
