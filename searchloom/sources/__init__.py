"""Readers and writers: tables, CSV, JSON and text."""

from searchloom.sources.files import (
    read_csv_dbfs,
    read_json_dbfs,
    write_csv_dbfs,
    write_json_dbfs,
    write_json_documents,
    write_text,
)
from searchloom.sources.tables import load_queries_from_table, with_query_id, write_table

__all__ = [
    "load_queries_from_table",
    "read_csv_dbfs",
    "read_json_dbfs",
    "with_query_id",
    "write_csv_dbfs",
    "write_json_dbfs",
    "write_json_documents",
    "write_table",
    "write_text",
]
