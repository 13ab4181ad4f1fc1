"""CSV, JSON and text folders.

Paths go to Spark as they are, so any URI the cluster can open will do, and
output folders are created by the writers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

LINES_AT_ONCE = 1000  # rows of a JSON document handed on together

# One dialect for both directions: quotes are doubled, blanks are kept, and an
# empty field is null, quoted or not.  Words such as "NA" or "null" are ordinary text.
# A line break inside a field is written as a backslash and a letter, so that every line is
# a row and a large file is read by many tasks.
CSV_DIALECT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def escape_breaks(text: Column) -> Column:
    """Backslashes doubled, line feeds and carriage returns as ``\\n`` and ``\\r``."""
    for char, mark in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(char), F.lit(mark))
    return text


def restore_breaks(text: Column) -> Column:
    """What :func:`escape_breaks` was given; between two doubled backslashes a mark is unambiguous."""

    def restored(piece: Column) -> Column:
        return F.replace(F.replace(piece, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    doubled = r"\\\\"  # a pattern for two backslashes
    pieces = F.transform(F.split(text, doubled, -1), restored)
    return F.when(F.contains(text, F.lit("\\")), F.array_join(pieces, "\\")).otherwise(text)


def _on_texts(df: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    return df.select(
        [
            change(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def read_csv_dbfs(
    spark: SparkSession,
    file_path: str,
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
    **options: object,
) -> DataFrame:
    """Read CSV with a header; without a schema every column is a string.

    Lines are rows, as :func:`write_csv_dbfs` writes them.  With ``multi_line`` texts are
    taken as they are and may hold line breaks inside quotes, as in files from elsewhere;
    one task then reads each file.
    """
    reader = spark.read.options(**{**CSV_DIALECT, "multiLine": multi_line, **options})
    if schema is not None:
        reader = reader.schema(schema)
    rows = reader.csv(file_path)
    return rows if multi_line else _on_texts(rows, restore_breaks)


def _flat(df: DataFrame) -> DataFrame:
    """CSV has no nested types: lists, maps and structs are written as JSON text."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        [
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def write_csv_dbfs(df: DataFrame, file_path: str, multi_line: bool = False, **options: object) -> None:
    """Overwrite a folder of CSV files with header; with ``multi_line`` line breaks stay inside quotes."""
    flat = _flat(df)
    rows = flat if multi_line else _on_texts(flat, escape_breaks)
    rows.write.mode("overwrite").options(**{**CSV_DIALECT, **options}).csv(file_path)


def read_json_dbfs(
    spark: SparkSession,
    file_path: str,
    schema: T.StructType | str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Read JSON lines, or with ``multi_line`` one document per file."""
    reader = spark.read.option("multiLine", multi_line)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(file_path)


def write_json_dbfs(df: DataFrame, file_path: str) -> None:
    """Overwrite a folder of JSON lines; null fields are written too."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(file_path)


def write_json_documents(df: DataFrame, file_path: str, files: int | None = None) -> None:
    """Overwrite a folder of JSON documents: each file is one array of records, a record a line.

    ``files`` is how many there are, by default one per partition; one document of everything is
    ``files=1``, which one task then writes row by row.  Null fields are written too, and text is
    not escaped beyond what JSON asks for.  Read them with ``read_json_dbfs(multi_line=True)``.
    """
    rows = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))
    dealt = rows if files is None else rows.repartition(files)

    def document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = "["
        for batch in batches:
            for start in range(0, batch.num_rows, LINES_AT_ONCE):
                part = batch.column(0).slice(start, LINES_AT_ONCE).to_pylist()
                lines = [f"{lead if n == 0 else ','}\n  {row}" for n, row in enumerate(part)]
                lead = ","
                yield pa.record_batch([pa.array(["".join(lines)], pa.string())], names=["value"])
        yield pa.record_batch([pa.array(["[]\n" if lead == "[" else "\n]\n"], pa.string())], names=["value"])

    documents = dealt.mapInArrow(document, "value string")
    documents.write.mode("overwrite").option("lineSep", " ").text(file_path)


def write_text(df: DataFrame, file_path: str, order: list[str]) -> None:
    """Overwrite a folder of text files with the ``line`` column in the given order."""
    df.orderBy(*order).select("line").write.mode("overwrite").text(file_path)
