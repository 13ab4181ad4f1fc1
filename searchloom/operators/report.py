"""The text report over cluster metadata, one line per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from searchloom import constants as C
from searchloom.sources.files import write_text

VALUES = ["topic", "n_queries", "avg_similarity", "unique_users", "most_central_query"]


def _block(title: Column, lines: tuple[str, ...], values: list[str]) -> Column:
    body = [F.format_string(text, F.col(v).cast("string")) for text, v in zip(lines, values)]
    return F.array(F.lit(""), title, *body)


def cluster_report(metadata: DataFrame, generated: str | None = None) -> DataFrame:
    """``(section, cluster_label, line_number, line)``; sort by the first three to read it.

    ``generated`` is the time to print in the header; without one it is left out,
    so that equal input gives an equal report.
    """
    spark = metadata.sparkSession
    valid = metadata.where(~F.col("cluster_label").endswith(C.NOISE_SUFFIX))
    candidates = metadata.where(F.col("seo_candidate") == "true")

    def fixed(section: int, lines: list[str]) -> DataFrame:
        return spark.createDataFrame(
            [(section, "", number, line) for number, line in enumerate(lines)],
            "section int, cluster_label string, line_number int, line string",
        )

    def blocks(section: int, rows: DataFrame, block: Column) -> DataFrame:
        return rows.select(
            F.lit(section).alias("section"),
            "cluster_label",
            F.posexplode(block).alias("line_number", "line"),
        )

    def total(section: int, rows: DataFrame, text: str) -> DataFrame:
        count = F.format_string(text, F.count(F.lit(1)).cast("string"))
        return rows.agg(F.array(F.lit(""), count).alias("lines")).select(
            F.lit(section).alias("section"),
            F.lit("").alias("cluster_label"),
            F.posexplode("lines").alias("line_number", "line"),
        )

    header = [C.REPORT_RULE, C.REPORT_TITLE, C.REPORT_RULE]
    if generated is not None:
        header.append(C.REPORT_GENERATED % generated)
    label = F.col("cluster_label")
    parts = [
        fixed(0, [*header, "", C.REPORT_CANDIDATES_TITLE]),
        blocks(
            1,
            candidates,
            _block(F.format_string(C.REPORT_CANDIDATE, label), C.REPORT_CANDIDATE_LINES, VALUES),
        ),
        total(2, candidates, C.REPORT_CANDIDATES_TOTAL),
        fixed(3, ["", C.REPORT_RULE, C.REPORT_CLUSTERS_TITLE, C.REPORT_RULE]),
        blocks(
            4,
            valid,
            _block(F.format_string(C.REPORT_CLUSTER, label), C.REPORT_CLUSTER_LINES, VALUES[1:]),
        ),
        total(5, valid, C.REPORT_CLUSTERS_TOTAL),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def generate_cluster_report(
    metadata: DataFrame, file_path: str, generated: str | None = None
) -> None:
    """Write the report as text."""
    write_text(
        cluster_report(metadata, generated), file_path, ["section", "cluster_label", "line_number"]
    )
