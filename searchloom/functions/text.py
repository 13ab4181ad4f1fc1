"""Text columns: cleaning, topic lists and tokens."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from searchloom.constants import ALNUM_PATTERN, WHITESPACE_NARROW, WHITESPACE_WIDE

TOKEN_PATTERN = r"[\p{L}\p{N}]+"

# The wide characters sit behind one range test, which ordinary letters fail at
# once; a lone space needs no replacement, so it is not matched when collapsing.
_WIDE = rf"[\x{{1680}}-\x{{3000}}&&[{WHITESPACE_WIDE}]]"
SPACE = rf"[\x20{WHITESPACE_NARROW}{_WIDE}]"
NOT_SPACE = rf"[^\x20{WHITESPACE_NARROW}{WHITESPACE_WIDE}]"
TO_COLLAPSE = rf"[{WHITESPACE_NARROW}{_WIDE}]{SPACE}*|\x20{SPACE}+"


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip(col: Column | str) -> Column:
    """Remove Unicode whitespace at both ends."""
    return F.regexp_replace(_column(col), f"^{SPACE}+|{SPACE}+$", "")


def clean_query(col: Column | str) -> Column:
    """Strip, collapse runs of whitespace to one space, lower-case."""
    return F.lower(F.trim(F.regexp_replace(_column(col), TO_COLLAPSE, " ")))


def is_blank(col: Column | str) -> Column:
    """Nothing but whitespace; null is not blank."""
    return F.coalesce(~_column(col).rlike(NOT_SPACE), F.lit(False))


def has_alnum(col: Column | str) -> Column:
    return F.coalesce(_column(col).rlike(ALNUM_PATTERN), F.lit(False))


def has_topic(col: Column | str) -> Column:
    column = _column(col)
    return column.isNotNull() & (column != "")


def parse_topics(col: Column | str) -> Column:
    """Comma-separated text to a list; blank tokens and repeats stay."""
    column = _column(col)
    return F.when(
        has_topic(column), F.transform(F.split(column, ",", -1), strip)
    ).otherwise(F.array().cast("array<string>"))


def parse_topics_no_blanks(col: Column | str) -> Column:
    """As :func:`parse_topics`, without blank tokens."""
    return F.filter(parse_topics(col), lambda t: t != "")


def tokens(col: Column | str) -> Column:
    """Runs of letters and digits of the cleaned text."""
    return F.regexp_extract_all(clean_query(col), F.lit(TOKEN_PATTERN), F.lit(0))
