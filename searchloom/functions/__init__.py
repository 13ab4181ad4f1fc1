"""Column expressions shared by the operators."""

from searchloom.functions.text import clean_query, parse_topics, parse_topics_no_blanks

__all__ = ["clean_query", "parse_topics", "parse_topics_no_blanks"]
