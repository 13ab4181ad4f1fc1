"""Vector columns held as ``array<double>``."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, functions as F


def as_doubles(col: Column | str) -> Column:
    column = F.col(col) if isinstance(col, str) else col
    return column.cast("array<double>")


def squared_norm(vec: Column) -> Column:
    return F.aggregate(vec, F.lit(0.0), lambda acc, x: acc + x * x)


def norm(vec: Column) -> Column:
    return F.sqrt(squared_norm(vec))


def unit(vec: Column, length: Column) -> Column:
    """Vector scaled to length one; a zero vector stays zero."""
    return F.when(length > 0, F.transform(vec, lambda x: x / length)).otherwise(vec)


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance."""
    return F.sqrt(
        F.aggregate(
            F.zip_with(a, b, lambda x, y: x - y), F.lit(0.0), lambda acc, x: acc + x * x
        )
    )


def mean_vector(vec: Column) -> Column:
    """Aggregate: mean of each dimension, combined on the map side."""
    return vector_to_array(Summarizer.mean(array_to_vector(vec)))


def sum_vector(vec: Column) -> Column:
    """Aggregate: sum of each dimension, combined on the map side."""
    return vector_to_array(Summarizer.sum(array_to_vector(vec)))
