"""ML vector columns."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_at(col: Column | str, i: int) -> Column:
    """Element ``i`` of an ML vector, for example the probability of class 1."""
    return vector_to_array(F.col(col) if isinstance(col, str) else col)[i]


def to_vector(col: Column | str) -> Column:
    """Array of numbers to an ML vector."""
    return array_to_vector((F.col(col) if isinstance(col, str) else col).cast("array<double>"))


def to_array(col: Column | str) -> Column:
    return vector_to_array(F.col(col) if isinstance(col, str) else col)
