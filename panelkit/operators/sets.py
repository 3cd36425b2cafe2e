"""Set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame


def union_all(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b)


def union_distinct(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def except_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``."""
    return a.subtract(b.select(*a.columns))


def add_rows(df: DataFrame, rows: list[tuple]) -> DataFrame:
    """``df`` with constant rows appended."""
    return df.unionByName(df.sparkSession.createDataFrame(rows, df.schema))
