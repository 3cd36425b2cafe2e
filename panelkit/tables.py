"""Lazy access to the Parquet tables of one directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelkit.sources.readers import read_table


class Tables:
    """``Tables(spark, dir).orders`` is the scan of ``dir/orders.parquet``."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")
        self._shared: dict[str, DataFrame] = {}

    def share(self, name: str, df: DataFrame) -> DataFrame:
        """Hand a written view to all plans that are given this object, so that each of them reads it."""
        self._shared[name] = df
        return df

    def shared(self, name: str) -> DataFrame | None:
        """The written view of that name, if there is one."""
        return self._shared.get(name)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return read_table(self.spark, self.directory, name)
