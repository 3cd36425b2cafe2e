"""Registered queries: a Spark plan and, where SQL can say it, the same result as standard SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The plans behind the queries, for a query that reads others over the same tables; dates and decimals stay what they are.
PLANS: dict[str, Callable[[Tables], DataFrame]] = {}


def plain(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Dates as text and decimals as doubles, so that results compare across engines; columns in ``keep`` stay as they are."""
    cols = []
    for f in df.schema.fields:
        if f.name in keep:
            cols.append(F.col(f.name))
        elif isinstance(f.dataType, (T.DateType,)):
            cols.append(F.col(f.name).cast("string").alias(f.name))
        elif isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``."""

    def add(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} exists")
        PLANS[name] = fn
        QUERIES[name] = lambda spark, sf_dir: plain(fn(Tables(spark, sf_dir)))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load() -> None:
    """Import every module that registers queries."""
    from panelkit.plans import (feature_marts, label_marts, market, panels, shaping, states, statistics,  # noqa: F401
                                variables, models)
