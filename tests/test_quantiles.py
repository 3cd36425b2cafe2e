"""Order statistics by counting agree with a sort, in every round and for every kind of column."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.operators import quantiles as Q
from tests.conftest import rows


def frame(spark):
    x = F.pmod(F.hash("id"), F.lit(1000))
    return spark.range(5000).select(
        "id", F.when(F.col("id") % 3 == 0, 7.5).when(F.col("id") % 50 == 1, None).when(F.col("id") % 50 == 2, float("nan"))
        .otherwise(x / 8).alias("x"), F.concat(F.lit("k"), (F.col("id") % 700).cast("string")).alias("name"),
        F.date_add(F.lit("2020-01-01").cast("date"), x.cast("int")).alias("day"))


@pytest.mark.parametrize("columns", [["x", "id"], ["x", "name"], ["day", "id"], ["name", "x", "id"]])
@pytest.mark.parametrize("few,pivots", [(20_000, 4096), (50, 40)])
def test_rows_at_ranks(spark, columns, few, pivots):
    df = frame(spark).repartition(7)
    line = [tuple(r) for r in df.select(*columns).orderBy(*columns).collect()]
    ranks = [1, 2, 700, 1666, 1667, 2500, 3333, 4999, 5000]
    got = Q.rows_at(df, columns, ranks, few, pivots)
    assert [Q._order(r) for r in got] == [Q._order(line[r - 1]) for r in ranks]


def test_equal_rows_end_the_search(spark):
    df = spark.range(4000).select((F.col("id") % 2).alias("a"), F.lit("x").alias("b"))
    assert Q.rows_at(df, ["a", "b"], [1, 2000, 2001, 4000], few=10, pivots=5) == [(0, "x"), (0, "x"), (1, "x"), (1, "x")]
    with pytest.raises(ValueError):
        Q.rows_at(df, ["a"], [4001])
    assert Q.rows_at(df, ["a"], []) == []


@pytest.mark.parametrize("n", [1, 3, 7, 10, 5000])
def test_labels_are_tiles(spark, n):
    df = frame(spark).where(F.col("id") < n)
    want = df.withColumn("q", F.ntile(7).over(W.orderBy("x", "id"))).select("id", "q")
    for sizes in ({}, {"few": 60, "pivots": 50}):
        out = Q.quantile_label(df, "x", ["id"], 7, "q", **sizes)
        assert rows(out.select("id", "q")) == rows(want)
    plan = Q.quantile_label(df, "x", ["id"], 7, "q")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_no_rows(spark):
    assert Q.quantile_label(frame(spark).where("false"), "x", ["id"], 5, "q").count() == 0
