"""Price grids and the best offer per client."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.functions.scalars import margin
from panelkit.operators.joins import cross
from panelkit.scale import lookup_join

#: Bounds of the search (fixed values): rate, commission, step and margin.
RATE = (0.05, 0.10)
COMMISSION = (0.0, 0.20)
STEP = 0.005
MARGIN = (0.075, 20.0)


def axis(spark: SparkSession, lo: float, hi: float, step: float, name: str) -> DataFrame:
    """Points lo, lo + step, .. hi, rounded to 3 digits, both ends included."""
    n = int(round((hi - lo) / step))
    return spark.range(n + 1).select(F.round(F.lit(lo) + F.col("id") * step, 3).alias(name))


def price_grid(spark: SparkSession, rate=RATE, commission=COMMISSION, step: float = STEP) -> DataFrame:
    """Every rate with every commission."""
    return cross(axis(spark, *rate, step, "rate"), axis(spark, *commission, step, "commission"))


def logistic_score(terms: dict[str, float], intercept: float) -> Column:
    """Probability from a linear predictor, as a column expression."""
    linear = F.lit(float(intercept))
    for name, weight in terms.items():
        linear = linear + F.col(name) * F.lit(float(weight))
    return 1 / (1 + F.exp(-linear))


def score_grid(offers: DataFrame, grid: DataFrame, probability: Column) -> DataFrame:
    """Every offer at every grid price with its acceptance probability."""
    return cross(offers, grid).withColumn("probability", probability)


def weighted_grid(grid: DataFrame, rate_density: DataFrame, commission_density: DataFrame) -> DataFrame:
    """Grid with the product of the densities of its two axes; inputs are axis-sized tables."""
    r = rate_density.select("rate", F.col("density").alias("_r"))
    c = commission_density.select("commission", F.col("density").alias("_c"))
    return grid.join(r, "rate").join(c, "commission").withColumn("weight", F.col("_r") * F.col("_c")).drop("_r", "_c")


def best_price(offers: DataFrame, grid: DataFrame, keys: list[str], instalments: str,
               probability: Callable[[Column, Column], Column], inputs: list[str] | None = None,
               bounds=MARGIN) -> DataFrame:
    """The grid prices with the highest expected profit per offer key, ties kept.

    ``grid`` has rate, commission and weight (and may have scenario, margin_lo, margin_hi).
    ``probability`` maps (rate, commission) to an expression over the offer columns. An offer searches
    the grid as an array, so no grid row is shuffled. When ``inputs`` names the offer columns that
    matter, offers that agree in them share one search. A key spread over many rows is combined by
    aggregation.
    """
    if "margin_lo" not in grid.columns:
        grid = grid.withColumn("margin_lo", F.lit(float(bounds[0]))).withColumn("margin_hi", F.lit(float(bounds[1])))
    tag = ["scenario"] if "scenario" in grid.columns else []
    per = grid.groupBy(*tag).agg(F.collect_list(F.struct("rate", "commission", "weight")).alias("_cells"),
                                 F.first("margin_lo").alias("_lo"), F.first("margin_hi").alias("_hi"))
    shared = inputs is not None
    searches = cross(offers.select(*inputs).distinct() if shared else offers, per)

    def price(cell: Column) -> Column:
        rate, commission = cell["rate"], cell["commission"]
        gain = margin(rate, commission, instalments)
        accept = probability(rate, commission)
        return F.struct(F.round(accept * gain * cell["weight"], 9).alias("profit"), rate.alias("rate"),
                        commission.alias("commission"), gain.alias("margin"), accept.alias("probability"))

    found = "struct<profit:double,rate:double,commission:double,margin:double,probability:double>"

    def keep_best(best: Column, cell: Column) -> Column:
        inside = cell["margin"].between(F.col("_lo"), F.col("_hi"))
        only = F.struct(cell["profit"].alias("profit"), F.array(cell).alias("cells"))
        also = F.struct(best["profit"].alias("profit"), F.concat(best["cells"], F.array(cell)).alias("cells"))
        return (F.when(inside & (cell["profit"] > best["profit"]), only)
                .when(inside & (cell["profit"] == best["profit"]), also).otherwise(best))

    nothing = F.struct(F.lit(float("-inf")).alias("profit"), F.array().cast(f"array<{found}>").alias("cells"))
    winners = searches.select(*[c for c in searches.columns if not c.startswith("_")],
                              F.aggregate(F.transform("_cells", price), nothing, keep_best).alias("_won"))
    # an offer's rows are dealt out by its keys before they get their prices; both steps below group them there
    if shared:
        winners = lookup_join(offers.select(*dict.fromkeys([*keys, *inputs])).repartition(*keys),
                              winners.select(*inputs, *tag, "_won"), inputs, "inner")
    else:
        winners = winners.repartition(*keys)
    by_profit = (winners.select(*keys, *tag, F.col("_won.profit").alias("profit"), F.explode("_won.cells").alias("_cell"))
                 .groupBy(*keys, *tag, "profit").agg(F.collect_set("_cell").alias("_cells")))
    best = by_profit.groupBy(*keys, *tag).agg(F.max_by("_cells", "profit").alias("_cells"))
    return best.select(*keys, *tag, F.inline("_cells"))


def with_original(best: DataFrame, offers: DataFrame, keys: list[str], rate: str, commission: str,
                  instalments: str) -> DataFrame:
    """Best prices next to the price and margin the offer had."""
    before = offers.select(*keys, F.col(rate).alias("original_rate"), F.col(commission).alias("original_commission"),
                           margin(rate, commission, instalments).alias("original_margin"))
    return best.join(before, keys)


def scenario_grid(spark: SparkSession, scenarios: list[dict]) -> DataFrame:
    """Stacked grids; a scenario has name, rate, commission, step and margin."""
    out = None
    for s in scenarios:
        grid = (price_grid(spark, s["rate"], s["commission"], s["step"]).withColumn("scenario", F.lit(s["name"]))
                .withColumn("margin_lo", F.lit(float(s["margin"][0])))
                .withColumn("margin_hi", F.lit(float(s["margin"][1]))))
        out = grid if out is None else out.unionByName(grid)
    return out


def write_scenarios(best: DataFrame, path: str, by: str = "scenario") -> None:
    """Write best prices with a folder for each scenario; scenarios that ``best`` does not hold keep their files.

    A rerun of one scenario replaces that one only, when its job commits.
    """
    (best.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path))


def read_scenarios(spark: SparkSession, path: str, names: list[str] | None = None, by: str = "scenario") -> DataFrame:
    """Prices of all scenarios, or of the named ones; only their folders are read."""
    prices = spark.read.option("basePath", path).parquet(path)
    prices = prices.withColumn(by, F.col(by).cast("string"))
    return prices if names is None else prices.where(F.col(by).isin(names))
