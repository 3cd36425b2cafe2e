"""Histograms, densities and distribution fits."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.scale import checkpoint


def prefix_sum(df: DataFrame, order: list[str], cols: list[str]) -> DataFrame:
    """Running totals ``<col>_upto`` over the whole table in ``order``.

    Range partitions are summed apart and shifted by the totals of the partitions before them.
    """
    rows = checkpoint(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sums = rows.groupBy("_part").agg(*[F.sum(c).alias(c) for c in cols]).orderBy("_part").collect()
    offsets, before = [], [0] * len(cols)
    for r in sums:  # one row per range partition
        offsets.append((r["_part"], *before))
        before = [b + r[c] for b, c in zip(before, cols)]
    if not offsets:
        return rows.drop("_part").withColumns({f"{c}_upto": F.lit(0).cast("long") for c in cols})
    table = df.sparkSession.createDataFrame(offsets, ["_part", *[f"_b_{c}" for c in cols]])
    run = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return (rows.join(F.broadcast(table), "_part")
            .withColumns({f"{c}_upto": F.sum(c).over(run) + F.col(f"_b_{c}") for c in cols})
            .drop("_part", *[f"_b_{c}" for c in cols]))


def median(df: DataFrame, col: str) -> float | None:
    """Exact median from value counts and their running total."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    run = prefix_sum(counts, [col], ["n"])
    n = counts.agg(F.sum("n")).first()[0]
    if n is None:
        return None
    low, high = (n + 1) // 2, n // 2 + 1
    row = run.agg(F.min(F.when(F.col("n_upto") >= low, F.col(col))),
                  F.min(F.when(F.col("n_upto") >= high, F.col(col)))).first()
    return (float(row[0]) + float(row[1])) / 2


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins over the value range: count, density and midpoint; empty bins included."""
    x = F.col(col).cast("double")
    ext = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"))).scalar()
    width = (ext["hi"] - ext["lo"]) / bins
    bin_of = F.least(F.floor(F.try_divide(x - ext["lo"], width)), F.lit(bins - 1)).cast("int")
    counts = (df.where(x.isNotNull()).groupBy(F.coalesce(bin_of, F.lit(0)).alias("bin"))
              .agg(F.count(F.lit(1)).alias("n")))
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (frame.join(counts, "bin", "left")
            .select("bin", F.coalesce("n", F.lit(0)).alias("n"),
                    (ext["lo"] + width * (F.col("bin") + 0.5)).alias("midpoint"),
                    F.try_divide(F.coalesce("n", F.lit(0)), ext["n"] * width).alias("density")))


def fit_distribution(df: DataFrame, col: str, bins: int = 200) -> DataFrame:
    """Closed-form fits of ten families, ranked by squared distance of the density to the histogram."""
    x = F.col(col).cast("double")
    data = df.where(x.isNotNull()).select(x.alias("x"))
    mid = median(data, "x")
    if mid is None:
        return df.sparkSession.createDataFrame([], "family string, sse double, place int")
    positive = F.when(F.col("x") > 0, F.log("x"))
    s = data.agg(F.count("x").alias("n"), F.avg("x").alias("mean"), F.stddev_pop("x").alias("sd"),
                 F.min("x").alias("lo"), F.max("x").alias("hi"), F.avg(F.col("x") * F.col("x")).alias("sq"),
                 F.avg(positive).alias("lmean"), F.stddev_pop(positive).alias("lsd"), F.count(positive).alias("ln"),
                 F.avg(F.abs(F.col("x") - mid)).alias("mad")).first()
    hist = histogram(data, "x", bins)
    m = F.col("midpoint")
    pdfs: dict[str, Column] = {}
    if s["sd"] and s["sd"] > 0:
        sd, mean, lo, hi = s["sd"], s["mean"], s["lo"], s["hi"]
        pdfs["normal"] = F.exp(-F.pow((m - mean) / sd, 2) / 2) / (sd * math.sqrt(2 * math.pi))
        pdfs["exponential"] = F.when(m >= lo, F.exp(-(m - lo) / (mean - lo)) / (mean - lo)).otherwise(0.0)
        pdfs["uniform"] = F.when(m.between(lo, hi), F.lit(1 / (hi - lo))).otherwise(0.0)
        pdfs["laplace"] = F.exp(-F.abs(m - mid) / s["mad"]) / (2 * s["mad"])
        scale = sd * math.sqrt(3) / math.pi
        e = F.exp(-F.abs(m - mean) / scale)
        pdfs["logistic"] = e / (scale * F.pow(1 + e, 2))
        beta = sd * math.sqrt(6) / math.pi
        z = (m - (mean - 0.5772156649 * beta)) / beta
        pdfs["gumbel"] = F.exp(-(z + F.exp(-z))) / beta
        if lo > 0:
            pdfs["lognormal"] = F.exp(-F.pow((F.log(m) - s["lmean"]) / s["lsd"], 2) / 2) / (
                m * s["lsd"] * math.sqrt(2 * math.pi))
            shape, theta = mean * mean / (sd * sd), sd * sd / mean
            pdfs["gamma"] = F.exp((shape - 1) * F.log(m) - m / theta - math.lgamma(shape) - shape * math.log(theta))
            sigma2 = s["sq"] / 2
            pdfs["rayleigh"] = m / sigma2 * F.exp(-m * m / (2 * sigma2))
            alpha = 1 / (s["lmean"] - math.log(lo))
            pdfs["pareto"] = F.when(m >= lo, alpha * F.pow(F.lit(lo), F.lit(alpha)) / F.pow(m, F.lit(alpha + 1))
                                    ).otherwise(0.0)
    sse = hist.agg(*[F.sum(F.pow(F.col("density") - pdf, 2)).alias(name) for name, pdf in pdfs.items()])
    long = sse.select(F.inline(F.array(*[F.struct(F.lit(n).alias("family"), F.col(n).alias("sse")) for n in pdfs])))
    best = F.row_number().over(W.partitionBy(F.lit(0)).orderBy("sse", "family"))  # ten rows
    return long.withColumn("place", best)


def kde(df: DataFrame, col: str, grid: DataFrame, point: str, bandwidth: float = 1.0) -> DataFrame:
    """Gaussian density at every grid point.

    Equal values are counted first, so the work is distinct values times grid points.
    """
    from panelkit.operators.joins import cross

    values = df.where(F.col(col).isNotNull()).groupBy(F.col(col).cast("double").alias("_x")).agg(
        F.count(F.lit(1)).alias("_n"))
    z = (F.col(point) - F.col("_x")) / bandwidth
    kernel = F.exp(-z * z / 2) / (bandwidth * math.sqrt(2 * math.pi))
    return (cross(values, grid.select(point)).groupBy(point)
            .agg((F.sum(kernel * F.col("_n")) / F.sum("_n")).alias("density")))


def zscore_by(df: DataFrame, col: str, by: list[str], name: str = "z") -> DataFrame:
    """Standardised value against the mean and sample deviation of its group; NULL when the deviation is 0."""
    from panelkit.scale import lookup_join

    stats = df.groupBy(*by).agg(F.avg(col).alias("_mean"), F.stddev_samp(col).alias("_sd"))
    out = lookup_join(df, stats, by, "left")
    return out.withColumn(name, F.when(F.col("_sd") > 0, (F.col(col) - F.col("_mean")) / F.col("_sd"))).drop("_mean", "_sd")
