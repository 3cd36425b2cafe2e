"""Variable selection."""

from __future__ import annotations

from itertools import combinations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators import trees


def corr_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every column pair from one pass."""
    pairs = list(combinations(cols, 2))
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_{i}")
                    for i, (a, b) in enumerate(pairs)])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                                                   F.col(f"_{i}").alias("corr")) for i, (a, b) in enumerate(pairs)])))


def correlated_walk(matrix: list[list[float]], cols: list[str], threshold: float) -> list[str]:
    """Columns to drop: walk in order, drop a column that any kept one is too close to."""
    dropped: list[int] = []
    for i in range(len(cols)):
        live = [j for j in range(len(cols)) if j != i and j not in dropped]
        if any(abs(matrix[i][j]) > threshold for j in live):
            dropped.append(i)
    return [cols[i] for i in dropped]


def _complete(df: DataFrame, cols: list[str]) -> DataFrame:
    """The columns as numbers, gaps filled with the mean (0 where a column has no value), in column ``_v``."""
    known = {c: F.nullif(F.col(c).cast("double"), F.lit(float("nan"))) for c in cols}
    means = df.agg(F.struct(*[F.coalesce(F.avg(known[c]), F.lit(0.0)).alias(c) for c in cols])).scalar()
    return VectorAssembler(inputCols=[f"_n_{c}" for c in cols], outputCol="_v", handleInvalid="error").transform(
        df.withColumns({f"_n_{c}": F.coalesce(known[c], means[c]) for c in cols}))


def correlated_columns(df: DataFrame, cols: list[str], threshold: float = 0.7, method: str = "pearson") -> list[str]:
    """Columns to drop so that no pair is correlated above ``threshold``; only the column matrix reaches the driver."""
    matrix = Correlation.corr(_complete(df, cols).select("_v"), "_v", method).first()[0].toArray().tolist()
    return correlated_walk(matrix, cols, threshold)


def drop_correlated(df: DataFrame, cols: list[str], threshold: float = 0.7, method: str = "pearson") -> DataFrame:
    """Drop columns until no pair is correlated above ``threshold``."""
    return df.drop(*correlated_columns(df, cols, threshold, method))


def single_feature_power(df: DataFrame, target: str, cols: list[str], keep: int = 20, bins: int = 16,
                         accuracy: int = 10_000) -> DataFrame:
    """Share of rows the majority class of their bin gets right and the number of bins, per feature.

    Numbers fall into quantile bins, whose borders come from mergeable sketches (off by one row in
    ``accuracy`` at most); strings are their own bins. All features share the two passes. The features with the least
    power are dropped, unless all have it; of the others the best ``keep`` stay, equal ones by fewer bins, then by name.
    """
    kinds = dict(df.dtypes)
    numeric = [c for c in cols if kinds[c] != "string"]
    shares = [i / bins for i in range(1, bins)]
    ends = df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, accuracy).alias(f"c{i}")
                    for i, c in enumerate(numeric)]).first() if numeric else ()

    def bin_of(c: str):
        if c not in numeric:
            return F.col(c)
        x = F.col(c).cast("double")
        borders = F.array(*[F.lit(float(e)) for e in sorted(set(ends[numeric.index(c)] or []))]).cast("array<double>")
        return F.when(x.isNotNull(), F.size(F.filter(borders, lambda e: e < x))).cast("string")

    cells = F.array(*[F.struct(F.lit(c).alias("feature"), bin_of(c).alias("bin")) for c in cols])
    counts = (df.select(F.col(target).alias("_t"), F.inline(cells)).groupBy("feature", "bin", "_t")
              .agg(F.count(F.lit(1)).alias("n")))
    best = counts.groupBy("feature", "bin").agg(F.max("n").alias("hit"), F.sum("n").alias("n"))
    power = best.groupBy("feature").agg((F.sum("hit") / F.sum("n")).alias("power"), F.count(F.lit(1)).alias("cells"))
    # a row a feature is left: its own extremes are a scalar
    ends_ = power.agg(F.struct(F.min("power").alias("lo"), F.max("power").alias("hi"))).scalar()
    return (power.where((F.col("power") > ends_["lo"]) | (ends_["lo"] == ends_["hi"]))
            .orderBy(F.desc("power"), "cells", "feature").limit(keep))


def tree_power(df: DataFrame, target: str, cols: list[str], depth: int = 4, keep: int = 20) -> list[tuple]:
    """The same ranking by one small tree per feature: (feature, share right, leaves); the weakest feature goes first.

    All trees grow on one table of counts; only the ranking reaches the driver.
    """
    kinds = dict(df.dtypes)
    text = [c for c in cols if kinds[c] == "string"]
    power = trees.feature_power(df, [], target, [c for c in cols if c not in text], text, depth)
    return [(r["feature"], r["power"], r["leaves"]) for r in trees.best_features(power, keep).orderBy("rank").collect()]


#: Regularisation strengths tried by the selection (fixed values).
REG_GRID = [0.0, 0.025, 0.5, 0.1, 0.2, 0.4]


def nonzero_coefficients(df: DataFrame, target: str, cols: list[str], grid: list[float] = REG_GRID, folds: int = 3,
                         elastic_net: float = 1.0, seed: int = 7) -> list[str]:
    """Columns with a non-zero coefficient after a cross-validated penalised fit.

    The models are fitted one after another: PySpark hands all threads of a validator the same local properties, and one
    that clears its execution's number fails another ("Cannot parse null string").
    """
    rows = _complete(df.where(F.col(target).isNotNull()), cols).withColumnRenamed("_v", "features")
    model = LogisticRegression(labelCol=target, elasticNetParam=elastic_net)
    params = ParamGridBuilder().addGrid(model.regParam, grid).build()
    best = CrossValidator(estimator=model, estimatorParamMaps=params, numFolds=folds, seed=seed,
                          evaluator=BinaryClassificationEvaluator(labelCol=target)).fit(rows).bestModel
    return [c for c, w in zip(cols, best.coefficients.toArray()) if w != 0.0]
