"""Encodings of categories, numbers and text."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import (CountVectorizer, PolynomialExpansion, RegexTokenizer, RFormula, StopWordsRemover,
                                StringIndexer, VectorAssembler, VectorSlicer)
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.scalars import words
from panelkit.operators.quantiles import quantile_label
from panelkit.scale import lookup_join


def woe_fit(df: DataFrame, target: str, cats: list[str], unknown: str = "unknown",
            weight: str | None = None) -> DataFrame:
    """Weight of evidence per column and category, with its part of the information value.

    A class without rows counts as one row; NULL and ``unknown`` get 0. ``weight`` names a row count
    when ``df`` is already aggregated.
    """
    size = F.lit(1) if weight is None else F.col(weight)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cats])

    def rows_of(k: int, name: str):
        return F.sum(F.when(F.col(name) == k, F.col("_w")).otherwise(0))

    weighted = df.withColumn("_w", size.cast("long"))
    per = (weighted.select(F.col(target).alias("_t"), "_w", F.inline(cells)).groupBy("column", "value")
           .agg(rows_of(1, "_t").alias("n1"), rows_of(0, "_t").alias("n0")))
    all1, all0 = (weighted.agg(rows_of(k, target)).scalar().cast("double") for k in (1, 0))
    known = F.col("value").isNotNull() & (F.col("value") != unknown)
    one, zero = F.greatest(F.col("n1"), F.lit(1)), F.greatest(F.col("n0"), F.lit(1))
    woe = F.when(known, F.log(one / zero) + F.log(all0 / all1)).otherwise(F.lit(0.0))
    return (per.withColumn("woe", woe)
            .withColumn("iv", (F.col("n1") / all1 - F.col("n0") / all0) * F.col("woe")))


def information_value(fitted: DataFrame) -> DataFrame:
    """Information value per column."""
    return fitted.groupBy("column").agg(F.sum("iv").alias("iv"))


def woe_encode(df: DataFrame, fitted: DataFrame, cats: list[str]) -> DataFrame:
    """Replace categories by their weight; a category not seen in training gets the mean training weight."""
    means = {r["column"]: r["m"] for r in  # one row per encoded column
             fitted.groupBy("column").agg((F.sum(F.col("woe") * (F.col("n0") + F.col("n1")))
                                           / F.sum(F.col("n0") + F.col("n1"))).alias("m")).collect()}
    out = df
    for c in cats:
        table = fitted.where((F.col("column") == c) & F.col("value").isNotNull()).select(
            F.col("value").alias(f"_{c}"), F.col("woe").alias(f"{c}_woe"))
        out = lookup_join(out.withColumn(f"_{c}", F.col(c).cast("string")), table, [f"_{c}"], "left")
        gap = F.when(F.col(c).isNull(), 0.0).otherwise(F.lit(means[c]))
        out = out.withColumn(f"{c}_woe", F.coalesce(f"{c}_woe", gap)).drop(f"_{c}")
    return out


def string_index(df: DataFrame, cols: list[str]) -> DataFrame:
    """Index by frequency, largest class 0, ties by name; unseen values get the next index."""
    model = StringIndexer(inputCols=cols, outputCols=[f"{c}_index" for c in cols], handleInvalid="keep").fit(df)
    return model.transform(df)


def one_hot(df: DataFrame, cols: list[str]) -> DataFrame:
    """Index and dummy vector per column; the last class, by index, has no dummy, and a missing value has none either."""
    index = StringIndexer(inputCols=cols, outputCols=[f"{c}_index" for c in cols], handleInvalid="keep").fit(df)
    out = index.transform(df)
    for c, labels in zip(cols, index.labelsArray):
        known = F.col(f"{c}_index") < len(labels) - 1
        place = F.when(known, F.col(f"{c}_index").cast("int"))
        ones = F.transform(F.sequence(F.lit(0), F.lit(max(len(labels) - 2, 0))), lambda i: F.coalesce((i == place).cast("double"), F.lit(0.0)))
        out = out.withColumn(f"{c}_dummy", array_to_vector(F.slice(ones, 1, max(len(labels) - 1, 0))))
    return out


def dummy_columns(df: DataFrame, col: str, values: list) -> DataFrame:
    """One 0/1 column per listed value but the first."""
    return df.withColumns({f"{col}_{v}": (F.coalesce(F.col(col) == F.lit(v), F.lit(False))).cast("int")
                           for v in values[1:]})


def standard_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    """Centre and divide by the population standard deviation; a constant column becomes 0."""
    stats = df.agg(F.struct(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
                            *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in cols])).scalar()
    return df.withColumns({f"{c}_scaled": F.when(stats[f"s_{c}"] > 0, (F.col(c) - stats[f"m_{c}"]) / stats[f"s_{c}"])
                          .otherwise(F.when(F.col(c).isNotNull(), 0.0)) for c in cols})


def assemble(df: DataFrame, cols: list[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=name, handleInvalid="error").transform(df)


def slice_vector(df: DataFrame, indices: list[int], source: str = "features", name: str = "selected") -> DataFrame:
    return VectorSlicer(inputCol=source, outputCol=name, indices=indices).transform(df)


def formula(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """R-style formula to ``features`` and ``label``."""
    return RFormula(formula=f"{target} ~ {' + '.join(cols)}").fit(df).transform(df)


def quantile_bins(df: DataFrame, first: str, second: str, key: list[str], k1: int = 15, k2: int = 5) -> DataFrame:
    """Cell of two quantile labels: first label + k1 * second label, both from 0."""
    one = quantile_label(df, first, key, k1, "_a")
    two = quantile_label(one, second, key, k2, "_b")
    return two.withColumn("cell", (F.col("_a") - 1 + k1 * (F.col("_b") - 1)).cast("int")).drop("_a", "_b")


def polynomial_features(df: DataFrame, cols: list[str], degree: int = 4) -> DataFrame:
    """All products of the columns up to ``degree`` as one vector."""
    assembled = assemble(df, cols, "_raw")
    return PolynomialExpansion(degree=degree, inputCol="_raw", outputCol="poly").transform(assembled).drop("_raw")


def power_columns(df: DataFrame, col: str, degree: int = 4) -> DataFrame:
    """Powers of one column by name."""
    return df.withColumns({f"{col}_pow{p}": F.pow(F.col(col).cast("double"), F.lit(float(p)))
                           for p in range(2, degree + 1)})


def text_counts(df: DataFrame, key: str, text: str, vocab: int = 1500, stop_words: list[str] | None = None) -> DataFrame:
    """Counts of the ``vocab`` most frequent words per text."""
    tokens = df.select(key, F.explode(words(text)).alias("word"))
    if stop_words:
        tokens = tokens.where(~F.col("word").isin(stop_words))
    top = (tokens.groupBy("word").agg(F.count(F.lit(1)).alias("_total")).orderBy(F.desc("_total"), "word").limit(vocab)
           .select("word"))
    # other words leave before texts are grouped, so that only counts of the vocabulary are moved
    return lookup_join(tokens, top, ["word"], "left_semi").groupBy(key, "word").agg(F.count(F.lit(1)).alias("n"))


def text_vectorizer(text: str, vocab: int = 1500) -> Pipeline:
    """Word counts as a vector, for models."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="_words", pattern="[^a-zA-Z]+", toLowercase=True),
        StopWordsRemover(inputCol="_words", outputCol="_kept"),
        CountVectorizer(inputCol="_kept", outputCol="features", vocabSize=vocab)])
