"""Scores of classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators.stats import prefix_sum


def gini(scores: DataFrame, label: str, score: str) -> DataFrame:
    """2 AUC - 1 with tied scores counted half; NULL when one class is missing.

    Scores are counted first and ranked by a distributed running total.
    """
    per = (scores.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("_s"))
           .agg(F.count(F.when(F.col(label) == 1, 1)).alias("n1"), F.count(F.when(F.col(label) == 0, 1)).alias("n0")))
    run = prefix_sum(per, ["_s"], ["n0"])
    below = F.col("n0_upto") - F.col("n0")
    won = F.sum(F.col("n1") * (below * 2 + F.col("n0")).cast("decimal(38,0)")).cast("double") / 2
    pairs = F.sum("n1").cast("double") * F.sum("n0").cast("double")
    return run.agg(F.sum("n1").alias("positives"), F.sum("n0").alias("negatives"),
                   (2 * F.try_divide(won, pairs) - 1).alias("gini"))


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Rows per (label, prediction) and the overall share of right predictions."""
    counts = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))
    accuracy = counts.agg(F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
                          / F.sum("n")).scalar()
    return counts.withColumn("accuracy", accuracy)
