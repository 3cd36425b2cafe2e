"""Windows over panels and best rows of groups.

Ordered windows expect one row per key and period, so a group is as long as the calendar. Picking
the best rows of a group is done by aggregation, which combines on the map side and has no such limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.scale import lookup_join


def _over(keys: list[str], order: list[str]):
    return W.partitionBy(*keys).orderBy(*order)


def lag_of(df: DataFrame, col: str, keys: list[str], order: list[str], name: str, default: object = None,
           n: int = 1) -> DataFrame:
    """Value ``n`` periods earlier."""
    return df.withColumn(name, F.lag(col, n, default).over(_over(keys, order)))


def lead_label(df: DataFrame, col: str, keys: list[str], order: list[str], ahead: list[int],
               name: str = "{col}_in_{n}") -> DataFrame:
    """The value of a flag some periods ahead, one column per distance, in one window pass."""
    w = _over(keys, order)
    return df.withColumns({name.format(col=col, n=n): F.lead(col, n).over(w) for n in ahead})


def frame(keys: list[str], order: list[str], lo: int | None, hi: int):
    """Rows ``lo``..``hi`` around the current one; ``lo=None`` starts at the first row."""
    return _over(keys, order).rowsBetween(W.unboundedPreceding if lo is None else lo, hi)


def moving(df: DataFrame, col: str | Column, keys: list[str], order: list[str], lo: int | None, hi: int, fn: str,
           name: str) -> DataFrame:
    """Moving sum, avg, min or max."""
    value = F.col(col) if isinstance(col, str) else col
    return df.withColumn(name, getattr(F, fn)(value).over(frame(keys, order, lo, hi)))


def best_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group in ascending ``order``; end the order with unique columns."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
            .select(*keys, "_row.*"))


def latest_row(df: DataFrame, keys: list[str], ts: str, ties: list[str]) -> DataFrame:
    """The last row of each group by time."""
    rest = [c for c in df.columns if c not in keys]
    return (df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(ts, *ties)).alias("_row"))
            .select(*keys, "_row.*"))


def main_partner(df: DataFrame, keys: list[str], partner: str, amount: str) -> DataFrame:
    """The partner with the largest amount and the one with most rows per group; ties go to the first name."""
    per = df.where(F.col(partner).isNotNull()).groupBy(*keys, partner).agg(
        F.sum(amount).alias("_amount"), F.count(F.lit(1)).alias("_rows"))
    return per.groupBy(*keys).agg(
        F.min_by(partner, F.struct(-F.col("_amount"), F.col(partner))).alias("main_by_amount"),
        F.min_by(partner, F.struct(-F.col("_rows"), F.col(partner))).alias("main_by_count"))


def max_rows(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    """All rows that reach the maximum of their group, ties kept."""
    top = df.groupBy(*keys).agg(F.max(col).alias("_top"))
    return lookup_join(df, top, keys, "inner").where(F.col(col) == F.col("_top")).drop("_top")


def top_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per group."""
    return best_row(df, keys, order)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows overall."""
    return df.orderBy(*order).limit(k)


def sort(df: DataFrame, keys: list[Column | str]) -> DataFrame:
    return df.orderBy(*keys)


def smooth_2d(hist: DataFrame, x: str, y: str, value: str, b: int, name: str = "smooth") -> DataFrame:
    """Moving average of a 2-D histogram along ``y`` and then along ``x``; the cells of one line are a group."""
    along_y = W.partitionBy(x).orderBy(y).rowsBetween(-b, b)
    along_x = W.partitionBy(y).orderBy(x).rowsBetween(-b, b)
    return (hist.withColumn("_pass", F.avg(value).over(along_y))
            .withColumn(name, F.avg("_pass").over(along_x)).drop("_pass"))
