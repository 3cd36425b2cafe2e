"""Aggregations."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.operators.lookback import Measure, Span, count, highest, history_agg, lowest, lookback_agg, total


def agg(df: DataFrame, keys: list[str | Column], **aggs: Column) -> DataFrame:
    """Aggregates per key; a key may be an expression."""
    return df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])


def dedupe_then_agg(df: DataFrame, unique_keys: list[str], keep: dict[str, Column], keys: list[str | Column],
                    **aggs: Column) -> DataFrame:
    """Collapse repeated records first, then aggregate the unique ones."""
    unique = agg(df, unique_keys, **keep)
    return agg(unique, keys, **aggs)


def scalar(df: DataFrame, value: Column) -> Column:
    """A global aggregate usable as a column in any other query."""
    return df.agg(value.alias("value")).scalar()


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values per column, one row per column."""
    wide = df.agg(*[F.count_distinct(c).alias(c) for c in cols])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct_values"))
                                          for c in cols])))


def classes_by_size(df: DataFrame, col: str) -> DataFrame:
    """Classes with their row count, largest first."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), F.col(col))


def pivot_actions(panel: DataFrame, log: DataFrame, key: list[str], rd: str, ts: str, action: str,
                  actions: dict[str, list], recent: Span, amount: str | None = None) -> DataFrame:
    """Per named action: days with it, recent days, age of first and last day, total and recent count.

    The log is collapsed to days once; the whole history is a running total, the recent window a
    bounded look-back, and all actions share both.
    """
    value = F.lit(1) if amount is None else F.col(amount)
    codes = sorted({c for group in actions.values() for c in group})
    per_day = (log.where(F.col(action).isin(codes)).groupBy(*key, F.col(ts).cast("date").alias("_ts"), action)
               .agg(F.sum(value).alias("_n")))
    past: dict[str, Measure] = {}
    now: dict[str, Measure] = {}
    for name, group in actions.items():
        mine = F.col(action).isin(group)
        past[f"{name}_days"] = count(mine)
        past[f"{name}_first"] = lowest(F.when(mine, F.col("_ts")))
        past[f"{name}_last"] = highest(F.when(mine, F.col("_ts")))
        past[f"{name}_total"] = total("_n", mine)
        now[f"{name}_days"] = count(mine)
        now[f"{name}_total"] = total("_n", mine)
    out = history_agg(panel, per_day, key, rd, "_ts", past)
    out = lookback_agg(out, per_day, key, rd, "_ts", {"_recent": recent}, now)
    cols = []
    for name in actions:
        cols += [F.col(f"{name}_days"), F.col(f"{name}_days_recent"),
                 F.datediff(rd, f"{name}_first").alias(f"{name}_age_first"),
                 F.datediff(rd, f"{name}_last").alias(f"{name}_age_last"),
                 F.col(f"{name}_total"), F.col(f"{name}_total_recent")]
    return out.select(*panel.columns, *cols)


def action_features(df: DataFrame, keys: list[str], action: str, values: list, amount: str) -> DataFrame:
    """One column per action value; naming the values avoids a pass to find them."""
    return df.groupBy(*keys).pivot(action, values).agg(F.sum(amount)).fillna(0, [str(v) for v in values])


def limits_features(accounts: DataFrame, key: list[str], rd: str, limit: str, reached: str,
                    months: int = 3) -> DataFrame:
    """Limit hits in the last months, capped at two plus the current flag, and whether the limit moved.

    A key's rows lie together and see each other through windows, so no table is joined to itself. The rows of a day
    are summed on the first of them, so a row looks at no more than the days of its window.
    """
    known = F.col(rd).isNotNull()
    for c in key:
        known = known & F.col(c).isNotNull()
    near = W.partitionBy(*key).orderBy("_at")
    same_day = W.partitionBy(*key, "_at")
    line = accounts.withColumn("_at", F.unix_date(F.col(rd).cast("date")))
    line = line.withColumns({"_hits": F.sum(reached).over(same_day), "_hi": F.max(limit).over(same_day),
                             "_lo": F.min(limit).over(same_day), "_before": F.lag("_at").over(near)})
    first = known & (F.col("_before").isNull() | (F.col("_before") != F.col("_at")))
    per_day = F.collect_list(F.when(first, F.struct("_at", "_hits", "_hi", "_lo"))).over(near.rangeBetween(-31 * months, 0))
    seen = F.filter(per_day, lambda x: x["_at"] >= F.unix_date(F.add_months(rd, -months)))
    out = line.withColumn("_seen", seen)
    zero = F.lit(0).cast(line.schema["_hits"].dataType)
    hits = F.aggregate("_seen", zero, lambda acc, x: (acc + F.coalesce(x["_hits"], zero)).cast(line.schema["_hits"].dataType))
    out = out.withColumns({"_hits": hits, "_hi": F.array_max("_seen._hi"), "_lo": F.array_min("_seen._lo")})
    return out.select(
        *accounts.columns,
        F.when(F.col("_hits") > 2, 2 + F.col(reached)).otherwise(F.col("_hits")).cast("int")
        .alias(f"limit_reached_{months}m"),
        (F.col("_hi") != F.col("_lo")).cast("int").alias(f"limit_changed_{months}m"))


def proportion_compare(df: DataFrame, group: str, first: object, second: object, traits: list[str]) -> DataFrame:
    """Share of each 0/1 trait in two groups in percent, standard errors, difference and its z value."""
    cells = F.inline(F.array(*[F.struct(F.lit(t).alias("trait"), F.col(t).cast("double").alias("yes"))
                               for t in traits]))
    long = df.where(F.col(group).isin(first, second)).select(F.col(group).alias("_g"), cells)

    def share(value: object) -> Column:
        return F.avg(F.when(F.col("_g") == F.lit(value), F.col("yes")))

    def size(value: object) -> Column:
        return F.count(F.when(F.col("_g") == F.lit(value), F.col("yes")))

    per = long.groupBy("trait").agg(share(first).alias("p1"), size(first).alias("n1"),
                                    share(second).alias("p2"), size(second).alias("n2"))
    v1 = F.try_divide(F.col("p1") * (1 - F.col("p1")), F.col("n1"))
    v2 = F.try_divide(F.col("p2") * (1 - F.col("p2")), F.col("n2"))
    z = F.try_divide(F.col("p1") - F.col("p2"), F.sqrt(v1 + v2))
    return per.select("trait", "n1", "n2", (100 * F.col("p1")).alias("share1"), (100 * F.sqrt(v1)).alias("se1"),
                      (100 * F.col("p2")).alias("share2"), (100 * F.sqrt(v2)).alias("se2"),
                      (100 * (F.col("p1") - F.col("p2"))).alias("difference"),
                      (100 * F.sqrt(v1 + v2)).alias("difference_se"), z.alias("z"), stars(z).alias("stars"))


def stars(z: Column) -> Column:
    """Number of significance stars of a z value: 10, 5 and 1 percent, two-sided."""
    size = F.abs(z)
    return (F.when(size >= 2.5758, 3).when(size >= 1.96, 2).when(size >= 1.6449, 1).otherwise(0)).cast("int")


def trait_correlation(df: DataFrame, traits: list[str], group: str) -> DataFrame:
    """Phi coefficient of every trait pair per group with its stars, in one pass over the rows."""
    pairs = list(combinations(traits, 2))
    wide = df.groupBy(group).agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"_c{i}")
                                   for i, (a, b) in enumerate(pairs)],
                                 *[F.count(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), 1)).alias(f"_n{i}")
                                   for i, (a, b) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(a).alias("trait_a"), F.lit(b).alias("trait_b"), F.col(f"_c{i}").alias("phi"),
                               F.col(f"_n{i}").alias("n")) for i, (a, b) in enumerate(pairs)])
    return (wide.select(group, F.inline(cells))
            .withColumn("stars", stars(F.col("phi") * F.sqrt("n"))))


def crosstab_totals(df: DataFrame, zone: str, region: str, household: str, cluster: str) -> DataFrame:
    """Distinct clusters and households per zone and region with total rows and columns."""
    each = df.select(zone, region, cluster, household).distinct()  # raw rows shrink before the cube multiplies them
    return (each.cube(zone, region)
            .agg(F.count_distinct(cluster).alias("clusters"), F.count_distinct(household).alias("households"),
                 F.grouping(zone).alias("_gz"), F.grouping(region).alias("_gr"))
            .select(F.when(F.col("_gz") == 1, "Total").otherwise(F.col(zone)).alias(zone),
                    F.when(F.col("_gr") == 1, "Total").otherwise(F.col(region)).alias(region),
                    "clusters", "households"))
