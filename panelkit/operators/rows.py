"""Projections, filters, samples and column clean-up."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.scale import checkpoint, lookup_join, skew_join


def select(df: DataFrame, cols: list[str], rename: dict[str, str] | None = None) -> DataFrame:
    """Pick columns and rename some of them."""
    names = rename or {}
    return df.select(*[F.col(c).alias(names.get(c, c)) for c in cols])


def where(df: DataFrame, predicate: Column | str) -> DataFrame:
    return df.where(predicate)


def distinct_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys).distinct()


def limit(df: DataFrame, n: int) -> DataFrame:
    return df.limit(n)


def subset_by_keys(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is listed; repeated keys in the list do not multiply rows."""
    return lookup_join(df, keys.select(*on).distinct(), on, "left_semi")


def subset_by_parent_keys(df: DataFrame, on: list[str], bridge: DataFrame, keys: DataFrame,
                          parent: list[str]) -> DataFrame:
    """Rows of a child table whose parent, found through a bridge table, is listed."""
    children = subset_by_keys(bridge, keys, parent).select(*on).distinct()
    return skew_join(df, children, on, "left_semi")


def hash32(key: Column | str) -> Column:
    """Multiplicative hash of a key in 0..2^32-1; an integer is used as it is, anything else by its crc32."""
    col = F.col(key) if isinstance(key, str) else key
    number = F.coalesce(col.try_cast("long"), F.crc32(col.cast("string").cast("binary")))
    return F.pmod(F.pmod(number, F.lit(1 << 31)) * F.lit(2654435761), F.lit(1 << 32))


def mark_sample(df: DataFrame, groups: list[str], key: str, quota: Column, name: str) -> DataFrame:
    """1 for the first rows of each group in hash order, 0 for the rest.

    ``quota`` is the number to take, given the group size as column ``_size``. A histogram of the
    hash finds the bucket where the quota ends; only that bucket is ranked, so a group of any size
    is handled without sorting it. ``key`` must identify a row.
    """
    hashed = df.withColumn("_hash", hash32(key)).withColumn("_bucket", F.shiftright("_hash", 16).cast("int"))
    tag = [*groups, "_all"]
    hashed = hashed.withColumn("_all", F.lit(0))
    counts = hashed.groupBy(*tag, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    run = W.partitionBy(*tag).orderBy("_bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy(*tag)
    ends = (counts.withColumn("_upto", F.sum("_n").over(run)).withColumn("_size", F.sum("_n").over(whole))
            .withColumn("_quota", quota.cast("long"))
            .where((F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_n") < F.col("_quota")))
            .select(*tag, F.col("_bucket").alias("_edge"),
                    (F.col("_quota") - (F.col("_upto") - F.col("_n"))).alias("_need")))
    placed = lookup_join(hashed, ends, tag, "left")
    last = F.coalesce(F.col("_bucket") == F.col("_edge"), F.lit(False))
    sure = placed.where(~last).withColumn(name, F.coalesce((F.col("_bucket") < F.col("_edge")).cast("int"), F.lit(0)))
    order = W.partitionBy(*tag, "_bucket").orderBy("_hash", key)
    edge = placed.where(last).withColumn(name, (F.row_number().over(order) <= F.col("_need")).cast("int"))
    return sure.unionByName(edge).drop("_hash", "_bucket", "_all", "_edge", "_need")


def balanced_fractions(df: DataFrame, label: str, target: float = 0.75) -> dict:
    """Keep ``target`` of the smallest class and as many rows of the largest; other classes stay whole."""
    sizes = df.groupBy(label).count().orderBy("count", label).collect()  # one row per class
    fractions = {r[label]: 1.0 for r in sizes}
    if len(sizes) > 1:
        fractions[sizes[0][label]] = target
        fractions[sizes[-1][label]] = target * sizes[0]["count"] / sizes[-1]["count"]
    return fractions


def stratified_sample(df: DataFrame, label: str, fractions: dict, key: str) -> DataFrame:
    """floor(fraction * class size) rows of each class, the same rows in every run."""
    share = F.coalesce(*[F.when(F.col(label) == F.lit(v), F.lit(float(f))) for v, f in fractions.items()], F.lit(0.0))
    marked = mark_sample(df, [label], key, F.floor(share * F.col("_size")), "_taken")
    return marked.where("_taken = 1").drop("_taken")


def random_stratified_sample(df: DataFrame, label: str, fractions: dict, seed: int) -> DataFrame:
    """Per-class random sample."""
    return df.sampleBy(label, fractions, seed)


def split_train_test(df: DataFrame, key: str, frac: float, name: str = "is_test") -> DataFrame:
    """Mark floor(frac * n) rows as test rows, by key, so both parts together are the input."""
    return mark_sample(df, [], key, F.floor(F.lit(float(frac)) * F.col("_size")), name)


def cap_sample(df: DataFrame, n: int, key: str) -> DataFrame:
    """At most ``n`` rows, spread over the table by key hash."""
    marked = mark_sample(df, [], key, F.least(F.lit(n), F.col("_size")), "_taken")
    return marked.where("_taken = 1").drop("_taken")


def separate_special(df: DataFrame, churned: Column, joiner: Column, segment: str, churn_name: str = "Churn",
                     joiner_name: str = "NewJoiner") -> tuple[DataFrame, DataFrame]:
    """Ordinary rows, and churned or new rows with their segment renamed (churn first)."""
    is_churned, is_joiner = F.coalesce(churned, F.lit(False)), F.coalesce(joiner, F.lit(False))
    special = df.where(is_churned | is_joiner).withColumn(
        segment, F.when(is_churned, churn_name).otherwise(joiner_name))
    return df.where(~is_churned & ~is_joiner), special


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _unfold(wide: DataFrame, cols: list[str], fields: dict[str, str]) -> DataFrame:
    """One row per column from the single row of an aggregate; ``fields`` is output name -> column prefix."""
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{p}{c}").alias(n) for n, p in fields.items()]) for c in cols])))


def column_summary(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """count, mean, stddev, min and max per numeric column from one pass."""
    names = cols or numeric_columns(df)
    aggs = []
    for c in names:
        v = F.col(c).cast("double")
        aggs += [F.count(c).alias(f"n_{c}"), F.avg(v).alias(f"m_{c}"), F.stddev_samp(v).alias(f"s_{c}"),
                 F.min(v).alias(f"lo_{c}"), F.max(v).alias(f"hi_{c}")]
    return _unfold(df.agg(*aggs), names, {"count": "n_", "mean": "m_", "stddev": "s_", "min": "lo_", "max": "hi_"})


def column_fill(df: DataFrame) -> DataFrame:
    """Non-null share and whether the column is constant, one row per column."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"n_{c}") for c in cols],
                  *[F.coalesce(F.min(c) == F.max(c), F.lit(True)).cast("int").alias(f"k_{c}") for c in cols])
    wide = wide.select(*[F.try_divide(F.col(f"n_{c}"), F.col("_rows")).alias(f"f_{c}") for c in cols],
                       *[F.col(f"k_{c}") for c in cols])
    return _unfold(wide, cols, {"fill": "f_", "is_constant": "k_"})


def drop_constant_columns(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Drop columns whose smallest and largest value agree."""
    constant = [r["column"] for r in column_fill(df).where("is_constant = 1").collect()]  # one row per column
    return df.drop(*[c for c in constant if c not in keep])


def keep_filled_columns(df: DataFrame, min_fill: float = 0.05) -> DataFrame:
    """Drop columns with a non-null share of at most ``min_fill``."""
    filled = [r["column"] for r in column_fill(df).where(F.col("fill") > min_fill).collect()]
    return df.select(*[c for c in df.columns if c in filled])


def wide_strings(df: DataFrame, max_distinct: int = 31) -> list[str]:
    """String columns with more than ``max_distinct`` values.

    A sketch settles the clearly wide columns; only the others are counted exactly.
    """
    cols = string_columns(df)
    if not cols:
        return []
    guess = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols]).first()
    unsure = [c for c in cols if guess[c] <= 3 * max_distinct]
    exact = df.agg(*[F.count_distinct(c).alias(c) for c in unsure]).first() if unsure else None
    return [c for c in cols if c not in unsure or exact[c] > max_distinct]


def drop_wide_strings(df: DataFrame, max_distinct: int = 31) -> DataFrame:
    return df.drop(*wide_strings(df, max_distinct))


def fill_nulls(df: DataFrame, values: dict[str, object] | None = None, mean_of: list[str] = ()) -> DataFrame:
    """Constant fill per column and mean fill for the columns in ``mean_of``."""
    out = df.fillna(values) if values else df
    if mean_of:
        means = df.agg(F.struct(*[F.avg(c).alias(c) for c in mean_of])).scalar()
        out = out.withColumns({c: F.coalesce(F.col(c).cast("double"), means[c]) for c in mean_of})
    return out


def replace_values(df: DataFrame, col: str, mapping: dict | DataFrame, default: object = None) -> DataFrame:
    """Map values of one column; unmapped values stay, or become ``default`` when one is given.

    A mapping table has the columns ``col`` and ``new_value``.
    """
    if isinstance(mapping, dict):
        pairs = [F.lit(x) for kv in mapping.items() for x in kv]
        new = F.try_element_at(F.create_map(*pairs), F.col(col))
        return df.withColumn(col, F.coalesce(new, F.col(col) if default is None else F.lit(default)))
    joined = lookup_join(df, mapping, [col], "left")
    return (joined.withColumn(col, F.coalesce("new_value", F.col(col) if default is None else F.lit(default)))
            .drop("new_value").select(*df.columns))


def dates_to_epoch(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Date and timestamp columns to seconds since 1970."""
    names = cols or [f.name for f in df.schema.fields
                     if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))]
    return df.withColumns({c: F.unix_seconds(F.col(c).cast("timestamp")) for c in names})


def materialise(df: DataFrame) -> DataFrame:
    """Keep a reused intermediate result in the shared checkpoint folder."""
    return checkpoint(df)
