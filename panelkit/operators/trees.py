"""Small classification trees of many groups at once, grown level by level on counts.

All groups (business segments, or a group for each single feature) share every pass: a level is one aggregate over
(group, node, feature, bin, class) of all rows, so the number of jobs follows the depth and not the groups. The
trees stay a table with a row for each group.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit import scale

#: Gains below this are rounding, not information.
LEAST_GAIN = 1e-12
#: Splits (about 40 bytes each) up to which they are sent to every executor.
MANY_SPLITS = 100_000
#: Relative error of quantile borders is one over this.
ACCURACY = 10_000

_SPLIT = "struct<feature:int,category:boolean,at:int,mask:long>"


def _key(groups: list[str]) -> Column:
    """One text that names the group, null values included."""
    return F.to_json(F.struct(*groups), {"ignoreNullFields": "false"}) if groups else F.lit("{}")


def _attach(rows: DataFrame, table: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with the columns of a written table of one row a group."""
    return rows.join(F.broadcast(table), "_g", how) if scale.small(table) else scale.skew_join(rows, table, ["_g"], how)


# ---- bins ----------------------------------------------------------------------------------------

def bins(df: DataFrame, groups: list[str], numbers: list[str], categories: list[str], max_bins: int = 32,
         max_values: int = 4, accuracy: int = ACCURACY) -> DataFrame:
    """How each group's features fall into bins: a written table with a row for each group.

    Columns _g, the group columns, fills (a mean for each number), borders (sorted upper ends of the
    bins of each number) and values (the values of each category by frequency, ties by name; null for one with more than
    ``max_values``). A number with up to ``max_bins`` values gets the midpoints between them, any other its
    quantiles from mergeable sketches. A missing number counts as the group's mean, a missing category is a value of its own.
    """
    rows = df.withColumn("_g", _key(groups))
    known = [F.nullif(F.col(c).cast("double"), F.lit(float("nan"))) for c in numbers]
    shares = [i / max_bins for i in range(1, max_bins)]
    none = F.array().cast("array<double>")
    first = scale.checkpoint(rows.groupBy("_g").agg(
        *[F.first(g).alias(g) for g in groups],
        F.array(*[F.coalesce(F.avg(x), F.lit(0.0)) for x in known]).cast("array<double>").alias("fills"),
        F.array(*[F.coalesce(F.percentile_approx(x, shares, accuracy), none) for x in known]).cast("array<array<double>>").alias("_ends"),
        F.array(*[F.approx_count_distinct(x, 0.02) <= 2 * max_bins for x in known]).cast("array<boolean>").alias("_few")))
    # the values of a number with few of them in its group, and how often each category value occurs
    marked = _attach(rows, first.select("_g", "_few")) if numbers else rows
    sets = F.array(*[F.array_sort(F.collect_set(F.when(F.col("_few")[i], x))) for i, x in enumerate(known)])
    found = marked.groupBy("_g").agg(sets.cast("array<array<double>>").alias("_sets"))
    middle = lambda s: F.zip_with(F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda a, b: (a + b) / 2)
    both = F.arrays_zip(F.col("_sets").alias("s"), F.col("_ends").alias("e"), F.col("_few").alias("f"))
    exact = lambda x: x["f"] & (F.size(x["s"]) <= max_bins)
    borders = F.transform(both, lambda x: F.when(exact(x) & (F.size(x["s"]) > 1), middle(x["s"])).when(exact(x), none)
                          .otherwise(F.array_sort(F.array_distinct(x["e"]))))
    out = first.join(found, "_g").select("_g", *groups, "fills", borders.alias("borders"))
    if not categories:
        return scale.checkpoint(out.withColumn("values", F.array().cast("array<array<string>>")))
    # values are counted, then all but a category's most frequent ones are left out; a few are left for each group
    counts = (rows.select("_g", F.posexplode(F.array(*[F.col(c).cast("string") for c in categories])).alias("_c", "v"))
              .groupBy("_g", "_c", "v").agg(F.count(F.lit(1)).alias("n")))
    place = F.row_number().over(W.partitionBy("_g", "_c").orderBy(F.desc("n"), F.col("v").asc_nulls_last()))
    most = counts.withColumn("_r", place).where(F.col("_r") <= max_values + 2)
    lists = most.groupBy("_g", "_c").agg(F.sort_array(F.collect_list(F.struct("_r", "v"))).alias("l"))
    # a null value is one more than the max_values named ones
    named = F.size(F.filter("l", lambda x: x["v"].isNotNull()))
    lists = lists.where((named > 0) & (named <= max_values)).groupBy("_g").agg(F.map_from_entries(F.collect_list(
        F.struct("_c", F.transform("l", lambda x: x["v"])))).alias("_m"))
    return scale.checkpoint(out.join(lists, "_g", "left").select(
        *out.columns, F.array(*[F.col("_m")[i] for i in range(len(categories))]).alias("values")))


def features(numbers: list[str], categories: list[str]) -> Column:
    """The bin of every feature of a row joined with its group's ``bins``; null for a category that is left out."""
    out = []
    for i, c in enumerate(numbers):
        x = F.coalesce(F.nullif(F.col(c).cast("double"), F.lit(float("nan"))), F.col("fills")[i])
        out.append(F.struct(F.lit(False).alias("category"), F.size(F.filter(F.col("borders")[i], lambda b: b < x)).alias("bin")))
    for i, c in enumerate(categories):
        v, values = F.col(c).cast("string"), F.col("values")[i]
        at = F.when(v.isNull(), F.array_position(F.transform(values, lambda x: F.coalesce(x.isNull(), F.lit(False))), F.lit(True))
                    ).otherwise(F.array_position(values, v))
        out.append(F.when(values.isNotNull(), F.struct(F.lit(True).alias("category"), (F.coalesce(at, F.lit(0)) - 1).cast("int").alias("bin"))))
    return F.array(*out)


# ---- growing -------------------------------------------------------------------------------------

def _step(splits: Column, feats: Column, levels: int) -> Column:
    """The node a row reaches: from node 1 to 2 n (left) or 2 n + 1 (right) while the node has a split."""
    def down(node: Column, _: Column) -> Column:
        s = splits[node]
        f = feats[s["feature"]]
        left = F.when(s["category"], (f["bin"] >= 0) & (F.getbit(s["mask"], F.greatest(f["bin"], F.lit(0))) == 1)
                      ).otherwise(f["bin"] <= s["at"])
        return F.when(s.isNull(), node).when(left, 2 * node).otherwise(2 * node + 1)
    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(1), down) if levels else F.lit(1)


def _best_splits(counts: DataFrame, min_rows: int) -> DataFrame:
    """The split of largest gain of every node: _g, node, split. Ties go to the first feature and the first border.

    ``counts`` has n rows for each (_g, node, feature, category, bin, _t). Going over the bins in order, a class
    that grows from a to a + x adds x (2 a + x) to the sum of squares on the left and takes x (2 r - x) from
    that on the right, where r rows of it were left; so classes that are absent from a bin need no row.
    """
    node = ["_g", "node", "feature"]
    of_class = W.partitionBy(*node, "_t").orderBy("bin")
    along, whole = W.partitionBy(*node).orderBy("bin"), W.partitionBy(*node)
    n, every = F.col("n"), F.sum("n").over(W.partitionBy(*node, "_t"))
    ordered = (counts.where("not category").withColumn("_a", F.sum("n").over(of_class) - n).withColumn("_r", every - F.col("_a"))
               .groupBy(*node, "bin").agg(F.sum("n").alias("n"), F.sum(n * (2 * F.col("_a") + n)).alias("_l"),
                                          F.sum(n * (2 * F.col("_r") - n)).alias("_d"))
               .select(*node, F.lit(False).alias("category"), F.col("bin").alias("at"), F.lit(0).cast("long").alias("mask"),
                       F.sum("n").over(along).alias("_n"), F.sum("n").over(whole).alias("_all"), F.sum("_l").over(along).alias("_left"),
                       F.sum("_l").over(whole).alias("_squares"), F.sum("_d").over(along).alias("_gone")))
    # categories: every way to part the few values in two, named by the values that go left
    subsets = (counts.where("category and bin >= 0").withColumn("_k", F.max("bin").over(whole)).withColumn("_c", every).where("_k > 0")
               .withColumn("mask", F.explode(F.sequence(F.lit(1).cast("long"), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_k")) - 1))))
    inside = F.sum(F.when(F.getbit("mask", "bin") == 1, n).otherwise(0))
    parted = (subsets.groupBy(*node, "mask", "_t").agg(inside.alias("_in"), F.max("_c").alias("_c")).groupBy(*node, "mask").agg(
        F.sum("_in").alias("_n"), F.sum("_c").alias("_all"), F.sum(F.col("_in") * F.col("_in")).alias("_left"),
        F.sum(F.col("_c") * F.col("_c")).alias("_squares"), F.sum(F.col("_in") * (2 * F.col("_c") - F.col("_in"))).alias("_gone"))
              .select(*node, F.lit(True).alias("category"), F.lit(0).alias("at"), *[c for c in ordered.columns if c not in (*node, "category", "at")]))
    rest = F.col("_all") - F.col("_n")
    gain = (F.col("_left") / F.col("_n") + (F.col("_squares") - F.col("_gone")) / rest - F.col("_squares") / F.col("_all")) / F.col("_all")
    fair = (F.col("_n") >= max(1, min_rows)) & (rest >= max(1, min_rows))
    return (ordered.unionByName(parted).where(fair).withColumn("_gain", gain).where(F.col("_gain") > LEAST_GAIN).groupBy("_g", "node")
            .agg(F.min_by(F.struct("feature", "category", "at", "mask"), F.struct(-F.col("_gain"), "feature", "at", "mask")).alias("split")))


def _stats(classes: DataFrame) -> DataFrame:
    """Rows, most frequent class (ties: the first) and its rows of every node, from rows by class."""
    return classes.groupBy("_g", "node").agg(F.sum("n").alias("n"), F.max("n").alias("hits"),
                                             F.min_by("_t", F.struct(-F.col("n"), "_t")).cast("string").alias("prediction"))


def _pruned(rows: pd.DataFrame) -> pd.DataFrame:
    """One group's nodes without splits whose two leaves predict the same; leaves numbered from left to right."""
    nodes = {int(r.node): r for r in rows.itertuples()}
    cut = {n for n, r in nodes.items() if r.split is None}
    for n in sorted(nodes, reverse=True):
        if n not in cut and 2 * n in cut and 2 * n + 1 in cut and nodes[2 * n].prediction == nodes[2 * n + 1].prediction:
            cut.add(n)
    out, waiting, leaves = [], [1], 0
    while waiting:
        n = waiting.pop()
        r, leaf = nodes[n], n in cut
        out.append((n, {"leaf": leaves if leaf else None, "prediction": r.prediction, "n": r.n, "hits": r.hits,
                        "split": None if leaf else r.split}))
        leaves += leaf
        if not leaf:
            waiting += [2 * n + 1, 2 * n]
    return pd.DataFrame({"_g": [rows["_g"].iloc[0]], "nodes": [out]})


def grow(cells: DataFrame, depth: int = 4, min_rows: int = 1000) -> DataFrame:
    """Trees of all groups in ``cells`` (_g, _t class, _w rows, feats): a written table with _g and nodes.

    The impurity is Gini's; a node predicts its most frequent class, ties the first of them; both sides of a split
    have at least ``min_rows`` rows. Splits between leaves that predict the same are taken back.
    """
    rows = scale.checkpoint(cells)
    kind = rows.schema["feats"].dataType
    # feature -1 has all rows in one bin: the classes of the node itself
    own = F.array(F.struct(F.lit(False).alias("category"), F.lit(0).alias("bin"))).cast(kind)
    levels, found = [], 0
    for level in range(max(1, depth)):
        at = rows.withColumn("node", F.lit(1))
        if levels:
            splits = _union(levels).where("split is not null").groupBy("_g").agg(F.map_from_entries(
                F.collect_list(F.struct("node", "split"))).alias("_splits"))
            reached = _step(F.col("_splits"), F.col("feats"), level)
            joined = rows.join(F.broadcast(splits), "_g") if found <= MANY_SPLITS else scale.skew_join(rows, splits, ["_g"])
            at = joined.withColumn("node", reached).where(F.col("node") >= 2 ** level)
        counts = scale.checkpoint(
            at.select("_g", "node", "_t", "_w", F.posexplode(F.concat(own, "feats") if depth else own).alias("_i", "_f")).where("_f is not null")
            .groupBy("_g", "node", (F.col("_i") - 1).alias("feature"), F.col("_f.category").alias("category"), F.col("_f.bin").alias("bin"), "_t")
            .agg(F.sum("_w").alias("n")))
        best = _best_splits(counts.where("feature >= 0"), min_rows)
        levels.append(scale.checkpoint(_stats(counts.where("feature = -1")).join(best, ["_g", "node"], "left")))
        new = levels[-1].where("split is not null").count()
        found += new
        if not new:
            break
        if level == depth - 1:  # the classes of the last leaves follow from the counts of the splits above them
            s = F.col("split")
            side = F.when(s["category"], F.getbit(s["mask"], "bin") == 1).otherwise(F.col("bin") <= s["at"])
            leaves = (counts.join(levels[-1].select("_g", "node", "split"), ["_g", "node"]).where(F.col("feature") == s["feature"])
                      .groupBy("_g", (2 * F.col("node") + F.when(side, 0).otherwise(1)).alias("node"), "_t").agg(F.sum("n").alias("n")))
            levels.append(_stats(leaves).withColumn("split", F.lit(None).cast(levels[-1].schema["split"].dataType)))
    packed = _union(levels).groupBy("_g").applyInPandas(
        _pruned_rows, f"_g string, nodes array<struct<key:int,value:struct<leaf:int,prediction:string,n:long,hits:long,split:{_SPLIT}>>>")
    return scale.checkpoint(packed.select("_g", F.map_from_entries("nodes").alias("nodes")))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _pruned_rows(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.assign(split=[None if s is None else (s if isinstance(s, dict) else s.asDict()) for s in rows["split"]])
    out = _pruned(rows)
    out["nodes"] = [[{"key": k, "value": v} for k, v in out["nodes"].iloc[0]]]
    return out


# ---- single features -----------------------------------------------------------------------------

def _single_tree(table: np.ndarray, category: bool, depth: int, min_rows: int) -> tuple[int, int]:
    """Rows told right and leaves of a tree on one feature, from its class counts (a row for each bin)."""
    total = table.sum(0)
    n, whole = int(total.sum()), int(total.max())
    if depth == 0 or len(table) < 2:
        return whole, 1
    if category:  # every way to part the values in two
        sides = np.array([[m >> k & 1 for k in range(len(table))] for m in range(1, 1 << (len(table) - 1))], bool)
    else:
        sides = np.tri(len(table) - 1, len(table), dtype=bool)
    left = sides.astype(np.int64) @ table
    right = total - left
    a, b = left.sum(1), right.sum(1)
    fair = (a >= min_rows) & (b >= min_rows)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fair, ((left ** 2).sum(1) / a + (right ** 2).sum(1) / b - (total ** 2).sum() / n) / n, -1.0)
    at = int(gain.argmax())
    if gain[at] <= LEAST_GAIN:
        return whole, 1
    parts = [table[sides[at]], table[~sides[at]]]
    (x, k), (y, m) = (_single_tree(t, category, depth - 1, min_rows) for t in parts)
    # two leaves that predict the same are one
    if k == m == 1 and parts[0].sum(0).argmax() == parts[1].sum(0).argmax():
        return whole, 1
    return x + y, k + m


def feature_power(df: DataFrame, groups: list[str], target: str, numbers: list[str], categories: list[str], depth: int = 4,
                  min_rows: int = 1, max_bins: int = 32, max_values: int = 4, binned: DataFrame | None = None) -> DataFrame:
    """How well a small tree on each single feature tells the target, in each group: power (share right) and leaves.

    One pass counts (group, feature, bin, class) of all features; each tree grows on the counts of its feature,
    which are as many as bins and classes, whatever the rows. Columns: _g,
    the group columns, feature, power, leaves. Rows without a target are left out.
    """
    binned = bins(df.where(F.col(target).isNotNull()), groups, numbers, categories, max_bins, max_values) if binned is None else binned
    names = [*numbers, *categories]
    rows = _attach(df.where(F.col(target).isNotNull()).withColumn("_g", _key(groups)), binned.drop(*groups))
    counts = (rows.select("_g", F.col(target).cast("string").alias("_t"), F.posexplode(features(numbers, categories)).alias("_i", "_f"))
              .where("_f is not null").groupBy("_g", "_i", "_f.category", "_f.bin", "_t").agg(F.count(F.lit(1)).alias("n")))

    def single(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        table = rows.pivot_table(index="bin", columns="_t", values="n", aggfunc="sum", fill_value=0).to_numpy(dtype=np.int64)
        hits, leaves = _single_tree(table, bool(rows["category"].iloc[0]), depth, max(1, min_rows))
        return pd.DataFrame({"_g": [key[0]], "feature": [names[key[1]]], "power": [hits / int(rows["n"].sum())], "leaves": [leaves]})

    # a histogram of bins and classes a group: the counts of one feature in one group
    out = counts.groupBy("_g", "_i").applyInPandas(single, "_g string, feature string, power double, leaves int")
    return binned.select("_g", *groups).join(out, "_g")


def best_features(power: DataFrame, keep: int) -> DataFrame:
    """Per group (_g), the ``keep`` features of largest power (ties: fewer leaves, then name), with their rank.

    Those with the least power of the group are dropped first, unless all have it.
    """
    own = W.partitionBy("_g")
    left = power.withColumn("_least", F.min("power").over(own)).withColumn("_most", F.max("power").over(own)).where(
        (F.col("power") > F.col("_least")) | (F.col("_least") == F.col("_most")))
    rank = F.row_number().over(own.orderBy(F.desc("power"), "leaves", "feature"))
    return left.withColumn("rank", rank).where(F.col("rank") <= keep).drop("_least", "_most")


# ---- trees by segment ----------------------------------------------------------------------------

@dataclass
class GroupTrees:
    """Trees of all groups as a table: _g, group columns, fills, borders, values, chosen features, nodes."""

    table: DataFrame
    groups: list[str]
    numbers: list[str]
    categories: list[str]
    depth: int

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds leaf (numbered from left to right) and prediction; null for a group without a tree."""
        known = self.table.drop(*self.groups)
        rows = _attach(df.withColumn("_g", _key(self.groups)), known, "left")
        node = _step(F.transform_values("nodes", lambda _, x: x["split"]), features(self.numbers, self.categories), self.depth)
        return rows.withColumn("_node", F.col("nodes")[F.when(F.col("nodes").isNotNull(), node)]).select(
            *df.columns, F.col("_node.leaf").alias("leaf"), F.col("_node.prediction").alias("prediction"))

    def splits(self) -> DataFrame:
        """The splits in words: group columns, node, feature, border (of a number) or values (that go left), rows, prediction."""
        names = F.array(*map(F.lit, [*self.numbers, *self.categories])).cast("array<string>")
        rows = self.table.select("*", F.explode("nodes").alias("node", "_x"))
        s, k = F.col("_x.split"), len(self.numbers)
        sides = F.col("values")[s["feature"] - k]
        left = F.filter(F.arrays_zip(sides.alias("v"), F.sequence(F.lit(0), F.size(sides) - 1).alias("i")),
                        lambda z: F.getbit(s["mask"], z["i"]) == 1)
        return rows.select(*self.groups, "node", F.element_at(names, s["feature"] + 1).alias("feature"),
                           F.when(~s["category"], F.col("borders")[F.when(~s["category"], s["feature"])][s["at"]]).alias("border"),
                           F.when(s["category"], F.transform(left, lambda z: z["v"])).alias("values"),
                           F.col("_x.n").alias("n"), F.col("_x.hits").alias("hits"), F.col("_x.prediction").alias("prediction"),
                           F.col("_x.leaf").alias("leaf"))

    def save(self, path: str) -> None:
        """Write the trees under ``path``; a table and the names it needs."""
        meta = json.dumps({"groups": self.groups, "numbers": self.numbers, "categories": self.categories, "depth": self.depth})
        self.table.withColumn("_meta", F.lit(meta)).write.mode("overwrite").parquet(path)


def load(spark: SparkSession, path: str) -> GroupTrees:
    """Trees written by ``save``."""
    table = spark.read.parquet(path)
    meta = json.loads((table.select("_meta").first() or ['{"groups": [], "numbers": [], "categories": [], "depth": 0}'])[0])
    return GroupTrees(table.drop("_meta"), **meta)


def fit(df: DataFrame, groups: list[str], target: str, numbers: list[str], categories: list[str] = (), depth: int = 4,
        min_rows: int = 1000, max_bins: int = 32, max_values: int = 4, keep: int | None = None) -> GroupTrees:
    """A small tree for each group on its own bins; with ``keep`` on its own best features only.

    Rows without a target are left out; null groups are groups too. A tree may use null, missing and rare values as they
    are described for ``bins``.
    """
    categories = list(categories)
    rows = df.where(F.col(target).isNotNull())
    binned = bins(rows, groups, numbers, categories, max_bins, max_values)
    names = [*numbers, *categories]
    feats = features(numbers, categories)
    if keep is not None:
        best = best_features(feature_power(rows, groups, target, numbers, categories, depth, 1, max_bins, max_values, binned), keep)
        chosen = best.groupBy("_g").agg(F.collect_set("feature").alias("chosen"))
        binned = scale.checkpoint(binned.join(chosen, "_g", "left"))
        feats = F.transform(F.arrays_zip(feats.alias("f"), F.array(*map(F.lit, names)).alias("name")),
                            lambda x: F.when(F.array_contains("chosen", x["name"]), x["f"]))
    at = _attach(rows.withColumn("_g", _key(groups)), binned.drop(*groups))
    trees = grow(at.select("_g", F.col(target).alias("_t"), F.lit(1).cast("long").alias("_w"), feats.alias("feats")), depth, min_rows)
    return GroupTrees(scale.checkpoint(binned.join(trees, "_g")), list(groups), list(numbers), categories, depth)
