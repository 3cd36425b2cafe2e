"""Trees of all groups in one job: against single fits, against counts by hand, saved and loaded."""

import collections

import pytest
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from panelkit.operators import trees as T
from tests.conftest import rows


def frame(spark, n=3000):
    h = lambda i, m: F.pmod(F.xxhash64("id", F.lit(i)), F.lit(m))
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, "s1").when(F.col("id") % 3 == 1, "s2").alias("seg"),
                               h(1, 20).cast("double").alias("a"), h(2, 9).cast("double").alias("b"), h(3, 2).cast("double").alias("c"),
                               F.element_at(F.array(*map(F.lit, "uvwx")), (h(4, 4) + 1).cast("int")).alias("cat"), h(5, 100).alias("noise"))
    y = F.when((F.col("a") > 7.5) & (F.col("b") < 4), 0).when((F.col("seg") == "s1") & (F.col("a") < 3), 2).when(F.col("c") > 0, 1).otherwise(2)
    return df.withColumn("y", F.when(F.col("noise") < 12, F.col("noise") % 3).otherwise(y).cast("int"))


def spark_tree(rows_, cols, target, depth, min_rows):
    data = VectorAssembler(inputCols=cols, outputCol="features").transform(rows_)
    return DecisionTreeClassifier(labelCol=target, maxDepth=depth, minInstancesPerNode=min_rows, maxBins=32).fit(data)


def text_tree(model):
    """Splits of a fitted tree by node number: (feature, border), None for a leaf."""
    out = {}

    def walk(node, at):
        if node.numDescendants() == 0:
            out[at] = None
        else:
            out[at] = (node.split().featureIndex(), round(node.split().threshold(), 9))
            walk(node.leftChild(), 2 * at)
            walk(node.rightChild(), 2 * at + 1)
    walk(model._call_java("rootNode"), 1)
    return out


def test_splits_are_those_of_single_fits(spark):
    df, cols = frame(spark), ["a", "b", "c"]
    model = T.fit(df, ["seg"], "y", cols, depth=4, min_rows=30)
    got = collections.defaultdict(dict)
    for r in model.splits().collect():
        got[r["seg"]][r["node"]] = None if r["feature"] is None else (cols.index(r["feature"]), round(r["border"], 9))
    for seg in ("s1", "s2", None):
        part = df.where(F.col("seg").eqNullSafe(F.lit(seg)))
        single = spark_tree(part, cols, "y", 4, 30)
        assert got[seg] == text_tree(single)
        data = VectorAssembler(inputCols=cols, outputCol="features").transform(part)
        single.setLeafCol("leaf")
        want = rows(single.transform(data).select("id", F.col("leaf").cast("int"), F.col("prediction").cast("int").cast("string")))
        assert rows(model.transform(part).select("id", "leaf", "prediction")) == want
    assert len(got) == 3 and sum(len(v) for v in got.values()) > 12


def test_leaf_counts_by_hand(spark):
    """Rows of the leaves are those that the splits select, and every split is the best one of its rows."""
    df = frame(spark, 900).where("seg = 's1'")
    model = T.fit(df, ["seg"], "y", ["a"], ["cat"], depth=2, min_rows=20)
    data = [r.asDict() for r in df.collect()]
    nodes = {r["node"]: r for r in model.splits().collect()}

    def gini(part):
        n = collections.Counter(r["y"] for r in part)
        return len(part) - sum(v * v for v in n.values()) / len(part) if part else 0.0

    def side(part, r):
        return [x for x in part if (x["a"] <= r["border"] if r["feature"] == "a" else x["cat"] in r["values"])]

    def check(at, part):
        r = nodes[at]
        assert r["n"] == len(part) and r["hits"] == max(collections.Counter(x["y"] for x in part).values())
        if r["feature"] is None:
            return
        left = side(part, r)
        right = [x for x in part if x not in left]
        loss, best = gini(left) + gini(right), float("inf")
        every = [[x for x in part if x["a"] <= v] for v in range(20)] + [
            [x for x in part if x["cat"] in s] for s in ("u", "v", "w", "uv", "uw", "vw", "uvw")]
        for one in every:
            ids = {x["id"] for x in one}
            two = [x for x in part if x["id"] not in ids]
            if len(one) >= 20 and len(two) >= 20:
                best = min(best, gini(one) + gini(two))
        assert loss == pytest.approx(best)
        check(2 * at, left)
        check(2 * at + 1, right)
    check(1, data)
    counts = collections.Counter(r["leaf"] for r in model.transform(df).collect())
    assert counts == {r["leaf"]: r["n"] for r in nodes.values() if r["leaf"] is not None}


def test_jobs_do_not_grow_with_groups(spark):
    tracker = spark.sparkContext.statusTracker()

    def jobs(df, name):
        spark.sparkContext.setJobGroup(name, name)
        model = T.fit(df, ["g"], "y", ["a", "b"], ["cat"], depth=3, min_rows=3, keep=2)
        assert model.transform(df).where("leaf is null").count() == 0
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(name))
    df = frame(spark)
    few, many = df.withColumn("g", F.col("id") % 2), df.withColumn("g", F.col("id") % 40)
    assert jobs(many, "many") <= jobs(few, "few") + 8


def test_power_is_that_of_single_trees(spark):
    df = frame(spark).where("seg is null")
    power = {r["feature"]: (r["power"], r["leaves"]) for r in T.feature_power(df, [], "y", ["a", "b", "c"], ["cat"]).collect()}
    for c in ("a", "b", "c"):
        single = spark_tree(df, [c], "y", 4, 1)
        data = single.transform(VectorAssembler(inputCols=[c], outputCol="features").transform(df))
        right = data.agg(F.avg((F.col("prediction") == F.col("y")).cast("double"))).first()[0]
        assert power[c] == (pytest.approx(right), (single.numNodes + 1) // 2)
    best = T.best_features(T.feature_power(df, [], "y", ["a", "b", "c"], ["cat"]), 2).orderBy("rank").collect()
    assert len(best) == 2 and best[0]["power"] == max(p for p, _ in power.values())
    same = spark.createDataFrame([("g", "x", 0.5, 2), ("g", "y", 0.5, 1), ("h", "x", 0.5, 1), ("h", "y", 0.6, 3)], "_g string, feature string, power double, leaves int")
    assert {(r["_g"], r["feature"], r["rank"]) for r in T.best_features(same, 5).collect()} == {("g", "y", 1), ("g", "x", 2), ("h", "y", 1)}


def test_odd_values(spark, tmp_path):
    """Missing numbers and classes, values and groups unseen in the fit, wide categories, one-class groups, no rows."""
    df = frame(spark, 600).withColumns({"a": F.when(F.col("id") % 7 == 0, None).when(F.col("id") % 7 == 1, float("nan")).otherwise(F.col("a")),
                                        "cat": F.when(F.col("id") % 5 > 0, F.col("cat")), "wide": F.col("id").cast("string"),
                                        "y": F.when(F.col("seg") == "s1", 1).when(F.col("id") % 11 > 0, F.col("y")), "void": F.lit(None).cast("double")})
    model = T.fit(df, ["seg"], "y", ["a", "b", "void"], ["cat", "wide"], depth=3, min_rows=5, keep=3)
    assert model.transform(df).where("leaf is null").count() == 0
    assert not {"wide", "void"} & {r["feature"] for r in model.splits().collect()}
    assert [r["leaf"] for r in model.transform(df).where("seg = 's1'").select("leaf").distinct().collect()] == [0]
    model.save(f"{tmp_path}/m")
    again = T.load(spark, f"{tmp_path}/m")
    unseen = df.unionByName(df.limit(3).withColumns({"seg": F.lit("new"), "cat": F.lit("q")})).unionByName(
        df.where("seg is null").limit(2).withColumn("cat", F.lit("q")))
    out = again.transform(unseen)
    assert rows(out.select("id", "seg", "leaf")) == rows(model.transform(unseen).select("id", "seg", "leaf"))
    assert out.where("seg = 'new' and leaf is null").count() == 3 and out.where("leaf is null").count() == 3
    empty = T.fit(df.where("false"), ["seg"], "y", ["a"], ["cat"])
    assert empty.transform(df).where("leaf is not null").count() == 0


def test_many_values_are_binned_by_quantiles(spark):
    df = spark.range(5000).select("id", (F.pmod(F.xxhash64("id"), F.lit(100_000)) / 7).alias("x"), F.lit(1).alias("one"))
    ends = T.bins(df, [], ["x", "one"], [], 8).first()["borders"]
    assert len(ends[0]) == 7 and ends[1] == []
    sizes = [df.where(F.col("x") <= e).count() for e in ends[0]]
    assert all(abs(s - 625 * (i + 1)) <= 2 for i, s in enumerate(sizes))
