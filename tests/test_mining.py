"""Item sets, long validities, streamed bounds, scenario output, folds, Ward groups and hashed neighbours against plain versions."""

import collections
import datetime as dt
import itertools
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import joins, models, neighbours, pricing, rules, ward
from panelkit.streaming.arms import arm_ucb, arm_ucb_stream
from tests.conftest import rows


def plain_sets(baskets, least, longest):
    held = collections.defaultdict(set)
    for b, i in baskets:
        held[b].add(i)
    n = collections.Counter(s for items in held.values() for k in range(1, longest + 1) for s in itertools.combinations(sorted(items), k))
    return {s: c for s, c in n.items() if c >= least * len(held)}, len(held)


@pytest.mark.parametrize("longest", [1, 2, 3, 4, None])
def test_item_sets_level_by_level(spark, longest, monkeypatch):
    rng = random.Random(2)
    data = [(b, rng.choice("aaabbbccddefg")) for b in range(300) for _ in range(rng.randint(1, 9))]
    df = spark.createDataFrame([*data, (1, None), *data[:50]], "basket long, item string")
    want, n = plain_sets(data, 0.04, longest or 7)
    counted = []
    plain = rules.set_counts
    monkeypatch.setattr(rules, "set_counts", lambda sets, wanted, per_pass=7: counted.append(wanted.collect()) or plain(sets, wanted, per_pass))
    got = {tuple(r["items"]): r["freq"] for r in rules.frequent_itemsets(df, "basket", "item", 0.04, longest).collect()}
    assert got == want and (longest is not None or max(map(len, got)) >= 4)
    # nothing longer than asked for is counted, and nothing with a rare part
    for level in counted:
        for r in level:
            s = tuple(r["items"])
            assert longest is None or len(s) <= longest
            assert all(p in want for p in itertools.combinations(s, len(s) - 1))
    made = {(tuple(r["items_base"]), r["items_add"][0]): (r["confidence"], r["lift"]) for r in rules.rules(df, "basket", "item", 0.04, 0.3, 0.0, longest).collect()}
    for s, c in want.items():
        for y in s:
            base = tuple(x for x in s if x != y)
            conf = c / (want[base] if base else n)
            assert ((base, y) in made) == (conf >= 0.3)
            if (base, y) in made and base:
                assert made[base, y] == (pytest.approx(conf), pytest.approx(conf / (want[(y,)] / n)))


def test_spans_are_few_cells(spark):
    levels = 11
    spans = [(a, b) for a, b in itertools.product([0, 1, 2, 5, 6, 7, 8, 100, 1023, 1024, 1025, 2046, 2047], repeat=2) if a <= b]
    df = spark.createDataFrame(spans, "a int, b int")
    for r in df.select("a", "b", joins.span_cells(F.col("a"), F.col("b"), levels).alias("cells")).collect():
        days = sorted(d for level, place in r["cells"] for d in range(place << level, (place + 1) << level))
        assert days == list(range(r["a"], r["b"] + 1))
        assert len(r["cells"]) <= max(1, 2 * np.log2(max(2, r["b"] - r["a"] + 1)))
    day = spark.range(1).select(joins.day_cells(F.lit(1025), levels).alias("c")).first()["c"]
    assert [tuple(c) for c in day] == [(level, 1025 >> level) for level in range(levels + 1)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_interval_join(spark, how):
    rng = random.Random(3)
    day = lambda n: dt.date(2015, 1, 1) + dt.timedelta(n)
    facts = [(rng.choice([1, 1, 1, 2, 3, None]), day(rng.randint(0, 3000)) if i % 40 else None, i) for i in range(600)]
    dim = []
    for k in (1, 2, None, 4):
        for _ in range(25):
            a = rng.randint(-4000, 3500)
            dim.append((k, day(a), rng.choice([None, day(a + rng.choice([-5, 0, 1, 30, 2000, 6000]))]), f"v{rng.randint(0, 9)}"))
    f = spark.createDataFrame(facts, "k long, at date, id long")
    d = spark.createDataFrame(dim, "k long, since date, until date, v string")
    got = rows(joins.interval_join(f, d, ["k"], "at", "since", "until", ["v"], how).select("id", "k", "at", "v"))
    want = []
    for k, at, i in facts:
        hits = [v for dk, a, b, v in dim if k is not None and dk == k and at is not None and a <= at and (b is None or at <= b)]
        want += [(i, k, at, v) for v in hits or ([None] if how == "left" else [])]
    assert got == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))
    assert joins.interval_join(f.where("false"), d, ["k"], "at", "since", "until", ["v"]).count() == 0
    assert joins.interval_join(f, d.where("false"), ["k"], "at", "since", "until", ["v"]).where("v is null").count() == 600


def test_streamed_bounds_after_a_restart(spark, tmp_path):
    def put(name, data):
        spark.createDataFrame(data, "arm string, hit int").coalesce(1).write.parquet(f"{tmp_path}/in/{name}.parquet")

    put("a", [("x", 1), ("x", 0), ("y", 1)])
    put("b", [("y", 0), ("z", 1)])
    schema = spark.read.parquet(f"{tmp_path}/in/a.parquet").schema
    files = f"{tmp_path}/in/*.parquet"
    run = lambda **more: rows(arm_ucb_stream(spark, files, schema, "arm", F.col("hit"), f"{tmp_path}/out", f"{tmp_path}/state", **more))
    want = lambda arms=(): rows(arm_ucb(spark.read.parquet(files), "arm", F.col("hit"), arms))
    assert run(files_per_batch=1) == want()
    put("c", [("x", 1)] * 7 + [("y", 1)])
    assert run() == want()  # a new query goes on from the state: 13 events, each counted once
    assert run() == want()
    put("d", [("z", 0)])
    assert run(arms=["x", "y", "z", "new"]) == want(["x", "y", "z", "new"])
    assert {r["batch"] for r in spark.read.parquet(f"{tmp_path}/out").select("batch").distinct().collect()} == {0, 1, 2, 3}


def test_one_scenario_is_replaced(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.createDataFrame([("low", 1, 0.5), ("high", 1, 0.7), ("high", 2, 0.8)], "scenario string, id int, rate double")
    pricing.write_scenarios(df, path)
    before = {f: os.stat(f).st_mtime_ns for f in map(str, (tmp_path / "s" / "scenario=low").iterdir())}
    pricing.write_scenarios(spark.createDataFrame([("high", 3, 0.9)], df.schema), path)
    assert {f: os.stat(f).st_mtime_ns for f in map(str, (tmp_path / "s" / "scenario=low").iterdir())} == before
    assert rows(pricing.read_scenarios(spark, path).select(*df.columns)) == [("high", 3, 0.9), ("low", 1, 0.5)]
    one = pricing.read_scenarios(spark, path, ["low"])
    assert rows(one.select("id")) == [(1,)] and "scenario" in str(one._jdf.queryExecution().executedPlan()).split("PartitionFilters")[1][:80]


def test_folds_are_stratified_and_repeatable(spark):
    df = spark.range(1003).select("id", (F.col("id") % 10 == 0).cast("int").alias("y"), (F.col("id") % 7).cast("double").alias("a"))
    folds = models.stratified_folds(df, "y", "id", 10)
    sizes = collections.Counter((r["y"], r["fold"]) for r in folds.collect())
    for y in (0, 1):
        own = [sizes[y, f] for f in range(10)]
        assert max(own) - min(own) <= 1 and sum(own) == df.where(F.col("y") == y).count()
    assert rows(folds.select("id", "fold")) == rows(models.stratified_folds(df.repartition(9), "y", "id", 10).select("id", "fold"))
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    data = VectorAssembler(inputCols=["a"], outputCol="features").transform(df.withColumn("a", F.col("a") + 3 * F.col("y")))
    run = lambda x: rows(models.cross_validate(LogisticRegression(labelCol="y", maxIter=5), x, "y", 4, key="id"))
    first = run(data)
    assert [pytest.approx(v) for v in first[0]] == list(run(data.repartition(5))[0]) and 0.7 < first[0][1] <= 1


def plain_ward(x, k):
    groups = [[i] for i in range(len(x))]
    while len(groups) > k:
        cost = lambda a, b: len(a) * len(b) / (len(a) + len(b)) * ((x[a].mean(0) - x[b].mean(0)) ** 2).sum()
        a, b = min(itertools.combinations(range(len(groups)), 2), key=lambda p: cost(groups[p[0]], groups[p[1]]))
        groups[a] += groups.pop(b)
    return {frozenset(g) for g in groups}


def test_ward_groups(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 1.2, (n, 2)) for c, n in (((0, 0), 60), ((6, 1), 50), ((0, 7), 40), ((8, 8), 30), ((3, 4), 20))])
    df = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(x)] + [(999, None)], "id long, v array<double>").repartition(6)
    got = {r["id"]: r["group"] for r in ward.ward(df, "v", 5).collect()}
    assert got.pop(999) is None
    found = collections.defaultdict(set)
    for i, g in got.items():
        found[g].add(i)
    assert {frozenset(g) for g in found.values()} == plain_ward(x, 5)
    assert sorted(found) == list(range(5)) and len(found[0]) == max(map(len, found.values()))
    # far more rows than summaries: tasks condense first, clear groups stay what they are
    many = np.concatenate([rng.normal(c, 0.5, (400, 2)) for c in ((0, 0), (20, 0), (0, 20), (20, 20), (10, 10))])
    big = spark.createDataFrame([(i, [float(a) for a in v]) for i, v in enumerate(many)], "id long, v array<double>").repartition(5)
    summary = ward.features(big, "v", 30, 2).collect()
    assert len(summary) <= 30 and sum(r["n"] for r in summary) == 2000
    assert np.allclose(np.sum([r["total"] for r in summary], axis=0), many.sum(0))
    out = {r["id"]: r["group"] for r in ward.ward(big, "v", 5, 30).collect()}
    assert all(len({out[i] for i in range(a, a + 400)}) == 1 for a in range(0, 2000, 400)) and len(set(out.values())) == 5
    assert ward.ward(df.where("false"), "v").count() == 0 and ward.ward(df.where("id = 999"), "v").first()["group"] is None


def test_hashed_neighbours(spark):
    rng = np.random.default_rng(6)
    centres = rng.normal(0, 3, (12, 16))
    x = centres[rng.integers(0, 12, 3000)] + rng.normal(0, 1, (3000, 16))
    df = spark.createDataFrame([(i, [float(a) for a in v], int(i % 3)) for i, v in enumerate(x)], "id long, v array<double>, y int").repartition(4)
    exact = collections.defaultdict(set)
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(2)
    np.fill_diagonal(d, np.inf)
    for i, row in enumerate(np.argsort(d, axis=1, kind="stable")[:, :5]):
        exact[i] = set(row.tolist())
    for block in (2048, 50):
        out = neighbours.knn_hashed(df, df, "id", "v", "y", block=block).collect()
        got = collections.defaultdict(set)
        for r in out:
            got[r["id"]].add(r["neighbour"])
            assert r["distance"] == pytest.approx(np.sqrt(d[r["id"], r["neighbour"]]), abs=1e-6) and r["neighbour_label"] == r["neighbour"] % 3
        assert all(len(g) <= 5 for g in got.values())
        recall = sum(len(got[i] & exact[i]) for i in exact) / (5 * len(exact))
        assert recall >= 0.9, recall
    # a row asks a bounded number of buckets, and those hold a part of all rows
    codes = neighbours._codes(x, x.mean(0), rng.normal(size=(8, 16)), 6)
    assert all(len(c) == 6 == len(set(c)) for c in codes)
    assert neighbours.knn_hashed(df.where("false"), df, "id", "v", "y").count() == 0
