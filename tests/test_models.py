"""Encoding, selection, chains, prices, rules, scores and neighbours."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.operators import choice, encode, markov, models, pricing, rules, scores, select, stats, trees
from panelkit.operators import rows as R
from tests.conftest import rows


def test_woe_rules(spark):
    df = spark.createDataFrame([(1, "a")] * 3 + [(0, "a")] + [(1, "b")] * 2 + [(0, "c")] * 4 + [(0, None), (1, "unknown")], "y int, c string")
    fitted = {r["value"]: r["woe"] for r in encode.woe_fit(df, "y", ["c"]).collect()}
    base = math.log(6 / 6)
    assert fitted["a"] == pytest.approx(math.log(3) + base) and fitted["b"] == pytest.approx(math.log(2)) and fitted["c"] == pytest.approx(-math.log(4))
    assert fitted[None] == 0 and fitted["unknown"] == 0
    table = encode.woe_fit(df, "y", ["c"])
    mean = (4 * math.log(3) + 2 * math.log(2) - 4 * math.log(4)) / 12
    out = dict(rows(encode.woe_encode(spark.createDataFrame([("new",), (None,), ("a",)], "c string"), table, ["c"]).select(F.coalesce("c", F.lit("~")), "c_woe")))
    assert out["new"] == pytest.approx(mean) and out["~"] == 0 and out["a"] == pytest.approx(math.log(3))


def test_correlation_walk_drops_the_right_name(spark):
    m = [[1, 0.9, 0.1], [0.9, 1, -0.95], [0.1, -0.95, 1]]
    assert select.correlated_walk(m, ["a", "b", "c"], 0.7) == ["a", "b"]
    df = spark.range(50).select(F.col("id").cast("double").alias("x"), (-F.col("id").cast("double")).alias("y"), F.pmod(F.hash("id"), F.lit(9)).cast("double").alias("z"))
    assert select.drop_correlated(df, ["x", "y", "z"], 0.7).columns == ["y", "z"]
    assert select.drop_correlated(df, ["x", "y", "z"], 0.7, "spearman").columns == ["y", "z"]


def test_column_checks(spark):
    df = spark.createDataFrame([(1, "x", None, f"v{i}") for i in range(40)], "k int, s string, e int, w string")
    assert R.drop_constant_columns(df).columns == ["w"] and R.keep_filled_columns(df).columns == ["k", "s", "w"]
    assert R.wide_strings(df) == ["w"]
    assert rows(R.replace_values(df.select("s").limit(1), "s", {"x": "y"})) == [("y",)]
    table = spark.createDataFrame([("x", "z")], "s string, new_value string")
    assert rows(R.replace_values(df.select("s").limit(1), "s", table)) == [("z",)]


def chain(spark):
    return spark.createDataFrame([("a", "a", 0.5), ("a", "b", 0.3), ("a", "Churn", 0.2), ("b", "a", 0.6), ("b", "b", 0.4), ("Churn", "Churn", 1.0)],
                                 "state_from string, state_to string, probability double")


def test_values_solve_the_equation(spark):
    revenue = spark.createDataFrame([("a", 10.0), ("b", 4.0), ("Churn", 99.0)], "state string, value double")
    d = 0.0016515813
    p = np.array([[0.5, 0.3, 0.2], [0.6, 0.4, 0.0], [0, 0, 1.0]])
    r = np.array([10.0, 4.0, 0.0])
    want = np.linalg.solve(np.eye(3) - p / (1 + d), r)
    got = dict(rows(markov.segment_value(chain(spark), revenue)))
    assert got["a"] == pytest.approx(want[0], rel=1e-9) and got["b"] == pytest.approx(want[1], rel=1e-9) and got["Churn"] == 0
    finite = dict(rows(markov.segment_value(chain(spark), revenue, horizon=2)))
    m = p / (1 + d)
    assert finite["a"] == pytest.approx((r + m @ r + m @ m @ r)[0])


def test_matrix_rows_sum_to_one_and_closed_states_stay(spark):
    facts = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "a"), (2, 2, "a"), (2, 3, "c"), (3, 1, "a"), (3, 3, "b")], "client int, period int, state string")
    m = markov.transition_matrix(facts, ["client"], "period", "state")
    assert {r[0]: round(r[1], 9) for r in rows(m.groupBy("state_from").agg(F.sum("probability")))} == {"a": 1.0, "b": 1.0, "c": 1.0}
    assert rows(m.where("state_from in ('b', 'c')")) == [("b", "b", 1.0), ("c", "c", 1.0)]
    powers = markov.transition_powers(m, 3)
    assert all(abs(r[2] - 1) < 1e-9 for r in rows(powers.groupBy("month", "state_from").agg(F.sum("probability"))))
    nobody = markov.new_joiners(facts, powers, "client", "period", "state", "NewJoiner", 3)
    assert nobody.count() == 0


def test_prices_keep_ties_and_respect_bounds(spark):
    grid = spark.createDataFrame([(0.05, 0.0, 1.0), (0.10, 0.0, 0.5), (0.30, 0.0, 9.0)], "rate double, commission double, weight double")
    offers = spark.createDataFrame([(1, 12), (2, 12), (2, 12)], "client int, instalments int")
    for inputs in (None, ["instalments"]):
        out = pricing.best_price(offers, grid, ["client"], "instalments", lambda r, c: F.lit(1.0), inputs, bounds=(0.0, 0.2))
        assert rows(out.select("client", "rate", "profit")) == [(1, 0.05, 0.05), (1, 0.1, 0.05), (2, 0.05, 0.05), (2, 0.1, 0.05)]
    assert pricing.best_price(offers, grid, ["client"], "instalments", lambda r, c: F.lit(1.0), bounds=(1.0, 2.0)).count() == 0
    assert pricing.price_grid(spark).count() == 11 * 41


def brute_pairs(baskets):
    n = len(baskets)
    out = {}
    for a in {i for b in baskets for i in b}:
        for b in {i for s in baskets for i in s}:
            together = sum(1 for s in baskets if a in s and b in s)
            if a != b and together:
                out[a, b] = (together / n, together / sum(a in s for s in baskets))
    return out


def test_pair_rules_against_brute_force(spark, monkeypatch):
    random.seed(3)
    baskets = [set(random.sample("abcdefgh", random.randint(1, 6))) for _ in range(60)]
    monkeypatch.setattr(rules, "ITEMS_PER_BLOCK", 3)
    monkeypatch.setattr(rules, "BASKETS_PER_BLOCK", 7)
    df = spark.createDataFrame([(i, x) for i, s in enumerate(baskets) for x in list(s) * 2], "basket int, item string")
    got = {(r["item_a"], r["item_b"]): (r["support"], r["confidence"]) for r in rules.pair_rules(df, "basket", "item", 0.1).collect()}
    want = {k: v for k, v in brute_pairs(baskets).items() if v[0] >= 0.1}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    found = rules.rules(df, "basket", "item", 0.1, 0.0, max_length=2)
    made = {(r["items_base"][0], r["items_add"][0]): r["confidence"] for r in found.where(F.size("items_base") == 1).collect()}
    assert made == pytest.approx({k: v[1] for k, v in want.items()})
    assert found.where(F.size("items_base") == 0).select("lift").distinct().collect()[0][0] == 1.0
    with pytest.raises(ValueError):
        rules.pair_rules(df, "basket", "item", 0.0)


def test_gini_ties_and_one_class(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1), (0, 0.9)], "y int, s double")
    auc = (0.5 + 1 + 1 + 0 + 0.5 + 1) / 6
    assert scores.gini(df, "y", "s").first()["gini"] == pytest.approx(2 * auc - 1)
    assert scores.gini(df.where("y = 1"), "y", "s").first()["gini"] is None
    assert rows(scores.confusion_matrix(spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "y int, p int"), "y", "p")) == [(0, 0, 2, 0.75), (1, 0, 1, 0.75), (1, 1, 1, 0.75)]


@pytest.mark.parametrize("skip_self", [True, False])
def test_neighbours_against_brute_force(spark, skip_self):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(60, 4)), rng.normal(size=(60, 4)) + 6, np.zeros((30, 4))])
    df = spark.createDataFrame([(i, v.tolist(), int(i % 3)) for i, v in enumerate(x)], "id int, v array<double>, y int")
    got = models.knn(df, df, "id", "v", "y", 4, block=20, skip_self=skip_self)
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)), 9)
    if skip_self:
        np.fill_diagonal(d, np.inf)
    want = sorted((i, int(j)) for i in range(len(x)) for j in np.lexsort((np.arange(len(x)), d[i]))[:4])
    assert sorted(map(tuple, got.select("id", "neighbour").collect())) == want


def test_neighbours_over_many_places(spark):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(300, 6)), rng.normal(size=(200, 6)) * 1e-3 + 9, np.zeros((60, 6)), [[1e6] * 6]])
    df = spark.createDataFrame([(i, v.tolist(), int(i % 3)) for i, v in enumerate(x)], "id int, v array<double>, y int")
    got = models.knn(df, df, "id", "v", "y", 4, block=16, held=2).collect()
    d = np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)), 9)
    np.fill_diagonal(d, np.inf)
    want = {(i, int(j), d[i, j], int(j % 3)) for i in range(len(x)) for j in np.lexsort((np.arange(len(x)), d[i]))[:4]}
    assert len(got) == 4 * len(x) and set(map(tuple, got)) == want
    assert models.knn(df.where("false"), df, "id", "v", "y").count() == 0


def test_neighbours_beside_a_row_without_place(spark):
    x = np.random.default_rng(8).normal(size=(30, 3))
    df = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)] + [(-1, [float("nan")] * 3, 1)], "id int, v array<double>, y int")
    got = models.knn(df, df, "id", "v", "y", 2, block=16)
    d = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    assert sorted(map(tuple, got.select("id", "neighbour").collect())) == sorted((i, int(j)) for i in range(30) for j in np.argsort(d[i])[:2])


def test_neighbours_get_few_exact_distances(monkeypatch):
    x = np.random.default_rng(7).normal(size=(4_000, 64))
    counted, ids = [], np.arange(len(x))
    first = models._first_of
    monkeypatch.setattr(models, "_first_of", lambda found, k: counted.append(len(found)) or first(found, k))
    best = models._closest(x[:500], ids[:500], np.full(500, np.inf), x, ids, ids, 5, True)
    d = np.round(np.sqrt(((x[:500, None] - x[None]) ** 2).sum(axis=2)), 9)
    d[ids[:500], ids[:500]] = np.inf
    assert best[:, 1].astype(int).reshape(500, 5).tolist() == np.argsort(d, axis=1, kind="stable")[:, :5].tolist()
    assert sum(counted) < 500 * 4_000 // 20


def test_histogram_fit_and_density(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 1, 2, 4]], "x double")
    hist = rows(stats.histogram(df, "x", 4).select("bin", "n", "midpoint", "density"))
    assert hist == [(0, 1, 0.5, 0.2), (1, 2, 1.5, 0.4), (2, 1, 2.5, 0.2), (3, 1, 3.5, 0.2)]
    normal = spark.createDataFrame([(float(v),) for v in np.random.default_rng(1).normal(50, 3, 4000)], "x double")
    best = [r["family"] for r in stats.fit_distribution(normal, "x", 40).orderBy("place").limit(4).collect()]
    assert "normal" in best
    grid = spark.createDataFrame([(0.0,), (1.0,)], "g double")
    density = dict(rows(stats.kde(df, "x", grid, "g", 0.5)))
    want = np.mean([math.exp(-((1 - v) / 0.5) ** 2 / 2) / (0.5 * math.sqrt(2 * math.pi)) for v in [0, 1, 1, 2, 4]])
    assert density[1.0] == pytest.approx(want)


def test_choice_and_checks(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 9.0), (3, None)], "id int, x double")
    out = choice.choose_by_utility(df, {"a": {"const": 1.0, "x": 0.0}, "b": {"x": 0.5}})
    assert rows(out.select("id", "choice")) == [(1, "a"), (2, "b"), (3, "a")]
    checks = [("S1", "small", F.col("x") < 5), ("S2", "tiny", F.col("x") < 2)]
    assert rows(choice.maturity_score(df, checks, "id")) == [(1, 1.0, "none", "S2"), (2, 0.0, "small", "none"), (3, 0.0, "small", "none")]


def test_model_invariants(spark):
    df = spark.range(300).select("id", (F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 2 + F.rand(1)).alias("a"), F.rand(2).alias("b"))
    model = models.logistic_fit(df, "y", ["a", "b"])
    table = models.score_table(model, df, ["id"], "y")
    assert table.where("score < 0 or score > 1").count() == 0 and scores.gini(table, "y", "score").first()["gini"] > 0.5
    curve = [r["cost"] for r in models.kmeans_curve(df, ["a", "b"], [1, 2, 4]).orderBy("k").collect()]
    assert curve[0] > curve[1] > curve[2]
    line = spark.range(20).select((F.col("id") * 3.0 + 2).alias("y"), F.col("id").cast("double").alias("x"))
    r = models.ols(line, "y", "x").first()
    assert (round(r["slope"], 9), round(r["intercept"], 9), round(r["r2"], 9)) == (3.0, 2.0, 1.0)


def gappy(spark, n=400):
    """Two informative columns; every fifth value of ``a`` and every seventh of ``b`` is missing."""
    df = spark.range(n).select("id", (F.col("id") % 2).cast("int").alias("y"), (F.col("id") % 2 * 100 + F.pmod(F.hash("id"), F.lit(150))).cast("double").alias("a"),
                               (F.pmod(F.hash("id", F.lit(3)), F.lit(9))).cast("double").alias("b"))
    return df.withColumns({"a": F.when(F.col("id") % 5 > 0, F.col("a")), "b": F.when(F.col("id") % 7 > 0, F.col("b"))})


def test_no_row_is_lost_to_a_missing_value(spark):
    df = gappy(spark)
    means = df.agg(F.avg("a"), F.avg("b")).first()
    full = df.fillna({"a": means[0], "b": means[1]})
    model = models.logistic_fit(df, "y", ["a", "b"])
    table = models.score_table(model, df, ["id"], "y")
    assert table.count() == 400 and table.where("score is null").count() == 0
    other = dict(rows(models.score_table(models.logistic_fit(full, "y", ["a", "b"]), full, ["id"], "y").select("id", "score")))
    assert all(r["score"] == pytest.approx(other[r["id"]]) for r in table.collect())
    for kind in ("tree", "forest", "boosted"):
        assert models.tree_fit(df, "y", ["a", "b"], kind, trees=3, rounds=2).transform(df).count() == 400
        assert models.tree_fit(df, "a", ["b"], f"{kind}_regression", trees=3, rounds=2).transform(df).count() == 400
    for made in (models.svm_fit(df, "y", ["a", "b"], rounds=5), models.bayes_fit(df, "y", ["a", "b"]),
                 models.mlp_fit(df, "y", ["a", "b"], rounds=5), models.kmeans_fit(df, ["a", "b"], 2),
                 models.bisecting_fit(df, ["a", "b"], 2), models.pca_fit(df, ["a", "b"], 1)):
        assert made.transform(df).count() == 400
    assert models.lda_fit(df, "y", ["a", "b"], 1).where("ld1 is not null").count() == 400
    assert [r[0] for r in select.tree_power(df, "y", ["a", "b"])] == ["a"]  # the weakest one is dropped
    assert "a" in select.nonzero_coefficients(df, "y", ["a", "b"], grid=[0.0], folds=2)


def test_coefficients_are_in_the_units_of_the_columns(spark):
    df = gappy(spark).where("a is not null and b is not null")
    scaled = {r["term"]: r["coefficient"] for r in models.coefficient_table(models.logistic_fit(df, "y", ["a", "b"]), ["a", "b"]).collect()}
    from pyspark.ml.classification import LogisticRegression
    raw = models.fit(df, ["a", "b"], LogisticRegression(labelCol="y", tol=1e-9, maxIter=300))
    plain = {r["term"]: r["coefficient"] for r in models.coefficient_table(raw, ["a", "b"]).collect()}
    assert scaled == pytest.approx(plain, rel=0.02, abs=1e-3)


def test_flow_scores_train_and_test(spark):
    df = gappy(spark).withColumn("twin", F.col("a") * 2)
    _, kept, scored = models.train_test(df, "y", ["a", "twin", "b"], "id")
    assert kept == ["twin", "b"] and scored.count() == 400 and scored.where("part = 'test'").count() == 100
    assert all(scores.gini(scored.where(F.col("part") == p), "y", "score").first()["gini"] > 0.3 for p in ("train", "test"))
    checked = models.evaluate(scored.where("part = 'test'"), "y")
    assert sum(r["n"] for r in checked.collect()) == 100 and 0.5 < checked.first()["accuracy"] <= 1


def test_micro_segments_are_saved_and_loaded(spark, tmp_path):
    df = gappy(spark).withColumns({"seg": F.when(F.col("id") % 3 == 0, "s1").when(F.col("id") % 3 == 1, "s2"),
                                   "small": F.when(F.col("id") % 4 == 0, "u").otherwise("v"), "wide": F.col("id").cast("string")})
    models.fit_micro_segments(df, "seg", "y", ["a", "b"], ["small", "wide"], str(tmp_path / "m"), min_rows=5)
    saved = trees.load(spark, str(tmp_path / "m"))
    out = models.label_micro_segments(df, "seg", saved)
    assert out.count() == 400 and out.where("micro_segment is null").count() == 0
    assert all(r["micro_segment"].rsplit("_", 1)[0] == (r["seg"] or "none") for r in out.collect())
    assert out.select("micro_segment").distinct().count() > 3
    unseen = models.label_micro_segments(df.withColumn("seg", F.when(F.col("seg") == "s1", "s9").otherwise(F.col("seg"))), "seg", saved)
    assert unseen.count() == 400 and unseen.where("micro_segment is null").count() == df.where("seg = 's1'").count()


def test_one_hot_drops_the_last_class(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",), (None,)], "c string")
    out = {r["c"]: list(r["c_dummy"].toArray()) for r in encode.one_hot(df, ["c"]).collect()}
    assert out == {"a": [1.0, 0.0], "b": [0.0, 1.0], "c": [0.0, 0.0], None: [0.0, 0.0]}


def test_endless_values_settle_or_fail(spark):
    stuck = spark.createDataFrame([("a", "a", 1.0)], "state_from string, state_to string, probability double")
    earns = spark.createDataFrame([("a", 1.0)], "state string, value double")
    assert dict(rows(markov.segment_value(stuck, earns, discount=1e-4)))["a"] == pytest.approx(10001.0, rel=1e-6)
    with pytest.raises(ValueError):
        markov.segment_value(stuck, earns, discount=0.0, max_rounds=5)


def test_longer_item_sets(spark):
    random.seed(9)
    baskets = [set(random.sample("abcdef", random.randint(1, 5))) for _ in range(50)]
    df = spark.createDataFrame([(i, x) for i, s in enumerate(baskets) for x in s], "basket int, item string")
    from itertools import combinations
    for top in (1, 2, 3, None):
        want = {c: sum(set(c) <= s for s in baskets) for n in range(1, (top or 6) + 1) for c in combinations("abcdef", n)}
        got = {tuple(r["items"]): r["freq"] for r in rules.frequent_itemsets(df, "basket", "item", 0.2, top).collect()}
        assert got == {c: n for c, n in want.items() if n >= 10}


def test_original_price_stands_next_to_the_best(spark):
    best = spark.createDataFrame([(1, 0.05), (2, 0.10)], "client int, rate double")
    before = spark.createDataFrame([(1, 0.06, 0.12, 12.0), (2, 0.07, 0.0, 6.0)], "client int, r double, c double, n double")
    out = rows(pricing.with_original(best, before, ["client"], "r", "c", "n").select("client", "rate", "original_rate", F.round("original_margin", 6)))
    assert out == [(1, 0.05, 0.06, 0.26), (2, 0.1, 0.07, 0.07)]


@pytest.mark.parametrize("name", ["boosted", "boosted_regression"])
def test_boosting_queries_use_the_default_rounds(spark, monkeypatch, name):
    import inspect

    from panelkit.operators import models as operators
    from panelkit.plans import registry

    class Called(Exception):
        pass

    plain = inspect.signature(operators.tree_fit)

    def fit(*args, **named):
        call = plain.bind(*args, **named)
        call.apply_defaults()
        raise Called(call.arguments["rounds"])

    registry.load()
    monkeypatch.setattr(operators, "tree_fit", fit)
    with pytest.raises(Called, match="^100$"):
        registry.QUERIES[name](spark, "/root/testdata/sf0.001")


def test_penalised_fits_share_no_threads(spark, monkeypatch):
    seen = []
    plain = select.CrossValidator
    monkeypatch.setattr(select, "CrossValidator", lambda **options: seen.append(options.get("parallelism", 1)) or plain(**options))
    df = spark.createDataFrame([(float(i), i % 2) for i in range(40)], "a double, y int")
    select.nonzero_coefficients(df, "y", ["a"], grid=[0.0], folds=2)
    assert seen == [1]
