"""Skew joins, ranks, samples and running totals against plain windows."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit import scale
from panelkit.operators import joins as J
from panelkit.operators import rows as R
from panelkit.operators.stats import median, prefix_sum
from tests.conftest import rows


def skewed(spark, n=3000):
    """A third of all rows sit on key 0."""
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("long").alias("k"), "id")


def test_hot_key_is_split_and_the_join_is_whole(spark):
    big = skewed(spark)
    small = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = scale.hot_keys(big, ["k"], rows_per_part=100).collect()
    assert [(r["k"], r["_parts"] > 1) for r in hot] == [(0, True)]
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = scale.skew_join(big, small, ["k"], how, rows_per_part=100)
        assert rows(got.select(sorted(got.columns))) == rows(big.join(small, "k", how).select(sorted(got.columns)))


def test_lookup_join_is_the_same_beyond_the_broadcast_bound(spark):
    big = skewed(spark)
    small = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert scale.small(small) and not scale.small(small, 100)
    assert rows(scale.lookup_join(big, small, ["k"], max_bytes=5)) == rows(scale.lookup_join(big, small, ["k"]))


def test_hot_null_keys_equal_rows_and_maps(spark):
    both = spark.createDataFrame([(None, 1)] * 300 + [(7, 2)] * 300 + [(8, 3)] * 3, "k long, x int")
    alone = both.where("k is null")
    small = spark.createDataFrame([(7, "a"), (9, "b"), (None, "c")], "k long, v string")
    for df in (both, alone, both.withColumn("m", F.create_map(F.lit("a"), F.lit(1)))):
        for how in ("inner", "left", "left_semi", "left_anti"):
            got = scale.skew_join(df, small, ["k"], how, rows_per_part=100)
            cols = sorted(c for c in got.columns if c != "m")
            assert rows(got.select(cols)) == rows(df.join(small, "k", how).select(cols))


def test_written_tables_are_deleted_on_request(spark, tmp_path):
    out = scale.checkpoint(spark.range(3))
    files = out.inputFiles()
    assert files and scale.release(spark) >= 1
    from pathlib import Path
    assert not any(Path(f.removeprefix("file://")).exists() for f in files)


def test_cross_is_whole_beyond_the_bound(spark):
    a, b = spark.range(30).toDF("a"), spark.range(25).toDF("b")
    want = sorted((x, y) for x in range(30) for y in range(25))
    assert sorted(map(tuple, J.cross(a, b).collect())) == want
    assert sorted(map(tuple, J.cross(a, b, max_bytes=60).select("a", "b").collect())) == want


def test_ranks_and_tiles(spark):
    df = skewed(spark).withColumn("x", F.pmod(F.hash("id"), F.lit(97)))
    want = df.withColumn("rank", F.row_number().over(W.orderBy("x", "id"))).select("id", "rank")
    assert rows(scale.global_rank(df, ["x", "id"]).select("id", "rank")) == rows(want)
    inner = df.withColumn("rank", F.row_number().over(W.partitionBy("k").orderBy("x", "id"))).select("k", "id", "rank")
    assert rows(scale.rank_within(df, ["k"], ["x", "id"]).select("k", "id", "rank")) == rows(inner)
    for n in (1, 2, 7, 10, 11):
        part = spark.range(1, n + 1).withColumn("t", scale.tile(F.col("id"), F.lit(n).cast("long"), 4))
        assert rows(part) == rows(spark.range(1, n + 1).withColumn("t", F.ntile(4).over(W.orderBy("id"))))


def test_samples_are_exact_and_stable(spark):
    df = skewed(spark)
    taken = R.stratified_sample(df, "k", {0: 0.25, 1: 1.0}, "id")
    sizes = {r["k"]: r["count"] for r in df.groupBy("k").count().collect()}
    got = {r["k"]: r["count"] for r in taken.groupBy("k").count().collect()}
    assert got == {0: int(0.25 * sizes[0]), 1: sizes[1]}
    assert rows(taken) == rows(R.stratified_sample(df.repartition(7), "k", {0: 0.25, 1: 1.0}, "id"))
    split = R.split_train_test(df, "id", 0.2)
    assert split.count() == 3000 and split.where("is_test = 1").count() == 600
    assert R.cap_sample(df, 77, "id").count() == 77 and R.cap_sample(df, 9999, "id").count() == 3000
    first = df.withColumn("h", R.hash32("id")).orderBy("h", "id").limit(77).select("id")
    assert rows(R.cap_sample(df, 77, "id").select("id")) == rows(first)
    assert R.balanced_fractions(spark.createDataFrame([(1,)] * 2 + [(0,)] * 6, "y int"), "y") == {1: 0.75, 0: 0.25}
    named = df.withColumn("name", F.concat(F.lit("n"), F.col("id").cast("string")))
    assert R.cap_sample(named, 77, "name").count() == 77


def test_running_total_and_median(spark):
    df = spark.range(100).select((F.col("id") * 7 % 100).alias("x"), F.col("id").alias("n"))
    want = df.withColumn("n_upto", F.sum("n").over(W.orderBy("x").rowsBetween(W.unboundedPreceding, 0)))
    assert rows(prefix_sum(df, ["x"], ["n"]).select("x", "n", "n_upto")) == rows(want.select("x", "n", "n_upto"))
    assert median(df, "x") == 49.5
    assert median(spark.createDataFrame([(3.0,), (1.0,), (9.0,), (None,)], "x double"), "x") == 3.0
    assert median(spark.createDataFrame([], "x double"), "x") is None
    assert prefix_sum(spark.createDataFrame([], "x int, n long"), ["x"], ["n"]).count() == 0


def test_checkpoint_writes_a_table(spark):
    out = scale.checkpoint(spark.range(5).select(F.col("id").alias("a b")))
    assert out.count() == 5 and "FileScan" in out._jdf.queryExecution().executedPlan().toString()


def _dealt(df) -> int:
    """Times that rows are dealt out in the plan of ``df``."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_disjoint_validities_are_not_cut_into_cells(spark, monkeypatch):
    from datetime import date

    from panelkit.operators import joins

    monkeypatch.setattr(joins, "day_cells", lambda *_: (_ for _ in ()).throw(AssertionError("cells")))
    dim = spark.createDataFrame([(1, "a", date(2024, 1, 1), date(2024, 1, 31)), (1, "b", date(2024, 2, 1), None)], "k int, v string, f date, t date")
    facts = spark.createDataFrame([(1, date(2024, 1, 31)), (1, date(2024, 2, 1)), (1, date(2023, 1, 1))], "k int, at date")
    out = {(r["at"].isoformat(), r["v"]) for r in joins.interval_join(facts, dim, ["k"], "at", "f", "t", ["v"]).collect()}
    assert out == {("2024-01-31", "a"), ("2024-02-01", "b"), ("2023-01-01", None)}


def test_overlapping_and_repeated_validities_all_match(spark):
    import random
    from datetime import date, timedelta

    from panelkit.operators import joins

    rng, day = random.Random(3), date(2024, 1, 1)
    spans = [(k, i, day + timedelta(a), None if n == 9 else day + timedelta(a + n)) for i in range(120)
             for k, a, n in [(rng.choice([1, 2, None]), rng.randrange(60), rng.choice([-1, 0, 3, 9, 40]))]]
    spans += [(1, -1, day, day), (1, -2, day, day), (1, -3, None, day)]
    facts = [(rng.choice([1, 2, 3, None]), rng.choice([None, day + timedelta(rng.randrange(-3, 120))]), i) for i in range(80)]
    out = joins.interval_join(spark.createDataFrame(facts, "k int, at date, i int"),
                              spark.createDataFrame(spans, "k int, v int, f date, t date"), ["k"], "at", "f", "t", ["v"])
    want = [(k, at, i, v) for k, at, i in facts for v in
            ([v for s, v, f, t in spans if s == k and k and at and f and f <= at and (t is None or at <= t)] or [None])]
    assert sorted(map(str, map(tuple, out.select("k", "at", "i", "v").collect()))) == sorted(map(str, want))


def test_deposit_mart_deals_rows_out_by_contract_and_client_once(spark):
    from panelkit.plans.feature_marts import deposit_mart
    from panelkit.tables import Tables

    assert _dealt(deposit_mart(Tables(spark, "/root/testdata/sf0.001"))) <= 8


def test_look_back_rows_carry_no_window_bounds(spark):
    from panelkit.operators import lookback

    panel = spark.sql("SELECT 1 AS k, DATE '2024-03-31' AS rd")
    assert lookback._bucketed(panel, ["k"], "rd", [lookback.months_back("rd", 3)]).columns == ["k", "rd", "_bucket"]


def test_churn_base_counts_own_and_late_rows_where_a_contract_lies(spark, monkeypatch):
    from panelkit.operators import lookback
    from panelkit.plans.label_marts import churn_base
    from panelkit.tables import Tables

    stop = lambda *_, **__: (_ for _ in ()).throw(AssertionError("dealt out again"))
    monkeypatch.setattr(lookback, "other_rows", stop)
    monkeypatch.setattr(lookback, "history_agg", stop)
    churn_base(Tables(spark, "/root/testdata/sf0.001"))


def test_line_months_and_windows_over_an_order_are_dealt_out_once(spark):
    from panelkit.operators.marts import true_end_date
    from panelkit.plans.label_marts import credit_history
    from panelkit.tables import Tables

    assert _dealt(true_end_date(credit_history(Tables(spark, "/root/testdata/sf0.001")))) <= 2


def test_prices_are_dealt_out_by_offer_once(spark):
    from panelkit.operators import pricing
    from panelkit.plans.market import accept

    offers = spark.sql("SELECT id % 5 AS k, 10.0D AS l_quantity, 0.01D * id AS l_tax FROM range(20)")
    grid = pricing.price_grid(spark).withColumn("weight", F.lit(1.0))
    best = pricing.best_price(offers, grid, ["k"], "l_quantity", accept, ["l_quantity", "l_tax"])
    text = best._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(k#") == 1 and best.select("k").distinct().count() == 5


def test_item_sets_are_written_once(spark, monkeypatch):
    from panelkit.operators import rules

    made = []
    plain = rules.lookup_join
    monkeypatch.setattr(rules, "lookup_join", lambda *a, **k: made.append(1) or plain(*a, **k))
    rules.rules(spark.sql("SELECT id % 7 AS b, CAST(id % 3 AS STRING) AS i FROM range(60)"), "b", "i", 0.1).count()
    assert len(made) == 1


def test_excess_payments_stand_on_one_line_per_contract_and_client(spark):
    from datetime import date as d

    from panelkit.operators import marts as M

    history = spark.createDataFrame(
        [(1, 10, d(2024, 3, 31), -2), (1, 10, d(2024, 6, 30), -2), (2, 10, d(2024, 6, 30), 0), (3, None, d(2024, 6, 30), 4),
         (4, 11, None, 1), (1, 10, d(2024, 3, 31), -2)], "contract long, client long, rd date, instalment int")
    paid = spark.createDataFrame(
        [(10, 1, d(2024, 3, 31), 4.0, 16), (10, 1, d(2024, 1, 15), 2.0, 16), (10, 1, d(2024, 1, 15), 2.0, 16), (10, 1, d(2023, 9, 30), 8.0, 16),
         (10, 2, d(2024, 6, 30), 5.0, 17), (10, 9, d(2024, 1, 1), 7.0, 16), (None, 3, d(2024, 6, 1), 2.0, 16), (11, 4, None, 2.0, 16)],
        "client long, contract long, day date, amount double, kind int")
    out = M.excess_payment_mart(history, paid)
    assert _dealt(out) <= 5 and "FileScan" not in out._jdf.queryExecution().executedPlan().toString()
    want = [(1, d(2024, 3, 31), 10, 2.0, 2, 3.0, 3, 7.0, 3, 1), (1, d(2024, 6, 30), 10, 0.0, 1, 2.0, 2, 3.0, 3, 1),
            (2, d(2024, 6, 30), 10, None, 0, None, 0, None, 3, 1), (3, d(2024, 6, 30), None, 0.0, 1, 0.5, 1, 0.5, None, None),
            (4, None, 11, 0.0, 0, 0.0, 0, 0.0, None, None)]
    assert rows(out) == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_bureau_requests_and_credits_meet_a_report_once(spark):
    from datetime import date as d

    from panelkit.operators import marts as M

    panel = spark.createDataFrame([(1, d(2024, 6, 30), d(2024, 2, 1), 10.0), (1, d(2024, 6, 30), d(2024, 3, 1), 5.0), (2, d(2024, 6, 30), None, 1.0),
                                   (None, d(2024, 6, 30), d(2024, 2, 1), 1.0)], "client long, rd date, start date, balance double")
    reports = spark.createDataFrame([(1, 7, d(2024, 5, 31)), (1, 6, d(2024, 4, 30)), (1, 8, d(2024, 6, 30)), (2, 9, d(2024, 5, 31)), (None, 5, d(2024, 1, 1))],
                                    "client long, report long, created date")
    asked = spark.createDataFrame([(7, d(2024, 6, 1), 1), (7, d(2024, 6, 1), 1), (7, d(2024, 2, 20), 1), (7, d(2024, 6, 2), 2), (6, d(2024, 6, 1), 1),
                                   (9, None, 1), (9, d(2024, 6, 3), 1)], "report long, day date, reason int")
    credit = (d(2024, 1, 1), None, 12, 2, 0, 30, 4.0, 1)
    credits = spark.createDataFrame([(7, *credit), (7, *credit), (9, *credit[:-2], None, 1), (6, *credit)],
                                    "report long, opened date, closed date, months int, credit_type int, own int, dpd int, balance double, relationship int")
    out = M.credit_bureau_mart(panel, reports, asked, credits)
    assert _dealt(out) <= 7 and "FileScan" not in out._jdf.queryExecution().executedPlan().toString()
    got = {tuple(r) for r in out.select("client", "foreign_credits", "foreign_balance", "queries_3m", "queries_1m", "queries_at_application").collect()}
    assert got == {(1, 2, 8.0, 2, 2, 1), (2, 1, None, 1, 1, None)}


def test_best_applications_are_dealt_out_before_they_are_sorted(spark, monkeypatch):
    from datetime import date as d

    from panelkit.operators import marts as M

    apps = spark.createDataFrame([(1, 5, d(2024, 1, 1), None, "Bank", d(1990, 1, 1)), (2, 5, d(2024, 1, 1), 2, "", d(1990, 1, 1))],
                                 "application long, client long, day date, contract long, rejection string, birth date")
    risk = spark.createDataFrame([(1, 1), (2, 3)], "application long, risk int")
    spans = spark.createDataFrame([(5, d(2023, 1, 1), None, "a")], "client long, valid_from date, valid_to date, segment string")
    plans, write = [], M.checkpoint
    monkeypatch.setattr(M, "checkpoint", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or write(df))
    out = M.best_applications(apps, risk, spans, F.lit("2024-06-01").cast("date"))
    assert [(r["application"], r["risk"], r["segment"]) for r in out.collect()] == [(2, 3, "a")]
    # the facts of the interval join are written, and no split is sorted before the rows are dealt out
    assert len(plans) == 1 and plans[0].index("SortAggregate") < plans[0].index("Exchange hashpartitioning(client")
    assert "SortAggregate" not in plans[0][plans[0].index("Exchange hashpartitioning(client"):].split("\n:")[0]


def test_blocks_of_the_model_input_are_joined_once(spark):
    from panelkit.operators import marts as M

    label = spark.createDataFrame([(1, "t", "a"), (2, "t", "a"), (3, "u", "a")], "id int, tag string, rd string")
    block = spark.createDataFrame([(1, 4.0, 1), (1, 2.0, 9)], "id int, age double, n int")
    out = M.model_input(label, {"b": block}, "id", "t", zero=["n"], impute=["age"], by="rd")
    assert _dealt(out) == 0
    assert rows(out.select("id", "age", "n")) == [(1, 2.0, 9), (2, 2.0, 0)]
