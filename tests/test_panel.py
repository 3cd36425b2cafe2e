"""Look-back, interval, as-of and window operators on hand-made frames."""

from datetime import date as D

from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators import aggregates as A
from panelkit.operators import joins as J
from panelkit.operators import lookback as L
from panelkit.operators import marts as M
from panelkit.operators import sets, windows
from tests.conftest import rows

LOG = "client int, day date, reason int, thread int, amount double"


def panel(spark):
    return spark.createDataFrame([(1, D(2024, 3, 31)), (1, D(2024, 2, 29)), (2, D(2024, 3, 31)), (1, D(2024, 3, 31))],
                                 "client int, rd date")


def log(spark):
    return spark.createDataFrame([
        (1, D(2023, 12, 31), 5, 1, 1.0), (1, D(2024, 1, 1), 5, 1, 2.0), (1, D(2024, 3, 31), 8, 2, None), (1, D(2024, 4, 1), 5, 3, 4.0),
        (None, D(2024, 3, 1), 5, 4, 9.0), (1, None, 5, 5, 9.0), (1, D(2024, 2, 29), 5, 1, 8.0)], LOG)


def test_window_ends_nulls_and_repeated_panel_rows(spark):
    out = L.lookback_agg(panel(spark), log(spark), ["client"], "rd", "day",
                         {"_c": L.months_back("rd", 3), "_o": L.open_window(F.add_months("rd", -3), "rd")},
                         {"n": L.count(), "s": L.total("amount")})
    assert rows(out) == sorted([
        (1, D(2024, 2, 29), 3, 11.0, 3, 11.0), (1, D(2024, 3, 31), 4, 11.0, 3, 10.0), (1, D(2024, 3, 31), 4, 11.0, 3, 10.0),
        (2, D(2024, 3, 31), 0, 0.0, 0, 0.0)], key=str)


def test_history_is_strict_or_not(spark):
    one = {"n": L.count(), "first": L.lowest("day"), "m": L.mean("amount")}
    loose = L.history_agg(panel(spark).distinct(), log(spark), ["client"], "rd", "day", one)
    strict = L.history_agg(panel(spark).distinct(), log(spark), ["client"], "rd", "day", one, strict=True)
    assert rows(loose) == [(1, D(2024, 2, 29), 3, D(2023, 12, 31), 11 / 3), (1, D(2024, 3, 31), 4, D(2023, 12, 31), 11 / 3),
                           (2, D(2024, 3, 31), 0, None, None)]
    assert [r[2] for r in rows(strict)] == [2, 3, 0]


def test_empty_log_keeps_the_panel(spark):
    none = spark.createDataFrame([], LOG)
    out = L.lookback_agg(panel(spark), none, ["client"], "rd", "day", {"": L.days_back("rd", 30)}, {"n": L.count()})
    assert {r["n"] for r in out.collect()} == {0} and out.count() == 4
    assert L.asof_latest(panel(spark), none, ["client"], "rd", "day", ["thread"], ["thread"]).where("thread is null").count() == 4


def test_threads_are_counted_once(spark):
    out = M.complaints_mart(panel(spark).distinct(), log(spark).withColumn("result", F.lit(4)))
    got = {(r["client"], r["rd"]): (r["query_threads"], r["complaint_threads"], r["pending_threads"]) for r in out.collect()}
    assert got == {(1, D(2024, 2, 29)): (1, 0, 1), (1, D(2024, 3, 31)): (1, 1, 2), (2, D(2024, 3, 31)): (0, 0, 0)}


def test_asof_takes_the_latest_earlier_row(spark):
    out = L.asof_latest(panel(spark).distinct(), log(spark), ["client"], "rd", "day", ["thread", "amount"], ["thread"])
    assert rows(out) == [(1, D(2024, 2, 29), 1, 2.0), (1, D(2024, 3, 31), 1, 8.0), (2, D(2024, 3, 31), None, None)]


def test_intervals_with_gap_touch_and_open_end(spark):
    dim = spark.createDataFrame([(1, "a", D(2024, 1, 1), D(2024, 1, 31)), (1, "b", D(2024, 3, 1), D(2024, 3, 31)),
                                 (1, "c", D(2024, 3, 31), None)], "client int, attr string, valid_from date, valid_to date")
    facts = spark.createDataFrame([(1, D(2024, 1, 31)), (1, D(2024, 2, 15)), (1, D(2024, 3, 31)), (1, D(2030, 1, 1)), (2, D(2024, 1, 1)),
                                   (1, None)], "client int, at date")
    out = J.interval_join(facts, dim, ["client"], "at", "valid_from", "valid_to", ["attr"])
    assert rows(out) == [(1, D(2024, 1, 31), "a"), (1, D(2024, 2, 15), None), (1, D(2024, 3, 31), "b"), (1, D(2024, 3, 31), "c"),
                         (1, D(2030, 1, 1), "c"), (1, None, None), (2, D(2024, 1, 1), None)]


def test_other_rows_without_pairs(spark):
    data = spark.createDataFrame([(1, 10, D(2024, 1, 31)), (1, 10, D(2024, 2, 29)), (1, 11, D(2024, 2, 29)), (1, 12, D(2024, 1, 15))],
                                 "client int, contract int, rd date")
    out = L.other_rows(data, data.withColumn("_d", F.col("rd")), ["client"], "contract", "rd", "_d", L.month_distance("rd", 1, 3))
    assert rows(out.select("contract", "rd", "others")) == [(10, D(2024, 1, 31), 0), (10, D(2024, 2, 29), 1), (11, D(2024, 2, 29), 2),
                                                             (12, D(2024, 1, 15), 0)]


def test_next_period_needs_the_very_next(spark):
    states = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 4, "a"), (2, 1, "a")], "client int, period int, state string")
    assert rows(J.next_period(states, ["client"], "period", ["state"])) == [(1, 1, "a", "b")]


def test_best_rows_and_partners(spark):
    df = spark.createDataFrame([(1, "x", 5.0, 1), (1, "y", 5.0, 2), (1, "y", 1.0, 3), (1, None, 99.0, 4), (2, "z", 0.0, 5)],
                               "k int, bank string, amount double, id int")
    assert rows(windows.main_partner(df, ["k"], "bank", "amount")) == [(1, "y", "y"), (2, "z", "z")]
    assert rows(windows.max_rows(df.where("bank is not null"), ["k"], "amount").select("k", "id")) == [(1, 1), (1, 2), (2, 5)]
    assert rows(windows.latest_row(df, ["k"], "amount", ["id"]).select("k", "id")) == [(1, 4), (2, 5)]


def test_frames(spark):
    df = spark.createDataFrame([(1, i, v) for i, v in enumerate([1, 5, 2, 9], 1)], "k int, t int, v int")
    out = windows.moving(df, "v", ["k"], ["t"], -3, -1, "max", "past")
    out = windows.lag_of(windows.lead_label(out, "v", ["k"], ["t"], [2]), "v", ["k"], ["t"], "before", 0)
    assert rows(out.select("t", "past", "v_in_2", "before")) == [(1, None, 2, 0), (2, 1, 9, 1), (3, 5, None, 5), (4, 5, None, 2)]


def test_true_end_date(spark):
    h = spark.createDataFrame([(1, D(2024, 1, 31), D(2025, 1, 1), -100.0), (1, D(2024, 2, 29), D(2025, 1, 1), -5.0), (1, D(2024, 3, 31), D(2025, 1, 1), -4.0),
                               (2, D(2024, 1, 31), D(2025, 1, 1), 0.0), (2, D(2024, 2, 29), D(2025, 1, 1), -5.0)], "contract int, rd date, planned_end date, balance double")
    assert rows(M.true_end_date(h)) == [(1, D(2024, 2, 29), 1), (2, D(2024, 2, 29), 0)]


def test_scalars(spark):
    one = spark.createDataFrame([(D(2024, 2, 29), "the Cat's 2 cats", 13, 0.0)], "d date, t string, m int, z double")
    r = one.select(S.month_window_start("d", 3).alias("a"), S.words("t", ["the"]).alias("w"), S.tenor_band("m").alias("b"), S.ratio("m", "z").alias("r"),
                   S.months_diff(F.lit("2024-04-30").cast("date"), "d").alias("n"), S.period_label("d").alias("p"), S.list_mean("m", "z", F.lit(None)).alias("l"),
                   S.extract("t", "(x+)").alias("e"), S.margin(F.lit(0.1), F.lit(0.06), F.lit(12)).alias("g")).first()
    assert tuple(r)[:8] == (D(2023, 11, 30), ["cat", "s", "cats"], 12, None, 2, "2024_1", 6.5, None)
    assert abs(r["g"] - 0.2) < 1e-12
    try:
        S.zscore("m", 0.0, 0.0)
        raise AssertionError("a zero deviation must be rejected")
    except ValueError:
        pass


def test_published_share_and_error(spark):
    men = [(1, 1 if i < 799 else 0) for i in range(984)]
    women = [(2, 1 if i < 800 else 0) for i in range(1000)]
    out = A.proportion_compare(spark.createDataFrame(men + women, "sex int, yes int"), "sex", 1, 2, ["yes"]).first()
    assert round(out["share1"], 1) == 81.2 and abs(out["se1"] - 1.25) < 0.01
    assert abs((1.25 ** 2 + 1.20 ** 2) ** 0.5 - 1.73) < 0.005 and abs(out["difference_se"] - (out["se1"] ** 2 + out["se2"] ** 2) ** 0.5) < 1e-9


def test_set_operations(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "n int"), spark.createDataFrame([(2,), (3,)], "n int")
    assert rows(sets.union_all(a, b)) == [(1,), (1,), (2,), (2,), (3,)] and rows(sets.union_distinct(a, b)) == [(1,), (2,), (3,)]
    assert rows(sets.except_rows(a, b)) == [(1,)] and rows(sets.add_rows(b, [(9,)])) == [(2,), (3,), (9,)]


def test_limits_are_capped_at_two_plus_now(spark):
    acc = spark.createDataFrame([(1, D(2024, m, 28), 10 * (m > 3), 0, 1) for m in range(1, 6)], "contract int, rd date, current_limit int, initial_limit int, limit_reached int")
    dep = spark.createDataFrame([(1, D(2024, 5, 28), 7)], "contract int, rd date, client int")
    out = {r["rd"].month: r for r in M.limits_mart(acc, dep).collect()}
    assert [out[m]["limit_reached_3m"] for m in range(1, 6)] == [1, 2, 3, 3, 3] and out[5]["limit_changed_3m"] == 1
    assert out[5]["client"] == 7 and out[1]["client"] is None and out[1]["initial_equals_current"] == 1


def test_limits_read_their_own_rows_without_a_join(spark):
    import random
    from datetime import timedelta

    rng = random.Random(7)
    days = [D(2023, 11, 28) + timedelta(n) for n in range(190)]
    some = lambda *xs: rng.choice(xs)
    acc = [(some(1, 2, 3, None), some(None, *days), some(0, 1, 1, None), some(5, 5, 7, None)) for _ in range(400)]
    df = spark.createDataFrame(acc, "contract int, rd date, reached int, size int")
    out = A.limits_features(df, ["contract"], "rd", "size", "reached")
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()

    def back(d):
        y, m = (d.year, d.month - 3) if d.month > 3 else (d.year - 1, d.month + 9)
        last = (D(y + m // 12, m % 12 + 1, 1) - timedelta(1)).day
        return D(y, m, min(d.day, last))

    def want(c, d, r, s):
        near = [x for x in acc if x[0] == c and x[1] and back(d) <= x[1] <= d] if c and d else []
        hits = sum(x[2] or 0 for x in near)
        sizes = [x[3] for x in near if x[3] is not None]
        over = None if r is None else 2 + r
        return c, d, r, s, over if hits > 2 else hits, int(max(sizes) != min(sizes)) if sizes else None

    text = lambda rs: sorted(map(str, rs))
    assert text(map(tuple, out.collect())) == text(want(*x) for x in acc)
