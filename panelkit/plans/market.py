"""Price search and basket rules on the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators import pricing as P
from panelkit.operators import rules as R
from panelkit.operators.stats import kde
from panelkit.plans.registry import query
from panelkit.scale import checkpoint, lookup_join, scratch
from panelkit.sources.writers import export_rules
from panelkit.tables import Tables

BANDWIDTH = 0.02
#: Weights of the acceptance model (fixed values).
INTERCEPT, W_RATE, W_COMMISSION, W_QUANTITY, W_TAX = 1.0, -30.0, -8.0, 0.02, 4.0

GRID = """rates AS (SELECT round(0.05::DOUBLE + i * 0.005::DOUBLE, 3) AS rate FROM range(11) t(i)),
comms AS (SELECT round(0.0::DOUBLE + i * 0.005::DOUBLE, 3) AS commission FROM range(41) t(i))"""
DENSITY = f"""taxes AS (SELECT l_tax AS x, COUNT(*) AS n FROM lineitem GROUP BY 1), discounts AS (SELECT l_discount AS x, COUNT(*) AS n FROM lineitem GROUP BY 1),
kr AS (SELECT rate, SUM(n * exp(-pow((rate - x) / {BANDWIDTH}::DOUBLE, 2) / 2) / ({BANDWIDTH}::DOUBLE * sqrt(2 * pi()))) / SUM(n) AS d FROM rates, taxes GROUP BY 1),
kc AS (SELECT commission, SUM(n * exp(-pow((commission - x) / {BANDWIDTH}::DOUBLE, 2) / 2) / ({BANDWIDTH}::DOUBLE * sqrt(2 * pi()))) / SUM(n) AS d FROM comms, discounts GROUP BY 1)"""


@query("price_grid", """WITH e AS (SELECT MIN(l_tax) AS lo, MAX(l_tax) AS hi, MIN(l_discount) AS clo, MAX(l_discount) AS chi FROM lineitem),
rates AS (SELECT round(lo + i * 0.005::DOUBLE, 3) AS rate FROM e, range(1000) t(i) WHERE i <= round((hi - lo) / 0.005::DOUBLE)),
comms AS (SELECT round(clo + i * 0.005::DOUBLE, 3) AS commission FROM e, range(1000) t(i) WHERE i <= round((chi - clo) / 0.005::DOUBLE))
SELECT rate, commission FROM rates, comms""")
def price_grid(t: Tables) -> DataFrame:
    """The grid between the lowest and the highest rate and commission that were sold."""
    e = t.lineitem.agg(F.min("l_tax"), F.max("l_tax"), F.min("l_discount"), F.max("l_discount")).first()
    return P.price_grid(t.spark, (e[0], e[1]), (e[2], e[3]))


def densities(t: Tables) -> tuple[DataFrame, DataFrame]:
    rates = P.axis(t.spark, *P.RATE, P.STEP, "rate")
    commissions = P.axis(t.spark, *P.COMMISSION, P.STEP, "commission")
    return kde(t.lineitem, "l_tax", rates, "rate", BANDWIDTH), kde(t.lineitem, "l_discount", commissions, "commission", BANDWIDTH)


@query("kde", f"WITH {GRID}, {DENSITY} SELECT rate AS point, round(d, 6) AS density FROM kr UNION ALL SELECT commission, round(d, 6) FROM kc")
def kde_query(t: Tables) -> DataFrame:
    r, c = densities(t)
    return r.select(F.col("rate").alias("point"), F.round("density", 6).alias("density")).unionAll(
        c.select("commission", F.round("density", 6)))


@query("score_grid", f"""WITH {GRID} SELECT s_suppkey, rate, commission, round(1 / (1 + exp(-(0.5::DOUBLE + s_nationkey * 0.01::DOUBLE + rate * -20 + commission * -5))), 6) AS probability
FROM supplier, rates, comms""")
def score_grid(t: Tables) -> DataFrame:
    score = P.logistic_score({"s_nationkey": 0.01, "rate": -20.0, "commission": -5.0}, 0.5)
    out = P.score_grid(t.supplier.select("s_suppkey", "s_nationkey"), P.price_grid(t.spark), score)
    return out.select("s_suppkey", "rate", "commission", F.round("probability", 6).alias("probability"))


def accept(rate: Column, commission: Column) -> Column:
    linear = (F.lit(INTERCEPT) + rate * W_RATE + commission * W_COMMISSION + F.col("l_quantity") * W_QUANTITY
              + F.col("l_tax") * W_TAX)
    return 1 / (1 + F.exp(-linear))


PRICED = """combos AS (SELECT DISTINCT l_quantity, l_tax FROM lineitem),
priced AS (SELECT c.*, scenario, rate, commission, rate + commission / 0.6::DOUBLE / l_quantity * 12 AS margin,
  1 / (1 + exp(-(1.0::DOUBLE + rate * -30 + commission * -8 + l_quantity * 0.02::DOUBLE + l_tax * 4))) AS probability, weight, lo, hi FROM combos c, grid),
profits AS (SELECT *, round(probability * margin * weight, 9) AS profit FROM priced WHERE margin BETWEEN lo AND hi),
combo_best AS (SELECT * FROM profits QUALIFY profit = MAX(profit) OVER (PARTITION BY scenario, l_quantity, l_tax)),
offers AS (SELECT DISTINCT l_orderkey, l_partkey, l_quantity, l_tax FROM lineitem),
top AS (SELECT o.l_orderkey, o.l_partkey, b.scenario, MAX(b.profit) AS profit FROM offers o JOIN combo_best b USING (l_quantity, l_tax) GROUP BY 1, 2, 3),
won AS (SELECT DISTINCT o.l_orderkey, o.l_partkey, b.scenario, b.rate, b.commission, b.margin, b.probability, b.profit
  FROM offers o JOIN combo_best b USING (l_quantity, l_tax) JOIN top ON top.l_orderkey = o.l_orderkey AND top.l_partkey = o.l_partkey
  AND top.scenario = b.scenario AND top.profit = b.profit)"""
ROUNDED = "rate, commission, round(margin, 6) AS margin, round(probability, 6) AS probability, round(profit, 6) AS profit"


def offers(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_tax")


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in ("margin", "probability", "profit")})


@query("best_price", f"""WITH {GRID}, {DENSITY}, grid AS (SELECT 'base' AS scenario, rate, commission, kr.d * kc.d AS weight, 0.075::DOUBLE AS lo, 20::DOUBLE AS hi FROM kr, kc),
{PRICED}, before AS (SELECT l_orderkey, l_partkey, l_quantity, l_tax AS original_rate, l_discount AS original_commission FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey ORDER BY l_quantity, l_tax, l_discount) = 1)
SELECT l_orderkey, l_partkey, {ROUNDED}, original_rate, original_commission,
  round(original_rate + original_commission / 0.6::DOUBLE / l_quantity * 12, 6) AS original_margin FROM won JOIN before USING (l_orderkey, l_partkey)""")
def best_price(t: Tables) -> DataFrame:
    r, c = densities(t)
    keys = ["l_orderkey", "l_partkey"]
    grid = P.weighted_grid(P.price_grid(t.spark), r, c)
    best = rounded(P.best_price(offers(t), grid, keys, "l_quantity", accept, ["l_quantity", "l_tax"]))
    first = t.lineitem.groupBy(*keys).agg(F.min(F.struct("l_quantity", "l_tax", "l_discount")).alias("_f")).select(*keys, "_f.*")
    out = P.with_original(best, first, keys, "l_tax", "l_discount", "l_quantity")
    return out.withColumn("original_margin", F.round("original_margin", 6))


#: Bounds of the scenarios (fixed values).
SCENARIOS = [{"name": "low", "rate": (0.05, 0.07), "commission": (0.0, 0.10), "step": 0.005, "margin": (0.075, 20)},
             {"name": "high", "rate": (0.06, 0.10), "commission": (0.05, 0.20), "step": 0.005, "margin": (0.1, 5)}]


@query("price_scenarios", f"""WITH {GRID}, {DENSITY}, grid AS (
  SELECT 'low' AS scenario, rate, commission, kr.d * kc.d AS weight, 0.075::DOUBLE AS lo, 20::DOUBLE AS hi FROM kr, kc WHERE rate <= 0.0701 AND commission <= 0.1001
  UNION ALL SELECT 'high', rate, commission, kr.d * kc.d, 0.1::DOUBLE, 5::DOUBLE FROM kr, kc WHERE rate >= 0.0599 AND commission >= 0.0499),
{PRICED} SELECT l_orderkey, l_partkey, scenario, {ROUNDED} FROM won""")
def price_scenarios(t: Tables) -> DataFrame:
    r, c = densities(t)
    grid = P.weighted_grid(P.scenario_grid(t.spark, SCENARIOS), r, c)
    best = checkpoint(P.best_price(offers(t), grid, ["l_orderkey", "l_partkey"], "l_quantity", accept, ["l_quantity", "l_tax"]))
    path = scratch(t.spark, "scenarios")
    P.write_scenarios(best, path)
    P.write_scenarios(best.where("scenario = 'high'"), path)  # one scenario again: the other stays
    return rounded(P.read_scenarios(t.spark, path))


def baskets(t: Tables) -> DataFrame:
    """Brands per order."""
    parts = t.part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("item"))
    lines = t.lineitem.select("l_partkey", F.col("l_orderkey").alias("basket")).distinct()
    return lookup_join(lines, parts, ["l_partkey"], "inner").select("basket", "item")


SUPPORT = 0.02
BASKETS = """b AS (SELECT DISTINCT l_orderkey AS basket, p_brand AS item FROM lineitem JOIN part ON p_partkey = l_partkey),
total AS (SELECT COUNT(DISTINCT basket) AS n FROM b), one AS (SELECT item, COUNT(*) AS n FROM b GROUP BY 1),
two AS (SELECT x.item AS a, y.item AS b, COUNT(*) AS n FROM b x JOIN b y ON x.basket = y.basket AND x.item <> y.item GROUP BY 1, 2)"""


@query("pair_rules", f"""WITH {BASKETS} SELECT two.a AS item_a, two.b AS item_b, two.n AS together, round(two.n / total.n, 9) AS support,
  round(two.n / oa.n, 9) AS confidence, round(two.n * total.n / (oa.n * ob.n), 9) AS lift
FROM two, total, one oa, one ob WHERE oa.item = two.a AND ob.item = two.b AND two.n / total.n >= {SUPPORT}""")
def pair_rules(t: Tables) -> DataFrame:
    out = R.pair_rules(baskets(t), "basket", "item", SUPPORT)
    return out.withColumns({c: F.round(c, 9) for c in ("support", "confidence", "lift")})


@query("frequent_itemsets", f"""WITH {BASKETS} SELECT item AS items, one.n AS freq FROM one, total WHERE one.n / total.n >= {SUPPORT}
UNION ALL SELECT a || '|' || b, two.n FROM two, total WHERE a < b AND two.n / total.n >= {SUPPORT}""")
def frequent_itemsets(t: Tables) -> DataFrame:
    out = R.frequent_itemsets(baskets(t), "basket", "item", SUPPORT, max_length=2)
    return out.select(F.concat_ws("|", "items").alias("items"), "freq")


@query("short_rules", f"""WITH {BASKETS} SELECT a AS items_base, b AS items_add, round(two.n / total.n, 9) AS support, round(two.n / oa.n, 9) AS confidence,
  round(two.n / oa.n / (ob.n / total.n), 6) AS lift FROM two, total, one oa, one ob WHERE oa.item = two.a AND ob.item = two.b
  AND two.n / total.n >= {SUPPORT} AND two.n / oa.n >= 0.1
UNION ALL SELECT '', item, round(one.n / total.n, 9), round(one.n / total.n, 9), 1.0 FROM one, total WHERE one.n / total.n >= 0.1""")
def short_rules(t: Tables) -> DataFrame:
    out = R.rules(baskets(t), "basket", "item", SUPPORT, 0.1, max_length=2)
    return out.select(F.concat_ws("|", "items_base").alias("items_base"), F.concat_ws("|", "items_add").alias("items_add"),
                      F.round("support", 9).alias("support"), F.round("confidence", 9).alias("confidence"), F.round("lift", 6).alias("lift"))


#: All sets of a basket's brands, by the bits of a number; a rule leaves out one of its items.
RULES = """b AS (SELECT l_orderkey AS basket, list_sort(list_distinct(list(p_brand))) AS items FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
total AS (SELECT COUNT(*) AS n FROM b), m AS (SELECT items, unnest(range(1, 1 << len(items))) AS bits FROM b),
f AS (SELECT list_filter(items, lambda x, i: (bits >> (i - 1)) & 1 = 1) AS s, COUNT(*) AS n FROM m GROUP BY 1),
big AS (SELECT s, f.n FROM f, total WHERE f.n >= 0.001 * total.n),
r AS (SELECT list_filter(s, lambda x: x <> y) AS base, y AS added, n FROM (SELECT *, unnest(s) AS y FROM big WHERE len(s) > 1))"""


@query("itemset_rules", f"""WITH {RULES}
SELECT array_to_string(base, '|') AS items_base, added AS items_add, round(r.n / total.n, 9) AS support, round(r.n / p.n, 9) AS confidence,
  round(r.n / p.n / (q.n / total.n), 6) AS lift FROM r JOIN big p ON p.s = base JOIN big q ON q.s = [added], total WHERE r.n / p.n >= 0.05
UNION ALL SELECT '', s[1], round(big.n / total.n, 9), round(big.n / total.n, 9), 1.0 FROM big, total WHERE len(s) = 1 AND big.n / total.n >= 0.05""")
def itemset_rules(t: Tables) -> DataFrame:
    out = R.rules(baskets(t), "basket", "item", 0.001, 0.05)
    return out.select(F.array_join(F.sort_array("items_base"), "|").alias("items_base"), F.concat_ws("|", "items_add").alias("items_add"),
                      F.round("support", 9).alias("support"), F.round("confidence", 9).alias("confidence"), F.round("lift", 6).alias("lift"))


@query("exported_rules", f"""WITH {BASKETS} SELECT a AS item_a, b AS item_b, round(two.n / total.n, 8) AS support, round(two.n / oa.n, 8) AS confidence,
  round(two.n / oa.n / (ob.n / total.n), 8) AS lift FROM two, total, one oa, one ob WHERE oa.item = two.a AND ob.item = two.b
  AND two.n / total.n >= {SUPPORT} AND two.n / oa.n >= 0.1""")
def exported_rules(t: Tables) -> DataFrame:
    """Rules of two items, exported as tab separated text and read back."""
    path = scratch(t.spark, "rules")
    export_rules(R.rules(baskets(t), "basket", "item", SUPPORT, 0.1, max_length=2), path, "tsv")
    cells = F.split("value", "\t")
    return t.spark.read.text(path).select(
        cells[0].alias("item_a"), cells[1].alias("item_b"), cells[2].cast("double").alias("support"),
        cells[3].cast("double").alias("confidence"), cells[4].cast("double").alias("lift"))
