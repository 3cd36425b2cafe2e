"""Histograms, fits, group comparisons, choices and checklists on the given tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators import aggregates as A
from panelkit.operators import choice, models, stats, windows
from panelkit.plans.registry import query
from panelkit.plans.views import ORDER_LOG, order_log
from panelkit.tables import Tables

EXT = "e AS (SELECT MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi, COUNT(*) AS n, (MAX(l_extendedprice) - MIN(l_extendedprice)) / {bins} AS w FROM lineitem)"
HIST = """h AS (SELECT CAST(least(floor((l_extendedprice - lo) / w), {bins} - 1) AS INT) AS bin, COUNT(*) AS n FROM lineitem, e GROUP BY 1),
hist AS (SELECT i AS bin, COALESCE(h.n, 0) AS n, e.lo + e.w * (i + 0.5::DOUBLE) AS m, COALESCE(h.n, 0) / (e.n * e.w) AS density FROM e, range({bins}) r(i) LEFT JOIN h ON h.bin = r.i)"""


@query("histogram", f"WITH {EXT.format(bins=50)}, {HIST.format(bins=50)} SELECT CAST(bin AS INT) AS bin, n, round(m, 4) AS midpoint, round(density, 10) AS density FROM hist")
def histogram(t: Tables) -> DataFrame:
    out = stats.histogram(t.lineitem, "l_extendedprice", 50)
    return out.withColumns({"midpoint": F.round("midpoint", 4), "density": F.round("density", 10)})


FAMILIES = {
    "normal": "exp(-pow((m - mean) / sd, 2) / 2) / (sd * sqrt(2 * pi()))",
    "exponential": "CASE WHEN m >= lo THEN exp(-(m - lo) / (mean - lo)) / (mean - lo) ELSE 0 END",
    "uniform": "CASE WHEN m BETWEEN lo AND hi THEN 1 / (hi - lo) ELSE 0 END",
    "laplace": "exp(-abs(m - mid) / mad) / (2 * mad)",
    "logistic": "exp(-abs(m - mean) / (sd * sqrt(3.0) / pi())) / (sd * sqrt(3.0) / pi() * pow(1 + exp(-abs(m - mean) / (sd * sqrt(3.0) / pi())), 2))",
    "gumbel": "exp(-((m - mean + 0.5772156649::DOUBLE * sd * sqrt(6.0) / pi()) / (sd * sqrt(6.0) / pi()) + exp(-(m - mean + 0.5772156649::DOUBLE * sd * sqrt(6.0) / pi()) / (sd * sqrt(6.0) / pi())))) / (sd * sqrt(6.0) / pi())",
    "lognormal": "exp(-pow((ln(m) - lmean) / lsd, 2) / 2) / (m * lsd * sqrt(2 * pi()))",
    "gamma": "exp((mean * mean / (sd * sd) - 1) * ln(m) - m * mean / (sd * sd) - lgamma(mean * mean / (sd * sd)) - mean * mean / (sd * sd) * ln(sd * sd / mean))",
    "rayleigh": "m / (sq / 2) * exp(-m * m / sq)",
    "pareto": "CASE WHEN m >= lo THEN (1 / (lmean - ln(lo))) * pow(lo, 1 / (lmean - ln(lo))) / pow(m, 1 / (lmean - ln(lo)) + 1) ELSE 0 END",
}


@query("fit_distribution", f"""WITH {EXT.format(bins=200)}, {HIST.format(bins=200)},
md AS (SELECT median(l_extendedprice) AS mid FROM lineitem),
s AS (SELECT AVG(l_extendedprice) AS mean, stddev_pop(l_extendedprice) AS sd, MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi, AVG(l_extendedprice * l_extendedprice) AS sq,
  AVG(ln(l_extendedprice)) AS lmean, stddev_pop(ln(l_extendedprice)) AS lsd, AVG(abs(l_extendedprice - mid)) AS mad, MAX(mid) AS mid FROM lineitem, md),
f AS ({" UNION ALL ".join(f"SELECT '{n}' AS family, SUM(pow(density - {x}, 2)) AS sse FROM hist, s" for n, x in FAMILIES.items())})
SELECT family, round(ln(sse), 4) AS log_sse, CAST(row_number() OVER (ORDER BY sse, family) AS INT) AS place FROM f""")
def fit_distribution(t: Tables) -> DataFrame:
    out = stats.fit_distribution(t.lineitem, "l_extendedprice", 200)
    return out.select("family", F.round(F.log("sse"), 4).alias("log_sse"), "place")


@query("zscore", f"""WITH {ORDER_LOG} SELECT contract, round((CAST(price AS DOUBLE) - AVG(CAST(price AS DOUBLE)) OVER w) / NULLIF(stddev_samp(CAST(price AS DOUBLE)) OVER w, 0), 5) AS z
FROM order_log WINDOW w AS (PARTITION BY last_day(day))""")
def zscore(t: Tables) -> DataFrame:
    rows = order_log(t).select("contract", F.col("price").cast("double").alias("price"), F.last_day("day").alias("month"))
    return stats.zscore_by(rows, "price", ["month"]).select("contract", F.round("z", 5).alias("z"))


TRAITS = {"urgent": "o_orderpriority = '1-URGENT'", "dear": "o_totalprice > 200000", "early": "o_orderdate < TIMESTAMP '1998-01-01'",
          "low": "o_orderpriority = '5-LOW'"}
TRAIT_ROWS = f"tr AS (SELECT o_orderstatus, {', '.join(f'CAST({e} AS INT) AS {n}' for n, e in TRAITS.items())} FROM orders)"


def trait_rows(t: Tables) -> DataFrame:
    return t.orders.select("o_orderstatus", *[F.expr(f"CAST({e} AS INT)").alias(n) for n, e in TRAITS.items()])


def _stars(z: str) -> str:
    return f"CASE WHEN abs({z}) >= 2.5758 THEN 3 WHEN abs({z}) >= 1.96 THEN 2 WHEN abs({z}) >= 1.6449 THEN 1 ELSE 0 END"


@query("proportion_compare", f"""WITH {TRAIT_ROWS}, l AS ({' UNION ALL '.join(f"SELECT o_orderstatus AS g, '{n}' AS trait, {n} AS y FROM tr" for n in TRAITS)}),
p AS (SELECT trait, AVG(CASE WHEN g = 'F' THEN y END) AS p1, COUNT(CASE WHEN g = 'F' THEN y END) AS n1, AVG(CASE WHEN g = 'O' THEN y END) AS p2,
  COUNT(CASE WHEN g = 'O' THEN y END) AS n2 FROM l GROUP BY 1), v AS (SELECT *, p1 * (1 - p1) / n1 AS v1, p2 * (1 - p2) / n2 AS v2 FROM p)
SELECT trait, n1, n2, round(100 * p1, 6) AS share1, round(100 * sqrt(v1), 6) AS se1, round(100 * p2, 6) AS share2, round(100 * sqrt(v2), 6) AS se2,
  round(100 * (p1 - p2), 6) AS difference, round(100 * sqrt(v1 + v2), 6) AS difference_se, round((p1 - p2) / NULLIF(sqrt(v1 + v2), 0), 6) AS z,
  {_stars('(p1 - p2) / NULLIF(sqrt(v1 + v2), 0)')} AS stars FROM v""")
def proportion_compare(t: Tables) -> DataFrame:
    out = A.proportion_compare(trait_rows(t), "o_orderstatus", "F", "O", list(TRAITS))
    return out.withColumns({c: F.round(c, 6) for c, k in out.dtypes if k == "double"})


@query("trait_correlation", "WITH " + TRAIT_ROWS + ", c AS (" + " UNION ALL ".join(
    f"SELECT o_orderstatus, '{a}' AS trait_a, '{b}' AS trait_b, corr({a}, {b}) AS phi, COUNT(*) AS n FROM tr GROUP BY 1"
    for a, b in combinations(TRAITS, 2)) + f") SELECT o_orderstatus, trait_a, trait_b, round(phi, 6) AS phi, n, {_stars('phi * sqrt(n)')} AS stars FROM c")
def trait_correlation(t: Tables) -> DataFrame:
    return A.trait_correlation(trait_rows(t), list(TRAITS), "o_orderstatus").withColumn("phi", F.round("phi", 6))


@query("crosstab", """SELECT CASE WHEN grouping(c_mktsegment) = 1 THEN 'Total' ELSE c_mktsegment END AS zone, CASE WHEN grouping(r_name) = 1 THEN 'Total' ELSE r_name END AS region,
  COUNT(DISTINCT c_nationkey) AS clusters, COUNT(DISTINCT c_custkey) AS households FROM customer JOIN nation ON n_nationkey = c_nationkey
JOIN region ON r_regionkey = n_regionkey GROUP BY CUBE (c_mktsegment, r_name)""")
def crosstab(t: Tables) -> DataFrame:
    rows = (t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("c_mktsegment").alias("zone"), F.col("r_name").alias("region"), "c_custkey", "c_nationkey"))
    return A.crosstab_totals(rows, "zone", "region", "c_custkey", "c_nationkey")


#: Utility weights per option (fixed values).
UTILITY = {"small_pack": {"const": 1.2, "p_size": -0.05, "p_retailprice": 0.0001},
           "large_pack": {"const": -0.4, "p_size": 0.04, "p_retailprice": 0.0002},
           "bulk": {"const": -1.5, "p_size": 0.03, "p_retailprice": 0.0015}}


def _utility_sql(w: dict) -> str:
    return " + ".join([f"{w['const']}::DOUBLE"] + [f"{n} * {v}::DOUBLE" for n, v in w.items() if n != "const"])


@query("choose_by_utility", "WITH u AS (" + " UNION ALL ".join(f"SELECT p_partkey, '{n}' AS choice, round({_utility_sql(w)}, 9) AS utility FROM part"
                                                              for n, w in UTILITY.items()) +
       ") SELECT p_partkey, choice, round(utility, 6) AS utility FROM u QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY utility DESC, choice) = 1")
def choose_by_utility(t: Tables) -> DataFrame:
    out = choice.choose_by_utility(t.part.select("p_partkey", "p_size", "p_retailprice"), UTILITY)
    return out.select("p_partkey", "choice", F.round("utility", 6).alias("utility"))


def checks():
    return [("FAIR", "has_language", F.col("lang").isNotNull()), ("FAIR", "has_source", F.col("source").isNotNull()),
            ("Cleaned", "has_text", F.length(F.trim("text")) > 0), ("Cleaned", "long_enough", F.col("n_chars") >= 500),
            ("Labelled", "is_labelled", F.col("quality").isNotNull()), ("Ready", "good_quality", F.col("quality") == 1),
            ("Ready", "not_toxic", F.col("toxic") == 0)]


CHECKS = {"has_language": "lang IS NOT NULL", "has_source": "source IS NOT NULL", "has_text": "length(trim(text)) > 0", "long_enough": "n_chars >= 500",
          "is_labelled": "quality IS NOT NULL", "good_quality": "quality = 1", "not_toxic": "toxic = 0"}


@query("maturity_score", "WITH c AS (SELECT doc_id, " + ", ".join(f"CAST(COALESCE({e}, FALSE) AS INT) AS {n}" for n, e in CHECKS.items()) +
       f""" FROM documents d LEFT JOIN (SELECT doc_id AS k, MAX(quality) AS quality, MAX(toxic) AS toxic FROM labels GROUP BY 1) l ON l.k = d.doc_id)
SELECT doc_id, round(({' + '.join(CHECKS)}) / {len(CHECKS)}, 9) AS score,
  CASE {' '.join(f"WHEN {n} = 0 THEN '{n}'" for n in CHECKS)} ELSE 'none' END AS first_failed,
  CASE WHEN {' * '.join(CHECKS)} = 1 THEN 'Ready' WHEN {' * '.join(list(CHECKS)[:5])} = 1 THEN 'Labelled' WHEN {' * '.join(list(CHECKS)[:4])} = 1 THEN 'Cleaned'
    WHEN has_language * has_source = 1 THEN 'FAIR' ELSE 'none' END AS stage FROM c""")
def maturity_score(t: Tables) -> DataFrame:
    marks = t.labels.groupBy("doc_id").agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    catalog = t.documents.join(marks, "doc_id", "left")
    return choice.maturity_score(catalog, checks(), "doc_id").withColumn("score", F.round("score", 9))


@query("smooth_2d", """WITH h AS (SELECT l_discount AS x, l_tax AS y, COUNT(*)::DOUBLE AS n FROM lineitem GROUP BY 1, 2),
p AS (SELECT *, AVG(n) OVER (PARTITION BY x ORDER BY y ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS a FROM h)
SELECT x, y, CAST(n AS BIGINT) AS n, round(AVG(a) OVER (PARTITION BY y ORDER BY x ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS smooth FROM p""")
def smooth_2d(t: Tables) -> DataFrame:
    hist = t.lineitem.groupBy(F.col("l_discount").alias("x"), F.col("l_tax").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    return windows.smooth_2d(hist, "x", "y", "n", 2).withColumn("smooth", F.round("smooth", 6))


@query("ols", """SELECT l_returnflag, round(regr_slope(l_extendedprice, l_quantity), 4) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
  round(regr_r2(l_extendedprice, l_quantity), 6) AS r2, COUNT(*) AS n FROM lineitem GROUP BY 1""")
def ols(t: Tables) -> DataFrame:
    out = models.ols(t.lineitem, "l_extendedprice", "l_quantity", ["l_returnflag"])
    return out.withColumns({"slope": F.round("slope", 4), "intercept": F.round("intercept", 4), "r2": F.round("r2", 6)})


@query("knn_vote", """WITH d AS (SELECT a.vec_id, b.vec_id AS other, b.label, round(list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS dist
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY dist, b.vec_id) <= 5),
v AS (SELECT vec_id, label, COUNT(*) AS votes FROM d GROUP BY 1, 2)
SELECT vec_id, label AS vote, votes FROM v QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY votes DESC, label) = 1""")
def knn_vote(t: Tables) -> DataFrame:
    return models.knn_vote(t.embeddings, t.embeddings, "vec_id", "embedding", "label", 5)
