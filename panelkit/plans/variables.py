"""Encodings, selection and scores on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import vectors as V
from panelkit.operators import encode as E
from panelkit.operators import quantiles
from panelkit.operators import select as X
from panelkit.operators.scores import confusion_matrix, gini
from panelkit.plans.registry import query
from panelkit.tables import Tables

RETURNS = """ret AS (SELECT CAST(l_returnflag = 'R' AS INT) AS target, p_brand, p_type FROM lineitem JOIN part ON p_partkey = l_partkey)"""


def returns(t: Tables) -> DataFrame:
    """Returned and kept line counts per part, with its brand and type; a returned line is the target."""
    counts = t.lineitem.groupBy("l_partkey", (F.col("l_returnflag") == "R").cast("int").alias("target")).agg(
        F.count(F.lit(1)).alias("lines"))
    return counts.join(t.part.select(F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type"), "l_partkey")


@query("woe_iv", f"""WITH {RETURNS}, n AS (SELECT SUM(target) AS n1, COUNT(*) - SUM(target) AS n0 FROM ret),
c AS (SELECT 'p_brand' AS "column", p_brand AS value, SUM(target)::BIGINT AS n1, (COUNT(*) - SUM(target))::BIGINT AS n0 FROM ret GROUP BY 2
  UNION ALL SELECT 'p_type', p_type, SUM(target)::BIGINT, (COUNT(*) - SUM(target))::BIGINT FROM ret GROUP BY 2)
SELECT "column", value, c.n1, c.n0, round(ln(greatest(c.n1, 1) / greatest(c.n0, 1)) + ln(n.n0 / n.n1), 6) AS woe,
  round((c.n1 / n.n1 - c.n0 / n.n0) * (ln(greatest(c.n1, 1) / greatest(c.n0, 1)) + ln(n.n0 / n.n1)), 9) AS iv FROM c, n""")
def woe_iv(t: Tables) -> DataFrame:
    fitted = E.woe_fit(returns(t), "target", ["p_brand", "p_type"], weight="lines")
    return fitted.withColumns({"woe": F.round("woe", 6), "iv": F.round("iv", 9)})


@query("woe_encode", f"""WITH {RETURNS}, n AS (SELECT SUM(target) AS n1, COUNT(*) - SUM(target) AS n0 FROM ret),
w AS (SELECT p_type, ln(greatest(SUM(target), 1) / greatest(COUNT(*) - SUM(target), 1)) + ln((SELECT n0 / n1 FROM n)) AS woe FROM ret GROUP BY 1)
SELECT p_partkey, round(w.woe, 6) AS p_type_woe FROM part LEFT JOIN w ON w.p_type = part.p_type""")
def woe_encode(t: Tables) -> DataFrame:
    fitted = E.woe_fit(returns(t), "target", ["p_type"], weight="lines")
    out = E.woe_encode(t.part.select("p_partkey", "p_type"), fitted, ["p_type"])
    return out.select("p_partkey", F.round("p_type_woe", 6).alias("p_type_woe"))


@query("quantile_cells", """WITH r AS (SELECT c_custkey, ntile(15) OVER (ORDER BY c_acctbal, c_custkey) AS a, ntile(5) OVER (ORDER BY c_nationkey, c_custkey) AS b FROM customer)
SELECT c_custkey, CAST(a - 1 + 15 * (b - 1) AS INT) AS cell FROM r""")
def quantile_cells(t: Tables) -> DataFrame:
    return E.quantile_bins(t.customer.select("c_custkey", "c_acctbal", "c_nationkey"), "c_acctbal", "c_nationkey",
                           ["c_custkey"]).select("c_custkey", "cell")


@query("quantile_label", "SELECT o_orderkey, ntile(7) OVER (ORDER BY o_totalprice, o_orderkey) AS label FROM orders")
def quantile_label(t: Tables) -> DataFrame:
    return quantiles.quantile_label(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"], 7,
                                  "label").select("o_orderkey", "label")


@query("scale", """SELECT p_partkey, round((p_size - (SELECT AVG(p_size) FROM part)) / (SELECT stddev_pop(p_size) FROM part), 6) AS p_size_scaled,
  round((p_retailprice - (SELECT AVG(p_retailprice) FROM part)) / (SELECT stddev_pop(p_retailprice) FROM part), 6) AS p_retailprice_scaled FROM part""")
def scale(t: Tables) -> DataFrame:
    out = E.standard_scale(t.part.select("p_partkey", "p_size", "p_retailprice"), ["p_size", "p_retailprice"])
    return out.select("p_partkey", *[F.round(f"{c}_scaled", 6).alias(f"{c}_scaled") for c in ("p_size", "p_retailprice")])


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query("one_hot", "SELECT p_partkey, " + ", ".join(f"CAST(p_type = '{v}' AS INT) AS \"p_type_{v}\"" for v in TYPES[1:]) + " FROM part")
def one_hot(t: Tables) -> DataFrame:
    return E.dummy_columns(t.part.select("p_partkey", "p_type"), "p_type", TYPES).drop("p_type")


@query("string_index", """WITH c AS (SELECT p_type, COUNT(*) AS n FROM part GROUP BY 1),
r AS (SELECT p_type, row_number() OVER (ORDER BY n DESC, p_type) - 1 AS i FROM c)
SELECT p_partkey, CAST(r.i AS DOUBLE) AS p_type_index FROM part JOIN r ON r.p_type = part.p_type""")
def string_index(t: Tables) -> DataFrame:
    return E.string_index(t.part.select("p_partkey", "p_type"), ["p_type"]).select("p_partkey", "p_type_index")


#: Words left out of counts (fixed values).
STOP_WORDS = ["the", "and", "a", "an", "of", "to", "in", "is", "it", "that", "for", "on", "was", "with", "as", "are"]


@query("text_counts", f"""WITH w AS (SELECT doc_id, unnest(string_split_regex(lower(regexp_replace(text, '[^a-zA-Z]', ' ', 'g')), ' +')) AS word FROM documents),
p AS (SELECT doc_id, word, COUNT(*) AS n FROM w WHERE word <> '' AND word NOT IN ({", ".join(f"'{s}'" for s in STOP_WORDS)}) GROUP BY 1, 2),
v AS (SELECT word FROM p GROUP BY word ORDER BY SUM(n) DESC, word LIMIT 1500) SELECT doc_id, word, n FROM p WHERE word IN (SELECT word FROM v)""")
def text_counts(t: Tables) -> DataFrame:
    return E.text_counts(t.documents, "doc_id", "text", 1500, STOP_WORDS)


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("corr_pairs", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
                                        for i, a in enumerate(NUMBERS) for b in NUMBERS[i + 1:]))
def corr_pairs(t: Tables) -> DataFrame:
    return X.corr_pairs(t.lineitem, NUMBERS).withColumn("corr", F.round("corr", 6))


def _unrelated(cols: list[str]) -> str:
    """SQL that no pair of columns is correlated above 0.7, so that none is dropped."""
    return "greatest(" + ", ".join(f"abs(corr({a}, {b}))" for i, a in enumerate(cols) for b in cols[i + 1:]) + ") <= 0.7"


@query("drop_correlated", f"""SELECT l_returnflag, {', '.join(f'round(AVG({c}), 6) AS {c}' for c in NUMBERS)} FROM lineitem
WHERE (SELECT {_unrelated(NUMBERS)} FROM lineitem) GROUP BY 1""")
def drop_correlated(t: Tables) -> DataFrame:
    kept = X.drop_correlated(t.lineitem.select(*NUMBERS), NUMBERS, 0.7)
    return t.lineitem.groupBy("l_returnflag").agg(*[F.round(F.avg(c), 6).alias(c) for c in kept.columns])


RANKED = ["p_size", "p_retailprice", "p_partkey"]


@query("drop_rank_correlated", f"""WITH r AS (SELECT {', '.join(f'rank() OVER (ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}' for c in RANKED)} FROM part)
SELECT p_type, {', '.join(f'round(AVG({c}), 6) AS {c}' for c in RANKED)} FROM part WHERE (SELECT {_unrelated(RANKED)} FROM r) GROUP BY 1""")
def drop_rank_correlated(t: Tables) -> DataFrame:
    kept = X.drop_correlated(t.part.select("p_size", "p_retailprice", "p_partkey"), ["p_size", "p_retailprice", "p_partkey"], 0.7, "spearman")
    return t.part.groupBy("p_type").agg(*[F.round(F.avg(c), 6).alias(c) for c in kept.columns])


@query("feature_power", """WITH v AS (SELECT 'p_size' AS feature, p_size::DOUBLE AS x, p_type AS t FROM part
UNION ALL SELECT 'p_retailprice', p_retailprice, p_type FROM part UNION ALL SELECT 'p_partkey', p_partkey, p_type FROM part),
r AS (SELECT feature, x, row_number() OVER (PARTITION BY feature ORDER BY x) AS rn, COUNT(*) OVER (PARTITION BY feature) AS n FROM v),
e AS (SELECT feature, list_distinct(list(x)) AS ends FROM r, range(1, 16) k(i) WHERE rn = CAST(ceil(i * n / 16.0) AS BIGINT) GROUP BY 1),
c AS (SELECT feature, len(list_filter(ends, lambda b: b < x))::VARCHAR AS bin, t, COUNT(*) AS n FROM v JOIN e USING (feature) GROUP BY ALL
UNION ALL SELECT 'p_brand', p_brand, p_type, COUNT(*) FROM part GROUP BY ALL),
b AS (SELECT feature, bin, MAX(n) AS hit, SUM(n) AS n FROM c GROUP BY 1, 2),
p AS (SELECT feature, SUM(hit) / SUM(n) AS power, COUNT(*) AS cells FROM b GROUP BY 1)
SELECT feature, round(power, 6) AS power, cells FROM p WHERE power > (SELECT MIN(power) FROM p)""")
def feature_power(t: Tables) -> DataFrame:
    out = X.single_feature_power(t.part, "p_type", ["p_size", "p_retailprice", "p_partkey", "p_brand"])
    return out.withColumn("power", F.round("power", 6))


SCORED = "scored AS (SELECT l.quality, l.toxic, d.n_chars AS score FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"


def scored(t: Tables) -> DataFrame:
    return t.labels.join(t.documents.select("doc_id", F.col("n_chars").alias("score")), "doc_id")


@query("gini_scores", f"""WITH {SCORED}, r AS (SELECT quality, rank() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM scored),
s AS (SELECT SUM(CASE WHEN quality = 1 THEN rk END) AS rs, COUNT(CASE WHEN quality = 1 THEN 1 END) AS n1, COUNT(CASE WHEN quality = 0 THEN 1 END) AS n0 FROM r)
SELECT n1 AS positives, n0 AS negatives, round(2 * (rs - n1 * (n1 + 1) / 2) / (CAST(n1 AS DOUBLE) * n0) - 1, 9) AS gini FROM s""")
def gini_scores(t: Tables) -> DataFrame:
    return gini(scored(t), "quality", "score").withColumn("gini", F.round("gini", 9))


@query("confusion", f"""WITH {SCORED}, p AS (SELECT quality AS label, CAST(score > 1000 AS INT) AS prediction FROM scored)
SELECT label, prediction, COUNT(*) AS n, round((SELECT AVG(CAST(label = prediction AS INT)) FROM p), 9) AS accuracy FROM p GROUP BY 1, 2""")
def confusion(t: Tables) -> DataFrame:
    rows = scored(t).withColumn("prediction", (F.col("score") > 1000).cast("int"))
    return confusion_matrix(rows, "quality", "prediction").withColumn("accuracy", F.round("accuracy", 9))


@query("polynomial_columns", """SELECT p_partkey, pow(p_size::DOUBLE, 2) AS p_size_pow2, pow(p_size::DOUBLE, 3) AS p_size_pow3, pow(p_size::DOUBLE, 4) AS p_size_pow4 FROM part""")
def polynomial_columns(t: Tables) -> DataFrame:
    return E.power_columns(t.part.select("p_partkey", "p_size"), "p_size", 4).drop("p_size")


#: Products of x and y up to the fourth degree, in the order of the expansion: by the power of y, then of x.
POWERS = [(i, j) for j in range(5) for i in range(5 - j) if i + j]
#: The same products in the same order of factors, so that the doubles agree to the last bit.
PRODUCTS = ", ".join(" * ".join(["y"] * j + ["x"] * i) for i, j in POWERS)


@query("polynomial_features", f"""WITH p AS (SELECT p_partkey, p_size::DOUBLE AS x, p_retailprice / 1000 AS y FROM part)
SELECT p_partkey, [{PRODUCTS}] AS poly FROM p""")
def polynomial_features(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.col("p_size").cast("double").alias("x"), (F.col("p_retailprice") / 1000).alias("y"))
    out = E.polynomial_features(rows, ["x", "y"], 4)
    return out.select("p_partkey", V.to_array("poly").alias("poly"))


@query("vector_round_trip", """SELECT vec_id, round(embedding[1]::DOUBLE, 6) AS first, round(embedding[2]::DOUBLE, 6) AS second, len(embedding) AS size FROM embeddings""")
def vector_round_trip(t: Tables) -> DataFrame:
    vectors = t.embeddings.select("vec_id", V.to_vector("embedding").alias("v"))
    return vectors.select("vec_id", F.round(V.vector_at("v", 0), 6).alias("first"), F.round(V.vector_at("v", 1), 6).alias("second"),
                          F.size(V.to_array("v")).cast("long").alias("size"))
