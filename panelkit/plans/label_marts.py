"""Churn base, labels and the model input on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators import lookback as L
from panelkit.operators import marts as M
from panelkit.operators.joins import wide_join
from panelkit.operators.windows import lead_label
from panelkit.plans.feature_marts import BLACK_LIST, black_list
from panelkit.plans.registry import ORACLES, PLANS, plain, query
from panelkit.plans.views import (CLIENT_PANEL, CONTRACT_PANEL, ORDER_LOG, client_panel, contract_panel, line_months,
                                  months_between, order_log, shift, whole_months)
from panelkit.scale import checkpoint, parts_for
from panelkit.tables import Tables

HISTORY = """lm AS (SELECT l_orderkey AS contract, last_day(CAST(l_shipdate AS DATE)) AS rd,
  SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS balance,
  MAX(CAST(l_quantity AS INT)) AS quantity, MAX(l_returnflag) AS flag, MAX(l_linestatus) AS line_status FROM lineitem GROUP BY 1, 2),
hist AS (SELECT lm.contract, o.o_custkey AS client, lm.rd, CASE WHEN o.o_orderpriority = '5-LOW' THEN 5 ELSE 6 END AS product,
  CAST(o.o_orderdate AS DATE) AS start, CAST(CAST(o.o_orderdate AS DATE) + INTERVAL 60 MONTH AS DATE) AS planned_end,
  CAST(CAST(o.o_orderdate AS DATE) + INTERVAL 58 MONTH AS DATE) AS stop, -lm.balance AS balance, lm.quantity - 15 AS dpd,
  CASE WHEN lm.flag = 'R' THEN 6 ELSE 1 END AS status, CASE lm.line_status WHEN 'F' THEN '' END AS refinancing
  FROM lm JOIN orders o ON o.o_orderkey = lm.contract)"""


def credit_history(t: Tables) -> DataFrame:
    """Orders and their line months as loans of five years with a negative balance."""
    start = F.to_date("o_orderdate")
    heads = t.orders.select(F.col("o_orderkey").alias("contract"), F.col("o_custkey").alias("client"),
                            S.case_of("o_orderpriority", {5: ["5-LOW"]}, 6).alias("product"), start.alias("start"),
                            F.add_months(start, 60).alias("planned_end"), F.add_months(start, 58).alias("end"))
    return line_months(t).join(heads, "contract").select(
        "contract", "client", "rd", "product", "start", "planned_end", "end", (-F.col("balance")).alias("balance"),
        (F.col("quantity") - 15).alias("dpd"), F.when(F.col("flag") == "R", 6).otherwise(1).alias("status"),
        F.when(F.col("line_status") == "F", "").alias("refinancing"))


ENDS = """marked AS (SELECT *, CASE WHEN CAST(balance AS DOUBLE) / NULLIF(CAST(lag(balance) OVER (PARTITION BY contract ORDER BY rd) AS DOUBLE), 0) <= 0.1
  AND balance < 0 AND rd < planned_end THEN 1 ELSE 0 END AS big FROM hist),
ends AS (SELECT contract, COALESCE(MIN(CASE WHEN big = 1 THEN rd END), MAX(rd)) AS true_end, MAX(big) AS had_big_payment FROM marked GROUP BY 1)"""


@query("true_end", f"""WITH {HISTORY}, {ENDS} SELECT contract, CAST(true_end AS VARCHAR) AS true_end, had_big_payment FROM ends""")
def true_end(t: Tables) -> DataFrame:
    return M.true_end_date(credit_history(t))


CHURN_BASE = f"""{HISTORY}, {ENDS}, {ORDER_LOG}, {BLACK_LIST},
seip AS (SELECT h.*, CASE WHEN h.rd = e.true_end AND e.had_big_payment = 1 THEN 666 ELSE h.status END AS status_now
  FROM hist h JOIN ends e ON e.contract = h.contract AND h.rd <= e.true_end),
pc AS (SELECT DISTINCT client, rd FROM seip),
f1 AS (SELECT s.client, s.rd, COUNT(h.client) > 0 AS f FROM seip s LEFT JOIN hist h ON h.client = s.client AND h.product = 6
  AND h.contract <> s.contract AND {whole_months('s.rd', 'h.rd')} BETWEEN 1 AND 3 GROUP BY 1, 2),
f5 AS (SELECT s.client, s.rd, COUNT(h.client) > 0 AS f FROM pc s LEFT JOIN hist h ON h.client = s.client
  AND {whole_months('s.rd', 'h.start')} BETWEEN 3 AND 6 GROUP BY 1, 2),
f6 AS (SELECT s.client, s.rd, COUNT(h.client) = 0 AS f FROM seip s LEFT JOIN hist h ON h.contract = s.contract AND h.rd <= s.rd
  AND h.dpd > 30 GROUP BY 1, 2),
f7 AS (SELECT s.client, s.rd, COUNT(CASE WHEN {whole_months('s.rd', 'b.month')} BETWEEN 0 AND 3 THEN 1 END) > 0 AS last3,
  COUNT(CASE WHEN {whole_months('s.rd', 'b.month')} BETWEEN -3 AND 0 THEN 1 END) > 0 AS next3
  FROM pc s LEFT JOIN black_list b ON b.client = s.client GROUP BY 1, 2),
k AS (SELECT s.*, CAST(((status_now = 6 AND COALESCE(refinancing, '') = '') OR status_now = 666) AND NOT f1.f AS INT) AS churn,
  CAST(status = 6 AND COALESCE(refinancing, '') = '' AS INT) AS churn_old, f5.f AS new_contract, f6.f AS clean, f7.last3, f7.next3
  FROM seip s JOIN f1 ON f1.client = s.client AND f1.rd = s.rd JOIN f5 ON f5.client = s.client AND f5.rd = s.rd
  JOIN f6 ON f6.client = s.client AND f6.rd = s.rd JOIN f7 ON f7.client = s.client AND f7.rd = s.rd WHERE s.product = 6),
base AS (SELECT contract, client, rd, start, stop, planned_end, balance, dpd,
  CAST(floor({months_between('rd', 'start')} / 3) * 3 AS INT) AS mob,
  CAST(CASE WHEN {months_between('planned_end', 'start')} <= 11 THEN floor({months_between('planned_end', 'start')} / 6) * 6
    ELSE floor({months_between('planned_end', 'start')} / 12) * 12 END AS INT) AS tenor,
  CAST(year(start) AS INT) AS start_year, year(start) || '_' || quarter(start) AS start_time,
  year(planned_end) || '_' || quarter(planned_end) AS planned_end_time,
  CAST({months_between('(SELECT MAX(rd) FROM hist)', 'rd')} >= 6 AS INT) AS has_next_6m, churn,
  lead(churn, 1) OVER w AS churn_in_1, lead(churn, 2) OVER w AS churn_in_2, lead(churn, 3) OVER w AS churn_in_3,
  lead(churn, 4) OVER w AS churn_in_4, churn_old, lead(churn_old, 1) OVER w AS churn_old_in_1, lead(churn_old, 2) OVER w AS churn_old_in_2,
  lead(churn_old, 3) OVER w AS churn_old_in_3, lead(churn_old, 6) OVER w AS churn_old_in_6, CAST(new_contract AS INT) AS has_new_contract,
  CAST(clean AS INT) AS dpd_clean, CAST(last3 AS INT) AS blacklisted_last_3m, CAST(next3 AS INT) AS blacklisted_next_3m
  FROM k WINDOW w AS (PARTITION BY contract ORDER BY rd))"""


@query("churn_base", f"""WITH {CHURN_BASE}
SELECT * EXCLUDE (rd, start, stop, planned_end, balance), CAST(rd AS VARCHAR) AS rd, CAST(start AS VARCHAR) AS start, CAST(stop AS VARCHAR) AS "end",
  CAST(planned_end AS VARCHAR) AS planned_end, CAST(balance AS DOUBLE) AS balance FROM base""")
def churn_base(t: Tables) -> DataFrame:
    return M.churn_base(credit_history(t), black_list(t))


def loan_sales(t: Tables) -> DataFrame:
    """Line 7 of a returned order stands for the sale of the loan."""
    return t.lineitem.where("l_linenumber = 7 AND l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("contract"), F.to_date("l_shipdate").alias("day"))


SAMPLE = f"""{CHURN_BASE},
sales AS (SELECT l_orderkey AS contract, CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_linenumber = 7 AND l_returnflag = 'R'),
sample AS (SELECT *, COALESCE(churn_in_3, churn_in_2, churn_in_1) AS target FROM base WHERE start_year >= 1995 AND dpd_clean = 1
  AND NOT EXISTS (SELECT 1 FROM sales s WHERE s.contract = base.contract AND s.day < base.rd) AND abs(balance) > 30
  AND {months_between('stop', 'rd')} >= 0 AND ((tenor > 24 AND planned_end - rd >= 90) OR (tenor <= 24 AND planned_end - rd >= 60))
  AND (COALESCE(churn_in_3, churn_in_2, churn_in_1) = 1 OR churn_in_3 = 0) AND rd >= DATE '1995-06-30' AND has_next_6m = 1
  AND blacklisted_last_3m = 0)"""
RULES = {"first_year": 1995, "first_rd": "1995-06-30"}


@query("label_sample", f"""WITH {SAMPLE} SELECT contract, client, CAST(rd AS VARCHAR) AS rd, mob, tenor, target FROM sample""")
def label_sample(t: Tables) -> DataFrame:
    base = M.churn_base(credit_history(t), black_list(t))
    return M.eligibility_sample(base, loan_sales(t), **RULES).select("contract", "client", "rd", "mob", "tenor", "target")


SNAPSHOTS = ["1997-01-31", "1998-04-30", "1999-07-31"]


@query("dependent_variable", f"""WITH {SAMPLE}
SELECT 'three_windows' AS tag, '2002-01-01' AS created, contract * 1000 + (year(rd) - 1990) * 12 + month(rd) AS sample_id, target
FROM sample WHERE rd IN (DATE '1997-01-31', DATE '1998-04-30', DATE '1999-07-31')""")
def dependent_variable(t: Tables) -> DataFrame:
    history = credit_history(t)
    base = M.churn_base(history, black_list(t))
    month = (F.year("rd") - 1990) * 12 + F.month("rd")
    keys = history.select("contract", "client", "rd", (F.col("contract") * 1000 + month).alias("sample_id"))
    return M.dependent_variable(base, loan_sales(t), keys, SNAPSHOTS, "three_windows", F.lit("2002-01-01"), **RULES)


@query("lead_labels", f"""WITH {HISTORY} SELECT contract, CAST(rd AS VARCHAR) AS rd, status, lead(status, 1) OVER w AS status_in_1,
  lead(status, 2) OVER w AS status_in_2, lead(status, 3) OVER w AS status_in_3, lead(status, 6) OVER w AS status_in_6
FROM hist WINDOW w AS (PARTITION BY contract ORDER BY rd)""")
def lead_labels(t: Tables) -> DataFrame:
    return lead_label(credit_history(t).select("contract", "rd", "status"), "status", ["contract"], ["rd"], [1, 2, 3, 6])


FEATURES = f"""{CLIENT_PANEL}, {ORDER_LOG},
recent AS (SELECT p.client, p.rd, COUNT(o.contract) AS orders_3m, CAST(SUM(o.price) AS DOUBLE) AS spend_3m,
  COUNT(CASE WHEN o.status = 'F' THEN 1 END) AS f_3m, COUNT(CASE WHEN o.priority IN ('1-URGENT', '2-HIGH') THEN 1 END) AS u_3m
  FROM client_panel p LEFT JOIN order_log o ON o.client = p.client AND o.day > {shift('p.rd', -3)} AND o.day <= p.rd GROUP BY 1, 2),
ever AS (SELECT p.client, p.rd, COUNT(o.contract) AS orders_before, MIN(o.day) AS first_order FROM client_panel p
  LEFT JOIN order_log o ON o.client = p.client AND o.day < p.rd GROUP BY 1, 2)"""


def recent_block(t: Tables) -> DataFrame:
    measures = {"orders": L.count(), "spend": L.total("price"), "f": L.count(F.col("status") == "F"),
                "u": L.count(F.col("priority").isin("1-URGENT", "2-HIGH"))}
    out = L.lookback_agg(client_panel(t), order_log(t), ["client"], "rd", "day",
                         {"_3m": L.open_window(F.add_months("rd", -3), "rd")}, measures)
    return out.withColumn("spend_3m", F.col("spend_3m").cast("double"))


def ever_block(t: Tables) -> DataFrame:
    return L.history_agg(client_panel(t), order_log(t), ["client"], "rd", "day",
                         {"orders_before": L.count(), "first_order": L.lowest("day")}, strict=True)


@query("impute_group_mean", f"""WITH {FEATURES}, r AS (SELECT client, rd, CAST(f_3m AS DOUBLE) / NULLIF(u_3m, 0) AS closed_share FROM recent)
SELECT client, CAST(rd AS VARCHAR) AS rd, round(COALESCE(closed_share, AVG(closed_share) OVER (PARTITION BY rd)), 6) AS closed_share FROM r""")
def impute_group_mean(t: Tables) -> DataFrame:
    rows = recent_block(t).select("client", "rd", S.ratio("f_3m", "u_3m").alias("closed_share"))
    return M.group_mean_impute(rows, ["closed_share"], ["rd"]).withColumn("closed_share", F.round("closed_share", 6))


@query("wide_join", f"""WITH {FEATURES} SELECT p.client, CAST(p.rd AS VARCHAR) AS rd, r.orders_3m, r.spend_3m, e.orders_before
FROM client_panel p LEFT JOIN recent r ON r.client = p.client AND r.rd = p.rd LEFT JOIN ever e ON e.client = p.client AND e.rd = p.rd""")
def wide_join_query(t: Tables) -> DataFrame:
    blocks = [recent_block(t).select("client", "rd", "orders_3m", "spend_3m"), ever_block(t).select("client", "rd", "orders_before")]
    return wide_join(client_panel(t), blocks, ["client", "rd"])


@query("model_input", f"""WITH {FEATURES}, lab AS (SELECT client, rd, client * 1000 + (year(rd) - 1990) * 12 + month(rd) AS sample_id,
  CAST(COALESCE(lead(rd) OVER (PARTITION BY client ORDER BY rd) <= CAST(rd + INTERVAL 4 MONTH AS DATE), FALSE) AS INT) AS target FROM client_panel),
b1 AS (SELECT l.sample_id, r.orders_3m, r.spend_3m, r.f_3m, r.u_3m, CAST(r.f_3m AS DOUBLE) / NULLIF(r.u_3m, 0) AS closed_share FROM lab l JOIN recent r ON r.client = l.client AND r.rd = l.rd),
b2 AS (SELECT l.sample_id, e.orders_before, l.rd - e.first_order AS age_days FROM lab l JOIN ever e ON e.client = l.client AND e.rd = l.rd)
SELECT l.sample_id, 'client_months' AS tag, l.target, CAST(l.rd AS VARCHAR) AS rd, COALESCE(orders_3m, 0) AS orders_3m, COALESCE(spend_3m, -100) AS spend_3m,
  COALESCE(f_3m, 0) AS f_3m, COALESCE(u_3m, 0) AS u_3m, round(COALESCE(closed_share, AVG(closed_share) OVER (PARTITION BY l.rd)), 6) AS closed_share,
  CAST(orders_before AS VARCHAR) AS orders_before, COALESCE(age_days, -10) AS age_days, CAST(least(COALESCE(f_3m, 0), 2) AS VARCHAR) AS f_3m_text,
  CASE WHEN COALESCE(u_3m, 0) >= 1 THEN '1' ELSE '0' END AS u_3m_class
FROM lab l LEFT JOIN b1 ON b1.sample_id = l.sample_id LEFT JOIN b2 ON b2.sample_id = l.sample_id""")
def model_input(t: Tables) -> DataFrame:
    sample = F.col("client") * 1000 + (F.year("rd") - 1990) * 12 + F.month("rd")
    ahead = lead_label(client_panel(t), "rd", ["client"], ["rd"], [1], "next_rd")
    soon = F.coalesce(F.col("next_rd") <= F.add_months("rd", 4), F.lit(False)).cast("int")
    label = ahead.select(sample.alias("sample_id"), F.lit("client_months").alias("tag"), soon.alias("target"), "rd")
    first = recent_block(t).select(
        sample.alias("sample_id"), "orders_3m", "spend_3m", "f_3m", "u_3m", S.ratio("f_3m", "u_3m").alias("closed_share"))
    second = ever_block(t).select(sample.alias("sample_id"), "orders_before", F.datediff("rd", "first_order").alias("age_days"))
    out = M.model_input(label, {"recent": first, "ever": second}, "sample_id", "client_months",
                        zero=["orders_3m", "f_3m", "u_3m"], fills={"spend_3m": -100.0, "age_days": -10},
                        text=["orders_before"], caps={"f_3m": 2}, classes=["u_3m"], impute=["closed_share"], by="rd")
    return out.withColumn("closed_share", F.round("closed_share", 6))


#: The nine marts and the keys they are found by through the key map.
MARTS = {"limits_mart": ["contract", "rd"], "excess_payment_mart": ["contract", "rd"], "loan_mart": ["contract", "rd"],
         "client_mart": ["client", "rd"], "bureau_mart": ["client", "rd"], "deposit_mart": ["client", "rd"],
         "complaints_mart": ["client", "day"], "channel_mart": ["client", "day"], "call_mart": ["client", "day"]}
#: Columns of the marts that the scorecard input takes.
TAKEN = {"limits_mart": ["current_limit", "limit_reached_3m"], "excess_payment_mart": ["payments_3m", "payments_6m"],
         "loan_mart": ["applications", "age", "segment"], "client_mart": ["is_on_blacklist"],
         "bureau_mart": ["foreign_credits", "queries_3m"], "deposit_mart": ["accounts", "operations"],
         "complaints_mart": ["complaint_threads", "query_threads"], "channel_mart": ["visits", "top_up_days", "days_since_login"],
         "call_mart": ["offered_3m", "answered_1m"]}
ZERO = ["payments_3m", "payments_6m", "applications", "foreign_credits", "queries_3m", "accounts", "operations",
        "complaint_threads", "query_threads", "visits", "top_up_days", "offered_3m", "answered_1m"]


def _scorecard_sql() -> str:
    blocks = " ".join(
        f"LEFT JOIN (SELECT {', '.join(keys[:1])}, rd AS key_rd, {', '.join(TAKEN[name])} FROM ({ORACLES[name]})) {name} "
        f"ON {name}.{keys[0]} = k.{keys[0]} AND {name}.key_rd = {'k.day' if keys[1] == 'day' else 'CAST(k.rd AS VARCHAR)'}"
        for name, keys in MARTS.items())
    zero = ", ".join(f"COALESCE({c}, 0) AS {c}" for c in ZERO)
    return f"""WITH {CONTRACT_PANEL}, k AS (SELECT contract, client, rd, contract * 1000 + (year(rd) - 1990) * 12 + month(rd) AS sample_id,
  CAST(DATE '2024-01-01' + CAST(contract % 30 AS INT) AS VARCHAR) AS day FROM contract_panel)
SELECT k.sample_id, 'contracts' AS tag, CAST(k.rd AS VARCHAR) AS rd, current_limit, COALESCE(limit_reached_3m, -1) AS limit_reached_3m, {zero},
  round(COALESCE(CAST(age AS DOUBLE), AVG(age) OVER (PARTITION BY k.rd)), 6) AS age, segment, is_on_blacklist,
  COALESCE(days_since_login, -10) AS days_since_login FROM k {blocks}"""


def _smallest(rows: DataFrame, keys: list[str], groups: dict[str, list[str]], parts: int) -> DataFrame:
    """Per key the smallest of each group of columns, as one column; Spark sorts rows for it, so they are dealt out before."""
    dealt = rows.repartition(parts, *keys)
    whole = {n: F.col(n) if n in rows.columns else F.struct(*cols) for n, cols in groups.items()}
    return dealt.groupBy(*keys).agg(*[F.min(c).alias(n) for n, c in whole.items()])


@query("scorecard_input", _scorecard_sql())
def scorecard_input(t: Tables) -> DataFrame:
    """All nine marts on the contract panel: the key map leads from a sample to the keys of each mart.

    Five marts read the panel as the key map does, so it is written once. The key map takes in the marts of one pair of keys after the other
    and is dealt out by each pair once, then by sample once.
    """
    t = Tables(t.spark, t.directory)  # what is shared here is for the marts of this run
    panel = t.share("contract_panel", checkpoint(contract_panel(t)))
    parts = parts_for(panel.count())  # a task sorts the rows of several marts side by side
    sample = F.col("contract") * 1000 + (F.year("rd") - 1990) * 12 + F.month("rd")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("contract") % 30).cast("int")).alias("day")
    label = panel.select(sample.alias("sample_id"), F.lit("contracts").alias("tag"), "rd")
    found = panel.select(sample.alias("sample_id"), "contract", "client", "rd", day)
    for who, when in dict.fromkeys(map(tuple, MARTS.values())):
        found = found.withColumn("_key", F.col(when))
        for name in (n for n, by in MARTS.items() if by == [who, when]):
            mart = PLANS[name](t).select(who, F.col("rd").alias("_key"), *TAKEN[name])
            mart = checkpoint(plain(mart, (who, "_key")))
            found = found.join(_smallest(mart, [who, "_key"], {name: TAKEN[name]}, parts), [who, "_key"], "left")
        found = found.drop("_key")
    blocks = {"marts": _smallest(found, ["sample_id"], TAKEN, parts).select("sample_id", *[f"{n}.*" for n in MARTS])}
    out = M.model_input(label, blocks, "sample_id", "contracts", zero=ZERO, fills={"limit_reached_3m": -1, "days_since_login": -10},
                        impute=["age"], by="rd")
    return out.withColumn("age", F.round("age", 6))


@query("attach_score", """SELECT d.doc_id, d.lang, l.quality AS score, (SELECT COUNT(*) FROM documents) AS input,
  (SELECT COUNT(DISTINCT doc_id) FROM labels) AS scores, (SELECT COUNT(*) FROM documents) AS output FROM documents d LEFT JOIN
  (SELECT doc_id, MAX(quality) AS quality FROM labels GROUP BY 1) l ON l.doc_id = d.doc_id""")
def attach_score(t: Tables) -> DataFrame:
    scores = t.labels.groupBy("doc_id").agg(F.max("quality").alias("score"))
    out, counts = M.attach_score(t.documents.select("doc_id", "lang"), scores, ["doc_id"])
    one = counts.select(F.struct("*").alias("c")).scalar()
    return out.select("*", *[one[c].alias(c) for c in counts.columns])
