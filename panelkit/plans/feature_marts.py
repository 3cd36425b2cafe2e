"""Feature marts on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators import marts as M
from panelkit.plans.panels import PRIORITY_HISTORY, priority_history
from panelkit.plans.registry import query
from panelkit.plans.views import (CLIENT_PANEL, CONTRACT_PANEL, EVENT_LOG, ORDER_LOG, USER_DAY, client_panel,
                                  contract_panel, event_log, months_between, money, order_log, shift, user_day,
                                  whole_months)
from panelkit.scale import lookup_join, parts_for
from panelkit.tables import Tables


@query("limits_mart", f"""WITH {CONTRACT_PANEL}, a AS (SELECT contract, rd, CAST(lines AS INT) AS initial_limit,
  quantity AS current_limit, CAST(flag = 'R' AS INT) AS limit_reached FROM contract_panel)
SELECT a.contract, CAST(a.rd AS VARCHAR) AS rd, a.current_limit, a.initial_limit, a.limit_reached,
  CASE WHEN SUM(b.limit_reached) > 2 THEN 2 + a.limit_reached ELSE CAST(SUM(b.limit_reached) AS INT) END AS limit_reached_3m,
  CAST(MAX(b.current_limit) <> MIN(b.current_limit) AS INT) AS limit_changed_3m,
  CAST(a.initial_limit = a.current_limit AS INT) AS initial_equals_current, d.client
FROM a JOIN a b ON b.contract = a.contract AND b.rd BETWEEN {shift('a.rd', -3)} AND a.rd
LEFT JOIN contract_panel d ON d.contract = a.contract AND d.rd = a.rd AND d.line_status = 'O'
GROUP BY a.contract, a.rd, a.current_limit, a.initial_limit, a.limit_reached, d.client""")
def limits_mart(t: Tables) -> DataFrame:
    panel = contract_panel(t)
    accounts = panel.select("contract", "rd", F.col("quantity").alias("current_limit"),
                            F.col("lines").cast("int").alias("initial_limit"),
                            (F.col("flag") == "R").cast("int").alias("limit_reached"))
    return M.limits_mart(accounts, panel.where("line_status = 'O'").select("contract", "rd", "client"))


def black_list(t: Tables) -> DataFrame:
    """Month ends with an urgent pending order stand for black list months."""
    return (order_log(t).where((F.col("status") == "P") & (F.col("priority") == "1-URGENT"))
            .select("client", F.last_day("day").alias("month")).distinct())


BLACK_LIST = """black_list AS (SELECT DISTINCT client, last_day(day) AS month FROM order_log
  WHERE status = 'P' AND priority = '1-URGENT')"""


@query("client_mart", f"""WITH {CLIENT_PANEL}, {ORDER_LOG}, {PRIORITY_HISTORY}, {BLACK_LIST}
SELECT p.client, CAST(p.rd AS VARCHAR) AS rd, CAST(h.priority = '2-HIGH' AS INT) AS is_bank_employee,
  CAST(EXISTS (SELECT 1 FROM black_list b WHERE b.client = p.client AND b.month = p.rd) AS INT) AS is_on_blacklist,
  CAST(EXISTS (SELECT 1 FROM black_list b WHERE b.client = p.client AND b.month <= p.rd) AS INT) AS was_ever_on_blacklist
FROM client_panel p LEFT JOIN priority_history h ON h.client = p.client AND p.rd >= h.valid_from
  AND (h.valid_to IS NULL OR p.rd <= h.valid_to)""")
def client_mart(t: Tables) -> DataFrame:
    clients = priority_history(t).withColumn("is_bank_employee", (F.col("priority") == "2-HIGH").cast("int"))
    return M.client_mart(client_panel(t), clients, black_list(t))


COMPLAINTS = """complaints AS (SELECT client, day, CASE kind WHEN 'click' THEN 5 WHEN 'view' THEN 8 ELSE 1 END AS reason,
  CASE kind WHEN 'error' THEN 4 WHEN 'signup' THEN 8 WHEN 'purchase' THEN 3 ELSE 0 END AS result,
  CAST(floor(value) AS BIGINT) AS thread FROM event_log)"""


@query("complaints_mart", f"""WITH {USER_DAY}, {EVENT_LOG}, {COMPLAINTS}
SELECT p.client, CAST(p.rd AS VARCHAR) AS rd,
  COUNT(DISTINCT CASE WHEN reason = 5 THEN thread END) AS query_threads,
  COUNT(DISTINCT CASE WHEN reason = 8 THEN thread END) AS complaint_threads,
  COUNT(DISTINCT CASE WHEN reason NOT IN (5, 8) THEN thread END) AS other_threads,
  COUNT(DISTINCT CASE WHEN result = 4 THEN thread END) AS pending_threads,
  COUNT(DISTINCT CASE WHEN result IN (8, 9) THEN thread END) AS rejected_threads,
  COUNT(DISTINCT CASE WHEN result IN (3, 7) THEN thread END) AS accepted_threads
FROM user_day p LEFT JOIN complaints c ON c.client = p.client AND c.day >= {shift('p.rd', -3)} AND c.day <= p.rd
GROUP BY p.client, p.rd""")
def complaints_mart(t: Tables) -> DataFrame:
    log = event_log(t).select("client", "day", S.case_of("kind", {5: ["click"], 8: ["view"]}, 1).alias("reason"),
                              S.case_of("kind", {4: ["error"], 8: ["signup"], 3: ["purchase"]}, 0).alias("result"),
                              F.floor("value").cast("long").alias("thread"))
    return M.complaints_mart(user_day(t), log)


#: Action code of an event by its kind and the remainder of its id: every action group has events.
ACTION_OF = {"click": [95, 96, 78], "purchase": [184, 172, 54], "view": [168, 176, 37], "signup": [219, 238, 219],
             "error": [113, 117, 113]}
ACTION_SQL = "CASE " + " ".join(f"WHEN kind = '{k}' AND event_id % 3 = {i} THEN {c}" for k, cs in ACTION_OF.items()
                                for i, c in enumerate(cs)) + " ELSE 0 END"
FLAGS = {"has_opened_deposit": 113, "has_closed_deposit": 117, "has_paid_card": 37, "has_activated_card": 54,
         "has_reached_login_limit": 96, "has_new_order": 238}


@query("channel_mart", f"""WITH {USER_DAY}, {EVENT_LOG},
acts AS (SELECT client, day, {ACTION_SQL} AS kind, COUNT(*) AS n FROM event_log GROUP BY ALL),
p AS (SELECT u.client, u.rd, a.kind, COUNT(CASE WHEN u.rd - a.day <= 30 THEN 1 END) AS recent_days,
  u.rd - MIN(a.day) AS first, u.rd - MAX(a.day) AS last, SUM(n)::BIGINT AS total,
  SUM(CASE WHEN u.rd - a.day <= 30 THEN n ELSE 0 END)::BIGINT AS recent
  FROM user_day u JOIN acts a ON a.client = u.client AND a.day <= u.rd GROUP BY u.client, u.rd, a.kind),
l AS (SELECT *, CAST(recent AS DOUBLE) / (CASE WHEN first <= 30 THEN first + 1 ELSE 31 END) AS rate FROM p WHERE kind = 95),
tr AS (SELECT client, rd, MIN(first) AS first, MIN(last) AS last, SUM(recent) AS recent FROM p
  WHERE kind IN (184, 168, 172, 176) GROUP BY 1, 2),
fl AS (SELECT client, rd, SUM(CASE WHEN kind = 219 THEN recent_days END) AS top_up, {', '.join(f'SUM(CASE WHEN kind = {c} THEN recent_days END) AS {n}' for n, c in FLAGS.items())}
  FROM p GROUP BY 1, 2),
tok AS (SELECT u.client, u.rd, COUNT(CASE WHEN e.kind = 'click' THEN 1 END) AS physical, COUNT(CASE WHEN e.kind = 'view' THEN 1 END) AS java
  FROM user_day u LEFT JOIN event_log e ON e.client = u.client AND e.day BETWEEN u.rd + 1 - 30 AND u.rd GROUP BY 1, 2),
v AS (SELECT u.client, u.rd, COUNT(e.kind) AS visits, COUNT(CASE WHEN e.kind = 'purchase' THEN 1 END) AS cash,
  COUNT(CASE WHEN e.kind = 'signup' THEN 1 END) AS sales FROM user_day u LEFT JOIN event_log e ON e.client = u.client
  AND e.kind <> 'click' AND e.day BETWEEN CAST((u.rd + 1) - INTERVAL 1 MONTH AS DATE) AND u.rd GROUP BY 1, 2),
vw AS (SELECT *, lag(visits) OVER w AS visits_last, lag(cash) OVER w AS cash_last, lag(sales) OVER w AS sales_last,
  AVG(visits) OVER (w ROWS 11 PRECEDING) AS visits_mean, AVG(cash) OVER (w ROWS 11 PRECEDING) AS cash_mean,
  AVG(sales) OVER (w ROWS 11 PRECEDING) AS sales_mean FROM v WINDOW w AS (PARTITION BY client ORDER BY rd)),
c AS (SELECT client, MIN(day) AS start, MAX(day) AS stop, MIN(day) AS first_login FROM event_log WHERE kind <> 'error' GROUP BY 1)
SELECT u.client, CAST(u.rd AS VARCHAR) AS rd, round(COALESCE(l.rate, 0), 6) AS logins_per_day,
  round(COALESCE(CAST(l.recent AS DOUBLE) / NULLIF(l.recent_days, 0), 0), 6) AS logins_per_login_day,
  round(l.rate - CAST(l.total AS DOUBLE) / (l.first + 1), 6) AS login_activity_diff, l.last AS days_since_login,
  tr.last AS days_since_transfer,
  round(COALESCE(CAST(tr.recent AS DOUBLE) / (CASE WHEN tr.first <= 30 THEN tr.first + 1 ELSE 30 END), 0), 6) AS transfers_per_day,
  CAST(COALESCE(fl.top_up, 0) AS BIGINT) AS top_up_days, {', '.join(f'CAST(COALESCE(fl.{n}, 0) > 0 AS INT) AS {n}' for n in FLAGS)},
  tok.physical AS physical_tokens, tok.java AS java_tokens, vw.visits, vw.cash AS cash_visits, vw.sales AS sales_visits,
  vw.visits_last, vw.cash_last AS cash_visits_last, vw.sales_last AS sales_visits_last,
  round(vw.visits_mean, 6) AS visits_year_mean, round(vw.cash_mean, 6) AS cash_visits_year_mean,
  round(vw.sales_mean, 6) AS sales_visits_year_mean, CAST(c.client IS NOT NULL AS INT) AS has_active_contract,
  {whole_months('u.rd', 'c.first_login')} AS months_since_first_login
FROM user_day u LEFT JOIN l ON l.client = u.client AND l.rd = u.rd LEFT JOIN tr ON tr.client = u.client AND tr.rd = u.rd
LEFT JOIN fl ON fl.client = u.client AND fl.rd = u.rd
JOIN tok ON tok.client = u.client AND tok.rd = u.rd JOIN vw ON vw.client = u.client AND vw.rd = u.rd
LEFT JOIN c ON c.client = u.client AND u.rd BETWEEN c.start AND c.stop""")
def channel_mart(t: Tables) -> DataFrame:
    log = event_log(t)
    code = F.lit(0)
    for kind, codes in ACTION_OF.items():
        code = F.when(F.col("kind") == kind, F.element_at(F.array(*map(F.lit, codes)), (F.col("event_id") % 3 + 1).cast("int"))).otherwise(code)
    actions = log.select("client", "day", code.alias("action"), F.lit(1).alias("n"))
    tokens = log.select("client", "day", S.case_of("kind", {1: ["click"], 2: ["view"]}, 0).alias("type"))
    visits = log.where("kind <> 'click'").select("client", "day", (F.col("kind") == "purchase").cast("int").alias("is_cash"),
                                                 (F.col("kind") == "signup").cast("int").alias("is_sales"))
    contracts = log.where("kind <> 'error'").groupBy("client").agg(
        F.min("day").alias("start"), F.max("day").alias("end"), F.min("day").alias("first_login"))
    out = M.channel_mart(user_day(t), actions, tokens, visits, contracts)
    rounded = [c for c, kind in out.dtypes if kind == "double"]
    return out.withColumns({c: F.round(c, 6) for c in rounded})


@query("call_mart", f"""WITH {USER_DAY}, {EVENT_LOG},
k AS (SELECT *, client * 10 + CASE kind WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'signup' THEN 3 WHEN 'error' THEN 4 ELSE 5 END AS call_id
  FROM event_log),
u AS (SELECT day, call_id, MAX(client) AS client, SUM(CAST(floor(value) AS BIGINT)) AS wait, SUM(event_id) AS talk,
  MAX(CAST(value > 20 AS INT)) AS answered, MAX(1) AS offered FROM k GROUP BY 1, 2),
r AS (SELECT DISTINCT call_id, CASE kind WHEN 'click' THEN 49 WHEN 'view' THEN 27 WHEN 'signup' THEN 41 WHEN 'error' THEN 50 ELSE 23 END AS reason FROM k
  UNION ALL SELECT DISTINCT call_id, 99 FROM k WHERE kind = 'view'),
c AS (SELECT u.*, r.reason FROM u JOIN r ON r.call_id = u.call_id),
m AS (SELECT p.client, p.rd, c.*EXCLUDE (client), c.day > CAST((p.rd + 1) - INTERVAL 1 MONTH AS DATE) - 1 AS in1
  FROM user_day p JOIN c ON c.client = p.client AND c.day > CAST((p.rd + 1) - INTERVAL 3 MONTH AS DATE) - 1 AND c.day <= p.rd)
SELECT p.client, CAST(p.rd AS VARCHAR) AS rd, COUNT(CASE WHEN reason = 23 THEN 1 END) AS early_payment_3m,
  COUNT(CASE WHEN reason = 49 THEN 1 END) AS collection_3m, COUNT(CASE WHEN reason = 50 THEN 1 END) AS complaints_3m,
  COUNT(CASE WHEN reason IN (29, 40, 27) THEN 1 END) AS console_3m,
  COUNT(CASE WHEN reason IN (41, 44, 26, 30, 36, 19, 38, 1, 11, 21) THEN 1 END) AS new_products_3m,
  CAST(trunc(CAST(SUM(wait) AS DOUBLE) / COUNT(wait)) AS INT) AS wait_3m, CAST(trunc(CAST(SUM(talk) AS DOUBLE) / COUNT(talk)) AS INT) AS talk_3m,
  CAST(SUM(answered) AS BIGINT) AS answered_3m, CAST(SUM(offered) AS BIGINT) AS offered_3m,
  COUNT(CASE WHEN in1 AND reason = 23 THEN 1 END) AS early_payment_1m,
  COUNT(CASE WHEN in1 AND reason = 49 THEN 1 END) AS collection_1m, COUNT(CASE WHEN in1 AND reason = 50 THEN 1 END) AS complaints_1m,
  COUNT(CASE WHEN in1 AND reason IN (29, 40, 27) THEN 1 END) AS console_1m,
  COUNT(CASE WHEN in1 AND reason IN (41, 44, 26, 30, 36, 19, 38, 1, 11, 21) THEN 1 END) AS new_products_1m,
  CAST(trunc(CAST(SUM(CASE WHEN in1 THEN wait END) AS DOUBLE) / COUNT(CASE WHEN in1 THEN wait END)) AS INT) AS wait_1m,
  CAST(trunc(CAST(SUM(CASE WHEN in1 THEN talk END) AS DOUBLE) / COUNT(CASE WHEN in1 THEN talk END)) AS INT) AS talk_1m,
  CAST(SUM(CASE WHEN in1 THEN answered END) AS BIGINT) AS answered_1m, CAST(SUM(CASE WHEN in1 THEN offered END) AS BIGINT) AS offered_1m
FROM user_day p LEFT JOIN m ON m.client = p.client AND m.rd = p.rd GROUP BY p.client, p.rd""")
def call_mart(t: Tables) -> DataFrame:
    code = S.case_of("kind", {1: ["click"], 2: ["view"], 3: ["signup"], 4: ["error"]}, 5)
    log = event_log(t).withColumn("call_id", F.col("client") * 10 + code)
    calls = log.select("day", "call_id", "client", F.floor("value").cast("long").alias("wait"), F.col("event_id").alias("talk"),
                       (F.col("value") > 20).cast("int").alias("answered"), F.lit(1).alias("offered"))
    first = S.case_of("kind", {49: ["click"], 27: ["view"], 41: ["signup"], 50: ["error"]}, 23)
    kinds = log.select("call_id", "kind").distinct()
    reasons = kinds.select("call_id", first.alias("reason")).unionByName(
        kinds.where("kind = 'view'").select("call_id", F.lit(99).alias("reason")))
    return M.inbound_call_mart(user_day(t), calls, reasons)


def payments(t: Tables) -> DataFrame:
    """Line items as transactions; returned ones are excess payments. The lines are dealt out by order once."""
    heads = t.orders.select(F.col("o_orderkey").alias("contract"), F.col("o_custkey").alias("client"))
    lines = t.lineitem.select(F.col("l_orderkey").alias("contract"), F.to_date("l_shipdate").alias("day"),
                              money("l_extendedprice", 2).alias("amount"),
                              S.case_of("l_returnflag", {16: ["R"]}, 17).alias("kind"))
    return lines.repartition(parts_for(t.lineitem.count()), "contract").distinct().join(heads, "contract")


@query("excess_payment_mart", f"""WITH {CONTRACT_PANEL}, h AS (SELECT contract, client, rd, abs(quantity - 50) AS size FROM contract_panel),
t AS (SELECT DISTINCT o_custkey AS client, l_orderkey AS contract, CAST(l_shipdate AS DATE) AS day, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_returnflag = 'R'),
w AS (SELECT h.contract, h.rd, SUM(CASE WHEN t.day = h.rd THEN amount END) AS now_amount,
  COUNT(CASE WHEN t.day >= {shift('h.rd', -3)} THEN 1 END) AS n3, SUM(CASE WHEN t.day >= {shift('h.rd', -3)} THEN amount END) AS a3,
  COUNT(*) AS n6, SUM(amount) AS a6 FROM h JOIN t ON t.contract = h.contract AND t.day BETWEEN {shift('h.rd', -6)} AND h.rd GROUP BY 1, 2),
e AS (SELECT p.client, p.rd, COUNT(t.amount) AS n, SUM(t.amount) AS a FROM (SELECT DISTINCT client, rd FROM h) p
  LEFT JOIN t ON t.client = p.client AND t.day <= p.rd GROUP BY 1, 2)
SELECT h.contract, h.client, CAST(h.rd AS VARCHAR) AS rd, round(CAST(COALESCE(now_amount, 0) AS DOUBLE) / NULLIF(size, 0), 8) AS paid_now,
  COALESCE(n3, 0) AS payments_3m, round(CAST(COALESCE(a3, 0) AS DOUBLE) / NULLIF(size, 0), 8) AS paid_3m,
  COALESCE(n6, 0) AS payments_6m, round(CAST(COALESCE(a6, 0) AS DOUBLE) / NULLIF(size, 0), 8) AS paid_6m,
  e.n AS payments_ever, CAST(COALESCE(e.a, 0) <> 0 AS INT) AS has_paid_ever
FROM h LEFT JOIN w ON w.contract = h.contract AND w.rd = h.rd JOIN e ON e.client = h.client AND e.rd = h.rd""")
def excess_payment_mart(t: Tables) -> DataFrame:
    history = contract_panel(t).select("contract", "client", "rd", (F.col("quantity") - 50).alias("instalment"))
    out = M.excess_payment_mart(history, payments(t))
    return out.withColumns({c: F.round(c, 8) for c in ("paid_now", "paid_3m", "paid_6m")})


@query("safe_ratio", """WITH s AS (SELECT l_orderkey, SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2))) AS off,
  SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2))) AS tax FROM lineitem GROUP BY 1)
SELECT l_orderkey, round(CAST(off AS DOUBLE) / NULLIF(CAST(tax AS DOUBLE), 0), 6) AS off_to_tax FROM s""")
def safe_ratio(t: Tables) -> DataFrame:
    price = money("l_extendedprice", 2)
    sums = t.lineitem.groupBy("l_orderkey").agg(F.sum(price * money("l_discount", 2)).alias("off"),
                                                F.sum(price * money("l_tax", 2)).alias("tax"))
    return sums.select("l_orderkey", F.round(S.ratio("off", "tax"), 6).alias("off_to_tax"))


@query("bureau_mart", f"""WITH {CONTRACT_PANEL}, {ORDER_LOG},
b AS (SELECT client, rd, MIN(start) AS start, SUM(balance) AS balance FROM contract_panel GROUP BY 1, 2),
lat AS (SELECT b.*, o.contract AS report, o.day AS created FROM b JOIN order_log o ON o.client = b.client AND o.day < b.rd
  QUALIFY row_number() OVER (PARTITION BY b.client, b.rd ORDER BY o.day DESC, o.contract DESC) = 1),
q AS (SELECT l_orderkey AS report, CAST(l_shipdate AS DATE) AS day FROM lineitem WHERE l_returnflag = 'A'),
qs AS (SELECT lat.client, lat.rd, COUNT(CASE WHEN {whole_months('lat.rd', 'q.day')} BETWEEN 0 AND 3 THEN 1 END) AS q3,
  COUNT(CASE WHEN {whole_months('lat.rd', 'q.day')} BETWEEN 0 AND 1 THEN 1 END) AS q1,
  COUNT(CASE WHEN CAST(trunc(abs({months_between('lat.start', 'q.day')})) AS INT) <= 1 THEN 1 END) AS q0
  FROM lat LEFT JOIN q ON q.report = lat.report GROUP BY 1, 2),
c AS (SELECT l_orderkey AS report, CAST(l_shipdate AS DATE) AS opened,
  CASE WHEN l_returnflag = 'R' THEN CAST(CAST(l_shipdate AS DATE) + INTERVAL 5 MONTH AS DATE) END AS closed,
  CAST(l_quantity AS INT) AS months, CASE WHEN l_linenumber = 1 THEN 18 ELSE l_linenumber END AS kind,
  CAST(l_linestatus = 'F' AS INT) AS own, CAST(round(l_tax * 1000) + 30 AS INT) AS dpd,
  CAST(l_extendedprice AS DECIMAL(18,2)) AS balance FROM lineitem WHERE l_discount < 0.085),
x AS (SELECT lat.client, lat.rd, lat.created, c.*, lat.balance AS own_balance, closed IS NULL
  AND CAST(opened + to_months(months) AS DATE) > lat.rd AS live, kind IN (2, 3, 4, 5) AS cash FROM lat JOIN c ON c.report = lat.report),
g AS (SELECT client, rd, created, COUNT(CASE WHEN live AND own = 0 AND kind = 18 THEN 1 END) AS m,
  COUNT(CASE WHEN live AND own = 0 AND cash THEN 1 END) AS fc, COUNT(CASE WHEN live AND own = 0 THEN 1 END) AS f,
  COUNT(CASE WHEN live AND own = 0 AND dpd < 90 THEN 1 END) AS fg,
  CAST(SUM(CASE WHEN live AND own = 0 THEN balance ELSE 0 END) AS DOUBLE) AS fb, COUNT(CASE WHEN live AND cash THEN 1 END) AS ac,
  COUNT(CASE WHEN live THEN 1 END) AS a, COUNT(CASE WHEN live AND cash AND own = 1 THEN 1 END) AS oc,
  COUNT(CASE WHEN live AND own = 1 THEN 1 END) AS o, COUNT(CASE WHEN cash THEN 1 END) AS allc, COUNT(*) AS n,
  COUNT(CASE WHEN {months_between('closed', 'opened')} < months - 1 AND cash THEN 1 END) AS early,
  CAST(SUM(own_balance) AS DOUBLE) AS ob FROM x GROUP BY 1, 2, 3)
SELECT g.client, CAST(g.rd AS VARCHAR) AS rd, round({months_between('g.rd', 'g.created')}, 6) AS months_since_report,
  m AS foreign_mortgages, fc AS foreign_cash_loans, f AS foreign_credits, fg AS foreign_good_credits, fb AS foreign_balance,
  round(ac / NULLIF(allc, 0), 6) AS active_cash_share, round(a / n, 6) AS active_share, round(oc / NULLIF(ac, 0), 6) AS own_cash_share,
  round(o / NULLIF(a, 0), 6) AS own_share, early AS early_closures, round(fb - ob, 4) AS balance_difference,
  round(fb / NULLIF(ob, 0), 6) AS balance_ratio,
  CASE WHEN {months_between('g.rd', 'g.created')} > 3 THEN -666.0 ELSE round(q3 / (4 - {months_between('g.rd', 'g.created')}), 6) END AS queries_per_month,
  q3 AS queries_3m, q1 AS queries_1m, q0 AS queries_at_application
FROM g JOIN qs ON qs.client = g.client AND qs.rd = g.rd""")
def bureau_mart(t: Tables) -> DataFrame:
    reports = order_log(t).select("client", F.col("contract").alias("report"), F.col("day").alias("created"))
    requests = t.lineitem.where("l_returnflag = 'A'").select(
        F.col("l_orderkey").alias("report"), F.to_date("l_shipdate").alias("day"), F.lit(1).alias("reason"))
    opened = F.to_date("l_shipdate")
    credits = t.lineitem.select(
        F.col("l_orderkey").alias("report"), opened.alias("opened"),
        F.when(F.col("l_returnflag") == "R", F.add_months(opened, 5)).alias("closed"),
        F.col("l_quantity").cast("int").alias("months"), S.case_of("l_linenumber", {18: [1]}, F.col("l_linenumber")).alias("credit_type"),
        (F.col("l_linestatus") == "F").cast("int").alias("own"), (F.round(F.col("l_tax") * 1000) + 30).cast("int").alias("dpd"),
        money("l_extendedprice", 2).alias("balance"), F.when(F.col("l_discount") < 0.085, 1).otherwise(2).alias("relationship"))
    out = M.credit_bureau_mart(contract_panel(t, dealt=False).select("client", "rd", "start", "balance"), reports, requests, credits)
    six = ["months_since_report", "active_cash_share", "active_share", "own_cash_share", "own_share", "balance_ratio",
           "queries_per_month"]
    return out.withColumns({c: F.round(c, 6) for c in six} | {
        "balance_difference": F.round(F.col("balance_difference").cast("double"), 4)})


AS_OF = "2002-01-01"


@query("loan_mart", f"""WITH {CONTRACT_PANEL}, {ORDER_LOG}, {PRIORITY_HISTORY},
app AS (SELECT contract AS application, client, day, CASE WHEN status = 'F' THEN contract END AS contract,
  CASE WHEN status = 'O' THEN 'BankRejected' WHEN status = 'P' AND priority = '1-URGENT' THEN 'ClientRejected'
    WHEN status = 'P' AND priority = '2-HIGH' THEN NULL WHEN status = 'P' THEN 'Other' ELSE 'NotRejected' END AS status,
  price AS income, priority AS education, CAST(day - INTERVAL 360 MONTH AS DATE) AS birth, length(priority) AS marital,
  CAST(left(priority, 1) AS INT) AS risk FROM order_log),
best AS (SELECT a.*, h.priority AS segment, CAST(trunc({months_between(f"DATE '{AS_OF}'", 'a.birth')} / 12) AS INT) AS age
  FROM (SELECT * FROM app QUALIFY row_number() OVER (PARTITION BY client, day ORDER BY CASE WHEN contract IS NOT NULL THEN 1
    WHEN status IS NULL OR status = 'ClientRejected' THEN 2 WHEN status = 'BankRejected' THEN 3 ELSE 4 END, application) = 1) a
  LEFT JOIN priority_history h ON h.client = a.client AND a.day >= h.valid_from AND (h.valid_to IS NULL OR a.day <= h.valid_to)),
sav AS (SELECT client, last_day(day) AS month, SUM(price) AS savings FROM order_log GROUP BY 1, 2),
opened AS (SELECT p.contract, p.client, MIN(p.start) AS start, MAX({months_between('p.planned_end', 'p.start')}) AS tenor,
  COALESCE(MAX(s.savings), 0) AS savings0 FROM contract_panel p LEFT JOIN sav s ON s.client = p.client
  AND abs({months_between('s.month', 'p.start')}) < 1 GROUP BY 1, 2),
lifa AS (SELECT o.contract, o.client, o.tenor, o.savings0, b.* EXCLUDE (contract, client) FROM opened o JOIN best b ON b.contract = o.contract AND b.client = o.client),
appl AS (SELECT p.client, p.rd, COUNT(b.application) AS n, MAX(b.risk) AS risk, MAX(b.income) AS income, MAX(b.marital) AS marital,
  COUNT(CASE WHEN b.status = 'BankRejected' THEN 1 END) AS br, COUNT(CASE WHEN b.status = 'ClientRejected' THEN 1 END) AS cr
  FROM contract_panel p LEFT JOIN best b ON b.client = p.client AND b.day BETWEEN {shift('p.rd', -3)} AND p.rd AND b.day > p.start GROUP BY 1, 2)
SELECT p.contract, p.client, CAST(p.rd AS VARCHAR) AS rd, appl.n AS applications, CAST(appl.n > 0 AS INT) AS has_application,
  CAST(CAST(COALESCE(appl.risk <> l.risk, FALSE) AS INT) AS VARCHAR) AS has_risk_change,
  CAST(CAST(COALESCE(appl.marital <> l.marital, FALSE) AS INT) AS VARCHAR) AS has_marital_change,
  CAST(appl.income - l.income AS DOUBLE) AS income_change, CAST(CAST(appl.br > 0 AS INT) AS VARCHAR) AS had_bank_rejection,
  CAST(CAST(appl.cr > 0 AS INT) AS VARCHAR) AS had_client_rejection, l.age, l.education, CAST(l.income AS DOUBLE) AS income,
  l.education AS income_type, l.marital, l.risk, l.segment, l.tenor AS tenor_months, CAST(l.savings0 AS DOUBLE) AS savings_at_start,
  round({months_between('p.rd', 'l.day')}, 6) AS months_since_application,
  round(CAST(s.savings AS DOUBLE) / NULLIF(CAST(p.balance AS DOUBLE), 0), 6) AS savings_to_balance
FROM contract_panel p JOIN appl ON appl.client = p.client AND appl.rd = p.rd
LEFT JOIN lifa l ON l.contract = p.contract AND l.client = p.client LEFT JOIN sav s ON s.client = p.client AND s.month = p.rd""")
def loan_mart(t: Tables) -> DataFrame:
    log = order_log(t)
    rejection = S.case_when([
        (F.col("status") == "O", F.lit("Bank")), ((F.col("status") == "P") & (F.col("priority") == "1-URGENT"), F.lit("Klient")),
        ((F.col("status") == "P") & (F.col("priority") == "2-HIGH"), F.lit(None).cast("string")),
        (F.col("status") == "P", F.lit("Late"))], F.lit(""))
    applications = log.select(
        F.col("contract").alias("application"), "client", "day", F.when(F.col("status") == "F", F.col("contract")).alias("contract"),
        rejection.alias("rejection"), F.col("price").alias("income"), F.col("priority").alias("education"),
        F.add_months("day", -360).alias("birth"), F.length("priority").alias("marital"), F.col("price").alias("own"),
        F.col("priority").alias("income_type"), F.lit(6).alias("product"))
    risk = log.select(F.col("contract").alias("application"), F.left("priority", F.lit(1)).cast("int").alias("risk"))
    segments = priority_history(t).withColumnRenamed("priority", "segment")
    savings = log.groupBy("client", F.last_day("day").alias("month")).agg(F.sum("price").alias("savings"))
    history = contract_panel(t).select("contract", "client", "rd", "start", "planned_end", "balance")
    out = M.loan_application_mart(history, applications, risk, segments, savings, F.lit(AS_OF).cast("date"))
    return out.withColumns({c: F.round(c, 6) for c in ("months_since_application", "savings_to_balance")})


@query("deposit_mart", f"""WITH {CONTRACT_PANEL},
d AS (SELECT client, contract, rd, start, balance, CAST(line_status = 'O' AS INT) AS active, CAST(flag = 'A' AS INT) AS salary FROM contract_panel),
tx AS (SELECT l_orderkey AS contract, last_day(CAST(l_shipdate AS DATE)) AS day, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_suppkey AS account,
  s_nationkey AS bank, CAST(l_returnflag = 'R' AS INT) AS nm, CAST(l_linestatus = 'F' AS INT) AS sn, CASE WHEN l_linenumber <= 3 THEN 17 ELSE 18 END AS kind
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey),
uq AS (SELECT kind, contract, day, amount, account, bank, MAX(nm) * MAX(sn) AS same FROM tx GROUP BY 1, 2, 3, 4, 5, 6),
bb AS (SELECT kind, contract, day, bank, same, SUM(amount) AS amount, COUNT(*) AS n FROM uq GROUP BY 1, 2, 3, 4, 5),
inn AS (SELECT contract, day AS rd, SUM(amount) AS amount, SUM(n) AS n, SUM(amount * same) AS sa, SUM(n * same) AS sn FROM bb WHERE kind = 17 GROUP BY 1, 2),
op0 AS (SELECT l_orderkey AS contract, last_day(CAST(l_shipdate AS DATE)) AS rd, COUNT(CASE WHEN l_linenumber = 1 THEN 1 END) AS so,
  SUM(CASE WHEN l_linenumber = 1 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS ss, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS os, COUNT(*) AS ops,
  COUNT(CASE WHEN l_linenumber = 2 THEN 1 END) AS atm, COUNT(CASE WHEN l_linenumber = 3 THEN 1 END) AS branch, COUNT(CASE WHEN l_linenumber = 4 THEN 1 END) AS tin,
  SUM(CASE WHEN l_linenumber >= 5 THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS outg,
  SUM(CASE WHEN l_linenumber IN (2, 3) THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END) AS ba FROM lineitem GROUP BY 1, 2),
op AS (SELECT contract, rd, CAST(so > 0 AS INT) AS hs, CAST(so = 0 AND lag(ss, 1, 0) OVER w > 0 AS INT) AS hc, os, ops,
  SUM(atm) OVER (w ROWS 2 PRECEDING) AS atm, SUM(branch) OVER (w ROWS 2 PRECEDING) AS branch, SUM(tin) OVER (w ROWS 2 PRECEDING) AS tin,
  round(CAST(SUM(outg) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) / COUNT(*) OVER (w ROWS UNBOUNDED PRECEDING), 6) AS om,
  MAX(outg) OVER (w ROWS 2 PRECEDING) AS omax, CAST(MAX(ba) OVER (w ROWS 2 PRECEDING) > 0 AS INT) AS hb FROM op0 WINDOW w AS (PARTITION BY contract ORDER BY rd)),
v AS (SELECT d.client, d.rd, MAX({months_between('d.rd', 'd.start')}) AS age, COUNT(CASE WHEN d.balance * active > 0 THEN 1 END) AS nz, SUM(active) AS acc,
  SUM(d.balance) AS bal, MAX(salary) AS sal, SUM(inn.amount) AS ta, SUM(inn.n) AS tc, SUM(inn.sa) AS sa, SUM(inn.sn) AS sn, MAX(hs) AS hs, MAX(hc) AS hc, SUM(os) AS os, SUM(ops) AS ops,
  CASE WHEN (SUM(atm) > 0 OR SUM(branch) > 0) AND SUM(tin) = 0 THEN 'CashOnlyPayment' WHEN SUM(atm) = 0 AND SUM(branch) = 0 AND SUM(tin) > 0 THEN 'TransferOnlyPayment'
    WHEN (SUM(atm) > 0 OR SUM(branch) > 0) AND SUM(tin) > 0 THEN 'MixedPayment' ELSE 'LackOfTransfer' END AS pt,
  CAST(SUM(CAST(om AS DECIMAL(24,6))) AS DOUBLE) / COUNT(om) AS om, MAX(omax) AS omax, MAX(hb) AS hb
  FROM d LEFT JOIN op ON op.contract = d.contract AND op.rd = d.rd LEFT JOIN inn ON inn.contract = d.contract AND inn.rd = d.rd GROUP BY 1, 2),
vw AS (SELECT *, CAST(SUM(bal) OVER w AS DOUBLE) / COUNT(bal) OVER w AS before, acc - MAX(acc) OVER w AS step FROM v
  WINDOW w AS (PARTITION BY client ORDER BY rd ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING)),
pairs AS (SELECT d.client, d.rd, bb.kind, bb.bank, bb.amount, {months_between('d.rd', 'bb.day')} AS dist FROM d JOIN bb ON bb.contract = d.contract),
near AS (SELECT client, rd, kind, bank, SUM(amount) AS a, COUNT(*) AS n FROM pairs WHERE dist >= 1 AND dist < 3 GROUP BY 1, 2, 3, 4),
wide AS (SELECT client, rd, kind, bank, SUM(amount) AS a FROM pairs WHERE dist >= CASE kind WHEN 17 THEN -6 ELSE -5 END AND dist < 3 GROUP BY 1, 2, 3, 4),
na AS (SELECT client, rd, kind, bank FROM near QUALIFY row_number() OVER (PARTITION BY client, rd, kind ORDER BY a DESC, bank) = 1),
nc AS (SELECT client, rd, kind, bank FROM near QUALIFY row_number() OVER (PARTITION BY client, rd, kind ORDER BY n DESC, bank) = 1),
wa AS (SELECT client, rd, kind, bank FROM wide QUALIFY row_number() OVER (PARTITION BY client, rd, kind ORDER BY a DESC, bank) = 1)
SELECT v.client, CAST(v.rd AS VARCHAR) AS rd, round(age, 6) AS account_months, nz AS accounts_with_balance, CAST(acc AS BIGINT) AS accounts, CAST(bal AS DOUBLE) AS balance,
  sal AS has_salary, CAST(COALESCE(ta, 0) AS DOUBLE) AS transfer_amount, CAST(COALESCE(tc, 0) AS BIGINT) AS transfer_count,
  CAST(COALESCE(sa, 0) AS DOUBLE) AS same_name_amount, CAST(COALESCE(v.sn, 0) AS BIGINT) AS same_name_count, hs AS has_standing_order, hc AS has_cancelled_order,
  CAST(os AS DOUBLE) AS operation_sum, CAST(ops AS BIGINT) AS operations, pt AS payment_type, round(om, 8) AS outgoing_mean, CAST(omax AS DOUBLE) AS outgoing_max,
  hb AS had_branch_operation, round(CASE WHEN om = 0 THEN 1 ELSE CAST(omax AS DOUBLE) / om END, 6) AS outgoing_ratio,
  CAST(COALESCE(step, 0) > 0 AS INT) AS has_opened_account, CAST(COALESCE(step, 0) < 0 AS INT) AS has_closed_account,
  round(CAST(bal AS DOUBLE) - COALESCE(before, 0), 6) AS balance_diff, a1.bank AS by_amount_sender, c1.bank AS by_count_sender,
  a2.bank AS by_amount_addressee, c2.bank AS by_count_addressee, w1.bank AS by_amount_sender_wide, w2.bank AS by_amount_addressee_wide
FROM vw v LEFT JOIN na a1 ON a1.client = v.client AND a1.rd = v.rd AND a1.kind = 17 LEFT JOIN na a2 ON a2.client = v.client AND a2.rd = v.rd AND a2.kind = 18
LEFT JOIN nc c1 ON c1.client = v.client AND c1.rd = v.rd AND c1.kind = 17 LEFT JOIN nc c2 ON c2.client = v.client AND c2.rd = v.rd AND c2.kind = 18
LEFT JOIN wa w1 ON w1.client = v.client AND w1.rd = v.rd AND w1.kind = 17 LEFT JOIN wa w2 ON w2.client = v.client AND w2.rd = v.rd AND w2.kind = 18""")
def deposit_mart(t: Tables) -> DataFrame:
    panel = contract_panel(t, dealt=False)
    deposits = panel.select("client", "contract", "rd", "start", "balance", (F.col("line_status") == "O").cast("int").alias("active"),
                            (F.col("flag") == "A").cast("int").alias("salary"))
    price, line = money("l_extendedprice", 2), F.col("l_linenumber")
    month = F.last_day(F.to_date("l_shipdate"))
    banks = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("bank"))
    transactions = lookup_join(t.lineitem, banks, ["l_suppkey"], "inner").select(
        F.col("l_orderkey").alias("contract"), month.alias("day"), price.alias("amount"), F.col("l_suppkey").alias("account"), "bank",
        (F.col("l_returnflag") == "R").cast("int").alias("same_name"), (F.col("l_linestatus") == "F").cast("int").alias("same_surname"),
        F.when(line <= 3, 17).otherwise(18).alias("kind"))
    zero = F.lit(0).cast("decimal(18,2)")
    part = lambda cond: F.sum(F.when(cond, price).otherwise(zero))
    # a contract's months and the windows over them lie together, so its lines are dealt out once
    lines = t.lineitem.select("l_orderkey", "l_shipdate", "l_linenumber", "l_extendedprice").repartition("l_orderkey")
    operations = lines.groupBy(F.col("l_orderkey").alias("contract"), month.alias("rd")).agg(
        S.count_if(line == 1).alias("standing_orders"), part(line == 1).alias("standing_sum"), F.sum(price).alias("operation_sum"),
        F.count(F.lit(1)).alias("operations"), S.count_if(line == 2).alias("cash_atm"), S.count_if(line == 3).alias("cash_branch"),
        S.count_if(line == 4).alias("transfers_in"), part(line >= 5).alias("outgoing"), part(line.isin(2, 3)).alias("branch_amount"))
    out = M.deposit_mart(panel.select("client", "rd").distinct(), deposits, transactions, operations)
    six = {c: F.round(c, 6) for c in ("account_months", "outgoing_ratio", "balance_diff")}
    return out.withColumns(six | {"outgoing_mean": F.round("outgoing_mean", 8)})
