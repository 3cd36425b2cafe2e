"""Panels, look-back windows and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators import aggregates as A
from panelkit.operators import joins as J
from panelkit.operators import lookback as L
from panelkit.operators import markov, rows, windows
from panelkit.plans.registry import query
from panelkit.plans.views import (CLIENT_PANEL, CONTRACT_PANEL, EVENT_LOG, ORDER_LOG, USER_DAY, client_panel,
                                  contract_panel, event_log, money, order_log, shift, user_day, whole_months)
from panelkit.scale import lookup_join
from panelkit.tables import Tables


@query("client_panel", f"WITH {CLIENT_PANEL} SELECT client, CAST(rd AS VARCHAR) AS rd FROM client_panel")
def client_panel_query(t: Tables) -> DataFrame:
    return client_panel(t)


@query("contract_panel", f"""WITH {CONTRACT_PANEL}
SELECT contract, client, CAST(rd AS VARCHAR) AS rd, CAST(start AS VARCHAR) AS start,
  CAST(planned_end AS VARCHAR) AS planned_end, CAST(balance AS DOUBLE) AS balance, lines FROM contract_panel""")
def contract_panel_query(t: Tables) -> DataFrame:
    return contract_panel(t).select("contract", "client", "rd", "start", "planned_end", "balance", "lines")


@query("lookback_3m", f"""WITH {CLIENT_PANEL}, {ORDER_LOG}
SELECT p.client, CAST(p.rd AS VARCHAR) AS rd, COUNT(o.contract) AS orders_3m,
  COUNT(CASE WHEN o.priority = '1-URGENT' THEN 1 END) AS urgent_3m,
  CAST(COALESCE(SUM(o.price), 0) AS DOUBLE) AS spend_3m,
  CAST(COALESCE(SUM(CASE WHEN o.priority = '5-LOW' THEN o.price END), 0) AS DOUBLE) AS low_spend_3m
FROM client_panel p LEFT JOIN order_log o
  ON o.client = p.client AND o.day > {shift('p.rd', -3)} AND o.day <= p.rd
GROUP BY p.client, p.rd""")
def lookback_3m(t: Tables) -> DataFrame:
    measures = {"orders": L.count(), "urgent": L.count(F.col("priority") == "1-URGENT"), "spend": L.total("price"),
                "low_spend": L.total("price", F.col("priority") == "5-LOW")}
    span = L.open_window(F.add_months("rd", -3), "rd")
    return L.lookback_agg(client_panel(t), order_log(t), ["client"], "rd", "day", {"_3m": span}, measures)


@query("lookback_30d", f"""WITH {USER_DAY}, {EVENT_LOG}
SELECT p.client, CAST(p.rd AS VARCHAR) AS rd,
  COUNT(CASE WHEN e.kind = 'purchase' THEN 1 END) AS purchases_30d,
  COUNT(CASE WHEN e.day >= p.rd - 6 AND e.kind = 'purchase' THEN 1 END) AS purchases_7d,
  CAST(MAX(e.value) AS DOUBLE) AS top_30d, CAST(MAX(CASE WHEN e.day >= p.rd - 6 THEN e.value END) AS DOUBLE) AS top_7d,
  CAST(SUM(e.value) AS DOUBLE) / COUNT(e.value) AS mean_30d,
  CAST(SUM(CASE WHEN e.day >= p.rd - 6 THEN e.value END) AS DOUBLE)
    / NULLIF(COUNT(CASE WHEN e.day >= p.rd - 6 THEN e.value END), 0) AS mean_7d
FROM user_day p JOIN event_log e ON e.client = p.client AND e.day BETWEEN p.rd - 29 AND p.rd
GROUP BY p.client, p.rd""")
def lookback_30d(t: Tables) -> DataFrame:
    measures = {"purchases": L.count(F.col("kind") == "purchase"), "top": L.highest("value"), "mean": L.mean("value")}
    return L.window_agg(user_day(t), event_log(t), ["client"], "rd", "day",
                        {"_30d": L.days_back("rd", 30), "_7d": L.days_back("rd", 7)}, measures)


@query("lookback_rows", f"""WITH {CLIENT_PANEL}, {ORDER_LOG}
SELECT p.client, CAST(p.rd AS VARCHAR) AS rd, o.contract, CAST(o.day AS VARCHAR) AS day
FROM client_panel p JOIN order_log o ON o.client = p.client AND o.day BETWEEN {shift('p.rd', -1)} AND p.rd""")
def lookback_rows_query(t: Tables) -> DataFrame:
    return L.lookback_rows(client_panel(t), order_log(t), ["client"], "rd", "day", L.months_back("rd", 1)).select(
        "client", "rd", "contract", "day")


@query("history_counts", f"""WITH {CLIENT_PANEL}, {ORDER_LOG}
SELECT p.client, CAST(p.rd AS VARCHAR) AS rd, COUNT(o.contract) AS orders_ever,
  CAST(COALESCE(SUM(o.price), 0) AS DOUBLE) AS spend_ever, CAST(MIN(o.day) AS VARCHAR) AS first_order
FROM client_panel p LEFT JOIN order_log o ON o.client = p.client AND o.day <= p.rd GROUP BY p.client, p.rd""")
def history_counts(t: Tables) -> DataFrame:
    measures = {"orders_ever": L.count(), "spend_ever": L.total("price"), "first_order": L.lowest("day")}
    return L.history_agg(client_panel(t), order_log(t), ["client"], "rd", "day", measures)


@query("months_between_flags", f"""WITH {CLIENT_PANEL}, {ORDER_LOG}
SELECT p.client, CAST(p.rd AS VARCHAR) AS rd,
  COUNT(CASE WHEN {whole_months('p.rd', 'o.day')} BETWEEN 1 AND 3 THEN 1 END) AS orders_1_3,
  COUNT(CASE WHEN {whole_months('p.rd', 'o.day')} BETWEEN 3 AND 6 THEN 1 END) AS orders_3_6,
  COUNT(CASE WHEN {whole_months('p.rd', 'o.day')} BETWEEN -3 AND 0 THEN 1 END) AS orders_next,
  CAST(COUNT(CASE WHEN {whole_months('p.rd', 'o.day')} BETWEEN 1 AND 3 AND o.status = 'F' THEN 1 END) > 0 AS INT) AS had_f
FROM client_panel p LEFT JOIN order_log o ON o.client = p.client GROUP BY p.client, p.rd""")
def months_between_flags(t: Tables) -> DataFrame:
    panel, log = client_panel(t), order_log(t)
    spans = {"_1_3": L.month_distance("rd", 1, 3), "_3_6": L.month_distance("rd", 3, 6),
             "_next": L.month_distance("rd", -3, 0)}
    counted = L.lookback_agg(panel, log, ["client"], "rd", "day", spans, {"orders": L.count()})
    return L.exists_flag(counted, log, ["client"], "rd", "day", L.month_distance("rd", 1, 3), "had_f",
                         F.col("status") == "F")


@query("other_contracts", f"""WITH {ORDER_LOG}, p AS (SELECT DISTINCT client, contract, last_day(day) AS rd FROM order_log)
SELECT p.client, p.contract, CAST(p.rd AS VARCHAR) AS rd, COUNT(o.contract) AS others
FROM p LEFT JOIN order_log o ON o.client = p.client AND o.contract <> p.contract
  AND {whole_months('p.rd', 'o.day')} BETWEEN 1 AND 3 GROUP BY p.client, p.contract, p.rd""")
def other_contracts(t: Tables) -> DataFrame:
    log = order_log(t)
    panel = log.select("client", "contract", F.last_day("day").alias("rd")).distinct()
    return L.other_rows(panel, log, ["client"], "contract", "rd", "day", L.month_distance("rd", 1, 3))


def priority_history(t: Tables) -> DataFrame:
    """Priority of a client valid from an order day to the day before the next order day."""
    # texts are combined by sorting: the orders are dealt out before, so that no split is sorted whole
    per_day = (order_log(t).repartition("client", "day").groupBy("client", "day")
               .agg(F.min_by("priority", "contract").alias("priority")))
    after = windows.lead_label(per_day, "day", ["client"], ["day"], [1], "next_day")
    return after.select("client", "priority", F.col("day").alias("valid_from"),
                        F.date_add("next_day", -1).alias("valid_to"))


PRIORITY_HISTORY = """per_day AS (SELECT client, day, arg_min(priority, contract) AS priority FROM order_log GROUP BY 1, 2),
priority_history AS (SELECT client, priority, day AS valid_from,
  lead(day) OVER (PARTITION BY client ORDER BY day) - 1 AS valid_to FROM per_day)"""


@query("interval_dim", f"""WITH {CONTRACT_PANEL}, {ORDER_LOG}, {PRIORITY_HISTORY}
SELECT c.contract, c.client, CAST(c.rd AS VARCHAR) AS rd, h.priority
FROM contract_panel c LEFT JOIN priority_history h ON h.client = c.client AND c.rd >= h.valid_from
  AND (h.valid_to IS NULL OR c.rd <= h.valid_to)""")
def interval_dim(t: Tables) -> DataFrame:
    facts = rows.materialise(contract_panel(t).select("contract", "client", "rd"))
    return J.interval_join(facts, priority_history(t), ["client"], "rd", "valid_from", "valid_to", ["priority"]).select(
        "contract", "client", "rd", "priority")


@query("asof_latest", f"""WITH {CONTRACT_PANEL}, {ORDER_LOG}, p AS (SELECT DISTINCT client, rd FROM contract_panel),
m AS (SELECT p.client, p.rd, o.contract, o.price, o.day,
  row_number() OVER (PARTITION BY p.client, p.rd ORDER BY o.day DESC, o.contract DESC) AS n
  FROM p LEFT JOIN order_log o ON o.client = p.client AND o.day < p.rd)
SELECT client, CAST(rd AS VARCHAR) AS rd, contract AS last_contract, CAST(day AS VARCHAR) AS last_day,
  CAST(price AS DOUBLE) AS last_price FROM m WHERE n = 1""")
def asof_latest_query(t: Tables) -> DataFrame:
    panel = contract_panel(t).select("client", "rd").distinct()
    log = order_log(t).select("client", "day", F.col("contract").alias("last_contract"), F.col("day").alias("last_day"),
                              F.col("price").alias("last_price"))
    return L.asof_latest(panel, log, ["client"], "rd", "day", ["last_contract", "last_day", "last_price"],
                         ["last_contract"])


@query("daily_next_state", f"""WITH {EVENT_LOG}, c AS (SELECT client, day, kind, COUNT(*) AS n FROM event_log GROUP BY ALL),
s AS (SELECT client, CAST(day - DATE '2024-01-01' AS INT) AS period, kind AS state FROM c
  QUALIFY row_number() OVER (PARTITION BY client, day ORDER BY n DESC, kind) = 1)
SELECT a.client, a.period, a.state, b.state AS state_next FROM s a JOIN s b
  ON b.client = a.client AND b.period = a.period + 1""")
def next_period_pairs(t: Tables) -> DataFrame:
    return J.next_period(user_states(t), ["client"], "period", ["state"])


def user_states(t: Tables) -> DataFrame:
    """Most frequent event type per user and day, the first name on ties; day number as period."""
    per = event_log(t).groupBy("client", "day", "kind").agg(F.count(F.lit(1)).alias("n"))
    return (per.groupBy("client", "day").agg(F.min_by("kind", F.struct(-F.col("n"), F.col("kind"))).alias("state"))
            .select("client", F.datediff("day", F.lit("2024-01-01").cast("date")).alias("period"), "state"))


USER_STATES = f"""{EVENT_LOG}, kinds AS (SELECT client, day, kind, COUNT(*) AS n FROM event_log GROUP BY ALL),
user_states AS (SELECT client, CAST(day - DATE '2024-01-01' AS INT) AS period, kind AS state FROM kinds
  QUALIFY row_number() OVER (PARTITION BY client, day ORDER BY n DESC, kind) = 1)"""


@query("no_exit_states", """WITH s AS (SELECT o_custkey AS client, o_orderpriority AS state,
  lead(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS state_next FROM orders)
SELECT DISTINCT client, state AS state_from FROM s EXCEPT SELECT client, state FROM s WHERE state_next <> state""")
def no_exit(t: Tables) -> DataFrame:
    """Priorities a client has never left for another one with the next order."""
    order = W.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    states = t.orders.select(F.col("o_custkey").alias("client"), F.col("o_orderpriority").alias("state"),
                             F.row_number().over(order).alias("period"))
    moved = J.next_period(states, ["client"], "period", ["state"]).where("state <> state_next")
    pair = lambda df: df.select("client", F.col("state").alias("state_from")).distinct()
    return J.anti(pair(states), pair(moved), ["client", "state_from"])


@query("outer_coalesce", """WITH a AS (SELECT o_custkey AS client, COUNT(*) AS orders FROM orders GROUP BY 1),
b AS (SELECT user_id AS client, COUNT(*) AS events FROM events GROUP BY 1)
SELECT COALESCE(a.client, b.client) AS client, COALESCE(orders, 0) AS orders, COALESCE(events, 0) AS events
FROM a FULL JOIN b ON a.client = b.client""")
def outer_coalesce(t: Tables) -> DataFrame:
    def counted(df: DataFrame, key: str, name: str) -> DataFrame:
        return df.groupBy(F.col(key).alias("client")).agg(F.count(F.lit(1)).alias(name))

    return J.full_outer(counted(t.orders, "o_custkey", "orders"), counted(t.events, "user_id", "events"), ["client"],
                        {"orders": 0, "events": 0})


@query("cross_grid", """SELECT p_partkey, r_regionkey, r_name FROM part CROSS JOIN region""")
def cross_grid(t: Tables) -> DataFrame:
    return J.cross(t.part.select("p_partkey"), t.region.select("r_regionkey", "r_name"))


@query("subset_one_hop", """SELECT * EXCLUDE (o_orderdate), CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate
FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def subset_one_hop(t: Tables) -> DataFrame:
    keys = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return rows.subset_by_keys(t.orders, keys, ["o_custkey"]).withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("subset_two_hop", """SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_orderkey IN
(SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))""")
def subset_two_hop(t: Tables) -> DataFrame:
    keys = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    bridge = t.orders.select("o_custkey", F.col("o_orderkey").alias("l_orderkey"))
    return rows.subset_by_parent_keys(t.lineitem.select("l_orderkey", "l_partkey", "l_quantity"), ["l_orderkey"],
                                      bridge, keys, ["o_custkey"])


@query("dedupe_then_sum", """WITH u AS (SELECT l_orderkey, l_partkey, CAST(l_quantity AS INT) AS quantity,
  MAX(CAST(l_returnflag = 'R' AS INT)) AS returned, MAX(CAST(l_linestatus = 'F' AS INT)) AS closed
  FROM lineitem GROUP BY 1, 2, 3)
SELECT l_partkey, returned * closed AS returned_closed, CAST(SUM(quantity) AS BIGINT) AS quantity, COUNT(*) AS transfers
FROM u GROUP BY 1, 2""")
def dedupe_then_sum(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("quantity", F.col("l_quantity").cast("int"))
    keep = {"returned": F.max((F.col("l_returnflag") == "R").cast("int")),
            "closed": F.max((F.col("l_linestatus") == "F").cast("int"))}
    return A.dedupe_then_agg(lines, ["l_orderkey", "l_partkey", "quantity"], keep,
                             ["l_partkey", (F.col("returned") * F.col("closed")).alias("returned_closed")],
                             quantity=F.sum("quantity"), transfers=F.count(F.lit(1)))


MONTH_SPEND = f"""{ORDER_LOG}, spend AS (SELECT client, last_day(day) AS rd, SUM(price) AS spend, COUNT(*) AS n
  FROM order_log GROUP BY 1, 2)"""


@query("moving_frames", f"""WITH {MONTH_SPEND}
SELECT client, CAST(rd AS VARCHAR) AS rd, CAST(spend AS DOUBLE) AS spend, n,
  CAST(lag(spend) OVER w AS DOUBLE) AS prev_spend,
  round(CAST(SUM(n) OVER (w ROWS 11 PRECEDING) AS DOUBLE) / COUNT(n) OVER (w ROWS 11 PRECEDING), 6) AS year_mean,
  CAST(SUM(spend) OVER (w ROWS 2 PRECEDING) AS DOUBLE) AS recent_sum,
  CAST(MAX(spend) OVER (w ROWS 2 PRECEDING) AS DOUBLE) AS recent_max,
  CAST(CAST(SUM(n) OVER (w ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS BIGINT) AS running_orders,
  CAST(MAX(n) OVER (w ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS BIGINT) AS past_max
FROM spend WINDOW w AS (PARTITION BY client ORDER BY rd)""")
def moving_frames(t: Tables) -> DataFrame:
    spend = order_log(t).groupBy("client", F.last_day("day").alias("rd")).agg(
        F.sum("price").alias("spend"), F.count(F.lit(1)).alias("n"))
    keys, order = ["client"], ["rd"]
    out = windows.lag_of(spend, "spend", keys, order, "prev_spend")
    for col, lo, hi, fn, name in [("n", -11, 0, "avg", "year_mean"), ("spend", -2, 0, "sum", "recent_sum"),
                                  ("spend", -2, 0, "max", "recent_max"), ("n", None, 0, "sum", "running_orders"),
                                  ("n", -3, -1, "max", "past_max")]:
        out = windows.moving(out, col, keys, order, lo, hi, fn, name)
    return out.withColumn("year_mean", F.round("year_mean", 6))


@query("best_application", """SELECT o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderkey, o_orderstatus
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey, CAST(o_orderdate AS DATE) ORDER BY
  CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, o_orderkey) = 1""")
def best_application(t: Tables) -> DataFrame:
    log = t.orders.select("o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderkey", "o_orderstatus")
    rank = S.case_of("o_orderstatus", {1: ["F"], 2: ["O"]}, 3)
    return windows.best_row(log, ["o_custkey", "day"], [rank, F.col("o_orderkey")])


@query("latest_row", """SELECT o_custkey, o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) = 1""")
def latest_row(t: Tables) -> DataFrame:
    log = t.orders.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))
    return windows.latest_row(log, ["o_custkey"], "day", ["o_orderkey"])


@query("main_partner", """WITH b AS (SELECT l_orderkey, s_nationkey AS partner, SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS amount,
  COUNT(*) AS n FROM lineitem JOIN supplier ON s_suppkey = l_suppkey GROUP BY 1, 2)
SELECT a.l_orderkey, a.partner AS main_by_amount, c.partner AS main_by_count FROM
 (SELECT l_orderkey, partner FROM b QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY amount DESC, partner) = 1) a
JOIN (SELECT l_orderkey, partner FROM b QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY n DESC, partner) = 1) c
  ON a.l_orderkey = c.l_orderkey""")
def main_partner(t: Tables) -> DataFrame:
    nations = t.supplier.select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("partner"))
    lines = t.lineitem.select("l_orderkey", "l_suppkey", money("l_extendedprice", 2).alias("amount"))
    per = lookup_join(lines, nations, ["l_suppkey"], "inner")
    return windows.main_partner(per, ["l_orderkey"], "partner", "amount")


@query("max_rows", """SELECT p_brand, p_partkey, p_size FROM part
QUALIFY p_size = MAX(p_size) OVER (PARTITION BY p_brand)""")
def max_rows(t: Tables) -> DataFrame:
    return windows.max_rows(t.part.select("p_brand", "p_partkey", "p_size"), ["p_brand"], "p_size")


@query("top_per_group", """SELECT p_brand, p_partkey, p_retailprice FROM part
QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) = 1""")
def top_per_group(t: Tables) -> DataFrame:
    return windows.top_per_group(t.part.select("p_brand", "p_partkey", "p_retailprice"), ["p_brand"],
                                 [-F.col("p_retailprice"), F.col("p_partkey")])


@query("top_rows", """SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20""")
def top_rows(t: Tables) -> DataFrame:
    return windows.top_k(t.customer.select("c_custkey", "c_name", "c_acctbal"), [F.desc("c_acctbal"), F.col("c_custkey")], 20)


@query("project_filter_sort", """SELECT o_orderkey AS id, o_custkey AS client, o_totalprice AS price FROM orders
WHERE (o_orderstatus = 'F' OR o_orderpriority IN ('1-URGENT', '2-HIGH')) AND o_totalprice BETWEEN 1000 AND 300000
  AND o_orderpriority NOT IN ('5-LOW') AND o_custkey IS NOT NULL AND o_orderstatus <> 'P'
ORDER BY price DESC, id""")
def project_filter_sort(t: Tables) -> DataFrame:
    wanted = ((F.col("o_orderstatus") == "F") | F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")) \
        & F.col("o_totalprice").between(1000, 300000) & ~F.col("o_orderpriority").isin("5-LOW") \
        & F.col("o_custkey").isNotNull() & (F.col("o_orderstatus") != "P")
    picked = rows.select(rows.where(t.orders, wanted), ["o_orderkey", "o_custkey", "o_totalprice"],
                         {"o_orderkey": "id", "o_custkey": "client", "o_totalprice": "price"})
    return windows.sort(picked, [F.desc("price"), "id"])


@query("scalar_join", """WITH m AS (SELECT MAX(CAST(o_orderdate AS DATE)) AS max_date, COUNT(*) AS all_orders FROM orders)
SELECT c.c_custkey, COUNT(o.o_orderkey) AS orders, m.all_orders,
  CAST(m.max_date - MAX(CAST(o.o_orderdate AS DATE)) AS INT) AS days_since
FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey CROSS JOIN m GROUP BY c.c_custkey, m.max_date, m.all_orders""")
def scalar_join(t: Tables) -> DataFrame:
    days = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.to_date("o_orderdate").alias("day"))
    per = days.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("orders"), F.max("day").alias("last"))
    out = J.left(t.customer.select("c_custkey"), per, ["c_custkey"]).fillna(0, ["orders"])
    out = J.with_scalar(out, days, max_date=F.max("day"), all_orders=F.count(F.lit(1)))
    return out.select("c_custkey", "orders", "all_orders", F.datediff("max_date", "last").alias("days_since"))


@query("classes_by_size", "SELECT c_mktsegment, COUNT(*) AS rows FROM customer GROUP BY 1 ORDER BY 2 DESC, 1")
def classes_by_size(t: Tables) -> DataFrame:
    return A.classes_by_size(t.customer, "c_mktsegment")


@query("distinct_threads", f"""WITH {USER_DAY}, {EVENT_LOG}
SELECT p.client, CAST(p.rd AS VARCHAR) AS rd,
  COUNT(DISTINCT CASE WHEN e.kind = 'error' THEN CAST(floor(e.value) AS BIGINT) END) AS error_threads,
  COUNT(DISTINCT CASE WHEN e.kind <> 'error' THEN CAST(floor(e.value) AS BIGINT) END) AS other_threads
FROM user_day p LEFT JOIN event_log e ON e.client = p.client AND e.day BETWEEN {shift('p.rd', -3)} AND p.rd
GROUP BY p.client, p.rd""")
def distinct_threads(t: Tables) -> DataFrame:
    log = event_log(t).withColumn("thread", F.floor("value").cast("long"))
    return L.lookback_distinct(user_day(t), log, ["client"], "rd", "day", L.months_back("rd", 3), "thread",
                               {"error_threads": F.col("kind") == "error", "other_threads": F.col("kind") != "error"})


@query("action_pivot", """SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
  CAST(COALESCE(SUM(CASE WHEN event_type = 'click' THEN CAST(value AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS click,
  CAST(COALESCE(SUM(CASE WHEN event_type = 'error' THEN CAST(value AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS error,
  CAST(COALESCE(SUM(CASE WHEN event_type = 'purchase' THEN CAST(value AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS purchase,
  CAST(COALESCE(SUM(CASE WHEN event_type = 'signup' THEN CAST(value AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS signup,
  CAST(COALESCE(SUM(CASE WHEN event_type = 'view' THEN CAST(value AS DECIMAL(18,2)) END), 0) AS DOUBLE) AS view
FROM events GROUP BY 1, 2""")
def action_pivot(t: Tables) -> DataFrame:
    log = t.events.select("user_id", F.to_date("ts").alias("day"), "event_type", money("value", 2).alias("value"))
    return A.action_features(log, ["user_id", "day"], "event_type", ["click", "error", "purchase", "signup", "view"], "value")


@query("transition_matrix", f"""WITH {USER_STATES}, m AS (SELECT a.state AS state_from, b.state AS state_to, COUNT(*) AS n
  FROM user_states a JOIN user_states b ON b.client = a.client AND b.period = a.period + 1 GROUP BY 1, 2)
SELECT state_from, state_to, round(n / SUM(n) OVER (PARTITION BY state_from), 9) AS probability FROM m
UNION ALL SELECT DISTINCT state, state, 1.0 FROM user_states WHERE state NOT IN (SELECT state_from FROM m)""")
def transition_matrix(t: Tables) -> DataFrame:
    return markov.transition_matrix(user_states(t), ["client"], "period", "state").withColumn(
        "probability", F.round("probability", 9))
