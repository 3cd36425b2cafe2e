"""Panels derived from the given tables, and the same panels as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.scale import parts_for
from panelkit.tables import Tables


def money(col: Column | str, scale: int = 4) -> Column:
    """Exact decimal, so sums do not depend on the order of rows."""
    return (F.col(col) if isinstance(col, str) else col).cast(f"decimal(18,{scale})")


def order_log(t: Tables) -> DataFrame:
    """Orders as an event log."""
    return t.orders.select(F.col("o_custkey").alias("client"), F.col("o_orderkey").alias("contract"),
                           F.to_date("o_orderdate").alias("day"), F.col("o_orderpriority").alias("priority"),
                           F.col("o_orderstatus").alias("status"), money("o_totalprice", 2).alias("price"))


def client_panel(t: Tables) -> DataFrame:
    """Client by month end."""
    return t.orders.select(F.col("o_custkey").alias("client"),
                           F.last_day(F.to_date("o_orderdate")).alias("rd")).distinct()


def user_day(t: Tables) -> DataFrame:
    """User by day."""
    return t.events.select(F.col("user_id").alias("client"), F.to_date("ts").alias("rd")).distinct()


def event_log(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.col("user_id").alias("client"), F.to_date("ts").alias("day"),
                           F.col("event_type").alias("kind"), money("value", 2).alias("value"))


def line_months(t: Tables) -> DataFrame:
    """Line items collapsed to one row per order and ship month, before any join.

    The lines are dealt out by order once: months, the join with the orders and windows over an order read them there.
    """
    price = money(F.col("l_extendedprice"), 2) * (1 - money("l_discount", 2))
    lines = t.lineitem.select(F.col("l_orderkey").alias("contract"), F.last_day(F.to_date("l_shipdate")).alias("rd"),
                              "l_extendedprice", "l_discount", "l_quantity", "l_returnflag", "l_linestatus")
    return (lines.repartition(parts_for(t.lineitem.count()), "contract").groupBy("contract", "rd")
            .agg(F.sum(price).cast("decimal(24,4)").alias("balance"), F.count(F.lit(1)).alias("lines"),
                 F.max(F.col("l_quantity").cast("int")).alias("quantity"),
                 F.max("l_returnflag").alias("flag"), F.max("l_linestatus").alias("line_status")))


def contract_panel(t: Tables, dealt: bool = True) -> DataFrame:
    """Contract by month end: start is the order date, the plan runs four months.

    Its rows lie by contract, in parts that follow their number; a written one is only dealt out for plans that need it.
    """
    if (written := t.shared("contract_panel")) is not None:
        return written.repartition(parts_for(written.count()), "contract") if dealt else written
    heads = t.orders.select(F.col("o_orderkey").alias("contract"), F.col("o_custkey").alias("client"),
                            F.to_date("o_orderdate").alias("start"))
    return (line_months(t).join(heads, "contract")
            .withColumn("planned_end", F.add_months("start", 4)))


CLIENT_PANEL = "client_panel AS (SELECT DISTINCT o_custkey AS client, last_day(CAST(o_orderdate AS DATE)) AS rd FROM orders)"
USER_DAY = "user_day AS (SELECT DISTINCT user_id AS client, CAST(ts AS DATE) AS rd FROM events)"
ORDER_LOG = """order_log AS (SELECT o_custkey AS client, o_orderkey AS contract, CAST(o_orderdate AS DATE) AS day,
  o_orderpriority AS priority, o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM orders)"""
EVENT_LOG = """event_log AS (SELECT event_id, user_id AS client, CAST(ts AS DATE) AS day, event_type AS kind,
  CAST(value AS DECIMAL(18,2)) AS value FROM events)"""
CONTRACT_PANEL = """line_months AS (SELECT l_orderkey AS contract, last_day(CAST(l_shipdate AS DATE)) AS rd,
  SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2)))) AS balance,
  COUNT(*) AS lines, MAX(CAST(l_quantity AS INT)) AS quantity, MAX(l_returnflag) AS flag,
  MAX(l_linestatus) AS line_status FROM lineitem GROUP BY 1, 2),
contract_panel AS (SELECT m.*, o.o_custkey AS client, CAST(o.o_orderdate AS DATE) AS start,
  CAST(CAST(o.o_orderdate AS DATE) + INTERVAL 4 MONTH AS DATE) AS planned_end
  FROM line_months m JOIN orders o ON o.o_orderkey = m.contract)"""


def months_between(a: str, b: str) -> str:
    """Exact months from ``b`` to ``a`` in SQL: whole when the days agree or both are month ends."""
    whole = f"(12 * (year({a}) - year({b})) + (month({a}) - month({b})))"
    return (f"(CASE WHEN {a} IS NULL OR {b} IS NULL THEN NULL WHEN day({a}) = day({b}) OR ({a} = last_day({a}) AND {b} = last_day({b})) "
            f"THEN CAST({whole} AS DOUBLE) ELSE round({whole} + (day({a}) - day({b})) / 31.0::DOUBLE, 8) END)")


def whole_months(a: str, b: str) -> str:
    return f"CAST(trunc({months_between(a, b)}) AS INT)"


def shift(d: str, n: int) -> str:
    """``d`` moved by ``n`` months in SQL."""
    return f"CAST({d} + INTERVAL ({n}) MONTH AS DATE)"
