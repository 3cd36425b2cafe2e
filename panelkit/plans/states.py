"""State transitions, values and forecasts on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.operators import markov as M
from panelkit.plans.panels import USER_STATES, user_states
from panelkit.plans.registry import query
from panelkit.plans.views import event_log
from panelkit.streaming.arms import arm_stats_stream, arm_ucb, arm_ucb_stream
from panelkit.scale import ensure_checkpoint_dir, scratch
from panelkit.tables import Tables

CHURN, JOINER = "error", "signup"
MATRIX = f"""{USER_STATES}, moves AS (SELECT a.state AS f, b.state AS t, COUNT(*) AS n FROM user_states a JOIN user_states b
  ON b.client = a.client AND b.period = a.period + 1 GROUP BY 1, 2),
p1 AS (SELECT f, t, n / SUM(n) OVER (PARTITION BY f) AS p FROM moves
  UNION ALL SELECT DISTINCT state, state, 1.0::DOUBLE FROM user_states WHERE state NOT IN (SELECT f FROM moves))"""


def _powers(n: int) -> str:
    steps = [f"p{k} AS (SELECT a.f, b.t, SUM(a.p * b.p) AS p FROM p{k - 1} a JOIN p1 b ON b.f = a.t GROUP BY 1, 2)" for k in range(2, n + 1)]
    union = " UNION ALL ".join(f"SELECT f, t, p, {k} AS month FROM p{k}" for k in range(1, n + 1))
    return f"{MATRIX}, {', '.join(steps)}, powers AS ({union})"


POWERS = _powers(6)


def matrix(t: Tables) -> DataFrame:
    return M.transition_matrix(user_states(t), ["client"], "period", "state")


@query("transition_powers", f"WITH {POWERS} SELECT f AS state_from, t AS state_to, month, round(p, 9) AS probability FROM powers")
def transition_powers(t: Tables) -> DataFrame:
    return M.transition_powers(matrix(t)).withColumn("probability", F.round("probability", 9))


def revenue(t: Tables) -> DataFrame:
    """Mean event value per state name."""
    return event_log(t).groupBy(F.col("kind").alias("state")).agg(
        (F.sum("value").cast("double") / F.count("value")).alias("value"))


D = M.DISCOUNT
REVENUE = f"""rev AS (SELECT s.state, CASE WHEN s.state = '{CHURN}' THEN 0 ELSE CAST(SUM(e.value) AS DOUBLE) / COUNT(*) END AS v
  FROM (SELECT DISTINCT f AS state FROM p1) s JOIN event_log e ON e.kind = s.state GROUP BY 1)"""


@query("segment_value_finite", f"""WITH {POWERS}, {REVENUE}, terms AS (SELECT state, v FROM rev
  UNION ALL SELECT powers.f, SUM(p * v) / pow(1 + {D}::DOUBLE, month) FROM powers JOIN rev ON rev.state = powers.t GROUP BY powers.f, month)
SELECT state, round(SUM(v), 6) AS value FROM terms GROUP BY 1""")
def segment_value_finite(t: Tables) -> DataFrame:
    return M.segment_value(matrix(t), revenue(t), horizon=6, churn=CHURN).withColumn("value", F.round("value", 6))


def _squares(rounds: int) -> str:
    """The endless discounted sum by squaring: a sum state collects the value, every square doubles its reach."""
    first = f"""s0 AS MATERIALIZED (SELECT f, t, p / (1 + {D}::DOUBLE) AS p FROM p1 UNION ALL SELECT state, '+', v FROM rev
  UNION ALL SELECT '+', '+', 1.0::DOUBLE)"""
    steps = [f"s{k} AS MATERIALIZED (SELECT a.f, b.t, SUM(a.p * b.p) AS p FROM s{k - 1} a JOIN s{k - 1} b ON b.f = a.t GROUP BY 1, 2)"
             for k in range(1, rounds + 1)]
    return f"{MATRIX}, {REVENUE}, {first}, {', '.join(steps)} SELECT f AS state, round(p, 4) AS value FROM s{rounds} WHERE t = '+' AND f <> '+'"


@query("segment_value", f"WITH {_squares(20)}")
def segment_value(t: Tables) -> DataFrame:
    return M.segment_value(matrix(t), revenue(t), churn=CHURN).withColumn("value", F.round("value", 4))


FORECAST = f"""forecast AS (SELECT s.client, s.period + w.month AS period, w.t AS state, w.p AS probability FROM user_states s
  JOIN powers w ON w.f = s.state WHERE s.period = (SELECT MAX(period) FROM user_states) AND s.state <> '{CHURN}')"""


@query("forecast_states", f"WITH {POWERS}, {FORECAST} SELECT client, period, state, round(probability, 9) AS probability FROM forecast")
def forecast_states(t: Tables) -> DataFrame:
    states = user_states(t)
    out = M.forecast_states(M.transition_powers(matrix(t)), states, "client", "period", "state", CHURN)
    return out.withColumn("probability", F.round("probability", 9))


JOINERS = f"""nj AS (SELECT CAST(floor(COUNT(CASE WHEN state = '{JOINER}' THEN 1 END) / (MAX(period) - MIN(period) + 1)) AS BIGINT) AS n, MAX(period) AS last FROM user_states),
journey AS (SELECT 0 AS step, '{JOINER}' AS state, 1.0::DOUBLE AS probability UNION ALL SELECT month, t, p FROM powers WHERE f = '{JOINER}'),
joiners AS (SELECT 'NJ_' || (last + m) || '_' || s AS client, last + m + step AS period, state, probability FROM nj, range(1, 7) g(m), journey,
  (SELECT unnest(range(1, n + 1)) AS s FROM nj) WHERE m + step <= 6)"""


@query("new_joiners", f"WITH {POWERS}, {JOINERS} SELECT client, period, state, round(probability, 9) AS probability FROM joiners")
def new_joiners(t: Tables) -> DataFrame:
    out = M.new_joiners(user_states(t), M.transition_powers(matrix(t)), "client", "period", "state", JOINER)
    return out.withColumn("probability", F.round("probability", 9))


@query("past_and_future", f"""WITH {POWERS}, {FORECAST}, {JOINERS} SELECT client, period, state, round(probability, 9) AS probability FROM
(SELECT CAST(client AS VARCHAR) AS client, period, state, 1.0::DOUBLE AS probability FROM user_states
 UNION ALL SELECT CAST(client AS VARCHAR), period, state, probability FROM forecast UNION ALL SELECT client, period, state, probability FROM joiners)""")
def past_and_future(t: Tables) -> DataFrame:
    states = user_states(t)
    powers = M.transition_powers(matrix(t))
    out = M.past_and_future(states, M.forecast_states(powers, states, "client", "period", "state", CHURN),
                            M.new_joiners(states, powers, "client", "period", "state", JOINER), "client", "period", "state")
    return out.withColumn("probability", F.round("probability", 9))


@query("segment_aggregates", """SELECT c_mktsegment || '_' || (c_nationkey % 5) AS segment, COUNT(*) AS members, round(AVG(c_acctbal), 6) AS revenue_mean,
  round(stddev_samp(c_acctbal), 6) AS revenue_sd, round(AVG(c_nationkey), 6) AS score_mean, round(stddev_samp(c_nationkey), 6) AS score_sd FROM customer GROUP BY 1""")
def segment_aggregates(t: Tables) -> DataFrame:
    segment = F.concat_ws("_", "c_mktsegment", F.col("c_nationkey") % 5)
    out = M.segment_aggregates(t.customer, segment, "c_acctbal", "c_nationkey")
    return out.withColumns({c: F.round(c, 6) for c in ("revenue_mean", "revenue_sd", "score_mean", "score_sd")})


def reward():
    return (F.col("event_type") == "purchase").cast("int")


@query("arm_ucb", """WITH a AS (SELECT props AS arm, COUNT(*) AS trials, COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS rewards FROM events GROUP BY 1)
SELECT arm, trials, rewards, round(rewards / trials, 9) AS mean, round(rewards / trials + sqrt(1.5::DOUBLE * ln((SELECT SUM(trials) FROM a) + 1) / trials), 9) AS upper_bound FROM a""")
def arm_ucb_query(t: Tables) -> DataFrame:
    return arm_ucb(t.events, "props", reward()).withColumns({c: F.round(c, 9) for c in ("mean", "upper_bound")})


@query("arm_ucb_stream", """WITH a AS (SELECT props AS arm, COUNT(*) AS trials, COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS rewards FROM events GROUP BY 1)
SELECT arm, trials, rewards, round(rewards / trials, 9) AS mean, round(rewards / trials + sqrt(1.5::DOUBLE * ln((SELECT SUM(trials) FROM a) + 1) / trials), 9) AS upper_bound FROM a""")
def arm_ucb_stream_query(t: Tables) -> DataFrame:
    folder = scratch(t.spark, "bounds")
    out = arm_ucb_stream(t.spark, f"{t.directory}/events*.parquet", t.events.schema, "props", reward(), f"{folder}/out", f"{folder}/state")
    return out.withColumns({c: F.round(c, 9) for c in ("mean", "upper_bound")})


@query("arm_stats_stream", """SELECT props AS arm, COUNT(*) AS trials, COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) AS rewards,
  round(COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) / COUNT(*), 9) AS mean, COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) + 1 AS alpha,
  COUNT(*) - COUNT(CASE WHEN event_type = 'purchase' THEN 1 END) + 1 AS beta FROM events GROUP BY 1""")
def arm_stats_stream_query(t: Tables) -> DataFrame:
    import uuid

    ensure_checkpoint_dir(t.spark)
    folder = f"{t.spark.sparkContext.getCheckpointDir()}/stream-{uuid.uuid4().hex}"
    out = arm_stats_stream(t.spark, f"{t.directory}/events*.parquet", t.events.schema, "props", reward(),
                           f"{folder}/out", f"{folder}/state")
    return out.withColumn("mean", F.round("mean", 9))
