"""State transitions, discounted state values and forecasts.

Matrices are tables of (state_from, state_to, probability); products are joins and sums.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.operators.joins import anti, cross, next_period
from panelkit.scale import cut, lookup_join

#: Monthly discount rate and forecast horizon (fixed values).
DISCOUNT = 0.0016515813
HORIZON = 6
#: Name of the extra state that collects the running sum.
SUM_STATE = "\u0000sum"


def transition_matrix(facts: DataFrame, key: list[str], period: str, state: str) -> DataFrame:
    """Share of each move from one period to the next; a state nobody leaves keeps itself."""
    moves = (next_period(facts, key, period, [state])
             .groupBy(F.col(state).alias("state_from"), F.col(f"{state}_next").alias("state_to"))
             .agg(F.count(F.lit(1)).alias("moves")))
    totals = moves.groupBy("state_from").agg(F.sum("moves").alias("_all"))
    shares = moves.join(totals, "state_from").select(
        "state_from", "state_to", (F.col("moves") / F.col("_all")).alias("probability"))
    states = facts.select(F.col(state).alias("state_from")).distinct()
    closed = no_exit_states(states, shares).select(
        "state_from", F.col("state_from").alias("state_to"), F.lit(1.0).alias("probability"))
    return shares.unionByName(closed)


def no_exit_states(states: DataFrame, moves: DataFrame) -> DataFrame:
    """States without an outgoing move."""
    return anti(states, moves, ["state_from"])


def product(a: DataFrame, b: DataFrame) -> DataFrame:
    """Matrix product of two sparse tables."""
    right = b.select(F.col("state_from").alias("_mid"), F.col("state_to").alias("_to"),
                     F.col("probability").alias("_p"))
    return (a.join(right, a["state_to"] == F.col("_mid"))
            .groupBy("state_from", F.col("_to").alias("state_to"))
            .agg(F.sum(F.col("probability") * F.col("_p")).alias("probability")))


def transition_powers(matrix: DataFrame, horizon: int = HORIZON) -> DataFrame:
    """Powers 1..horizon stacked, with the step in ``month``."""
    base = cut(matrix)
    power = base
    out = base.withColumn("month", F.lit(1))
    for step in range(2, horizon + 1):
        power = cut(product(power, base))
        out = out.unionByName(power.withColumn("month", F.lit(step)))
    return out


def apply_matrix(matrix: DataFrame, vector: DataFrame) -> DataFrame:
    """Matrix times a (state, value) vector."""
    v = vector.select(F.col("state").alias("state_to"), F.col("value").alias("_v"))
    return (matrix.join(v, "state_to").groupBy(F.col("state_from").alias("state"))
            .agg(F.sum(F.col("probability") * F.col("_v")).alias("value")))


def _add(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).groupBy("state").agg(F.sum("value").alias("value"))


def segment_value(matrix: DataFrame, revenue: DataFrame, discount: float = DISCOUNT, horizon: int | None = None,
                  churn: str = "Churn", tolerance: float = 1e-9, max_rounds: int = 60) -> DataFrame:
    """Discounted value per state: the sum of (P/(1+d))^k r, for k = 0..horizon or until it settles.

    ``revenue`` is (state, value); the churned state earns nothing. The endless sum doubles its reach every
    round until no value changes by more than ``tolerance`` of the largest one; a sum that has not settled
    after ``max_rounds`` raises an error.
    """
    states = matrix.select(F.col("state_from").alias("state")).distinct()
    earned = (states.join(revenue.select("state", "value"), "state", "left")
              .select("state", F.when(F.col("state") == churn, 0.0)
                      .otherwise(F.coalesce(F.col("value").cast("double"), F.lit(0.0))).alias("value")))
    reward = cut(earned)
    step = cut(matrix.withColumn("probability", F.col("probability") / (1 + discount)))
    value = reward
    if horizon is not None:
        for k in range(horizon):
            value = _add(reward, apply_matrix(step, value))
            if k % 4 == 3:
                value = cut(value)
        return value
    # squaring [[M, r], [0, 1]] doubles the reach of the sum that stands in its last column
    column = reward.select(F.col("state").alias("state_from"), F.lit(SUM_STATE).alias("state_to"),
                           F.col("value").alias("probability"))
    corner = matrix.sparkSession.range(1).select(F.lit(SUM_STATE).alias("state_from"),
                                                 F.lit(SUM_STATE).alias("state_to"), F.lit(1.0).alias("probability"))
    system = step.unionByName(column).unionByName(corner)
    def sums(rows: DataFrame) -> DataFrame:
        return (rows.where((F.col("state_to") == SUM_STATE) & (F.col("state_from") != SUM_STATE))
                .select(F.col("state_from").alias("state"), F.col("probability").alias("value")))

    for _ in range(max_rounds):
        after = cut(product(system, system))
        moved = (sums(after).join(sums(system).withColumnRenamed("value", "_old"), "state", "left")
                 .agg(F.max(F.abs(F.col("value") - F.coalesce("_old", F.lit(0.0)))).alias("d"), F.max(F.abs("value")).alias("v")).first())
        system = after
        if (moved["d"] or 0.0) <= tolerance * max(1.0, moved["v"] or 0.0):
            return sums(system)
    raise ValueError("the value of a state does not settle: it needs a discount or a way out")


def forecast_states(powers: DataFrame, facts: DataFrame, key: str, period: str, state: str,
                    churn: str = "Churn") -> DataFrame:
    """State probabilities of every key for the periods after the last one; churned keys are left out."""
    last = facts.agg(F.max(period)).scalar()
    current = (facts.where((F.col(period) == last) & (F.col(state) != churn))
               .select(key, period, F.col(state).alias("state_from")))
    table = powers.select("state_from", F.col("state_to").alias("_to"), "month", "probability")
    return (lookup_join(current, table, ["state_from"], "inner")
            .select(key, (F.col(period) + F.col("month")).alias(period), F.col("_to").alias(state), "probability"))


def joiners_per_period(facts: DataFrame, period: str, state: str, joiner: str) -> tuple[int, int]:
    """Average number of new joiners per period, rounded down, and the last period."""
    joined = F.count(F.when(F.col(state) == joiner, 1))
    row = facts.agg(F.floor(joined / (F.max(period) - F.min(period) + 1)).cast("long").alias("n"),
                    F.max(period).alias("last")).first()
    return row["n"] or 0, row["last"] or 0


def new_joiners(facts: DataFrame, powers: DataFrame, key: str, period: str, state: str, joiner: str,
                horizon: int = HORIZON) -> DataFrame:
    """Expected journeys of the keys that will join in the next periods, up to the horizon."""
    spark = facts.sparkSession
    journey = (powers.where(F.col("state_from") == joiner)
               .select(F.col("month").alias("_step"), F.col("state_to").alias(state), "probability"))
    start = spark.range(1).select(F.lit(0).alias("_step"), F.lit(joiner).alias(state), F.lit(1.0).alias("probability"))
    n, last = joiners_per_period(facts, period, state, joiner)
    arrivals = spark.range(n * horizon).select(
        (F.lit(last + 1).cast("long") + F.expr(f"id div {max(n, 1)}")).alias("_joined"),
        (F.col("id") % max(n, 1) + 1).alias("_seq"))
    return (cross(arrivals, start.unionByName(journey))
            .select(F.concat(F.lit("NJ_"), F.col("_joined").cast("string"), F.lit("_"),
                             F.col("_seq").cast("string")).alias(key),
                    (F.col("_joined") + F.col("_step")).alias(period), state, "probability")
            .where(F.col(period) <= last + horizon))


def past_and_future(facts: DataFrame, forecast: DataFrame, joiners: DataFrame, key: str, period: str,
                    state: str) -> DataFrame:
    """Observed states with probability 1, forecasts and joiners in one table."""
    def shape(df: DataFrame) -> DataFrame:
        return df.select(F.col(key).cast("string").alias(key), F.col(period).cast("long").alias(period),
                         state, "probability")

    past = facts.withColumn("probability", F.lit(1.0))
    return shape(past).unionByName(shape(forecast)).unionByName(shape(joiners))


def segment_aggregates(facts: DataFrame, segment: Column, revenue: str, score: str) -> DataFrame:
    """Mean and deviation of revenue and score per micro-segment."""
    return (facts.groupBy(segment.alias("segment"))
            .agg(F.count(F.lit(1)).alias("members"), F.avg(revenue).alias("revenue_mean"),
                 F.stddev_samp(revenue).alias("revenue_sd"), F.avg(score).alias("score_mean"),
                 F.stddev_samp(score).alias("score_sd")))


def segment_facts(facts: DataFrame, key: str, period: str, segment: Column) -> DataFrame:
    """Membership rows with probability 1."""
    return facts.select(key, period, segment.alias("segment"), F.lit(1.0).alias("probability"))
