"""Choice by utility and checklist scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def utility(option: dict[str, float]) -> Column:
    """Weighted sum of the features of one option; ``const`` is the constant."""
    total = F.lit(float(option.get("const", 0.0)))
    for name, weight in option.items():
        if name != "const":
            total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * F.lit(float(weight))
    return total


def choose_by_utility(rows: DataFrame, coefficients: dict[str, dict[str, float]]) -> DataFrame:
    """The option with the highest utility per row, the first name on ties, without a shuffle."""
    scored = F.array(*[F.struct((-F.round(utility(w), 9)).alias("minus"), F.lit(name).alias("choice"))
                       for name, w in coefficients.items()])
    best = F.array_min(scored)
    return rows.withColumn("choice", best["choice"]).withColumn("utility", -best["minus"])


def maturity_score(catalog: DataFrame, checks: list[tuple[str, str, Column]], key: str) -> DataFrame:
    """Share of passed checks, the first failed one and the highest stage reached without a gap.

    ``checks`` is an ordered list of (stage, check, condition).
    """
    passed = {name: F.coalesce(cond, F.lit(False)) for _, name, cond in checks}
    flags = [c.cast("int") for c in passed.values()]
    share = sum(flags[1:], flags[0]) / len(flags)
    failed = F.coalesce(*[F.when(~c, F.lit(n)) for n, c in passed.items()], F.lit("none"))
    stages = list(dict.fromkeys(stage for stage, _, _ in checks))
    reached: Column = F.lit("none")
    so_far: Column | None = None
    branches = []
    for stage in stages:
        for s, name, _ in checks:
            if s == stage:
                so_far = passed[name] if so_far is None else so_far & passed[name]
        branches.append((stage, so_far))
    for stage, cond in branches:
        reached = F.when(cond, F.lit(stage)).otherwise(reached)
    return catalog.select(key, share.alias("score"), failed.alias("first_failed"), reached.alias("stage"))
