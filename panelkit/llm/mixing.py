"""Mixing sources to target weights by fitting subset sums of exact document lengths."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelkit import scale
from panelkit.llm.common import WORD_BREAKS, written

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (3, 1, 2)
#: Share of all words that the mix takes.
BUDGET = 1.5
#: Most copies of a document, and so most words of a source in its own sizes.
MAX_COPIES = 2
#: Sums kept by the knapsack, over all its stages.
SUMS = 1 << 21
#: Documents of each size left out of the even share at first, and at last.
RESERVE, MOST_RESERVE = 1, 512
#: Documents of one length ranked together by one task.
ROWS_PER_BUCKET = 20_000


def sized(docs: DataFrame) -> DataFrame:
    """Adds ``size``: the number of words of the whole text, null and empty texts have none."""
    # a word starts where a character that is no break follows a break or the start
    marked = F.translate(F.coalesce("text", F.lit("")), WORD_BREAKS, " " * len(WORD_BREAKS))
    return docs.withColumn("size", F.size(F.filter(F.split(marked, " "), lambda w: w != "")).cast("long"))


def targets(sources: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MAX_COPIES) -> DataFrame:
    """Adds ``target`` to rows (source, source_size): shares of the budget by weight, capped, the excess reshared.

    Sources are numbered in the order of their names by code point, null last. The loop only moves sums;
    it ends when no uncapped source is above its cap, at the latest when all are capped.
    """
    numbered = scale.global_rank(sources, [F.col("source").asc_nulls_last()], "_n")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    rows = written(numbered.select("source", "source_size",
                                   F.element_at(cycle, (F.pmod(F.col("_n") - 1, F.lit(len(weights))) + 1).cast("int")).alias("_w"),
                                   (F.lit(most) * F.col("source_size")).cast("double").alias("_cap")))
    total = (rows.agg(F.sum("source_size")).first()[0] or 0) * budget
    level = 0.0  # words for each unit of weight
    while True:
        capped = F.col("_cap") <= F.lit(level) * F.col("_w")
        sums = rows.agg(F.sum(F.when(capped, F.col("_cap"))).alias("c"), F.sum(F.when(~capped, F.col("_w"))).alias("w")).first()
        if not sums["w"]:
            break
        after = (total - (sums["c"] or 0.0)) / sums["w"]
        if after <= level:
            break
        level = after
    return rows.select("source", "source_size", F.least(F.col("_cap"), F.lit(level) * F.col("_w")).alias("target"))


def nearest(sizes: np.ndarray, counts: np.ndarray, budget: int, most: int = SUMS) -> np.ndarray:
    """How many of each size (at most ``counts``) so that the sum comes nearest to ``budget``, on either side of it.

    Bounded subset sum over the sums that can be reached, however large they are: size by size, with the sums
    kept in order and those out of reach of the budget left out. That is exact while there are at most
    ``most`` sums in all stages together. Beyond, only one sum in each of equal intervals is kept while large sizes
    are laid, so the error stays within what small sizes, which come last, can fill.
    """
    order = np.argsort(-sizes, kind="stable")
    order = order[(sizes[order] > 0) & (counts[order] > 0)]
    took = np.zeros(len(sizes), np.int64)
    if not len(order):
        return took
    room = max(1024, most // len(order))
    after = np.concatenate([np.cumsum((sizes * counts)[order][::-1])[::-1][1:], [0]])  # what later sizes can add
    stages, sums = [], np.zeros(1, np.int64)
    for i, rest in zip(order, after):
        size, left = int(sizes[i]), int(counts[i])
        step, new = 1, sums
        while left > 0:  # 1, 2, 4 ... of a size and the remainder make up any number of it
            step = min(step, left)
            new = np.union1d(new, new + step * size)
            left -= step
            step *= 2
            # one sum above the budget is enough, and one that can no longer come up to it
            high, low = np.searchsorted(new, budget), np.searchsorted(new, budget - rest - left * size, "right")
            new = new[max(0, low - 1):high + 1]
            if len(new) > room:
                cell = (new - new[0]) // max(1, -(-(int(new[-1] - new[0]) + 1) // room))
                new = new[np.concatenate([[True], cell[1:] != cell[:-1]]) | (new == new[-1])]
        stages.append(sums)
        sums = new
    at = int(sums[np.abs(sums - budget).argmin()])
    for i, before in zip(order[::-1], stages[::-1]):
        k = np.arange(int(min(counts[i], at // sizes[i])) + 1)
        want = at - k * int(sizes[i])
        place = np.minimum(np.searchsorted(before, want), len(before) - 1)
        hit = np.flatnonzero(before[place] == want)
        took[i] = hit[0]
        at = int(want[hit[0]])
    return took


def fit(sizes: np.ndarray, counts: np.ndarray, budget: int, most: int = SUMS) -> np.ndarray:
    """How many documents of each size to take so that the sum comes as near to ``budget`` as it can.

    Every size first gives its even share but for RESERVE documents, which are free like those beyond the share; a source
    with fewer of every size is free as a whole. What is left of the budget is fitted by the knapsack
    of ``nearest``. A difference below half the greatest common divisor of the sizes is
    the least there can be; only if it is larger is more of the even share freed.
    """
    total = int((sizes * counts).sum())
    if budget >= total or not total:
        return counts.copy()
    unit = int(np.gcd.reduce(sizes[(sizes > 0) & (counts > 0)]))
    share = np.array([int(c) * budget // total for c in counts], np.int64)
    best, gap, reserve = None, None, RESERVE
    while True:
        fixed = np.maximum(0, share - reserve)
        free = np.minimum(counts - fixed, 2 * reserve + 2)
        left = budget - int((sizes * fixed).sum())
        took = nearest(sizes, free, left, most)
        off = abs(left - int((sizes * took).sum()))
        if gap is None or off < gap:
            best, gap = fixed + took, off
        if 2 * gap <= unit or not fixed.any() and (free == counts).all():
            return best
        reserve *= 8
        if reserve > MOST_RESERVE:
            return best


def _plan(group: pd.DataFrame) -> pd.DataFrame:
    """For one source: how many documents of each size are taken once and how many twice."""
    group = group.sort_values("size", ignore_index=True)
    sizes, counts = group["size"].to_numpy(np.int64), group["n"].to_numpy(np.int64)
    total, budget = int((sizes * counts).sum()), int(np.floor(group["target"].iloc[0] + 0.5))
    rounds, rest = divmod(budget, total) if total else (0, 0)
    extra = fit(sizes, counts, rest)
    return group.assign(rounds=rounds, extra=extra)[["_sid", "size", "rounds", "extra"]]


def mix(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MAX_COPIES, seed: int = 17,
        rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Copies of every document that bring each source near its target (needs doc_id, text, source).

    Returns doc_id, source, size, source_size, target, copies, taken. Documents are counted by (source, exact
    length); the plan for a source is made from those counts alone: whole rounds, then a subset whose lengths
    sum to the rest. Which documents of a length are taken is a seeded draw on doc_id: a length's documents
    are split into hash buckets of bounded size, buckets are taken whole in order, and only the bucket at the
    border ranks its documents. Repeated rows with equal doc_id draw alike and are told apart by their order.
    Null and empty texts have size 0 and are never taken; null is a source like others, last in order. An
    empty table gives no rows; extra columns are left out. Reruns agree.
    """
    return _mixed(docs, weights, budget, most, seed, rows_per_bucket).drop("_text")


def repeat(docs: DataFrame, **options) -> DataFrame:
    """The rows, with all their columns, as often as the mix takes them; rows it does not take go.

    Rows that agree in doc_id and text share their copies: each gets the same number, and those that are first
    by their other columns one more if the number does not divide. Nulls, empty texts, an empty table and extra columns
    are as in ``mix``; a table may have any columns besides.
    """
    plan = _mixed(docs, **options).groupBy("doc_id", "_text").agg(F.sum("copies").alias("_copies"), F.count(F.lit(1)).alias("_rows"))
    share, rest = F.floor(F.col("_copies") / F.col("_rows")), F.pmod("_copies", "_rows")
    plan = written(plan.where("_copies > 0").select(F.col("doc_id").alias("_id"), F.col("_text").alias("_hash"), "_rows",
                                                    share.alias("_share"), rest.alias("_rest")))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"))

    def planned(part: DataFrame) -> DataFrame:
        return rows.join(part, rows["id"].eqNullSafe(part["_id"]) & (rows["hash"] == part["_hash"]))

    taken = planned(plan.where("_rest = 0")).select("row", F.col("_share").alias("_n"))
    uneven = plan.where("_rest > 0")
    if not uneven.isEmpty():  # only rows repeated and taken unevenly are ranked, over as many tasks as they need
        part = planned(uneven).select("row", "_share", "_rest", F.to_json(F.struct("id", "hash")).alias("_key"), F.to_json("row").alias("_order"))
        ranked = scale.rank_within(part, ["_key"], ["_order"], "_r")
        taken = taken.unionByName(ranked.select("row", (F.col("_share") + (F.col("_r") <= F.col("_rest")).cast("long")).alias("_n")))
    return (taken.where("_n > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))).alias("_nth")).select("row.*"))


def _mixed(docs: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MAX_COPIES, seed: int = 17,
           rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    rows = written(sized(docs.select("doc_id", "source", "text")).select("doc_id", "source", "size", F.xxhash64("text").alias("_text")))
    counts = written(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    goals = targets(counts.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")),
                    weights, budget, most)
    goals = written(goals.withColumn("_sid", F.monotonically_increasing_id()))
    counted = counts.join(goals, counts["source"].eqNullSafe(goals["source"])).select("_sid", "size", "n", "target", "source_size")
    plan = counted.groupBy("_sid").applyInPandas(_plan, "_sid long, size long, rounds long, extra long")
    plan = written(plan.join(counted, ["_sid", "size"]).join(goals.select("_sid", "source"), "_sid")
                   .withColumn("_buckets", F.ceil(F.col("n") / rows_per_bucket)))
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(seed))
    plan = plan.select("_sid", F.col("source").alias("_src"), F.col("size").alias("_size"), "n", "target", "source_size",
                       "rounds", "extra", "_buckets")
    joined = (rows.join(plan, rows["source"].eqNullSafe(plan["_src"]) & (rows["size"] == plan["_size"]))
              .withColumn("_draw", key).withColumn("_bucket", F.pmod("_draw", "_buckets")))
    inside = Window.partitionBy("_sid", "size", "_bucket").orderBy("_draw", "doc_id", "_text")
    ranked = joined.withColumn("_rank", F.row_number().over(inside))
    sizes = (joined.where("_buckets > 1").groupBy("_sid", "size", "_bucket").agg(F.count(F.lit(1)).alias("_in")))
    before = Window.partitionBy("_sid", "size").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_sid", "size", "_bucket", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_start"))
    ranked = ranked.join(starts, ["_sid", "size", "_bucket"], "left")
    chosen = F.coalesce("_start", F.lit(0)) + F.col("_rank") <= F.col("extra")
    copies = F.least(F.lit(most), F.col("rounds") + chosen.cast("long"))
    copies = F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("long")
    return ranked.select("doc_id", "_text", "source", "size", "source_size", "target", copies.alias("copies"),
                         (F.col("size") * copies).alias("taken"))
