"""Equi, interval, next-period and grid joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.scale import BROADCAST_BYTES, checkpoint, lookup_join


def inner(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    return left.join(right, on, "inner")


def left(rows: DataFrame, block: DataFrame, on: list[str]) -> DataFrame:
    """Attach a feature block that has one row per key."""
    return rows.join(block, on, "left")


def full_outer(a: DataFrame, b: DataFrame, on: list[str], fill: dict | None = None) -> DataFrame:
    """Full outer join with merged keys and filled gaps."""
    out = a.join(b, on, "outer")
    return out.fillna(fill) if fill else out


def anti(rows: DataFrame, other: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not in ``other``."""
    return rows.join(other.select(*on).distinct(), on, "left_anti")


def span_cells(first: Column, last: Column, levels: int) -> Column:
    """The fewest dyadic cells (level, place) that make up the days ``first`` to ``last``: at most two of each level.

    A cell of level l and place p is the 2^l days from p 2^l on. Level by level, a span that begins or ends
    in the middle of a cell of the next level gives up its outermost cell.
    """
    def step(s: Column, level: Column) -> Column:
        lo, hi = s["lo"], s["hi"]
        live = lo <= hi
        left, right = live & (lo % 2 == 1), live & (hi % 2 == 0)
        cell = lambda p: F.array(F.struct(level.alias("level"), p.alias("place")))
        none = F.array().cast("array<struct<level:int,place:int>>")
        cells = F.concat(s["cells"], F.when(left, cell(lo)).otherwise(none), F.when(right, cell(hi)).otherwise(none))
        half = lambda x: F.floor(x / 2).cast("int")
        return F.struct(F.when(live, half(F.when(left, lo + 1).otherwise(lo))).otherwise(1).alias("lo"),
                        F.when(live, half(F.when(right, hi - 1).otherwise(hi))).otherwise(0).alias("hi"), cells.alias("cells"))

    start = F.struct(first.cast("int").alias("lo"), last.cast("int").alias("hi"),
                     F.array().cast("array<struct<level:int,place:int>>").alias("cells"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(levels)), start, step, lambda s: s["cells"])


def day_cells(day: Column, levels: int) -> Column:
    """The cell of each level that holds a day."""
    return F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda level: F.struct(
        level.alias("level"), F.call_function("shiftright", day.cast("int"), level).alias("place")))


def interval_join(facts: DataFrame, dim: DataFrame, key: list[str], at: str, valid_from: str, valid_to: str,
                  values: list[str], how: str = "left") -> DataFrame:
    """Dimension rows whose closed validity interval holds ``at``; an open end is NULL.

    A validity is cut where the key's next one begins. The parts before the cuts are disjoint, so a running window over
    the key's dates and beginnings finds the only one that can hold a date: a date is one row and a validity is one row.
    The parts that reach past a cut exist only where validities overlap; they meet the dates of their keys by cells
    (``_reaching_pairs``). The match is joined back to the facts by (key, date), with hot pairs dealt over several tasks.
    """
    known = F.lit(True)
    for c in key:
        known = known & F.col(c).isNotNull()
    begin, end = F.col(valid_from).cast("date"), F.col(valid_to).cast("date")
    spans = (dim.where(known).select(*key, F.struct(*values).alias("_row"), begin.alias("_from"), end.alias("_to"))
             .where(F.col("_from").isNotNull() & (F.col("_to").isNull() | (F.col("_from") <= F.col("_to")))))
    # both kinds of parts are read from one written table: validities that begin together are cut the same way
    cut = checkpoint(spans.withColumn("_next", F.lead("_from").over(W.partitionBy(*key).orderBy("_from"))))
    dates = facts.select(*key, at).where(known & F.col(at).isNotNull()).distinct()
    begins = cut.where("_next IS NULL OR _next > _from").select(
        *key, F.col("_from").alias("_day"), F.lit(0).alias("_mark"),
        F.struct("_row", F.least("_to", F.date_add("_next", -1)).alias("_until")).alias("_part"))
    line = dates.select(*key, at, F.col(at).cast("date").alias("_day"), F.lit(1).alias("_mark"))
    upto = W.partitionBy(*key).orderBy("_day", "_mark").rowsBetween(W.unboundedPreceding, W.currentRow)
    run = line.unionByName(begins, allowMissingColumns=True).withColumn("_part", F.last("_part", ignorenulls=True).over(upto))
    until = F.col("_part._until")
    pairs = (run.where((F.col("_mark") == 1) & F.col("_part").isNotNull() & (until.isNull() | (F.col("_day") <= until)))
             .select(*key, at, "_part._row.*"))
    reaching = cut.where("_next IS NOT NULL AND (_to IS NULL OR _to >= _next)")
    if not reaching.isEmpty():
        pairs = pairs.unionByName(_reaching_pairs(dates, reaching, key, at))
    return lookup_join(facts, pairs, [*key, at], how)


def _reaching_pairs(dates: DataFrame, reaching: DataFrame, key: list[str], at: str) -> DataFrame:
    """Dates inside ``_next`` to ``_to`` of the same key, with the row of that validity.

    A span is cut into dyadic cells of days, at most two for each power of two of its length, however long it is, and
    meets the cells of each date by (key, cell); only keys that have such a span take part.
    """
    dates = dates.join(reaching.select(*key).distinct(), key, "left_semi")
    extent = dates.agg(F.min(at).cast("date").alias("lo"), F.max(at).cast("date").alias("hi")).first()
    days = (extent["hi"] - extent["lo"]).days + 1 if extent["lo"] else 1
    levels = max(0, (days - 1).bit_length())
    lo = F.lit(extent["lo"]).cast("date")
    begin = F.greatest(F.datediff("_next", lo), F.lit(0))
    end = F.least(F.coalesce(F.datediff("_to", lo), F.lit(days - 1)), F.lit(days - 1))
    spans = (reaching.select(*key, "_row", begin.alias("_from"), end.alias("_to")).where("_from <= _to")
             .withColumn("_cell", F.explode(span_cells(F.col("_from"), F.col("_to"), levels))).drop("_from", "_to"))
    asked = dates.withColumn("_cell", F.explode(day_cells(F.datediff(F.col(at).cast("date"), lo), levels)))
    return asked.join(spans, [*key, "_cell"]).select(*key, at, "_row.*")


def next_period(facts: DataFrame, key: list[str], period: str, values: list[str]) -> DataFrame:
    """Rows that have a row of the same key in the very next period, with its values as ``<name>_next``.

    One row per key and period is expected, so a key has as many rows as there are periods.
    """
    order = W.partitionBy(*key).orderBy(period)
    out = facts.withColumn("_next", F.lead(F.struct(period, *values)).over(order))
    return (out.where(F.col("_next")[period] == F.col(period) + 1)
            .select("*", *[F.col("_next")[v].alias(f"{v}_next") for v in values]).drop("_next"))


def cross(rows: DataFrame, grid: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every row with every grid row.

    The grid is cut into chunks of at most about ``max_bytes``, each one array; a row meets every chunk through an
    equi join on the chunk's number and unfolds it. A grid of one chunk is simply the case of one number.
    """
    grid = checkpoint(grid)
    size = grid.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    chunks = max(1, -(-size // max_bytes))
    cells = (grid.select(F.struct("*").alias("_cell"), F.pmod(F.monotonically_increasing_id(), F.lit(chunks)).alias("_chunk"))
             .groupBy("_chunk").agg(F.collect_list("_cell").alias("_cells")))
    asked = rows.withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<long>")))
    met = asked.join(F.broadcast(cells) if chunks == 1 else cells, "_chunk")
    return met.select(*rows.columns, F.inline("_cells"))


def with_scalar(rows: DataFrame, source: DataFrame, **aggs: Column) -> DataFrame:
    """Attach global aggregates of ``source`` to every row."""
    one = source.agg(F.struct(*[a.alias(n) for n, a in aggs.items()])).scalar()
    return rows.select("*", *[one[n].alias(n) for n in aggs])


def wide_join(base: DataFrame, blocks: list[DataFrame], key: list[str]) -> DataFrame:
    """One wide row per key from many feature blocks.

    A key that a block repeats keeps the row that is smallest in the order of the block's columns, so reruns agree.
    """
    def one_row(block: DataFrame) -> DataFrame:
        rest = [c for c in block.columns if c not in key]
        return block.groupBy(*key).agg(F.min(F.struct(*rest)).alias("_row")).select(*key, "_row.*")

    return reduce(lambda acc, block: acc.join(one_row(block), key, "left"), blocks, base)
