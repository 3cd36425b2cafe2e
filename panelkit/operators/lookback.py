"""Look-back windows of an event log on a panel of (key, date) rows.

All operators first collapse the log to one partial row per key and day. That step combines on the
map side, so a key holding a large share of the log costs one row per calendar day afterwards, and
every later group is bounded by days and months, not by log rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.functions.scalars import month_index, months_diff
from panelkit.scale import skew_join


@dataclass(frozen=True)
class Measure:
    """One output column: ``kind`` is sum, count, min, max or mean of ``value``."""

    kind: str
    value: Column
    fill: object = None

    def partials(self, name: str) -> list[Column]:
        if self.kind == "mean":
            return [F.sum(self.value).alias(f"{name}__s"), F.count(self.value).alias(f"{name}__n")]
        return [getattr(F, self.kind)(self.value).alias(name)]

    def merged(self, name: str, keep: Column | None, over=None) -> Column:
        def part(column: str, fn: str) -> Column:
            value = F.col(column) if keep is None else F.when(keep, F.col(column))
            out = getattr(F, fn)(value)
            return out.over(over) if over is not None else out

        if self.kind == "mean":
            return F.try_divide(part(f"{name}__s", "sum").cast("double"), part(f"{name}__n", "sum"))
        if self.kind == "count":
            return F.coalesce(part(name, "sum"), F.lit(0))
        return part(name, "sum" if self.kind == "sum" else self.kind)


def count(cond: Column | None = None) -> Measure:
    """Number of log rows (that meet ``cond``), 0 when there is none."""
    return Measure("count", F.lit(1) if cond is None else F.when(cond, 1), 0)


def total(value: Column | str, cond: Column | None = None, fill: object = 0) -> Measure:
    col = F.col(value) if isinstance(value, str) else value
    return Measure("sum", col if cond is None else F.when(cond, col), fill)


def lowest(value: Column | str) -> Measure:
    return Measure("min", F.col(value) if isinstance(value, str) else value)


def highest(value: Column | str) -> Measure:
    return Measure("max", F.col(value) if isinstance(value, str) else value)


def mean(value: Column | str) -> Measure:
    return Measure("mean", F.col(value) if isinstance(value, str) else value)


@dataclass(frozen=True)
class Span:
    """Days ``first``..``last`` around a panel date, with an optional further test on the day.

    ``width`` is the number of months of one join bucket: about half the window, so that a panel row
    is repeated for two or three buckets, however long its window is.
    """

    first: Column
    last: Column
    test: Callable[[Column], Column] | None = None
    width: int = 1

    def contains(self, day: Column) -> Column:
        """Whether the window of a panel row holds ``day``."""
        inside = day.between(self.first, self.last)
        return inside if self.test is None else inside & self.test(day)

    def holds(self, i: int, day: Column) -> Column:
        inside = day.between(F.col(f"_first{i}"), F.col(f"_last{i}"))
        return inside if self.test is None else inside & self.test(day)


def months_back(rd: str, n: int) -> Span:
    """Both ends included: ``[add_months(rd, -n), rd]``."""
    return Span(F.add_months(rd, -n), F.col(rd), width=max(1, n // 2))


def days_back(rd: str, n: int) -> Span:
    """The last ``n`` days up to ``rd``."""
    return Span(F.date_add(rd, 1 - n), F.col(rd))


def open_window(start: Column, rd: str) -> Span:
    """Start excluded, end included."""
    return Span(F.date_add(start, 1), F.col(rd))


def month_distance(rd: str, lo: int, hi: int) -> Span:
    """Whole months between panel date and event, cut toward zero, from ``lo`` to ``hi``."""
    return Span(F.add_months(rd, -(hi + 1)), F.add_months(rd, -(lo - 1)),
                lambda day: months_diff(rd, day).between(lo, hi), max(1, (hi - lo + 2) // 2))


def month_distance_open(rd: str, lo: int, hi: int) -> Span:
    """Exact months between panel date and event in ``[lo, hi)``."""
    return Span(F.add_months(rd, -(hi + 1)), F.add_months(rd, -(lo - 1)),
                lambda day: (F.months_between(F.col(rd), day) >= lo) & (F.months_between(F.col(rd), day) < hi),
                max(1, (hi - lo + 2) // 2))


def daily(log: DataFrame, key: list[str], ts: str, measures: dict[str, Measure]) -> DataFrame:
    """One partial row per key and day."""
    parts = [p for name, m in measures.items() for p in m.partials(name)]
    return (log.where(F.col(ts).isNotNull()).groupBy(*key, F.col(ts).cast("date").alias("_day")).agg(*parts))


def _width(spans: list[Span]) -> int:
    return max(s.width for s in spans)


def _bucket(day: str | Column, spans: list[Span]) -> Column:
    return F.floor(month_index(day) / _width(spans)).cast("int")


def _bounds(spans: list[Span]) -> dict[str, Column]:
    """First and last day of each window, as columns ``_first<i>`` and ``_last<i>``."""
    return {f"_{end}{i}": getattr(s, end).cast("date") for i, s in enumerate(spans) for end in ("first", "last")}


def _bucketed(panel: DataFrame, key: list[str], rd: str, spans: list[Span]) -> DataFrame:
    """Panel rows repeated for every bucket of months their widest window touches.

    They carry no window bounds: those follow from ``rd`` and are made again behind the shuffle (``_bounds``).
    """
    bounds = list(_bounds(spans).values())
    first = F.least(*bounds[::2]) if len(spans) > 1 else bounds[0]
    last = F.greatest(*bounds[1::2]) if len(spans) > 1 else bounds[1]
    return (panel.select(*key, rd).distinct().where(first <= last)
            .withColumn("_bucket", F.explode(F.sequence(_bucket(first, spans), _bucket(last, spans)))))


def window_agg(panel: DataFrame, log: DataFrame, key: list[str], rd: str, ts: str, spans: dict[str, Span],
               measures: dict[str, Measure]) -> DataFrame:
    """Measures of the log per (key, rd) that has any log row in a window; names are measure + suffix."""
    windows = list(spans.values())
    days = daily(log, key, ts, measures).withColumn("_bucket", _bucket("_day", windows))
    joined = _bucketed(panel, key, rd, windows).join(days, [*key, "_bucket"]).withColumns(_bounds(windows))
    any_holds = None
    for i, s in enumerate(windows):
        test = s.holds(i, F.col("_day"))
        any_holds = test if any_holds is None else any_holds | test
    outs = []
    for i, (suffix, s) in enumerate(spans.items()):
        keep = s.holds(i, F.col("_day")) if len(spans) > 1 else None
        outs += [m.merged(name, keep).alias(f"{name}{suffix}") for name, m in measures.items()]
    return joined.where(any_holds).groupBy(*key, rd).agg(*outs)


def fill_measures(df: DataFrame, suffixes, measures: dict[str, Measure]) -> DataFrame:
    """Fill values of windows without a log row."""
    fills = {f"{name}{s}": F.coalesce(F.col(f"{name}{s}"), F.lit(m.fill))
             for s in suffixes for name, m in measures.items() if m.fill is not None}
    return df.withColumns(fills) if fills else df


def lookback_agg(panel: DataFrame, log: DataFrame, key: list[str], rd: str, ts: str, spans: dict[str, Span],
                 measures: dict[str, Measure]) -> DataFrame:
    """Every panel row with the measures of its windows; empty windows get the fill value."""
    found = window_agg(panel, log, key, rd, ts, spans, measures)
    return fill_measures(panel.join(found, [*key, rd], "left"), spans, measures)


def lookback_rows(panel: DataFrame, log: DataFrame, key: list[str], rd: str, ts: str, span: Span) -> DataFrame:
    """The log rows inside the window of each panel row (inner).

    The (key, day) to panel date map is small per key; hot keys of the log are split over tasks.
    """
    dated = log.withColumn("_day", F.col(ts).cast("date"))
    days = dated.select(*key, "_day").distinct().withColumn("_bucket", _bucket("_day", [span]))
    pairs = (_bucketed(panel, key, rd, [span]).join(days, [*key, "_bucket"]).withColumns(_bounds([span]))
             .where(span.holds(0, F.col("_day"))).select(*key, "_day", rd))
    return skew_join(dated, pairs, [*key, "_day"]).drop("_day")


def collapsed_rows(panel: DataFrame, days: DataFrame, key: list[str], rd: str, day: str, span: Span) -> DataFrame:
    """As ``lookback_rows`` for a log already collapsed per key and day, which has no hot keys left."""
    log = days.withColumn("_bucket", _bucket(day, [span]))
    return (_bucketed(panel, key, rd, [span]).join(log, [*key, "_bucket"]).withColumns(_bounds([span]))
            .where(span.holds(0, F.col(day))).drop("_bucket", "_first0", "_last0"))


def lookback_distinct(panel: DataFrame, log: DataFrame, key: list[str], rd: str, ts: str, span: Span, item: str,
                      conditions: dict[str, Column]) -> DataFrame:
    """Distinct items per panel row and condition, 0 for an empty window.

    The panel dates whose windows hold a day lie next to each other. So each day of an item is one stretch of
    panel dates, cut where the item's next day takes over, and the items of a date are the stretches begun
    minus those ended: no log row is repeated for the dates that see it.
    """
    flags = [F.max(F.when(cond, 1).otherwise(0)).alias(name) for name, cond in conditions.items()]
    items = (log.where(F.col(item).isNotNull() & F.col(ts).isNotNull())
             .groupBy(*key, F.col(ts).cast("date").alias("_day"), item).agg(*flags))
    names = F.filter(F.array(*[F.when(F.col(n) == 1, F.lit(n)) for n in conditions]), lambda n: n.isNotNull())
    seen = items.select(*key, "_day", item, F.explode(names).alias("_name"))
    days = items.select(*key, "_day").distinct().withColumn("_bucket", _bucket("_day", [span]))
    dates = panel.select(*key, rd).distinct()
    reach = (_bucketed(dates, key, rd, [span]).join(days, [*key, "_bucket"]).withColumns(_bounds([span])).where(span.holds(0, F.col("_day")))
             .groupBy(*key, "_day").agg(F.min(rd).alias("_first"), F.max(rd).alias("_last")))
    placed = skew_join(seen, reach, [*key, "_day"])
    order = W.partitionBy(*key, item, "_name").orderBy("_day")
    placed = placed.withColumn("_next", F.lead("_first").over(order))
    over = F.coalesce(F.col("_next") <= F.col("_last"), F.lit(False))
    steps = F.array(F.struct(F.col("_first").alias("_at"), F.lit(1).alias("_now"), F.lit(0).alias("_then")),
                    F.struct(F.when(over, F.col("_next")).otherwise(F.col("_last")).alias("_at"),
                             F.when(over, -1).otherwise(0).alias("_now"), F.when(over, 0).otherwise(-1).alias("_then")))
    steps = placed.select(*key, "_name", F.inline(steps))
    sums = steps.groupBy(*key, F.col("_at").alias(rd)).agg(
        *[F.sum(F.when(F.col("_name") == n, F.col(c)).otherwise(0)).alias(f"{c}_{n}") for n in conditions for c in ("_now", "_then")])
    line = dates.join(sums, [*key, rd], "left").fillna(0, [f"{c}_{n}" for n in conditions for c in ("_now", "_then")])
    upto = W.partitionBy(*key).orderBy(rd).rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy(*key).orderBy(rd).rowsBetween(W.unboundedPreceding, -1)
    found = line.select(*key, rd, *[(F.sum(f"_now_{n}").over(upto) + F.coalesce(F.sum(f"_then_{n}").over(before), F.lit(0)))
                                    .cast("long").alias(n) for n in conditions])
    return panel.join(found, [*key, rd], "left").fillna(0, list(conditions))


def _timeline(panel: DataFrame, days: DataFrame, key: list[str], rd: str, strict: bool) -> tuple[DataFrame, object]:
    """Panel dates and day rows on one line per key; a key has at most two rows per calendar day."""
    marks = panel.select(*key, F.col(rd).alias("_day")).distinct().withColumn("_mark", F.lit(0 if strict else 1))
    line = (days.withColumn("_mark", F.lit(1 if strict else 0))
            .unionByName(marks, allowMissingColumns=True))
    order = W.partitionBy(*key).orderBy("_day", "_mark").rowsBetween(W.unboundedPreceding, W.currentRow)
    return line.withColumn("_is_panel", F.col("_mark") == (0 if strict else 1)), order


def history_agg(panel: DataFrame, log: DataFrame, key: list[str], rd: str, ts: str,
                measures: dict[str, Measure], strict: bool = False) -> DataFrame:
    """Measures over the whole history up to ``rd`` (before ``rd`` when ``strict``)."""
    line, order = _timeline(panel, daily(log, key, ts, measures), key, rd, strict)
    run = line.select(*key, "_day", "_is_panel",
                      *[m.merged(name, None, order).alias(name) for name, m in measures.items()])
    found = run.where("_is_panel").withColumnRenamed("_day", rd).drop("_is_panel")
    return fill_measures(panel.join(found, [*key, rd], "left"), [""], measures)


def asof_latest(panel: DataFrame, log: DataFrame, key: list[str], rd: str, ts: str, values: list[str],
                ties: list[str], strict: bool = True) -> DataFrame:
    """``values`` of the latest log row before ``rd``; panel rows without one are kept.

    ``ties`` orders rows of the same moment, the largest wins.
    """
    pick = F.struct(*[F.col(v) for v in values])
    days = (log.where(F.col(ts).isNotNull()).groupBy(*key, F.col(ts).cast("date").alias("_day"))
            .agg(F.max_by(pick, F.struct(ts, *ties)).alias("_row")))
    line, order = _timeline(panel, days, key, rd, strict)
    found = (line.withColumn("_row", F.last("_row", ignorenulls=True).over(order)).where("_is_panel")
             .select(*key, F.col("_day").alias(rd), *[F.col("_row")[v].alias(v) for v in values]))
    return panel.join(found, [*key, rd], "left")


def asof_rows(panel: DataFrame, log: DataFrame, key: list[str], rd: str, ts: str, values: list[str],
              ties: list[str]) -> DataFrame:
    """As ``asof_latest`` for a panel with one row per key and date: its rows stand on the line and are not joined back."""
    known = F.col(ts).isNotNull()
    for c in key:
        known = known & F.col(c).isNotNull()
    pick = F.struct(*[F.col(v) for v in values])
    # the rows are structs, which Spark combines by sorting: they are dealt out before, so that no split is sorted whole
    days = (log.where(known).withColumn("_day", F.col(ts).cast("date")).repartition(*key, "_day").groupBy(*key, "_day")
            .agg(F.max_by(pick, F.struct(ts, *ties)).alias("_row")).withColumn("_mark", F.lit(1)))
    line = panel.withColumns({"_day": F.col(rd).cast("date"), "_mark": F.lit(0)}).unionByName(days, allowMissingColumns=True)
    order = W.partitionBy(*key).orderBy("_day", "_mark").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = line.withColumn("_row", F.last("_row", ignorenulls=True).over(order)).where("_mark = 0")
    return found.select(*panel.columns, *[F.col("_row")[v].alias(v) for v in values])


def other_rows(panel: DataFrame, log: DataFrame, key: list[str], own: str, rd: str, ts: str, span: Span,
               name: str = "others") -> DataFrame:
    """Log rows of the same key in the window that belong to another ``own`` value.

    Counted as all rows of the key minus the own rows, so no pair of rows is ever formed.
    """
    one = {"_all": count()}
    everyone = lookback_agg(panel.select(*key, rd).distinct(), log, key, rd, ts, {"": span}, one)
    mine = window_agg(panel, log, [*key, own], rd, ts, {"": span}, {"_own": count()})
    return (panel.join(everyone, [*key, rd], "left").join(mine, [*key, own, rd], "left")
            .withColumn(name, F.coalesce("_all", F.lit(0)) - F.coalesce("_own", F.lit(0))).drop("_all", "_own"))


def exists_flag(panel: DataFrame, other: DataFrame, key: list[str], rd: str, ts: str, span: Span | None,
                name: str, cond: Column | None = None) -> DataFrame:
    """1 when the window (the whole history when ``span`` is None) holds a matching row, else 0."""
    rows = other if cond is None else other.where(cond)
    hits = (history_agg(panel, rows, key, rd, ts, {name: count()}) if span is None
            else lookback_agg(panel, rows, key, rd, ts, {"": span}, {name: count()}))
    return hits.withColumn(name, (F.col(name) > 0).cast("int"))
