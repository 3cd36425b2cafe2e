"""Exact order statistics by counting: no sort of the rows and no copy of them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows sampled as pivots in a round, and most rows that are looked at one by one in the end.
PIVOTS, FEW = 4096, 20_000


@dataclass
class _Range:
    """Where the row of a rank is: after ``low`` (with ``below`` rows up to it), before ``high`` (``upto`` rows before it)."""

    rank: int
    low: tuple | None
    below: int
    high: tuple | None
    upto: int
    found: tuple | None = None

    @property
    def rows(self) -> int:
        return 0 if self.found is not None else self.upto - self.below


def _order(row: tuple) -> tuple:
    """Sort key of a row as Spark orders it: null first, NaN after all numbers."""
    return tuple((0, 0, 0) if v is None else (1, int(v != v), 0 if v != v else v) for v in row)


def rows_at(df: DataFrame, columns: list[str], ranks: list[int], few: int = FEW, pivots: int = PIVOTS,
            n: int | None = None) -> list[tuple]:
    """The rows (values of ``columns``) at 1-based ``ranks`` in the order of ``columns``.

    Every round samples pivots from the ranges that still hold a wanted rank, brackets each rank between two of
    them and counts, in one aggregate, the rows before and up to every bracket. A range shrinks to a few
    thousandths each round; when all ranges together have at most ``few`` rows, these are looked at. Equal rows need no
    special care: a rank inside the copies of a pivot is found as soon as they are counted. Only pivots,
    counts and the last few rows reach the driver.
    """
    kinds = [df.schema[c].dataType for c in columns]
    place = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(columns)])

    def border(row: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(f"c{i}") for i, (v, t) in enumerate(zip(row, kinds))])

    def inside(r: _Range) -> Column:
        out = F.lit(True)
        if r.low is not None:
            out = out & (place > border(r.low))
        if r.high is not None:
            out = out & (place < border(r.high))
        return out

    n = df.count() if n is None else n
    if any(not 1 <= r <= n for r in ranks):
        raise ValueError(f"ranks must lie between 1 and the {n} rows")
    ranges = [_Range(r, None, 0, None, n) for r in ranks]
    turn = 0
    while live := [r for r in ranges if r.found is None]:
        spans = {(r.low, r.high): r for r in live}
        where = F.lit(False)
        for r in spans.values():
            where = where | inside(r)
        rows = df.where(where).select(*columns)
        if sum(r.rows for r in spans.values()) <= few:
            left = sorted((tuple(x) for x in rows.collect()), key=_order)
            for r in live:
                own = [x for x in left if (r.low is None or _order(x) > _order(r.low)) and (r.high is None or _order(x) < _order(r.high))]
                r.found = own[r.rank - r.below - 1]
            break
        # a sample by hash: each task keeps its smallest, nothing is shuffled but those
        sample = rows.orderBy(F.xxhash64(*columns, F.lit(turn)), *columns).limit(pivots).collect()
        turn += 1
        sample = sorted({tuple(x) for x in sample}, key=_order)
        asked = set()
        for r in live:
            own = [x for x in sample if (r.low is None or _order(x) > _order(r.low)) and (r.high is None or _order(x) < _order(r.high))]
            if own:
                at, room = len(own) * (r.rank - r.below) / r.rows, 2 * len(own) ** 0.5
                asked |= {own[max(0, min(len(own) - 1, int(at + d)))] for d in (-room, 0, room)}
        asked = sorted(asked, key=_order)
        counts = df.agg(*[F.count_if(place < border(p)).alias(f"b{i}") for i, p in enumerate(asked)],
                        *[F.count_if(place <= border(p)).alias(f"u{i}") for i, p in enumerate(asked)]).first()
        for r in live:
            for i, p in enumerate(asked):
                if counts[f"b{i}"] < r.rank <= counts[f"u{i}"]:
                    r.found = p
                elif counts[f"u{i}"] < r.rank and counts[f"u{i}"] >= r.below:
                    r.low, r.below = p, counts[f"u{i}"]
                elif counts[f"b{i}"] >= r.rank and counts[f"b{i}"] <= r.upto:
                    r.high, r.upto = p, counts[f"b{i}"]
    return [r.found for r in ranges]


def tile_starts(n: int, k: int) -> list[int]:
    """The ranks at which tiles 2 to ``k`` of ``n`` rows begin; tiles without rows are left out."""
    small, larger = divmod(n, k)
    starts, at = [], 1
    for tile in range(1, k):
        at += small + (tile <= larger)
        if at <= n:
            starts.append(at)
    return starts


def quantile_label(df: DataFrame, col: str, key: list[str], k: int, name: str, **sizes) -> DataFrame:
    """Quantile bucket 1..k of ``col``, ties by ``key``: the label ``ntile`` gives, from k - 1 exact border rows."""
    columns = [col, *key]
    narrow = df.select(*columns)
    n = narrow.count()
    starts = rows_at(narrow, columns, tile_starts(n, k), n=n, **sizes)
    kinds = [narrow.schema[c].dataType for c in columns]
    label = F.lit(1)
    for row in starts:
        border = F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(row, kinds, columns)])
        label = label + (F.struct(*columns) >= border).cast("int")
    return df.withColumn(name, label.cast("int"))
