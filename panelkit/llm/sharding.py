"""Sharding by a hierarchical weighted hash tree: region, rack, shard."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import parts_for, written

#: Fixed bytes counted for every document besides its text.
ROW_BYTES = 16
#: Rows numbered together by one task.
ROWS_PER_BUCKET = 20_000


@dataclass(frozen=True)
class Shard:
    """A leaf of the tree; equal names of region and rack put shards under the same node."""

    number: int
    region: str
    rack: str
    weight: float = 1.0


def tree(shards: int, base: int = 40, per_rack: int = 4, racks: int = 2) -> list[Shard]:
    """The layout for a number of shards: ``base`` of them in regions of ``racks`` racks, later ones alone.

    A shard added later stands in a region of its own, so the only subtree whose weight changes is its own.
    """
    out = []
    for i in range(shards):
        region = f"r{i // (per_rack * racks)}" if i < base else f"new{i}"
        out.append(Shard(i, region, f"{region}/{i // per_rack}", 1.0))
    return out


def _draw(key: Column, node: str, weight: float) -> Column:
    """Exponential draw of a node with rate ``weight``: the smallest wins with chance in proportion to it."""
    uniform = (F.shiftrightunsigned(F.xxhash64(key, F.lit(node)), 11) + F.lit(0.5)) * F.lit(2.0 ** -53)
    return -F.log(uniform) / F.lit(float(weight))


def _winner(key: Column, nodes: dict[str, float], then) -> Column:
    """Value of ``then(name)`` for the node whose draw is smallest; equal draws go to the node listed first."""
    live = [(n, w) for n, w in nodes.items() if w > 0]
    if len(live) == 1:
        return then(live[0][0])
    least = F.array_min(F.array(*[F.struct(_draw(key, n, w).alias("d"), F.lit(i).alias("i"))
                                  for i, (n, w) in enumerate(live)]))["i"]

    def choose(i: Column) -> Column:
        out = F.when(i == 0, then(live[0][0]))
        for k, (name, _) in enumerate(live[1:], 1):
            out = out.when(i == k, then(name))
        return out

    return F.element_at(F.transform(F.array(least), choose), 1)  # the draws are made once, not once a branch


def place(key: Column, layout: list[Shard]) -> Column:
    """Shard of a key: the weighted draw picks a region, then a rack inside it, then a shard."""
    if not any(s.weight > 0 for s in layout):
        raise ValueError("no shard has a weight above 0")

    def total(shards: list[Shard], by: str) -> dict[str, float]:
        out: dict[str, float] = {}
        for s in shards:
            out[getattr(s, by)] = out.get(getattr(s, by), 0.0) + s.weight
        return out

    def shard(rack: str) -> Column:
        own = {f"{s.rack}#{s.number}": s for s in layout if s.rack == rack}
        return _winner(key, {n: s.weight for n, s in own.items()}, lambda n: F.lit(own[n].number))

    def rack(region: str) -> Column:
        return _winner(key, total([s for s in layout if s.region == region], "rack"), shard)

    return _winner(key, total(layout, "region"), rack)


def shard(docs: DataFrame, shards: int = 40, layout: list[Shard] | None = None, grown: list[Shard] | None = None,
          rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Shard, place inside the shard and shard after growth of every document (needs doc_id, text).

    Law ``key``: doc_id and the layout alone decide. Adding a shard moves rows only into its own subtree.
    Slots count from 0 without gaps in each shard: rows are numbered inside hash buckets of bounded size,
    and a bucket starts where the ones before it end, so no shard passes through one task. Rows with equal
    doc_id share a shard and are spread over its buckets. Null text has no bytes, null doc_id is a key of
    its own. An empty table gives no rows; extra columns are left out.
    """
    layout = layout or tree(shards)
    grown = grown or tree(shards + 1)
    text = F.coalesce("text", F.lit(""))
    # the bucket count only spreads work: it never decides a shard
    buckets = parts_for(docs.count(), rows_per_bucket * max(1, len(layout)))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = written(docs.select(
        "doc_id", (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), key.alias("_key"),
        F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(buckets)).cast("int").alias("_bucket"))
        .select("*", place(F.col("_key"), layout).alias("shard"), place(F.col("_key"), grown).alias("grown_shard"))
        .drop("_key"))
    counts = rows.groupBy("shard", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("shard", "_bucket").orderBy("doc_id", "text_crc32", "size")
    return (rows.withColumn("_row", F.row_number().over(inside)).join(starts, ["shard", "_bucket"])
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                    (F.col("_start") + F.col("_row") - 1).alias("slot"), "grown_shard"))


def write(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Write the documents under ``path/shard=N``; doc_id must identify a row."""
    docs.join(placed.select("doc_id", "shard", "slot"), "doc_id").repartition("shard", F.floor(F.col("slot") / 100_000)) \
        .write.partitionBy("shard").parquet(path)
