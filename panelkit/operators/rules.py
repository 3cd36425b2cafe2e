"""Market basket rules."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.scale import checkpoint, lookup_join

# executors get the functions below by value and need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Item sets counted in one pass over the baskets.
SETS_PER_PASS = 100_000
BASKETS_PER_BLOCK = 1024
ITEMS_PER_BLOCK = 2048


def frequent_items(baskets: DataFrame, basket: str, item: str, min_support: float) -> DataFrame:
    """Baskets per item, for the items that reach the support."""
    return _frequent(baskets.where(F.col(item).isNotNull()).select(basket, item).distinct(), basket, item, min_support)


def _frequent(unique: DataFrame, basket: str, item: str, min_support: float) -> DataFrame:
    total = unique.agg(F.count_distinct(basket)).scalar()
    return (unique.groupBy(item).agg(F.count(F.lit(1)).alias("n")).withColumn("baskets", total)
            .where(F.col("n") >= F.lit(min_support) * F.col("baskets")))


def _count_block(sets: list[np.ndarray]) -> Iterator[pd.DataFrame]:
    sizes = [len(s) for s in sets]
    codes, names = pd.factorize(np.concatenate(sets).astype(object), sort=True)
    rows = np.repeat(np.arange(len(sets)), sizes)
    starts = range(0, len(names), ITEMS_PER_BLOCK)

    def dense(start: int) -> np.ndarray:
        width = min(ITEMS_PER_BLOCK, len(names) - start)
        mine = (codes >= start) & (codes < start + width)
        out = np.zeros((len(sets), width), dtype=np.float32)
        out[rows[mine], codes[mine] - start] = 1.0
        return out

    for a in starts:
        left = dense(a)
        for b in starts:
            if b < a:
                continue
            together = left.T @ (left if a == b else dense(b))
            i, j = np.nonzero(np.triu(together, 1) if a == b else together)
            yield pd.DataFrame({"item_a": names[a + i], "item_b": names[b + j],
                                "n": together[i, j].astype("int64")})


def _count_together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        sets = list(batch["items"])
        for at in range(0, len(sets), BASKETS_PER_BLOCK):
            yield from _count_block(sets[at:at + BASKETS_PER_BLOCK])


def pair_counts(baskets: DataFrame, basket: str, item: str, frequent: DataFrame) -> DataFrame:
    """Number of baskets holding both items, for pairs of frequent items.

    A basket is reduced to its frequent items, at most (mean basket size / support) of them. Blocks of
    baskets are counted together as a matrix product, so pairs of single baskets are never written.
    """
    unique = baskets.where(F.col(item).isNotNull()).select(basket, item).distinct()
    return _pairs(_item_sets(unique, basket, item, frequent))


def _pairs(sets: DataFrame) -> DataFrame:
    return (sets.where(F.size("items") > 1).mapInPandas(_count_together, "item_a string, item_b string, n long")
            .groupBy("item_a", "item_b").agg(F.sum("n").alias("n")))


def pair_rules(baskets: DataFrame, basket: str, item: str, min_support: float, min_confidence: float = 0.0,
               min_lift: float = 0.0) -> DataFrame:
    """Support, confidence and lift of every pair of items, in both directions."""
    if min_support <= 0:
        raise ValueError("minimum support must be positive")
    baskets = checkpoint(baskets.select(basket, item).distinct())
    baskets = baskets.where(F.col(item).isNotNull())
    frequent = checkpoint(_frequent(baskets, basket, item, min_support))
    pairs = pair_counts(baskets, basket, item, frequent)
    both = pairs.select("item_a", "item_b", "n").unionByName(
        pairs.select(F.col("item_b").alias("item_a"), F.col("item_a").alias("item_b"), "n"))
    a = frequent.select(F.col(item).cast("string").alias("item_a"), F.col("n").alias("_na"), "baskets")
    b = frequent.select(F.col(item).cast("string").alias("item_b"), F.col("n").alias("_nb"))
    total = F.col("baskets")
    return (both.join(a, "item_a").join(b, "item_b")
            .select("item_a", "item_b", F.col("n").alias("together"), (F.col("n") / total).alias("support"),
                    (F.col("n") / F.col("_na")).alias("confidence"),
                    (F.col("n") * total / (F.col("_na") * F.col("_nb"))).alias("lift"))
            .where((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence)
                   & (F.col("lift") >= min_lift)))


def _item_sets(unique: DataFrame, basket: str, item: str, frequent: DataFrame) -> DataFrame:
    """Baskets, of unique rows, as sets of their frequent items, of which there are few; others cannot be in a frequent set."""
    text = F.col(item).cast("string").alias("item")
    kept = lookup_join(unique.select(basket, text), frequent.select(text), ["item"], "left_semi")
    return kept.groupBy(basket).agg(F.collect_list("item").alias("items")).select("items")


def candidates(found: DataFrame) -> DataFrame:
    """Sets one item longer than those of ``found`` (items, sorted) of which every part of that length is in ``found``.

    Two sets that agree in all but their last item make a candidate; its other parts are looked up.
    """
    sets = found.select("items", F.slice("items", 1, F.size("items") - 1).alias("_head"), F.element_at("items", -1).alias("_last"))
    joined = (sets.alias("a").join(sets.select("_head", F.col("_last").alias("_next")), "_head").where("_last < _next")
              .select(F.concat("items", F.array("_next")).alias("items")))
    parts = joined.select("items", F.explode(F.transform("items", lambda x: F.array_remove("items", x))).alias("_part"))
    whole = parts.join(found.select(F.col("items").alias("_part")), "_part").groupBy("items").agg(F.count(F.lit(1)).alias("_n"))
    return whole.where(F.col("_n") == F.size("items")).select("items")


def _count_sets(wanted: list[list[str]]):
    """Batches of baskets to the number of them that hold each wanted set, from one bit row for each item."""
    items = sorted({i for s in wanted for i in s})
    index = pd.Index(items, dtype=object)
    columns = np.array([index.get_indexer(s) for s in wanted])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(wanted), dtype=np.int64)
        for batch in batches:
            sets = batch["items"].tolist()
            for at in range(0, len(sets), BASKETS_PER_BLOCK):
                block = sets[at:at + BASKETS_PER_BLOCK]
                held = np.zeros((len(items), len(block)), dtype=bool)
                rows = index.get_indexer(np.concatenate(block).astype(object))
                held[rows[rows >= 0], np.repeat(np.arange(len(block)), [len(b) for b in block])[rows >= 0]] = True
                bits = np.packbits(held, axis=1)
                for c in range(0, len(columns), 4096):
                    part = columns[c:c + 4096]
                    both = bits[part[:, 0]]
                    for k in range(1, part.shape[1]):
                        both = both & bits[part[:, k]]
                    total[c:c + 4096] += np.bitwise_count(both).sum(axis=1, dtype=np.int64)
        if total.any():
            left = np.flatnonzero(total)
            yield pd.DataFrame({"at": left, "n": total[left]})

    return run


def set_counts(sets: DataFrame, wanted: DataFrame, per_pass: int = SETS_PER_PASS) -> DataFrame:
    """Number of baskets (column items) that hold each of the ``wanted`` sets of one length: items, freq.

    A task turns a block of baskets into bits and combines the bit rows of a set's items, so no pair of basket and
    set is written. The wanted sets go to the tasks ``per_pass`` at a time, in as many passes as they need.
    """
    spark = sets.sparkSession
    passes = max(1, -(-wanted.count() // per_pass))
    out = None
    for i in range(passes):
        # the hash deals the sets evenly, so a part stays near per_pass
        part = sorted(r["items"] for r in wanted.where(F.pmod(F.xxhash64("items"), F.lit(passes)) == i).collect())
        if not part:
            continue
        names = spark.createDataFrame(list(enumerate(part)), "at long, items array<string>")
        found = sets.mapInPandas(_count_sets(part), "at long, n long").groupBy("at").agg(F.sum("n").alias("freq"))
        one = found.join(names, "at").select("items", "freq")
        out = one if out is None else out.unionByName(one)
    return wanted.select("items", F.lit(0).cast("long").alias("freq")).where("false") if out is None else out


def frequent_itemsets(baskets: DataFrame, basket: str, item: str, min_support: float,
                      max_length: int | None = None) -> DataFrame:
    """Item sets that reach the support, with their basket count, mined level by level up to ``max_length``.

    Pairs are counted as block products; a longer set is counted only if all its parts are frequent, and
    nothing longer than ``max_length`` is made. Baskets are reduced to their frequent items once.
    """
    return _mined(baskets, basket, item, min_support, max_length)[0]


def _mined(baskets: DataFrame, basket: str, item: str, min_support: float, max_length: int | None) -> tuple[DataFrame, int | None]:
    """The frequent item sets and the number of baskets, None if nothing is frequent."""
    if min_support <= 0:
        raise ValueError("minimum support must be positive")
    baskets = checkpoint(baskets.where(F.col(item).isNotNull()).select(basket, item).distinct())
    frequent = checkpoint(_frequent(baskets, basket, item, min_support))
    total = frequent.agg(F.max("baskets")).first()[0]
    out = frequent.select(F.array(F.col(item).cast("string")).alias("items"), F.col("n").alias("freq"))
    if not total or max_length == 1:
        return out, total
    # the sets are written once for all levels
    sets = checkpoint(_item_sets(baskets, basket, item, frequent).where(F.size("items") > 1))
    pairs = _pairs(sets).where(F.col("n") >= min_support * total)
    level = pairs.select(F.sort_array(F.array("item_a", "item_b")).alias("items"), F.col("n").alias("freq"))
    if max_length == 2:
        return out.unionByName(level), total
    level, length = checkpoint(level), 2
    sets = sets.where(F.size("items") > 2)
    while not level.isEmpty():
        out = out.unionByName(level)
        if length == max_length:
            break
        wanted = checkpoint(candidates(level))
        level = checkpoint(set_counts(sets, wanted).where(F.col("freq") >= min_support * total))
        length += 1
    return out, total


def rules(baskets: DataFrame, basket: str, item: str, min_support: float, min_confidence: float = 0.0,
          min_lift: float = 0.0, max_length: int | None = None) -> DataFrame:
    """Rules with one added item; single items come with an empty base, confidence = support and lift 1."""
    if min_support <= 0:
        raise ValueError("minimum support must be positive")
    mined, total = _mined(baskets, basket, item, min_support, max_length)
    found, total = checkpoint(mined), F.lit(total).cast("long")
    sizes = found.select(F.col("items").alias("_set"), F.col("freq").alias("_n"))
    # each frequent set gives one rule per item it adds to the rest of the set, which is frequent too
    made = found.where(F.size("items") > 1).select("items", "freq", F.explode("items").alias("added"))
    made = made.select("freq", "added", F.array_remove(F.col("items"), F.col("added")).alias("items_base"))
    made = made.join(sizes.withColumnRenamed("_n", "_nb"), F.col("items_base") == F.col("_set")).drop("_set")
    made = made.join(sizes.withColumnRenamed("_n", "_na"), F.array("added") == F.col("_set")).drop("_set")
    made = made.withColumn("_all", total).select(
        "items_base", F.array("added").alias("items_add"), (F.col("freq") / F.col("_all")).alias("support"),
        (F.col("freq") / F.col("_nb")).alias("confidence"),
        (F.col("freq") / F.col("_nb") / (F.col("_na") / F.col("_all"))).alias("lift"))
    single = (found.where(F.size("items") == 1).withColumn("_all", total)
              .select(F.array().cast("array<string>").alias("items_base"), F.col("items").alias("items_add"),
                      (F.col("freq") / F.col("_all")).alias("support"), (F.col("freq") / F.col("_all")).alias("confidence"),
                      F.lit(1.0).alias("lift")))
    return made.unionByName(single).where((F.col("confidence") >= min_confidence) & (F.col("lift") >= min_lift))
