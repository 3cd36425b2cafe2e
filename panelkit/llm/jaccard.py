"""Exact n-gram Jaccard join: documents linked by similar shingle sets, and the groups those links make."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelkit.llm.common import WORD_BREAKS, components, give_back, lean, mix, parts_for, runs, signed, sized, slices, words, written

#: Words of a shingle, and the smallest similarity of linked sets in hundredths.
SHINGLE = 5
PERCENT = 80
#: Entries of one part of the counting index, and entries a task gathers before it hands them on.
PART_ENTRIES = 2_000_000
BATCH_ENTRIES = 500_000
#: Minima and bands that pick each set's first partner; they only order the work.
BANDS, BAND_ROWS = 4, 2

_SALT = np.uint64(0x5851F42D4C957F2D)


def shingle_sets(raw: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; fewer words than a shingle count as one, none as empty."""
    w = words(raw, at, lower=True)
    h = runs(w.hash, SHINGLE)
    for lo, hi in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if hi - lo >= SHINGLE:
            yield np.unique(h[lo:hi - SHINGLE + 1])
        elif hi > lo:
            yield mix(runs(w.hash[lo:hi], hi - lo) + np.uint64(0x5851F42D4C957F2D ^ (hi - lo)))
        else:
            yield w.hash[:0]


def identity(s: np.ndarray) -> int:
    """64-bit name of a set, equal for equal sets."""
    with np.errstate(over="ignore"):
        return int(mix(np.add.reduce(mix(s ^ _SALT), keepdims=True) + np.uint64(len(s)))[0].view(np.int64)) if len(s) else 0


def least_overlap(n, percent: int = PERCENT):
    """Elements that a set of size n shares with any partner, at least."""
    return -(-n * percent // 100)


def _head(n: int, percent: int) -> int:
    """Length of the head of a set in which partners meet several times: see ``_meetings``."""
    return min(n, n - least_overlap(n, percent) + 1 + n // 10)


def _meetings(n: Column, percent: int) -> Column:
    """How many elements of the head of a set of size n its partner's head holds too, at least.

    Two sets that share o elements share m of them among their first n - o + m in any common order. With
    m = 1 + n // 10 of the smaller set, which has at least percent / 100 of the larger one's elements.
    """
    return F.lit(1) + F.floor(n * F.lit(percent) / F.lit(1000))


@lean
def _name_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, name = [], []
        for _, _, raw, at in slices(batch.column(2)):
            for s in shingle_sets(raw, at):
                size.append(len(s))
                name.append(identity(s))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(size, pa.int64()),
                                          pa.array(name, pa.int64())], ["doc_id", "_text", "n", "sig"])


def _hand_on(entries: list[np.ndarray], parts: int) -> Iterator[pa.RecordBatch]:
    """Entries (hash, set) of one task by part of the index.

    A hash that two sets of the task share is settled here: both are counted, and the index only learns that
    the hash is shared. So the index gets one entry per task and hash, however common the hash is.
    """
    if not entries:
        return
    h, sig = _unique_pairs(np.concatenate(entries, axis=1))
    first = np.append(True, h[1:] != h[:-1])
    count = np.diff(np.append(np.flatnonzero(first), len(h)))
    settled = np.repeat(count > 1, count)
    ids, n = np.unique(sig[settled], return_counts=True)
    lone_h, lone_s, known = h[~settled], sig[~settled], h[first][count > 1]
    where, where_known, where_ids = lone_h % np.uint64(parts), known % np.uint64(parts), ids % np.uint64(parts)
    by, by_known, by_ids = (np.argsort(x, kind="stable") for x in (where, where_known, where_ids))
    cuts = [np.searchsorted(x[o], np.arange(parts + 1, dtype=np.uint64)) for x, o in
            ((where, by), (where_known, by_known), (where_ids, by_ids))]
    rows: list[list] = [[] for _ in range(6)]
    for p in range(parts):
        a, b, c = (o[k[p]:k[p + 1]] for o, k in zip((by, by_known, by_ids), cuts))
        if len(a) or len(b) or len(c):
            for col, v in zip(rows, (p, lone_h[a].tobytes(), lone_s[a].tobytes(), known[b].tobytes(), ids[c].tobytes(),
                                     n[c].astype(np.int64).tobytes())):
                col.append(v)
    yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *[pa.array(r, pa.binary()) for r in rows[1:]]],
                                     ["part", "hashes", "sets", "shared", "ids", "counts"])


def _unique_pairs(pair: np.ndarray) -> np.ndarray:
    pair = pair[:, np.lexsort((pair[1], pair[0]))]
    new = np.append(True, (pair[0, 1:] != pair[0, :-1]) | (pair[1, 1:] != pair[1, :-1]))
    return pair[:, new]


def _entries(parts: int, percent: int):
    @lean
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            for _, _, raw, at in slices(batch.column(0)):
                for s in shingle_sets(raw, at):
                    if len(s):
                        head = s[:_head(len(s), percent)]
                        held.append(np.stack([head, np.full(len(head), identity(s), np.int64).view(np.uint64)]))
                        count += len(head)
                if count >= BATCH_ENTRIES:
                    yield from _hand_on(held, parts)
                    held, count = [], 0
        yield from _hand_on(held, parts)

    return emit


def _packed(column: pa.Array) -> np.ndarray:
    """The 64-bit numbers of all rows of a binary column, one after the other."""
    at = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset) if len(column) else [0, 0]
    data = column.buffers()[2]
    return np.frombuffer(data, np.uint64, (at[-1] - at[0]) // 8, int(at[0])) if data is not None and at[-1] > at[0] else np.zeros(0, np.uint64)


def _count_shared(table: pa.Table) -> pa.Table:
    """For one part of the index: how many of its hashes each set shares with another set."""
    cols = {c: np.concatenate([_packed(x) for x in table[c].chunks] or [np.zeros(0, np.uint64)])
            for c in ("hashes", "sets", "shared", "ids", "counts")}
    if len(cols["hashes"]):
        h, sig = _unique_pairs(np.stack([cols["hashes"], cols["sets"]]))
        same = np.zeros(len(h), bool)
        same[1:] |= h[1:] == h[:-1]
        same[:-1] |= h[1:] == h[:-1]
        same |= np.isin(h, cols["shared"])
        ids, n = np.unique(sig[same], return_counts=True)
    else:
        ids, n = cols["ids"][:0], np.zeros(0, np.int64)
    out = pa.table({"sig": signed(np.concatenate([ids, cols["ids"]])),
                    "shared": np.concatenate([n.astype(np.int64), cols["counts"].view(np.int64)])})
    del cols
    give_back()
    return out


@lean
def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, raw, at in slices(batch.column(2)):
            sets = [s.tobytes() for s in shingle_sets(raw, at)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), batch.column(1).slice(a, b - a),
                                              pa.array(sets, pa.binary())], ["sig", "n", "elems"])


@lean
def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seeds = mix(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64))
    for batch in batches:
        keys = []
        for e in batch.column(1):
            s = np.frombuffer(e.as_buffer(), np.uint64)
            low = np.array([mix(s ^ k).min() for k in seeds], np.uint64).reshape(BANDS, BAND_ROWS)
            keys.append(mix(low[:, 0] * _SALT ^ np.bitwise_xor.reduce(mix(low[:, 1:]), axis=1)
                            + np.arange(BANDS, dtype=np.uint64)))
        if keys:
            sig = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(sig, BANDS)), pa.array(signed(np.concatenate(keys)))],
                                             ["sig", "key"])


def _linked(percent: int):
    @lean
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return check


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of sets whose similarity, counted exactly, is high enough."""
    asked = sized(written(pairs))
    side = lambda c, name: sets.select(F.col("sig").alias(c), F.col("elems").alias(name)).join(asked, c).select("a", "b", name)
    return side("a", "_x").join(side("b", "_y"), ["a", "b"]).mapInArrow(_linked(percent), "a long, b long")


def _explode(head_only: bool, percent: int):
    @lean
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = [np.frombuffer(e.as_buffer(), np.uint64) for e in batch.column(3)]
            held = [s[:_head(len(s), percent)] if head_only else s for s in held]
            row = pa.array(np.repeat(np.arange(len(held)), [len(s) for s in held]))
            if len(row):
                yield pa.RecordBatch.from_arrays([batch.column(c).take(row) for c in range(3)]
                                                 + [pa.array(signed(np.concatenate(held)))], ["sig", "n", "label", "h"])

    return rows


def _lists(sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Index lists of the sets that could link across labels: sig, n, label, h, p, c, block.

    First only sets whose head meets other labels often enough stay. Of their elements only those that
    another label holds too count (c of them); a set needs enough of these. They are ordered so that rare ones
    come first, and a set is listed for its rare part alone, at its positions p.
    """
    rows = written(sets.join(sized(labels), sets["sig"] == labels["node"], "left").select(
        "sig", "n", F.coalesce("component", "sig").alias("label"), "elems"))
    shape = "sig long, n long, label long, h long"
    heads = rows.mapInArrow(_explode(True, percent), shape)
    common = heads.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("h")
    live = written(heads.join(common, "h", "left_semi").groupBy("sig", "n").agg(F.count(F.lit(1)).alias("k"))
                   .where(F.col("k") >= _meetings(F.col("n"), percent)).select("sig"))
    listed = rows.join(sized(live), "sig", "left_semi").select("sig", "n", "label", "elems").mapInArrow(_explode(False, percent), shape)
    seen = (listed.groupBy("h").agg(F.count(F.lit(1)).alias("f"), F.min("label").alias("lo"), F.max("label").alias("hi"))
            .where("lo < hi").select("h", "f"))
    own = Window.partitionBy("sig")
    need = F.ceil(F.col("n") * F.lit(percent) / F.lit(100))
    listed = (listed.join(seen, "h").withColumn("c", F.count(F.lit(1)).over(own))
              .withColumn("p", F.row_number().over(own.orderBy("f", "h")))
              .where(F.col("p") <= F.col("c") - need + 1))
    block = F.floor(F.log(F.col("n").cast("double")) / F.lit(np.log(100 / percent))).cast("int")
    return written(listed.select("sig", "n", "label", "h", "p", "c", block.alias("block")))


def _across(listed: DataFrame, percent: int) -> DataFrame:
    """All pairs of listed sets with different labels that could link.

    Lists are split into blocks by set size; a set meets only the blocks whose sizes fit its own. A pair comes
    from the first element both sets have in common: what they can share is that element and what stands after
    it in either list. Sets that link pass this test there; at a later common element it may fail.
    """
    x = listed.select(*[F.col(c).alias(f"x_{c}") for c in listed.columns])
    y = listed.withColumn("block", F.explode(F.array(F.col("block") - 1, F.col("block"), F.col("block") + 1)))
    y = y.select(*[F.col(c).alias(f"y_{c}") for c in listed.columns])
    most = 1 + F.least(F.col("x_c") - F.col("x_p"), F.col("y_c") - F.col("y_p"))
    fits = ((F.col("x_h") == F.col("y_h")) & (F.col("x_block") == F.col("y_block")) & (F.col("x_sig") < F.col("y_sig"))
            & (F.col("x_label") != F.col("y_label")) & (100 * F.col("x_n") >= percent * F.col("y_n"))
            & (100 * F.col("y_n") >= percent * F.col("x_n"))
            & (100 * most >= percent * (F.col("x_n") + F.col("y_n") - most)))
    return x.join(y, fits).select(F.col("x_sig").alias("a"), F.col("y_sig").alias("b")).distinct()


def join(docs: DataFrame, percent: int = PERCENT, part_entries: int = PART_ENTRIES) -> DataFrame:
    """Shingle count and group of every document (needs doc_id, text): doc_id, n_shingles, component_id.

    Documents with equal sets are one set. An index over the heads of all sets (their smallest hashes) tells
    how often each set meets another; sets that cannot reach the similarity drop out. The others first take
    their answers from a similar set: they are checked against one set with the same minima, and all that
    link to it share its group. Then only pairs across groups are left, found by block-skipping index lists;
    each is counted exactly. Links are exact: 100 * intersection >= percent * union. Sets are sets of 64-bit
    hashes. Null, empty and blank texts have an empty set and stand alone; fewer words than a shingle are one
    shingle; a null doc_id never names a group; repeated rows fall into one group. An empty table gives no
    rows; extra columns are left out.
    """
    named = groups(docs, percent, part_entries)
    least = named.where("n > 0").groupBy("_group").agg(F.min("doc_id").alias("component_id"))
    return (named.where("n > 0").join(least, "_group").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
            .unionByName(named.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"),
                                                     F.col("doc_id").alias("component_id"))))


def groups(docs: DataFrame, percent: int = PERCENT, part_entries: int = PART_ENTRIES) -> DataFrame:
    """doc_id, _text (hash of the text), n (size of its set) and _group of every document; null for empty sets."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.xxhash64("text").alias("_text"), "text")
    named = written(texts.mapInArrow(_name_sets, f"doc_id {kind}, _text long, n long, sig long"))
    found = components(links(docs, texts, named, percent, part_entries), "a", "b")
    return written(named.join(found, named["sig"] == found["node"], "left").select(
        "doc_id", "_text", "n", F.when(F.col("n") > 0, F.coalesce("component", "sig")).alias("_group")))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows, with all their columns, of one document of each group: the smallest doc_id, null last.

    Rows with an empty set all stay, so those of null and empty texts do; of rows with equal doc_id and text in a group the
    one that is first by a hash of its columns stays. An empty table gives no rows; extra columns, whatever their names, are kept.
    """
    found = groups(docs, percent)
    first = (found.where("n > 0").groupBy("_group")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text")).alias("r"))
             .select(F.col("r.doc_id").alias("_id"), F.col("r._text").alias("_hash")))
    blank = F.length(F.translate(F.coalesce("text", F.lit("")), WORD_BREAKS, "")) == 0
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("hash"), blank.alias("blank"))
    place = F.xxhash64(*[F.col("row")[f.name] for f in docs.schema.fields if f.name != "text" and not isinstance(f.dataType, T.MapType)])
    chosen = (rows.where("not blank").join(first, rows["id"].eqNullSafe(F.col("_id")) & (rows["hash"] == F.col("_hash")), "left_semi")
              .groupBy("id", "hash").agg(F.min_by("row", place).alias("row")))
    return chosen.select("row").unionByName(rows.where("blank").select("row")).select("row.*")


def links(docs: DataFrame, texts: DataFrame, named: DataFrame, percent: int, part_entries: int) -> DataFrame:
    """Links (a, b) between names of sets that connect exactly what all links would connect."""
    total = named.agg(F.sum("n")).first()[0] or 0
    parts = parts_for(total * 3 // 10, part_entries)
    packed = docs.select("text").mapInArrow(
        _entries(parts, percent), "part int, hashes binary, sets binary, shared binary, ids binary, counts binary")
    shared = packed.groupBy("part").applyInArrow(_count_shared, "sig long, shared long")
    shared = shared.groupBy("sig").agg(F.sum("shared").alias("shared"))
    # a row with an id stands for its set where there is one, so rows without are looked up for few sets
    reps = named.where("n > 0").groupBy("sig", "n").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text")).alias("r"))
    live = written(reps.join(shared, "sig").where(F.col("shared") >= _meetings(F.col("n"), percent))
                   .select("sig", "n", "shared", "r.doc_id", "r._text"))
    picked = sized(live.select("sig", "n", F.col("doc_id").alias("_id"), F.col("_text").alias("_hash")))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_text") == F.col("_hash"))
    sets = written(texts.join(picked, same).dropDuplicates(["sig"]).select("sig", "n", "text")
                   .mapInArrow(_elements, "sig long, n long, elems binary"))
    keys = sets.select("sig", "elems").mapInArrow(_band_keys, "sig long, key long")
    keys = written(keys)
    # the first partner of a set is the one with its minima that meets most others: edits make a set meet fewer
    ranked = keys.join(sized(live.select("sig", (F.col("shared") / F.col("n")).alias("rank"))), "sig")
    first = (ranked.groupBy("key").agg(F.max_by("sig", F.struct("rank", "sig")).alias("b"), F.count(F.lit(1)).alias("k"))
             .where("k > 1").select("key", "b"))
    stars = keys.join(first, "key").where("sig <> b").select(F.col("sig").alias("a"), "b").distinct()
    stars = written(verified(stars, sets, percent))
    listed = _lists(sets, written(components(stars, "a", "b")), percent)
    return written(stars.unionByName(verified(_across(listed, percent), sets, percent)))
