"""Exact top-k inner products over an impact-ordered index, score at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit.llm.common import parts_for, written

#: Rows of one index block and of one query block.
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
#: Index blocks of a group; a task holds one group and one query block.
GROUP_BLOCKS = 8
#: Whole numbers a block is kept in.
KINDS = (np.int8, np.int16, np.int32, np.int64)
#: Once at most this share of a block can still be among the best, exact scores cost less than more segments.
RESCORE_SHARE = 0.02


def whole(embedding: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of each component as long; null for null vectors and null or non-finite components."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(embedding.isNotNull() & ~F.coalesce(bad, F.lit(True)),
                  F.transform(embedding, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix of the smallest whole numbers that hold it; shorter vectors end in zeros."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    far = max(int(flat.max(initial=0)), -int(flat.min(initial=0)))
    out = np.zeros((len(size), int(size.max(initial=0))), next(t for t in KINDS if far <= np.iinfo(t).max or t is KINDS[-1]))
    out[np.arange(out.shape[1]) < size[:, None]] = flat
    return out


def _blocks(rows: int):
    """Pack the rows of a task into blocks of at most ``rows``: one binary matrix per row, with the bytes of its numbers."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                m = _matrix(part.column(1))
                ids = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(ids)], pa.int32()), pa.array([m.itemsize], pa.int32()), pa.array([ids.tobytes()], pa.binary()),
                     pa.array([m.tobytes()], pa.binary())], ["n", "width", "ids", "data"])

    return pack


class Segments:
    """Impact-ordered postings of a block: for each impact 2^b the (row, dimension) entries with that bit.

    The value of an entry is the sum of its impacts with its sign, so all segments together give exact scores,
    and after the segments of impact 2^b every value is known up to 2^b - 1.
    """

    def __init__(self, values: np.ndarray):
        self.values = values
        top = int(np.abs(values).max(initial=0))
        self.bits = top.bit_length()

    def segment(self, bit: int, kind) -> np.ndarray:
        """Signed entries of impact 2^bit as a matrix of -1, 0, 1."""
        return (np.sign(self.values) * ((np.abs(self.values) >> bit) & 1)).astype(kind)


def search_block(queries: np.ndarray, query_ids: np.ndarray, block: Segments, ids: np.ndarray, k: int,
                 share: float = RESCORE_SHARE, floor: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its exact best ``k`` rows of the block, as (query place, row places, scores).

    ``floor`` is a score that ``k`` rows of other blocks reach, for each query: rows below it may be left out.
    """
    values = block.values
    dims = max(queries.shape[1], values.shape[1])
    q = np.pad(queries, ((0, 0), (0, dims - queries.shape[1])))
    values = np.pad(values, ((0, 0), (0, dims - values.shape[1])))
    block = Segments(values)
    reach = np.abs(q).astype(float).sum(1) * (2.0 ** block.bits)
    kind = np.float32 if reach.max(initial=0) < 2 ** 24 else np.float64 if reach.max(initial=0) < 2 ** 53 else None
    if kind is None:  # too large for floats to be exact: whole numbers of 64 bits, wrapping as Spark's long does
        yield from _best(np.arange(len(q)), q @ values.T, query_ids, ids, k)
        return
    mass = np.abs(q).sum(1).astype(kind)
    live = np.arange(len(q))
    score = np.zeros((len(q), len(ids)), kind)
    own = ids[None, :] == query_ids[:, None]
    known = np.full(len(q), -np.inf, kind) if floor is None else floor.astype(kind)
    for bit in range(block.bits - 1, -1, -1):
        score += q[live].astype(kind) @ block.segment(bit, kind).T * kind(2 ** bit)
        if bit == 0 or len(ids) <= k:
            continue
        rest = mass[live] * kind(2 ** bit - 1)  # what the segments to come can add or take, at most
        seen = np.where(own[live], -np.inf, score)
        bound = known[live]
        blank = np.flatnonzero(~np.isfinite(bound))  # nothing is known yet: k rows of the block surely reach this
        if len(blank):
            bound[blank] = np.partition(seen[blank], len(ids) - k, axis=1)[:, len(ids) - k] - rest[blank]
        possible = seen + rest[:, None] >= bound[:, None]
        done = np.isfinite(bound) & (possible.sum(1) <= max(k, share * len(ids)))
        for i in np.flatnonzero(done):  # the proof: every other row stays below k known ones
            rows = np.flatnonzero(possible[i])
            exact = values[rows] @ q[live[i]]
            order = np.lexsort((ids[rows], -exact))[:k]
            yield int(live[i]), rows[order], exact[order]
        if done.any():
            live, score = live[~done], score[~done]
        if not len(live):
            return
    yield from _best(live, score.astype(np.int64), query_ids, ids, k)


def _best(places, score, query_ids, ids, k):
    for i, s in zip(places, score):
        rows = np.flatnonzero(ids != query_ids[i])
        if len(rows) > k:
            rows = rows[s[rows] >= np.partition(s[rows], len(rows) - k)[len(rows) - k]]
        order = np.lexsort((ids[rows], -s[rows]))[:k]
        yield int(i), rows[order], s[rows][order]


class Best:
    """The best ``k`` candidates seen so far of each row of a query block."""

    def __init__(self, rows: int, k: int):
        self.k, self.place, self.id, self.score = k, *(np.zeros(0, np.int64) for _ in range(3))
        self.floor = np.full(rows, -np.inf)  # what the last of k known candidates reaches

    def add(self, found: list[tuple[int, np.ndarray, np.ndarray]], ids: np.ndarray) -> None:
        """Take in what a block gave; ties go to the smaller id."""
        if not found:
            return
        place = np.concatenate([self.place, np.repeat([i for i, _, _ in found], [len(x) for _, x, _ in found])]).astype(np.int64)
        id_ = np.concatenate([self.id, *[ids[x] for _, x, _ in found]])
        score = np.concatenate([self.score, *[s for _, _, s in found]]).astype(np.int64)
        order = np.lexsort((id_, -score, place))
        first = np.searchsorted(place[order], place[order])
        order = order[np.arange(len(order)) - first < self.k]
        self.place, self.id, self.score = place[order], id_[order], score[order]
        counts = np.bincount(self.place, minlength=len(self.floor))
        last = np.cumsum(counts) - 1
        full = counts == self.k
        self.floor[full] = self.score[last[full]]


def _search(k: int):
    """Rows of a task come by group, the index blocks of a group before its query blocks: the former are held, the latter pass by."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            for r in range(batch.num_rows):
                to, first, n, width, ids, data = (batch.column(c)[r].as_py() for c in range(6))
                if to != group:
                    group, held = to, []
                ids, m = np.frombuffer(ids, np.int64), np.frombuffer(data, f"i{width}").reshape(n, -1)
                if first is None:
                    held.append((ids, m))
                    continue
                best, q = Best(n, k), m.astype(np.int64)
                for block_ids, block in held:
                    found = search_block(q, ids, Segments(block.astype(np.int64)), block_ids, k, floor=best.floor)
                    best.add(list(found), block_ids)
                yield pa.RecordBatch.from_arrays([pa.array(first + best.place), pa.array(ids[best.place]), pa.array(best.id),
                                                  pa.array(best.score)], ["_q", "query_id", "vec_id", "score"])

    return search


def top_k(vectors: DataFrame, queries: Column, k: int = 5, scale: float = 256.0, block_rows: int = BLOCK_ROWS,
          query_rows: int = QUERY_ROWS, group_blocks: int = GROUP_BLOCKS) -> DataFrame:
    """The ``k`` rows with the largest integer inner product for every query row (needs vec_id, embedding).

    Every row of ``vectors`` is indexed in blocks of at most ``block_rows``; ``queries`` picks the query rows
    of the same table, in blocks too. Index blocks are dealt into groups of about ``group_blocks`` and each query block
    goes to every group, so a task holds one group and one query block, and nothing passes through the driver. The query
    block goes through the posting segments of a block by falling impact, a query stops when only few rows can still be
    among its best, and those are scored exactly. Ties go to the smaller vec_id; a query's own vec_id is no candidate.
    Vectors that are null, empty of numbers to compare or hold null or non-finite components take no part; a
    shorter vector counts as ending in zeros. Repeated query rows are answered each, repeated candidates are
    listed each. An empty table, or a single row, gives no rows. Extra columns are left out.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), whole(F.col("embedding"), scale).alias("v"),
                          F.coalesce(queries, F.lit(False)).alias("_is_query")).where("v is not null and vec_id is not null")
    shape = "n int, width int, ids binary, data binary"
    block = ["n", "width", "ids", "data"]
    index = written(rows.select("vec_id", "v").mapInArrow(_blocks(block_rows), shape)
                    .withColumn("_block", F.monotonically_increasing_id()))
    asked = written(rows.where("_is_query").select("vec_id", "v").mapInArrow(_blocks(query_rows), shape)
                    .withColumn("_qb", F.monotonically_increasing_id()))
    groups = parts_for(index.count(), group_blocks)
    # every query block meets every index block: the query set is asked of all rows. They meet in the task they are dealt
    # to, not in a join: whatever the size of a table of blocks, it is never sent to all
    numbered = index.select(F.pmod(F.xxhash64("_block"), F.lit(groups)).alias("_to"), F.lit(None).cast("long").alias("first"), *block)
    copies = asked.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")).alias("_to"),
                          F.shiftleft("_qb", 12).alias("first"), *block)
    # four parts a group, so that few groups share a part
    dealt = numbered.unionByName(copies).repartition(4 * groups, "_to").sortWithinPartitions("_to", F.col("first").asc_nulls_first())
    best = dealt.mapInArrow(_search(k), "_q long, query_id long, vec_id long, score long")
    order = Window.partitionBy("_q", "query_id").orderBy(F.col("score").desc(), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
