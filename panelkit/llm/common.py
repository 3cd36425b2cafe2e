"""Helpers the text operators share: tables written once, word arrays of whole Arrow batches, group links."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit import scale

#: Most bytes of text handled at once inside a task; one longer document is handled alone.
SLICE_BYTES = 1 << 20
#: Most bytes, as JSON text, of a written table that is sent to every executor.
BROADCAST_BYTES = 16 << 20
#: Name under which a worker process keeps the word tables of tokenizers.
WORD_TABLES = "_panelkit_word_tables"
#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_BREAKS = " \t\n\x0b\f\r"


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back; lost executors cost a re-read only."""
    return scale.checkpoint(df)


def sized(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A written table, marked for broadcast when its rows take at most ``max_bytes``; larger ones are shuffled."""
    return F.broadcast(df) if scale.small(df, max_bytes) else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of ``sf_dir/name.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def parts_for(rows: int, per_part: int) -> int:
    """Number of parts that keeps each near ``per_part`` rows."""
    return max(1, -(-int(rows) // per_part))


# ---- words of many texts at once -----------------------------------------------------------------

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of consecutive texts: byte ranges in ``data``, 64-bit hashes, and each text's word range."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # text i has words first[i] .. first[i + 1] - 1

    def text_of(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


_SPACE = np.zeros(256, bool)
_SPACE[[ord(c) for c in WORD_BREAKS]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offsets of its rows; null counts as empty."""
    vars(sys.modules.get("tokenizers", sys)).pop(WORD_TABLES, None)  # this worker does other work now
    return rows_bytes(column)


def rows_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``text_bytes`` for an operator that keeps the word tables."""
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    at = np.frombuffer(offsets, kind, n + 1, column.offset * kind().itemsize).astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def give_back() -> None:
    """Return what this process has freed to the system: the workers of an executor share its memory, idle ones too."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def lean(run: Callable) -> Callable:
    """A function of Arrow batches that gives its memory back when its task ends."""
    @wraps(run)
    def ending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return ending


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Rows ``a`` to ``b`` of a text column with their bytes and offsets, at most ``size`` bytes or one row each."""
    raw, at = text_bytes(column)
    a, n = 0, len(at) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(at, at[a] + size, "right")) - 1)
        yield a, b, raw[at[a]:at[b]], at[a:b + 1] - at[a]
        a = b
    give_back()


def words(raw: np.ndarray, at: np.ndarray, lower: bool = False, breaks: np.ndarray = _SPACE) -> Words:
    """Maximal runs of bytes that are not word breaks, never across texts. ``lower`` folds A-Z only.

    ``breaks`` says for each of the 256 byte values whether it separates words.
    """
    data = _LOWER[raw] if lower else raw
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~breaks[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = at[:-1][inside[at[:-1]]] if len(data) else at[:0]
    begins[edges] = True
    start = np.flatnonzero(begins)
    stops = np.zeros(len(data) + 1, bool)
    stops[1:] = inside[:-1] & ~inside[1:]
    ends = at[1:][at[1:] > 0]
    stops[ends] |= inside[ends - 1]
    end = np.flatnonzero(stops)
    return Words(data, start, end, hash_ranges(data, start, end), np.searchsorted(start, at))


def hash_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte range, eight bytes a step."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(data) + 1,), "<u8", padded.data, 0, (1,))
    size = (end - start).astype(np.int64)
    out = mix(size.astype(np.uint64) + _M1)
    live = np.flatnonzero(size > 0)
    done = 0
    while len(live):
        left = size[live] - done
        chunk = eights[start[live] + done]
        cut = np.maximum(0, 8 - left).astype(np.uint64) * np.uint64(8)
        chunk = (chunk << cut) >> cut
        out[live] = mix((out[live] ^ chunk) * _M1 + np.uint64(done + 1))
        done += 8
        live = live[left > 8]
    return out


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive values, by doubling; ``len(hashes) - n + 1`` values."""
    if len(hashes) < n:
        return hashes[:0]
    out, have, power, size = None, 0, hashes, 1
    while have < n:
        if n & size:
            if out is None:
                out = power
            else:  # out[i] ends where power[i + have] begins
                both = min(len(out), len(power) - have)
                out = mix(out[:both] * _M1 ^ power[have:have + both])
            have += size
        if have < n:
            power = mix(power[:-size] * _M1 ^ power[size:] + _M2)
            size *= 2
    return out[:len(hashes) - n + 1]


def gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """Byte ranges as a string column."""
    size = end - start
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    inner = np.arange(offsets[-1]) - np.repeat(offsets[:-1], size)
    bytes_ = np.ascontiguousarray(data[np.repeat(start, size) + inner])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(offsets), pa.py_buffer(bytes_)).cast(pa.string())


class Distinct:
    """Sums by 64-bit key inside a task, and the columns stored with each key when it was first seen."""

    def __init__(self) -> None:
        self.keys, self.number, self.sums = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.stored: list[list[pa.Array]] = []

    def add(self, keys: np.ndarray, store) -> None:
        """Count ``keys``; ``store(places)`` gives the columns of those places in ``keys`` that are new."""
        unique, first, counts = np.unique(keys, return_index=True, return_counts=True)
        at = np.searchsorted(self.keys, unique)
        old = at < len(self.keys)
        old[old] = self.keys[at[old]] == unique[old]
        self.sums[self.number[at[old]]] += counts[old]
        new = unique[~old]
        if len(new):
            self.stored.append(store(first[~old]))
            both = np.concatenate([self.keys, new])
            order = np.argsort(both, kind="stable")
            self.number = np.concatenate([self.number, np.arange(len(new)) + len(self.sums)])[order]
            self.keys, self.sums = both[order], np.concatenate([self.sums, counts[~old]])

    def columns(self) -> list[pa.Array]:
        """The stored columns and the sums, one row for each key."""
        return [pa.concat_arrays(c) for c in zip(*self.stored)] + [pa.array(self.sums, pa.int64())]


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return x.view(np.int64)


# ---- links to groups -----------------------------------------------------------------------------

def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Smallest node reachable from each linked node: columns ``node``, ``component``.

    Alternating large and small stars: every node links its larger neighbours, then itself and its smaller
    neighbours, to the smallest of them, until only stars are left; the rounds grow with the logarithm of the
    longest chain. ``edges`` is read more than once, so it should be a written table. Every round is written
    to the shared folder; nothing is collected but one flag.
    """
    after = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v")
    while True:
        both = after.unionByName(after.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                              F.col("m").alias("v")).where("u <> v").distinct()
        after = written(small)
        # only stars are left when every child has one parent and no parent is a child
        ends = after.select(F.col("u").alias("x"), F.lit(1).alias("child"), F.lit(0).alias("parent")).unionByName(
            after.select(F.col("v").alias("x"), F.lit(0).alias("child"), F.lit(1).alias("parent")))
        ends = ends.groupBy("x").agg(F.sum("child").alias("child"), F.max("parent").alias("parent"))
        if ends.where("child + parent > 1").isEmpty():
            roots = after.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return after.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
