"""Removal of repeated passages by relative Lempel-Ziv factors over an index of reference blocks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit import scale
from panelkit.llm.common import BROADCAST_BYTES, Words, mix, runs, signed, slices, words, written

#: Words of a factor that counts as a duplicate.
WINDOW = 50
#: Words of the seed that anchors a block inside a window.
SEED = 20
#: Most windows of one block.
BLOCK = 32

_WEIGHTS = mix(np.arange(1, BLOCK + 1, dtype=np.uint64)) | np.uint64(1)


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Smallest of every ``n`` consecutive values."""
    out, size = x, 1
    while 2 * size <= n:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return out if size == n else np.minimum(out[:len(x) - n + 1], out[n - size:])


class Blocks:
    """Windows of all texts of a slice, cut into blocks of neighbouring windows with the same anchor.

    A window is WINDOW consecutive words; its anchor is the smallest seed hash inside it, so equal windows
    have equal anchors wherever they stand. A block is a run of windows of one text with the same anchor.
    """

    def __init__(self, w: Words):
        self.window = runs(w.hash, WINDOW)
        n = len(self.window)
        text = w.text_of()
        whole = text[:n] == text[WINDOW - 1:] if n else np.zeros(0, bool)
        at = np.flatnonzero(whole)
        self.text = text[at]
        if not n:
            self.anchor = self.window
        else:
            self.anchor = _sliding_min(runs(w.hash, SEED), WINDOW - SEED + 1)[at]
        self.window = self.window[at]
        self.place = at - w.first[self.text]  # window start inside its text
        m = len(at)
        new = np.ones(m, bool)
        if m:
            new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.text[1:] != self.text[:-1])
        begins = np.flatnonzero(new)
        length = np.diff(np.append(begins, m))
        # long runs (repeats inside a text) are cut, so that a block has at most BLOCK windows
        pieces = -(-length // BLOCK)
        first = np.repeat(begins, pieces) + BLOCK * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        self.first = first
        self.size = np.diff(np.append(first, m))
        if m:
            inside = np.arange(m) - np.repeat(first, self.size)
            self.content = mix(np.add.reduceat(mix(self.window) * _WEIGHTS[inside], first) + self.size.astype(np.uint64))
        else:
            self.content = self.window


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, raw, at in slices(batch.column(2)):
            k = Blocks(words(raw, at))
            if not len(k.first):
                continue
            row = pa.array(k.text[k.first] + a)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(row), batch.column(1).take(row), pa.array(k.place[k.first].astype(np.int32)),
                 pa.array(k.size.astype(np.int32)), pa.array(signed(k.anchor[k.first])), pa.array(signed(k.content))],
                ["doc_id", "_text", "place", "n", "anchor", "content"])


def _ranges(column: pa.Array, i: int) -> list[dict]:
    return column[i].as_py() or []


def _edge_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of the blocks asked for: columns doc_id, text, blocks (place, n, anchor, content)."""
    for batch in batches:
        for a, b, raw, at in slices(batch.column(1)):
            w = words(raw, at)
            window = runs(w.hash, WINDOW)
            out = [[], [], [], [], [], []]
            for i in range(a, b):
                for r in _ranges(batch.column(2), i):
                    s = w.first[i - a] + r["place"]
                    for x, v in zip(out, (np.full(r["n"], r["anchor"]), np.full(r["n"], r["content"]),
                                          np.full(r["n"], r["n"]), np.arange(r["n"]), signed(window[s:s + r["n"]]),
                                          np.full(r["n"], r["least"]))):
                        x.append(v)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x).astype(t)) for x, t in
                     zip(out, (np.int64, np.int64, np.int32, np.int32, np.int64, np.int64))],
                    ["anchor", "content", "n", "nth", "window", "least"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words that a duplicate window covers, and the factors those windows make up."""
    for batch in batches:
        cols: list[list] = [[], [], [], []]
        for a, b, raw, at in slices(batch.column(1)):
            w = words(raw, at)
            starts = np.zeros(len(w.start) + 1, np.int32)
            for i in range(a, b):
                base = w.first[i - a]
                for r in _ranges(batch.column(2), i):
                    mask = np.array([(r["mask"] >> j) & 1 for j in range(r["n"])], np.int32)
                    starts[base + r["place"]: base + r["place"] + r["n"]] |= mask
            # a word is covered when a duplicate window starts at it or at one of the words before it
            covered = np.cumsum(np.concatenate([starts, np.zeros(WINDOW, np.int32)])
                                - np.concatenate([np.zeros(WINDOW, np.int32), starts]))[:len(w.start)] > 0
            for i in range(a, b):
                lo, hi = w.first[i - a], w.first[i - a + 1]
                keep = ~covered[lo:hi]
                data = w.data.tobytes() if i == a else data
                s, e = w.start[lo:hi][keep].tolist(), w.end[lo:hi][keep].tolist()
                edge = np.flatnonzero(np.diff(np.concatenate([[0], covered[lo:hi].astype(np.int8), [0]])))
                cols[0].append(hi - lo)
                cols[1].append(int((~keep).sum()))
                cols[2].append(b" ".join([data[x:y] for x, y in zip(s, e)]))
                cols[3].append([{"start": int(x), "end": int(y)} for x, y in edge.reshape(-1, 2)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
             pa.array([hashlib.sha256(t).hexdigest() for t in cols[2]]), pa.array([t.decode() for t in cols[2]], pa.string()),
             pa.array(cols[3], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
            ["doc_id", "n_words", "n_removed", "kept_sha256", "kept", "factors"])


def repeats(docs: DataFrame) -> DataFrame:
    """Blocks with windows that also start in a document with a smaller doc_id: doc_id, _text, place, n, mask.

    ``mask`` has bit j set when the j-th window of the block is such a one.
    """
    blocks = written(docs.where("doc_id is not null and text is not null")
                     .select("doc_id", F.xxhash64("text").alias("_text"), "text").mapInArrow(
                         _index, "doc_id long, _text long, place int, n int, anchor long, content long"))
    key = ["anchor", "content", "n"]
    # the index: each distinct block once, with its first document
    index = written(blocks.groupBy(*key).agg(F.min(F.struct("doc_id", "_text", "place")).alias("r")))
    # whole blocks settle themselves; blocks that share an anchor but not all words meet window by window
    edges = (index.groupBy("anchor").agg(F.min("r.doc_id").alias("a"), F.max("r.doc_id").alias("b"))
             .where("a < b").select("anchor"))
    asked = written(index.join(edges, "anchor", "left_semi").groupBy("r.doc_id", "r._text").agg(
        F.collect_list(F.struct(F.col("r.place").alias("place"), "n", "anchor", "content", F.col("r.doc_id").alias("least")))
        .alias("blocks")))
    texts = docs.select("doc_id", F.xxhash64("text").alias("_text"), "text")
    windows = written(_joined(texts, asked, False).select("doc_id", "text", "blocks").mapInArrow(
        _edge_windows, "anchor long, content long, n int, nth int, window long, least long").distinct())
    first = windows.groupBy("anchor", "window").agg(F.min("least").alias("lo"), F.max("least").alias("hi")).where("lo < hi")
    masks = (windows.join(first, ["anchor", "window"]).where("least > lo").groupBy(*key)
             .agg(F.bit_or(F.expr("shiftleft(1L, nth)")).alias("mask")))
    known = index.select(*key, F.col("r.doc_id").alias("least")).join(masks, key, "left")
    full = F.expr("shiftleft(1L, n) - 1")
    return (blocks.join(known, key).select("doc_id", "_text", "place", "n",
                                           F.when(F.col("doc_id") > F.col("least"), full).otherwise(F.col("mask")).alias("mask"))
            .where("mask is not null"))


def _joined(texts: DataFrame, found: DataFrame, keep_all: bool) -> DataFrame:
    """Texts with their row of ``found``; with ``keep_all`` also all other texts, with nulls.

    While the keys of ``found`` are small enough to be sent to every executor, only texts that have a row are
    moved; beyond, all texts are.
    """
    keys, cols = ["doc_id", "_text"], [c for c in found.columns if c not in ("doc_id", "_text")]
    ids = written(found.select(*keys))
    if not scale.small(ids, BROADCAST_BYTES):
        return texts.join(found, keys, "left" if keep_all else "inner")
    hit = texts.join(F.broadcast(ids), keys, "left_semi").join(found, keys)
    if not keep_all:
        return hit
    rest = texts.join(F.broadcast(ids), keys, "left_anti")
    return hit.unionByName(rest.select("*", *[F.lit(None).cast(found.schema[c].dataType).alias(c) for c in cols]))


def remove(docs: DataFrame) -> DataFrame:
    """Every document without its repeated passages (needs doc_id, text): n_words, n_removed, kept_sha256, kept, factors.

    Reference blocks are cut from all documents at content-defined anchors and indexed once each. A document
    is parsed greedily against the index: runs of blocks that an earlier document holds whole become factors,
    and at factor boundaries, where a block only partly agrees with an indexed one, its windows are checked
    one by one. Words under a window of WINDOW words that also starts in a document with a smaller doc_id go;
    windows are judged on the input. Factors are given as word ranges. Null texts count as empty; documents
    below WINDOW words lose nothing; rows with equal doc_id are not earlier than one another, and a null
    doc_id is neither a reference nor cut. An empty table gives no rows; extra columns are left out.
    """
    found = written(repeats(docs).groupBy("doc_id", "_text").agg(F.collect_set(F.struct("place", "n", "mask")).alias("ranges")))
    texts = docs.select("doc_id", F.xxhash64("text").alias("_text"), F.coalesce("text", F.lit("")).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return _joined(texts, found, True).select("doc_id", "text", "ranges").mapInArrow(
        _cut, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept string, "
              "factors array<struct<start:long,end:long>>")
