"""Collocations: phrases whose words stand together more often than the frequencies of their parts suggest."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelkit import scale
from panelkit.llm.common import Distinct, gather, hash_ranges, mix, slices, text_bytes, words, written

#: Most words of a phrase and fewest occurrences of one that counts.
MAX_WORDS, MIN_COUNT = 3, 10
#: A phrase goes when a longer one around it has at least this percentage of its occurrences.
INSIDE_PERCENT = 50
#: Collocations returned for each language.
TOP = 2000
#: Name of the language of texts that have none.
NO_LANGUAGE = "und"
#: Bytes of text tokenized at once; occurrences summed inside a task before they are sent on.
SLICE, LOCAL = 1 << 20, 2_000_000
#: Phrase occurrences of one hash partition, about; most partitions, as a power of two.
PER_PARTITION, MOST_BITS = 1 << 22, 20
#: Counters of a summary, as a multiple of the fewest that lose no frequent phrase; more of them let fewer rare ones stay.
SLACK = 4
#: Bits of a hash, after those that name its partition, by which a summary tells phrases apart.
KEY_BITS = 27
#: Bits (KEY_BITS at most) of the Bloom filter of surviving phrases that is sent to every executor (16 MB, whatever the
#: input), and places that a phrase sets in it.
FILTER_BITS, FILTER_PLACES = 27, 3
#: Parts in which the best phrases of a language are looked for first.
RANK_PARTS = 64

_PIECE = np.zeros(256, bool)
_PIECE[[ord(c) for c in ".,;:!?\n\x0b\f\r"]] = True
_BREAK = _PIECE.copy()
_BREAK[[0x20, 0x09]] = True
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


# ---- phrases of many texts at once ---------------------------------------------------------------

class Phrases:
    """Words of consecutive texts, and the phrases of 1 to ``most`` words that lie inside one piece of a text."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, seeds: np.ndarray, most: int):
        w = words(raw, at, lower=True, breaks=_BREAK)
        self.words, self.text = w, w.text_of()
        piece = np.searchsorted(np.flatnonzero(_PIECE[w.data]), w.start)
        joined = (piece[1:] == piece[:-1]) & (self.text[1:] == self.text[:-1])  # word i + 1 follows word i in its piece
        hash_ = mix(w.hash ^ seeds[self.text])
        place = np.arange(len(hash_))
        self.hashes, self.places = [hash_], [place]
        for k in range(1, most):
            place = place[place + k < len(w.hash)]
            place = place[joined[place + k - 1]]
            # hashes of the phrases one word shorter stand at the same places
            before = np.searchsorted(self.places[-1], place)
            hash_ = mix(self.hashes[-1][before] * _M1 ^ w.hash[place + k] + _M2)
            self.hashes.append(hash_)
            self.places.append(place)

    def joined_text(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All words with one space after each, and where each begins and ends there."""
        size = self.words.end - self.words.start
        start = np.cumsum(size + 1) - (size + 1)
        out = np.full(int((size + 1).sum()), 0x20, np.uint8)
        inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(start, size) + inner] = self.words.data[np.repeat(self.words.start, size) + inner]
        return out, start, start + size


def _seeds(lang: pa.Array) -> np.ndarray:
    """A number for each row's language, unrelated to the hash of a word of the same name."""
    raw, at = text_bytes(lang)
    return mix(hash_ranges(raw, at[:-1], at[1:]) * _M1 + _M2)


# ---- summaries -----------------------------------------------------------------------------------

def tally(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their counts (1 each by default)."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if counts is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    if counts is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(counts, first)


def merge(parts: list[tuple[np.ndarray, np.ndarray]], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Misra-Gries merge of summaries: at most ``capacity`` counters, and what was taken off every counter.

    Counts are added; if more than ``capacity`` counters are left, the largest count beyond the first
    ``capacity`` is taken off all of them. Each unit taken off removes more than ``capacity`` units of mass, so
    over any sequence of merges the loss of a counter is at most mass / (capacity + 1).
    """
    keys, counts = tally(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
    if len(keys) <= capacity:
        return keys, counts, 0
    at = len(counts) - capacity - 1
    cut = int(np.partition(counts, at)[at])
    left = counts > cut
    return keys[left], counts[left] - cut, cut


def _pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as their differences, all low bytes first: high ones are mostly 0 and shrink when they are moved."""
    return np.diff(keys, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack_keys(data: bytes, n: int) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, n).T).view("<u4").ravel()
    return np.cumsum(steps, dtype=np.uint32)


def _pack(counts: np.ndarray) -> bytes:
    """Counts in a byte each; larger ones follow in full."""
    large = counts[counts >= 255].astype("<i8")
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + large.tobytes()


def _unpack(data: bytes, n: int) -> np.ndarray:
    out = np.frombuffer(data, np.uint8, n).astype(np.int64)
    out[out == 255] = np.frombuffer(data, "<i8", -1, n)
    return out


def _phrase_keys(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Phrases]:
    for batch in batches:
        seeds = _seeds(batch.column(0))
        for a, b, raw, at in slices(batch.column(1), SLICE):
            yield Phrases(raw, at, seeds[a:b], most)


def summaries(docs: DataFrame, bits: int, most: int, local: int = LOCAL) -> DataFrame:
    """Counts of phrase hashes inside each task, one row per hash partition: part, mass, n, keys, counts.

    A partition is the hashes with the same first ``bits`` bits; of a hash, the KEY_BITS bits after them are kept. Two
    phrases that agree in those only make each other look more frequent, which the exact pass undoes.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            keys, counts = tally(np.concatenate(held))
            part = (keys >> np.uint64(KEY_BITS)).astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            ends = np.append(first[1:], len(keys))
            low = (keys & np.uint64((1 << KEY_BITS) - 1)).astype(np.uint32)
            return pa.RecordBatch.from_arrays(
                [pa.array(part[first], pa.int32()), pa.array(np.add.reduceat(counts, first), pa.int64()), pa.array(ends - first, pa.int32()),
                 pa.array([_pack_keys(low[a:b]) for a, b in zip(first, ends)], pa.binary()),
                 pa.array([_pack(counts[a:b]) for a, b in zip(first, ends)], pa.binary())],
                ["part", "mass", "n", "keys", "counts"])

        for phrases in _phrase_keys(batches, most):
            held += [h >> np.uint64(64 - KEY_BITS - bits) for h in phrases.hashes if len(h)]
            if sum(map(len, held)) >= local:
                yield flush()
                held = []
        if held:
            yield flush()

    return docs.mapInArrow(count, "part int, mass long, n int, keys binary, counts binary")


def _places(keys: np.ndarray, inner: int) -> Iterator[np.ndarray]:
    """The places of keys in their partition's block of 2^inner bits."""
    for i in range(FILTER_PLACES):
        yield (mix(keys.astype(np.uint64) + _M1 * np.uint64(i + 1)) >> np.uint64(64 - inner)).astype(np.int64) if inner else np.zeros(len(keys), np.int64)


def survivors(summary: DataFrame, bits: int, min_count: int, filter_bits: int = FILTER_BITS) -> DataFrame:
    """Hashes of every partition that may be frequent, as a block of the filter: part, n, block.

    The summaries of a partition are merged with more counters than its mass divided by ``min_count``, so all
    that was taken off a counter is below ``min_count`` and no frequent phrase goes. A counter that stays below
    ``min_count`` with all of that added back cannot be frequent and is dropped.
    """
    inner = max(0, filter_bits - bits)

    def reduce(table: pa.Table) -> pa.Table:
        capacity = SLACK * (sum(table.column("mass").to_pylist()) // min_count + 1)
        now, lost, waiting, held = (np.zeros(0, np.uint32), np.zeros(0, np.int64)), 0, [], 0
        rows = zip(table.column("n").to_pylist(), table.column("keys"), table.column("counts"))
        for n, keys, counts in rows:
            waiting.append((_unpack_keys(keys.as_py(), n), _unpack(counts.as_py(), n)))
            held += n
            if held >= capacity:
                keys, counts, cut = merge([now, *waiting], capacity)
                now, lost, waiting, held = (keys, counts), lost + cut, [], 0
        if waiting:
            keys, counts, cut = merge([now, *waiting], capacity)
            now, lost = (keys, counts), lost + cut
        left = now[0][now[1] + lost >= min_count]
        block = np.zeros(1 << inner, bool)
        for place in _places(left, inner):
            block[place] = True
        return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int32()), "n": pa.array([len(left)], pa.int64()),
                         "block": pa.array([np.packbits(block).tobytes()], pa.binary())})

    return summary.groupBy("part").applyInArrow(reduce, "part int, n long, block binary")


# ---- exact counts --------------------------------------------------------------------------------

def _exact(docs: DataFrame, bits: int, blocks: list, most: int, filter_bits: int, local: int) -> DataFrame:
    """Occurrences, inside each task, of the phrases that the filter lets through, packed by hash partition.

    Columns part, lang, phrases (a line each), counts; part -1 has all words of a language, as an empty phrase.
    Inside a task, phrases are told apart by 64 bits.
    """
    inner = max(0, filter_bits - bits)
    live = np.zeros(1 << (bits + inner), bool)
    for r in blocks:
        live[r["part"] << inner:(r["part"] + 1) << inner] = np.unpackbits(np.frombuffer(r["block"], np.uint8), count=1 << inner)
    shared = docs.sparkSession.sparkContext.broadcast(np.packbits(live).tobytes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passed = np.frombuffer(shared.value, np.uint8)
        seen, totals = Distinct(), {}

        def may_be_frequent(h: np.ndarray) -> np.ndarray:
            """Places of the hashes that the filter lets through."""
            named = h >> np.uint64(64 - KEY_BITS - bits)
            block, keys = (named >> np.uint64(KEY_BITS)).astype(np.int64) << inner, named & np.uint64((1 << KEY_BITS) - 1)
            left = np.arange(len(h))
            for i in range(FILTER_PLACES):
                bit = block[left] + next(itertools.islice(_places(keys[left], inner), i, None))
                left = left[(passed[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 > 0]
            return left

        def packed(part: np.ndarray, lang: pa.Array, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
            """A row for each partition and language of rows in that order: phrases with a line feed after each, and counts."""
            codes = lang.dictionary_encode()
            code = codes.indices.to_numpy(zero_copy_only=False)
            order = np.lexsort((code, part))
            part, code, n = part[order], code[order], n[order]
            lines = pc.binary_join_element_wise(phrase.take(pa.array(order)), pa.scalar(""), "\n")
            raw, at = text_bytes(lines)
            first = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (code[1:] != code[:-1])]))
            ends = np.append(first[1:], len(part))
            return pa.RecordBatch.from_arrays(
                [pa.array(part[first], pa.int32()), codes.dictionary.take(pa.array(code[first])),
                 pa.array([raw[at[a]:at[b]].tobytes() for a, b in zip(first, ends)], pa.binary()),
                 pa.array([_pack(n[a:b]) for a, b in zip(first, ends)], pa.binary())], ["part", "lang", "phrases", "counts"])

        def flush() -> pa.RecordBatch:
            lang, phrase, n = seen.columns()
            part = np.empty(len(seen.keys), np.int32)
            part[seen.number] = (seen.keys >> np.uint64(32) >> np.uint64(32 - bits)).astype(np.int32)
            return packed(part, lang, phrase, n.to_numpy())

        for batch in batches:
            lang, seeds = batch.column(0), _seeds(batch.column(0))
            for a, b, raw, at in slices(batch.column(1), SLICE):
                phrases = Phrases(raw, at, seeds[a:b], most)
                for name, n in zip(lang.slice(a, b - a).to_pylist(), np.bincount(phrases.text, minlength=b - a).tolist()):
                    totals[name] = totals.get(name, 0) + n
                text, start, end = phrases.joined_text()
                for k, (h, place) in enumerate(zip(phrases.hashes, phrases.places)):
                    hit = may_be_frequent(h)
                    place = place[hit]
                    seen.add(h[hit], lambda new: [lang.take(pa.array(phrases.text[place[new]] + a)),
                                                  gather(text, start[place[new]], end[place[new] + k])])
                if len(seen.sums) >= local // 2:
                    yield flush()
                    seen = Distinct()
        if len(seen.sums):
            yield flush()
        if totals:
            yield packed(np.full(len(totals), -1, np.int32), pa.array(list(totals), pa.string()), pa.array([""] * len(totals), pa.string()),
                         np.array(list(totals.values())))

    return docs.mapInArrow(count, "part int, lang string, phrases binary, counts binary")


def _summed(counts: DataFrame, min_count: int) -> DataFrame:
    """Sums over all tasks by language and text, of at least ``min_count``: lang, k, phrase, n."""
    def add(table: pa.Table) -> pa.Table:
        every, parts = table.column("part")[0].as_py() < 0, []
        for lang, phrases, counts in zip(table.column("lang"), table.column("phrases"), table.column("counts")):
            raw = np.frombuffer(phrases.as_py(), np.uint8)
            end = np.flatnonzero(raw == 10)
            phrase = gather(raw, np.concatenate([[0], end[:-1] + 1]), end)
            parts.append(pa.table([pa.repeat(lang, len(end)), phrase, pa.array(_unpack(counts.as_py(), len(end)))], ["lang", "phrase", "n"]))
        flat = pa.concat_tables(parts)
        flat = flat.group_by(["lang", "phrase"]).aggregate([("n", "sum")])
        if not every:
            flat = flat.filter(pc.greater_equal(flat.column("n_sum"), min_count))
        k = pa.chunked_array([pa.array(np.zeros(len(flat)), pa.int32())]) if every else pc.add(pc.count_substring(flat.column("phrase"), " "), pa.scalar(1, pa.int32()))
        return pa.table([flat.column("lang"), k, flat.column("phrase"), flat.column("n_sum")], ["lang", "k", "phrase", "n"])

    return counts.groupBy("part").applyInArrow(add, "lang string, k int, phrase string, n long")


def frequent(docs: DataFrame, most: int = MAX_WORDS, min_count: int = MIN_COUNT, per_partition: int = PER_PARTITION,
             filter_bits: int = FILTER_BITS, local: int = LOCAL) -> DataFrame:
    """Exact counts of all phrases of 1 to ``most`` words with ``min_count`` occurrences or more in their language.

    Columns lang, k (words), phrase, n; rows of k = 0 hold all words of a language. The first pass finds, by
    mergeable summaries of each hash partition, which phrases may be frequent; the second counts those by
    their text. Between them a filter of a fixed size goes to every executor. As more of it is set, the
    second pass sends more rare phrases too; the result is the same.
    """
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    # a word takes two bytes of text at least, so no more phrases than this can occur
    occurrences = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) * most // 2
    bits = min(MOST_BITS, max(0, int(occurrences // per_partition).bit_length()))
    blocks = survivors(summaries(docs, bits, most, local), bits, min_count, filter_bits).select("part", "block").collect()
    return written(_summed(_exact(docs, bits, blocks, most, filter_bits, local), min_count))


# ---- scores --------------------------------------------------------------------------------------

def _words(start: Column | int, n: Column | int) -> Column:
    lit = lambda x: F.lit(x) if isinstance(x, int) else x
    return F.array_join(F.slice("_w", lit(start), lit(n)), " ")


def score(counted: DataFrame, inside_percent: int = INSIDE_PERCENT, rows_per_part: int = scale.ROWS_PER_PART) -> DataFrame:
    """Candidates that no longer one holds: lang, phrase, a, l, r, n, score, of the cut with the lowest score.

    The score of a cut is floor(1,000,000 a a / (l r)) in whole numbers of up to 38 digits. A frequent word is
    part of many phrases: the look-ups of its count are dealt over several tasks.
    """
    phrases = counted.where("k >= 2").select("lang", "phrase", "k", F.col("n").alias("a"), F.split("phrase", " ").alias("_w"))
    parts = counted.where("k >= 1").select("lang", "phrase", "n")
    cuts = written(phrases.select("lang", "phrase", "a", "_w", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
                   .select("lang", "phrase", "a", "cut", _words(1, F.col("cut")).alias("left"),
                           _words(F.col("cut") + 1, F.size("_w") - F.col("cut")).alias("right")))
    for side, name in (("left", "l"), ("right", "r")):
        cuts = scale.skew_join(cuts, parts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side],
                               rows_per_part=rows_per_part)
    number = lambda c: F.col(c).cast("decimal(15,0)")
    scored = cuts.select("lang", "phrase", "cut", "l", "r", "a", (F.lit(1_000_000).cast("decimal(7,0)") * number("a") * number("a")).alias("_x"),
                         (number("l") * number("r")).alias("_y")).withColumn("score", F.expr("_x div _y"))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "cut", "l", "r", "a")).alias("b"))
    # every phrase inside a longer candidate, with the most occurrences of such a one
    held = (phrases.where("k >= 3").select("lang", "a", "k", "_w", F.explode(F.sequence(F.lit(2), F.col("k") - 1)).alias("_n"))
            .select("lang", "a", "_w", "_n", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("_n") + 1)).alias("_i"))
            .groupBy("lang", _words(F.col("_i"), F.col("_n")).alias("phrase")).agg(F.max("a").alias("_longer")))
    totals = counted.where("k = 0").select("lang", F.col("n").alias("_total"))
    kept = best.join(held, ["lang", "phrase"], "left").where(
        F.col("_longer").isNull() | (100 * F.col("_longer") < inside_percent * F.col("b.a")))
    return scale.lookup_join(kept, totals, ["lang"], "inner").select(
        "lang", "phrase", "b.a", "b.l", "b.r", F.col("_total").alias("n"), "b.score")


def top(scored: DataFrame, limit: int = TOP, parts: int = RANK_PARTS) -> DataFrame:
    """The first ``limit`` of each language by score, a (both descending) and phrase, with their rank.

    The best of each of ``parts`` hash parts of a language are found first, so no task sorts a whole language.
    """
    order = [F.desc("score"), F.desc("a"), "phrase"]
    near = (scored.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
            .withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("rank") <= limit))
    return (near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
            .where(F.col("rank") <= limit).drop("_part"))


def mine(docs: DataFrame, limit: int = TOP, most: int = MAX_WORDS, min_count: int = MIN_COUNT,
         inside_percent: int = INSIDE_PERCENT, **sizes) -> DataFrame:
    """The best collocations of each language (needs text, lang): lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z only) and cut into pieces at ``. , ; : ! ?`` and line breaks, pieces into words
    at spaces and tabs; a phrase lies inside one piece, overlaps count. Null texts are empty, texts
    of null language belong to ``und``; repeated rows count as often as they occur; equal scores and counts are
    ordered by the phrase's bytes; a table without candidates gives no rows; extra columns are left out.
    """
    found = top(score(frequent(docs, most, min_count, **sizes), inside_percent), limit)
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
