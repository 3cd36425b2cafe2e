"""Spelling variants: words one edit apart, found by an index of variable-length grams, and the form each belongs to."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import Distinct, gather, hash_ranges, mix, parts_for, signed, sized, slices, text_bytes, words, written

#: Fewest letters of a word, and fewest occurrences of one that counts.
MIN_LENGTH, MIN_COUNT = 7, 2
#: A form has at least this many times the occurrences of its variant.
FORM_RATIO = 10
#: One occurrence in this many loses a letter.
DROP_EVERY = 31
#: Lengths of grams; a gram is extended while more than one in SHARE of all grams agree with it.
QMIN, QMAX, SHARE = 2, 4, 2000
#: Words of this many letters and more are compared by halves; all others have at most 61 places for an edit.
LONG = 60
#: Lists up to this many words are merged word by word; longer ones by what is left after an edit.
LIST = 64
#: Index entries compared by one task; a list with more is dealt over several.
ROWS_PER_BUCKET = 100_000
#: Distinct words a task holds before it sends them on.
LOCAL = 500_000

_M1 = np.uint64(0x9E3779B97F4A7C15)


# ---- words of texts ------------------------------------------------------------------------------

def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & np.uint32(1), (out >> np.uint32(1)) ^ np.uint32(0xEDB88320), out >> np.uint32(1))
    return out


_CRC = _crc_table()


def crc32s(data: np.ndarray, start: np.ndarray, end: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Unsigned crc32 of each byte range, continued from the crc32 ``before`` it."""
    out = before.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    size = end - start
    long = np.flatnonzero(size > 64)
    live, at = np.flatnonzero((size > 0) & (size <= 64)), 0
    while len(live):
        now = out[live]
        out[live] = _CRC[(now ^ data[start[live] + at]) & np.uint32(255)] ^ (now >> np.uint32(8))
        at += 1
        live = live[size[live] > at]
    out ^= np.uint32(0xFFFFFFFF)
    for i in long.tolist():
        out[i] = zlib.crc32(data[start[i]:end[i]], int(before[i]))
    return out


def _letters(raw: np.ndarray) -> np.ndarray:
    """Bytes with blanks in place of all but A-Z, a-z and U+00C0 to U+00FF."""
    lead = raw == 0xC3
    keep = ((raw | 0x20) - np.uint8(0x61) < 26) | lead
    keep[1:] |= lead[:-1]
    return np.where(keep, raw, np.uint8(0x20))


def _counted(batches: Iterator[pa.RecordBatch], min_length: int, drop_every: int, local: int) -> Iterator[pa.RecordBatch]:
    """Columns _id (the id as text), text: words with their number inside the task."""
    seen = Distinct()

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(seen.columns(), ["word", "n"])

    for batch in batches:
        ids = [zlib.crc32(f"{x or ''}:".encode()) for x in batch.column(0).to_pylist()]
        for a, b, raw, at in slices(batch.column(1)):
            w = words(_letters(raw), at, lower=True)
            leads = np.concatenate([[0], np.cumsum(w.data == 0xC3)])
            size = w.end - w.start - (leads[w.end] - leads[w.start])
            keep = size >= min_length
            start, end, size, text, hash_ = w.start[keep], w.end[keep], size[keep], w.text_of()[keep], w.hash[keep]
            crc = crc32s(w.data, start, end, np.array(ids[a:b], np.uint32)[text])
            dropped = crc % np.uint32(drop_every) == 0
            whole = np.flatnonzero(~dropped)
            seen.add(hash_[whole], lambda new: [gather(w.data, start[whole[new]], end[whole[new]])])
            short = []
            for i in np.flatnonzero(dropped & (size > min_length)).tolist():
                word, place = w.data[start[i]:end[i]].tobytes().decode(), int(crc[i]) % int(size[i])
                short.append(word[:place] + word[place + 1:])
            if short:
                column = pa.array(short, pa.string())
                data, ends = text_bytes(column)
                seen.add(hash_ranges(data, ends[:-1], ends[1:]), lambda new: [column.take(pa.array(new))])
            if len(seen.sums) >= local:
                yield flush()
                seen = Distinct()
    if len(seen.sums):
        yield flush()


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, drop_every: int = DROP_EVERY,
               local: int = LOCAL) -> DataFrame:
    """Words of at least ``min_length`` letters and ``min_count`` occurrences (needs doc_id, text): word, n.

    A run of letters whose crc32 with its document is divisible by ``drop_every`` loses one of its letters.
    """
    counted = docs.select(F.col("doc_id").cast("string").alias("_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        lambda batches: _counted(batches, min_length, drop_every, local), "word string, n long")
    return written(counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))


# ---- variable-length grams -----------------------------------------------------------------------

class Letters:
    """Words as rows of letter codes (one byte each), padded with zeros to ``LONG`` letters; longer ones apart."""

    def __init__(self, column: pa.Array):
        raw, at = text_bytes(column)
        lead = raw == 0xC3
        codes = raw.copy()
        codes[1:][lead[:-1]] += 0x40  # the second byte of a letter from U+00C0 on
        before = np.concatenate([[0], np.cumsum(lead)])
        self.flat, ends = codes[~lead], at - before[at]
        self.start, self.size = ends[:-1], np.diff(ends)
        self.n = len(self.size)

    def matrix(self, rows: np.ndarray) -> np.ndarray:
        """Codes of rows of up to LONG letters."""
        width = int(self.size[rows].max(initial=0))
        inside = np.arange(width) < self.size[rows][:, None]
        out = np.zeros((len(rows), width), np.uint8)
        out[inside] = self.flat[(self.start[rows][:, None] + np.arange(width))[inside]]
        return out

    def codes(self, row: int) -> np.ndarray:
        return self.flat[self.start[row]:self.start[row] + self.size[row]]


def _packed(codes: np.ndarray, q: int) -> np.ndarray:
    """The q letters from each place on, as one number; grams of different lengths differ, as no code is 0."""
    width = codes.shape[1] - q + 1
    out = np.zeros((len(codes), max(0, width)), np.uint32)
    for k in range(q):
        out |= codes[:, k:k + out.shape[1]].astype(np.uint32) << np.uint32(8 * k)
    return out


def gram_dictionary(vocab: DataFrame, share: int = SHARE) -> dict[int, int]:
    """Frequent grams of QMIN to QMAX letters with their rank by frequency, from 1.

    A gram counts as frequent with more than one in ``share`` of all places, so there are fewer than
    ``share`` of each length, whatever the vocabulary.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words_ = Letters(batch.column(0))
            codes = words_.matrix(np.flatnonzero(words_.size <= LONG))
            for q in range(QMIN, QMAX + 1):
                grams = _packed(codes, q)
                full = grams >> np.uint32(8 * (q - 1)) > 0
                found, n = np.unique(grams[full], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), q), pa.int32()), pa.array(found.astype(np.int64)),
                                                  pa.array(n.astype(np.int64))], ["q", "gram", "n"])

    counts = written(vocab.select("word").mapInArrow(count, "q int, gram long, n long").groupBy("q", "gram").agg(F.sum("n").alias("n")))
    total = counts.where(F.col("q") == QMIN).agg(F.sum("n")).first()[0] or 0
    frequent = counts.where(F.col("n") * share > total).orderBy("n", "gram").collect()
    return {r["gram"]: i for i, r in enumerate(frequent, 1)}


class Grams:
    """The variable-length grams of words of QMAX + 2 to LONG letters, one for each place.

    From a place on, the gram grows from QMIN letters while it is frequent, up to QMAX. ``seen`` letters decide
    it, with the end of the word as one more; an edit elsewhere leaves the gram as it is.
    """

    def __init__(self, codes: np.ndarray, size: np.ndarray, ranks: dict[int, int]):
        names = np.array(sorted(ranks), np.uint32)
        order = np.array([ranks[int(g)] for g in names], np.uint64)
        n, width = codes.shape
        places = width - QMIN + 1
        room = size[:, None] - np.arange(places)  # letters from each place on
        self.valid = room >= QMIN
        self.size = np.full((n, places), QMIN)
        self.gram, self.rank = np.zeros((n, places), np.uint32), np.zeros((n, places), np.uint64)
        grows, self.at_end = np.ones((n, places), bool), np.zeros((n, places), bool)
        for q in range(QMIN, QMAX + 1):
            grams = np.zeros((n, places), np.uint32)
            packed = _packed(codes, q)
            grams[:, :packed.shape[1]] = packed
            reach = grows & (room >= q)
            at = np.minimum(np.searchsorted(names, grams), max(0, len(names) - 1))
            frequent = (names[at] == grams) if len(names) else np.zeros(grams.shape, bool)
            self.size[reach], self.gram[reach] = q, grams[reach]
            self.rank[reach] = np.where(frequent[reach], order[at[reach]] if len(names) else 0, 0)
            grows = reach & frequent
            self.at_end |= grows & (room == q) & (q < QMAX)
        self.seen = self.size + self.at_end


def entries(codes: np.ndarray, size: np.ndarray, ranks: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Index entries of words of QMAX + 2 to LONG letters: row numbers and 64-bit keys of the lists they are in.

    Two words one edit apart share all grams that the edit does not affect, in the same order by (frequency,
    gram, place). So the first of those, the rarest, stands in both words behind affected grams only: the edit
    lies in all of their windows. Grams are taken rarest first while some place for an edit is left in all
    windows before; that bounds a word's entries. The edit lies on one side of the shared gram, so the words also
    agree in all letters on its other side, and a list is named by the gram with these: the beginning of the word
    up to the gram, or its end from the gram on.
    """
    n, width = codes.shape
    g = Grams(codes, size, ranks)
    places = g.valid.shape[1]
    first, last = np.empty((n, width + 1), np.uint64), np.empty((n, width + 1), np.uint64)
    first[:, 0], last[:, width] = 1, 2
    wide = codes.astype(np.uint64)
    for k in range(width):
        first[:, k + 1] = mix(first[:, k] * _M1 ^ wide[:, k])
        j = width - 1 - k
        last[:, j] = np.where(wide[:, j] > 0, mix(last[:, j + 1] * _M1 ^ wide[:, j]), np.uint64(2))
    key = (g.rank << np.uint64(40)) | (g.gram.astype(np.uint64) << np.uint64(8)) | np.arange(places).astype(np.uint64)
    order = np.argsort(np.where(g.valid, key, np.uint64(2 ** 64 - 1)), axis=1)
    one = np.uint64(1)
    possible = (one << (size.astype(np.uint64) + one)) - one  # places 0 to size
    rows, keys = [], []
    live, count = np.arange(n), g.valid.sum(1)
    for t in range(places):
        live = live[(t < count[live]) & (possible[live] > 0)]
        if not len(live):
            break
        p = order[live, t]
        at, stop = p.astype(np.uint64), (p + g.seen[live, p]).astype(np.uint64)
        window = (one << stop) - (one << at)
        edit = possible[live]
        beyond = edit & ~window
        after = live[beyond >> stop > 0]
        rows.append(after)
        q = order[after, t]
        keys.append(first[after, q + g.size[after, q]])
        # an edit may also put a letter right before the gram
        ahead = live[((beyond | edit & (one << at)) & ((one << at + one) - one) > 0) & (p > 0)]
        rows.append(ahead)
        keys.append(last[ahead, order[ahead, t]])
        possible[live] = edit & window
    return np.concatenate(rows) if rows else live, np.concatenate(keys) if keys else np.zeros(0, np.uint64)


def _half_keys(codes: np.ndarray) -> list[int]:
    """Keys of a word of LONG letters and more: its first and last half, for a partner as long or one longer."""
    out = []
    for m in (len(codes), len(codes) + 1):
        h = (m - 1) // 2
        for side, part in ((1, codes[:h]), (2, codes[len(codes) - h:])):
            x = hash_ranges(part, np.array([0]), np.array([h]))
            out.append(int(signed(mix(x ^ np.uint64(4 * m + side)))[0]))
    return out


def index(vocab: DataFrame, ranks: dict[int, int]) -> DataFrame:
    """The inverted lists, an entry a row: key, word, n."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            w = Letters(batch.column(0))
            rows, keys = [], []
            short = np.flatnonzero(w.size <= LONG)
            if len(short):
                r, k = entries(w.matrix(short), w.size[short], ranks)
                rows.append(short[r])
                keys.append(signed(k))
            for i in np.flatnonzero(w.size >= LONG).tolist():
                half = _half_keys(w.codes(i))
                rows.append(np.full(len(half), i))
                keys.append(np.array(half, np.int64))
            row = pa.array(np.concatenate(rows)) if rows else pa.array([], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64)),
                                              batch.column(0).take(row), batch.column(1).take(row)], ["key", "word", "n"])

    return vocab.select("word", "n").mapInArrow(build, "key long, word string, n long")


# ---- merging lists -------------------------------------------------------------------------------

def residues(codes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word and of what is left of it without one letter: a matrix, and which of its cells count."""
    n, width = codes.shape
    wide, place = codes.astype(np.uint64) << np.uint64(32), np.arange(width).astype(np.uint64)
    inside = codes > 0
    here, moved = np.where(inside, mix(wide + place + _M1), 0), np.where(inside, mix(wide + place - np.uint64(1) + _M1), 0)
    zero = np.zeros((n, 1), np.uint64)
    head = np.concatenate([zero, np.cumsum(here, axis=1, dtype=np.uint64)], axis=1)
    tail = np.concatenate([zero, np.cumsum(moved[:, ::-1], axis=1, dtype=np.uint64)], axis=1)[:, ::-1]
    out = np.concatenate([head[:, :-1] + tail[:, 1:], head[:, -1:]], axis=1)
    return out, np.concatenate([inside, np.ones((n, 1), bool)], axis=1)


def one_edit(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two words differ by one inserted, deleted or replaced letter."""
    if abs(len(a) - len(b)) > 1:
        return False
    n = min(len(a), len(b))
    unlike = np.flatnonzero(a[:n] != b[:n])
    if len(a) == len(b):
        return len(unlike) == 1
    at = int(unlike[0]) if len(unlike) else n
    return bool(np.array_equal(a[at + 1:], b[at:]) if len(a) > len(b) else np.array_equal(a[at:], b[at + 1:]))


class _Pairs:
    """Words of one bucket, and the pairs of them that are one edit apart."""

    def __init__(self, column: pa.Array):
        self.words = Letters(column)
        self.short = np.flatnonzero(self.words.size <= LONG)
        self.place = np.full(self.words.n, -1)
        self.place[self.short] = np.arange(len(self.short))
        self.ahead = self.words.matrix(self.short)
        width, size = self.ahead.shape[1], self.words.size[self.short][:, None]
        shift = (np.arange(width) + size) % max(width, 1)  # the same letters, ending in the last column
        self.back = np.take_along_axis(self.ahead, shift, 1) if width else self.ahead

    def near(self, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of the pairs that are one edit apart."""
        size = self.words.size
        ok = np.abs(size[i] - size[j]) <= 1
        i, j = i[ok], j[ok]
        both = (self.place[i] >= 0) & (self.place[j] >= 0)
        x, y = self.place[i[both]], self.place[j[both]]
        good = np.zeros(len(i), bool)
        found = []
        for a in range(0, len(x), 1 << 16):
            u, v = x[a:a + (1 << 16)], y[a:a + (1 << 16)]
            same = self.ahead[u] == self.ahead[v]
            width = same.shape[1]
            head = np.where(same.all(1), width, same.argmin(1))
            same = (self.back[u] == self.back[v])[:, ::-1]
            tail = np.where(same.all(1), width, same.argmin(1))
            most = np.maximum(size[self.short[u]], size[self.short[v]])
            found.append((head < width) & (head + tail >= most - 1))
        good[both] = np.concatenate(found) if found else False
        for k in np.flatnonzero(~both).tolist():
            good[k] = one_edit(self.words.codes(i[k]), self.words.codes(j[k]))
        return i[good], j[good]

    def runs(self, keys: np.ndarray, rows: np.ndarray, most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Near pairs of rows with equal keys (in order), a distance in the list at a time; lists above ``most`` are left."""
        begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(begins, len(keys)))
        left = np.repeat(begins + size, size) - np.arange(len(keys)) - 1  # rows after each in its list
        if most is not None:
            left[np.repeat(size > most, size)] = 0
        at = np.flatnonzero(left > 0)
        d = 1
        while len(at):
            yield self.near(rows[at], rows[at + d])
            d += 1
            at = at[left[at] >= d]

    def merge(self, keys: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Near pairs of all lists."""
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        yield from self.runs(keys, order, longest)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(first, len(keys)))
        large = np.flatnonzero(np.repeat(size > longest, size))
        if len(large):
            # a long list: words that agree without one letter each, or as a whole with such a rest
            names, rows = dealt_keys(self.words, keys[large], order[large])
            again = np.argsort(names, kind="stable")
            yield from self.runs(names[again], rows[again])


def dealt_keys(words_: Letters, keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of entries by the list and one residue of the word: keys, rows."""
    names, out = [], []
    short = np.flatnonzero(words_.size[rows] <= LONG)
    for a in range(0, len(short), 1 << 14):
        k, r = keys[short[a:a + (1 << 14)]], rows[short[a:a + (1 << 14)]]
        rest, valid = residues(words_.matrix(r), words_.size[r])
        names.append(mix(rest ^ mix(k.view(np.uint64))[:, None])[valid])
        out.append(np.repeat(r, valid.sum(1)))
    for i in np.flatnonzero(words_.size[rows] > LONG).tolist():
        rest, valid = residues(words_.codes(rows[i])[None, :], words_.size[rows[i]:rows[i] + 1])
        names.append(mix(rest ^ mix(keys[i:i + 1].view(np.uint64))[:, None])[valid])
        out.append(np.full(valid.sum(), rows[i]))
    return np.concatenate(names), np.concatenate(out)


_LINK = ["word", "other", "n"]


def links(entries_: DataFrame, longest: int = LIST, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Both directions of all pairs one edit apart, once for each list they share: word, other, n (of the other).

    ``entries_`` is a written index. Lists lie whole in buckets of bounded size; entries of a list with more
    than ``rows_per_bucket`` words are first dealt by what is left of the word after an edit, so no list
    lands in one task, and no pair is lost.
    """
    hot = written(entries_.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_bucket).select("key"))
    if not hot.isEmpty():
        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                w = Letters(batch.column(1))
                names, rows = dealt_keys(w, batch.column(0).to_numpy(zero_copy_only=False), np.arange(w.n)) if w.n else ([], [])
                for a in range(0, len(rows), 1 << 18):
                    row = pa.array(rows[a:a + (1 << 18)])
                    yield pa.RecordBatch.from_arrays([pa.array(signed(names[a:a + (1 << 18)])), batch.column(1).take(row),
                                                      batch.column(2).take(row)], ["key", "word", "n"])
        spread = entries_.join(sized(hot), "key", "left_semi").select("key", "word", "n").mapInArrow(deal, "key long, word string, n long")
        entries_ = written(entries_.join(sized(hot), "key", "left_anti").unionByName(spread))
    buckets = parts_for(entries_.count(), rows_per_bucket)

    def merge(table: pa.Table) -> pa.Table:
        keys = table.column("key").to_numpy()
        word, n = table.column("word").combine_chunks(), table.column("n").combine_chunks()
        pairs = list(_Pairs(word).merge(keys, longest))
        i = np.concatenate([x for x, _ in pairs]) if pairs else np.zeros(0, np.int64)
        j = np.concatenate([x for _, x in pairs]) if pairs else np.zeros(0, np.int64)
        a, b = pa.array(np.concatenate([i, j])), pa.array(np.concatenate([j, i]))
        return pa.table([word.take(a), word.take(b), n.take(b)], _LINK)

    return (entries_.withColumn("_bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")).groupBy("_bucket")
            .applyInArrow(merge, "word string, other string, n long"))


# ---- forms and roots -----------------------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """The last form that each word (word, form) leads to: word, root. Each round doubles the steps taken.

    A form has several times the occurrences of its word, so chains are short and end.
    """
    now = written(forms.select("word", F.col("form").alias("root")))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        after = written(now.join(step, "root", "left").select("word", F.coalesce("_next", "root").alias("root"),
                                                              F.col("_next").isNotNull().alias("_moved")))
        now = after.select("word", "root")
        if after.where("_moved").isEmpty():
            return now


def group(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, ratio: int = FORM_RATIO,
          drop_every: int = DROP_EVERY, longest: int = LIST, rows_per_bucket: int = ROWS_PER_BUCKET, share: int = SHARE) -> DataFrame:
    """Words of a corpus and the form each is a variant of (needs doc_id, text): word, form, root, n, n_near, form_n.

    Words are runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, some with a letter dropped by a rule of
    document and run. A word's form is the word one edit away with the most occurrences (ties: the smallest in
    code-point order), if those are ``ratio`` times its own. Null texts have no words, a null doc_id
    counts as empty, repeated rows count as often as they occur, words of any length are compared; an empty
    table gives no rows; extra columns are left out. ``min_length`` must be QMAX + 2 at least: an
    edit affects QMAX + 1 grams at most, so every word keeps one.
    """
    if min_length < QMAX + 2:
        raise ValueError(f"min_length is below {QMAX + 2}: an edit could affect all grams of a word")
    vocab = vocabulary(docs, min_length, min_count, drop_every)
    lists = written(index(vocab, gram_dictionary(vocab, share)))
    # the links of a word are shuffled once: first told apart, then counted
    near = (links(lists, longest, rows_per_bucket).repartition("word").groupBy("word", "other").agg(F.first("n").alias("n"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), "other")).alias("_best")))
    best = written(vocab.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("_best.n") >= ratio * F.col("n"), F.struct("_best.other", (-F.col("_best.n")).alias("n"))).alias("_form")))
    formed = best.where("_form is not null").select("word", F.col("_form.other").alias("form"))
    return best.join(roots(formed), "word", "left").select(
        "word", F.col("_form.other").alias("form"), F.coalesce("root", "word").alias("root"), "n", "n_near", F.col("_form.n").alias("form_n"))
