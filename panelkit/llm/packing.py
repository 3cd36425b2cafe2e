"""Best-fit decreasing packing of tokenised documents into sequences of a fixed length."""

from __future__ import annotations

import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import _LOWER, WORD_TABLES, give_back, lean, parts_for, rows_bytes, written

#: Pieces packed together by one task.
GROUP_PIECES = 16_384
#: Units (words or parts of words) a worker process remembers the ids of, and one of how many of them parts of odd words.
CACHE_WORDS, PARTS_SHARE = 600_000, 4
#: Bytes of text cut into units at a time; their new units are learnt together.
STEP_BYTES = 2 << 20
#: Words or parts in one call of the tokenizer, and parts on one line of it.
CALL_WORDS, LINE_PARTS = 8_192, 32


#: Words whose parts can be cut here just as the tokenizer cuts them: printable ASCII and Latin letters. Letters whose
#: lower-case form lies beyond that range (such as U+018F) are left to the tokenizer.
_PLAIN = re.compile("[!-~" + "".join(c for c in map(chr, range(0xc0, 0x250)) if max(c.lower()) < "\u0250") + "]+")
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+|[0-9]| |[^ a-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")

#: Stands for the space between two words while their ids are joined; no id is as large.
_GAP = b"\xff" * 4


def _byte_letters() -> np.ndarray:
    """The letter by which byte-level tokenizers write each byte."""
    letters = np.arange(256, dtype="<u2")
    odd = [b for b in range(256) if not (33 <= b < 127 or 161 <= b < 256 and b != 173)]
    letters[odd] = 256 + np.arange(len(odd))
    letters[[10, 32]] = 10, 32  # these stand between lines and parts
    return letters


_BYTE_LETTERS = _byte_letters()


#: Kinds of bytes besides gaps; what is odd only the tokenizer cuts.
_LETTER, _DIGIT, _SIGN, _ODD = 1, 2, 3, 4


def _kinds() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The kind of each byte alone; of each code point of two bytes at most its kind and its lower-case form."""
    kind, low = np.full(0x800, _ODD, np.uint8), np.arange(0x800)
    for c in filter(_PLAIN.fullmatch, map(chr, range(0x250))):
        kind[ord(c)] = _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _SIGN
        low[ord(c)] = ord(c.lower())
    byte = np.full(256, _ODD, np.uint8)
    byte[:128] = kind[:128]
    byte[[10, 32]] = 0
    return byte, kind, low


_BYTE_KIND, _KIND, _LOW = _kinds()


def _units(data: np.ndarray, at: np.ndarray, by_part: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts in lower case, the ends of their units, and which units are odd words.

    A unit is a part of a word that the tokenizer never joins with its neighbours: letters, one digit, or signs. Words with
    an apostrophe, a special token or other characters are odd: they stay whole and as they are. The space or line feed
    after a word belongs to its last unit.
    """
    kind, low = _BYTE_KIND[data], _LOWER[data]
    lead = np.flatnonzero((data[:-1] >= 0xc3) & (data[:-1] <= 0xc9))
    lead = lead[data[lead + 1] & 0xc0 == 0x80]
    code = (data[lead] & 31).astype(np.int64) << 6 | data[lead + 1] & 63
    kind[lead] = kind[lead + 1] = _KIND[code]
    low[lead], low[lead + 1] = 0xc0 | _LOW[code] >> 6, 0x80 | _LOW[code] & 63
    ends = np.zeros(len(data) + 1, bool)
    ends[1:] = kind == 0
    ends[at[1:]] = True
    ends[0] = False
    word_ends = np.flatnonzero(ends)
    odd = kind == _ODD
    odd |= data == 39
    odd[:-1] |= (data[:-1] == 60) & (data[1:] == 124)
    odd_word = np.full(len(word_ends), not by_part)
    odd_word[np.searchsorted(word_ends, np.flatnonzero(odd), "right")] = True
    ends[1:-1] |= (kind[1:] != kind[:-1]) & (kind[1:] != 0) | (kind[1:] == _DIGIT)
    if odd_word.any():
        inside = np.repeat(odd_word, np.diff(word_ends, prepend=0))
        ends[:-1] &= ~inside
        ends[word_ends] = True
        low = np.where(inside, data, low)
    stops = np.flatnonzero(ends)
    return low, stops, odd_word[np.searchsorted(word_ends, stops, "left")]


class WordIds:
    """Token ids of texts as little-endian unsigned 32-bit bytes, one look-up per distinct unit of a stretch of texts.

    The tokenizer never joins characters across spaces or line feeds, so a text's ids are its words' ids;
    inside a word it never joins letters with digits or signs, so a word's ids are its parts' ids. ``known`` has the
    ids of parts and of odd words, ``parts`` those of parts of odd words. New parts
    are tokenized many at a time: the last token of each part is known by its end-of-word suffix. A full table
    keeps what the stretch at hand asks for, which are mostly the frequent words.
    """

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        from tokenizers import Tokenizer, pre_tokenizers

        # parts come normalised and cut, each once: what is left to do is to merge their bytes
        self.merger = Tokenizer.from_file(path)
        self.path, self.plain = path, None
        suffix = self.merger.model.end_of_word_suffix
        vocab = self.merger.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        self.by_part = bool(suffix)
        self.merger.normalizer = None
        self.merger.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")  # of bytes that are written as letters
        self.limit = limit
        self.known: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {" ": _GAP}

    def _merged(self, new: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each part with its ids."""
        for some in range(0, len(new), CALL_WORDS):
            want = new[some:some + CALL_WORDS]
            lines = "\n".join([" ".join(want[i:i + LINE_PARTS]) for i in range(0, len(want), LINE_PARTS)])
            if not lines.isascii():
                lines = _BYTE_LETTERS[np.frombuffer(lines.encode(), np.uint8)].tobytes().decode("utf-16-le")
            found = self.merger.encode_batch_fast(lines.split("\n"), add_special_tokens=False)
            ids = np.fromiter(chain.from_iterable([e.ids for e in found]), "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(want):
                raise ValueError("the tokenizer cuts words in another way")
            data, stops = ids.tobytes(), (4 * stops).tolist()
            yield from zip(want, [data[a:b] for a, b in zip([0, *stops], stops)])

    def learn(self, new: list[str]) -> None:
        """Learn whole words."""
        plain, whole = [], []
        for word in new:
            simple = word.isprintable() if word.isascii() else _PLAIN.fullmatch(word)
            (plain if simple and self.by_part and "<|" not in word else whole).append(word)
        parts = _PARTS.findall(unicodedata.normalize("NFC", " ".join(plain)).lower())
        asked = set(parts)
        if len(self.parts) > self.limit // PARTS_SHARE:  # only words that are new ask for parts
            self.parts = {p: self.parts[p] for p in asked if p in self.parts} | {" ": _GAP}
        self.parts.update(self._merged(list(asked.difference(self.parts))))
        ids = b"".join(map(self.parts.__getitem__, parts)).split(_GAP) if plain else []
        self.known.update(zip(plain, ids))
        if whole and self.plain is None:
            self.plain = type(self.merger).from_file(self.path)
        for some in range(0, len(whole), CALL_WORDS):
            want = whole[some:some + CALL_WORDS]
            for word, e in zip(want, self.plain.encode_batch_fast(want, add_special_tokens=False)):
                self.known[word] = np.asarray(e.ids, "<u4").tobytes()

    def of(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        return list(self.each(*rows_bytes(pa.array(texts, pa.large_string()))))

    def each(self, raw: np.ndarray, at: np.ndarray) -> Iterator[bytes]:
        """Ids of each text; text i has bytes at[i] to at[i + 1] of ``raw``."""
        a, n = 0, len(at) - 1
        while a < n:
            b = max(a + 1, int(np.searchsorted(at, at[a] + STEP_BYTES, "right")) - 1)
            data = raw[at[a]:at[b]]
            if len(data) <= STEP_BYTES:
                yield from self._stretch(data, at[a:b + 1] - at[a])
            else:  # one long text
                steps = (np.frombuffer(x, np.uint8) for x in _steps(data.tobytes()))
                yield b"".join([self._stretch(x, np.array([0, len(x)]))[0] for x in steps])
            a = b

    def _stretch(self, data: np.ndarray, at: np.ndarray) -> list[bytes]:
        low, stops, odd = _units(data, at, self.by_part)
        offsets = np.concatenate([[0], stops]).astype(np.int64)
        units = pa.LargeStringArray.from_buffers(len(stops), pa.py_buffer(offsets), pa.py_buffer(low)).dictionary_encode()
        code = units.indices.to_numpy()
        names = pc.ascii_rtrim(units.dictionary, characters=" \n").to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > self.limit:
            self.known = {w: self.known[w] for w in names if w in self.known} | {"": b""}
        ids = list(map(self.known.get, names))
        new = [k for k, i in enumerate(ids) if i is None]
        if new:
            whole = np.zeros(len(names), bool)
            whole[code[odd]] = True
            self.learn(list({names[k] for k in new if whole[k]}))
            self.known.update(self._merged(list({names[k] for k in new if not whole[k]})))
            for k in new:
                ids[k] = self.known[names[k]]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first, flat = np.cumsum(size) - size, np.frombuffer(b"".join(ids), "<u4")
        n = size[code]
        total = np.concatenate([[0], np.cumsum(n)])
        out = flat[np.repeat(first[code] - total[:-1], n) + np.arange(total[-1])].tobytes()
        edges = (4 * total[np.searchsorted(stops, at, "right")]).tolist()
        return [out[a:b] for a, b in zip(edges, edges[1:])]


def shared_words(path: str) -> WordIds:
    """The table of a worker process, which its tasks fill together; it is bounded by CACHE_WORDS.

    It hangs on the tokenizer library because the functions of this package come anew with every task. A worker
    that turns to another operator of this package gives it back.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; threads of the tokenizer keep memory of their own
    import tokenizers

    held = tokenizers.__dict__.setdefault(WORD_TABLES, {})
    if path not in held:
        held[path] = WordIds(path)
    return held[path]


def _steps(text: bytes) -> Iterator[bytes]:
    """A text in stretches that end at a space or line feed, so that a long text is never cut in words at once."""
    at = 0
    while len(text) - at > STEP_BYTES:
        cut = max(text.rfind(b" ", at, at + STEP_BYTES), text.rfind(b"\n", at, at + STEP_BYTES))
        if cut < at:
            after = [x for x in (text.find(b" ", at), text.find(b"\n", at)) if x >= 0]
            if not after:
                break
            cut = min(after)
        yield text[at:cut + 1]
        at = cut + 1
    yield text[at:]


def _cut(path: str, length: int, end_id: int):
    @lean
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared_words(path)
        end = np.uint32(end_id).tobytes()
        for batch in batches:
            doc, out = batch.column(0), []
            for row, ids in enumerate(words.each(*rows_bytes(batch.column(1)))):
                ids += end
                for k, at in enumerate(range(0, len(ids), 4 * length)):
                    part = ids[at:at + 4 * length]
                    out.append((row, k, at // 4, len(part) // 4, zlib.crc32(part)))
            rows, k, at, n, crc = np.array(out, np.int64).reshape(-1, 5).T
            yield pa.RecordBatch.from_arrays([doc.take(pa.array(rows)), pa.array(k.astype(np.int32)), pa.array(at),
                                              pa.array(n), pa.array(crc)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32"])
            give_back()

    return pieces


def pieces(docs: DataFrame, path: str, length: int = 2048, end_id: int = 0) -> DataFrame:
    """Token pieces of every whole text: doc_id, piece, start, length, ids_crc32."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _cut(path, length, end_id), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class OpenBins:
    """Open bins by remaining capacity, with a segment tree of which capacities have one.

    ``tightest(n)`` finds the smallest remaining capacity of at least n in a logarithmic number of steps.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def add(self, remaining: int, bin_: int) -> None:
        self.bins[remaining].append(bin_)
        node = remaining + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, remaining: int) -> int:
        node = remaining + self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return self.bins[remaining].pop()

    def tightest(self, need: int) -> int | None:
        count, node = self.count, need + self.leaves
        if count[node]:
            return need
        while node > 1:  # climb until a right neighbour holds a bin
            if not node & 1 and count[node + 1]:
                node += 1
                break
            node >>= 1
        else:
            return None
        while node < self.leaves:
            node = 2 * node if count[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece by best-fit decreasing; equal lengths in the given order."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_, made = OpenBins(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        room = open_.tightest(n)
        if room is None:
            bin_, room, made = made, capacity, made + 1
        else:
            bin_ = open_.take(room)
        bins[i], offsets[i] = bin_, capacity - room
        if room > n:
            open_.add(room - n, bin_)
    return bins, offsets


def _pack(capacity: int):
    def one(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True],
                                  ignore_index=True)
        bins, offsets = best_fit(group["length"].to_numpy(np.int64), capacity)
        return group.drop(columns="_group").assign(sequence_id=group["_group"] * 2 ** 32 + bins, offset=offsets)

    return one


def pack(docs: DataFrame, path: str, length: int = 2048, end_id: int = 0, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Pack the tokens of all documents into sequences of at most ``length`` (needs doc_id, text).

    Null and empty texts are the end id alone. Pieces are dealt by a hash into groups of about
    ``group_pieces``; each group is packed by best-fit decreasing, so a group leaves about one sequence that
    is not full. Rows with equal doc_id are dealt apart by their place, so none needs one task. Ties of length
    keep the order of doc_id and piece. An empty table gives no rows; extra columns are left out.
    """
    cut = pieces(docs, path, length, end_id).withColumn("_at", F.monotonically_increasing_id())
    cut = written(cut)
    groups = parts_for(cut.count(), group_pieces)
    dealt = cut.withColumn("_group", F.pmod(F.xxhash64("_at"), F.lit(groups)).cast("long")).drop("_at")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("_group").applyInPandas(
        _pack(length), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
