"""Spelling variants against a plain version, and the parts of the index on their own."""

import collections
import itertools
import os
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from panelkit.llm import variants as V
from panelkit.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_words(rows, min_length=7, min_count=2, every=31):
    n = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= min_length:
                n[run] += 1
    return {w: k for w, k in n.items() if k >= min_count}


def plain_near(words):
    """All words one edit away of each, by the words that share a rest without one letter."""
    rests = collections.defaultdict(set)
    for w in words:
        for i in range(len(w)):
            rests[w[:i] + w[i + 1:]].add((w, i))
    near = collections.defaultdict(set)
    for rest, found in rests.items():
        for (a, i), (b, j) in itertools.combinations(found, 2):
            if a != b and i == j:
                near[a].add(b), near[b].add(a)
        if rest in words:
            for a, _ in found:
                near[a].add(rest), near[rest].add(a)
    return near


def plain(rows, ratio=10, **limits):
    n = plain_words(rows, **limits)
    near, form = plain_near(n), {}
    for w in n:
        if near[w]:
            best = min(near[w], key=lambda x: (-n[x], x))
            if n[best] >= ratio * n[w]:
                form[w] = best
    out = set()
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def texts(seed, n, voc=60):
    rng = random.Random(seed)
    part = ["th", "on", "an", "er", "é", "ß", "ing", "ou", "a", "b", "Z", "ÿ"]
    base = ["".join(rng.choice(part) for _ in range(rng.randint(3, 8))) for _ in range(voc)] + ["x" * 59, "x" * 60, "x" * 61, "ab" * 40]

    def word():
        w = base[min(int(rng.expovariate(0.08)), len(base) - 1)]
        for _ in range(rng.choice([0, 0, 0, 0, 1, 1, 2])):
            i, c = rng.randrange(len(w) + 1), rng.choice("abéonz")
            w = rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]])
        return w
    return [(rng.choice([i, i, i, None]), "".join(word() + rng.choice([" ", " ", ", ", "€", "\n", "1", "×", "đ"]) for _ in range(rng.randint(0, 80))))
            for i in range(n)]


@pytest.mark.parametrize("seed,sizes", [(1, {}), (2, {"longest": 3}), (3, {"longest": 3, "rows_per_bucket": 40}),
                                        (4, {"share": 1}), (5, {"share": 40, "min_length": 6, "min_count": 1, "drop_every": 2})])
def test_against_plain(spark, seed, sizes):
    rows = texts(seed, 150)
    df = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(4)
    limits = {k: v for k, v in sizes.items() if k in ("min_length", "min_count")} | ({"every": 2} if "drop_every" in sizes else {})
    got = [tuple(r) for r in V.group(df, **sizes).collect()]
    assert len(got) == len(set(got)) and set(got) == plain(rows, **limits)
    assert any(r[1] for r in got) and any(r[4] > 3 for r in got)


def test_odd_rows(spark, odd):
    long = "y" * 3_000
    extra = spark.createDataFrame([("one", f"{long} {long} {long}z ÀÉÿ{long} {long}z"), ("two", f"{long} ÀÉÿ{long}"), (None, "notable notable notabla " * 30)],
                                  "doc_id string, text string")
    for df in (odd, extra):
        rows = [(r["doc_id"], r["text"]) for r in df.collect()]
        assert {tuple(r) for r in V.group(df).collect()} == plain(rows)
    assert V.group(odd.where("false")).count() == 0
    with pytest.raises(ValueError):
        V.group(odd, min_length=5)


def test_every_near_pair_shares_a_list():
    """The bound on affected grams: of random words of all lengths, two that are one edit apart share an entry."""
    rng = random.Random(8)
    words = {"".join(rng.choice("abcaba") for _ in range(rng.randint(6, 20))) for _ in range(1500)}
    for w in list(words):
        for _ in range(3):
            i, c = rng.randrange(len(w) + 1), rng.choice("abc")
            words |= {w[:i] + c + w[i:], w[:i] + w[i + 1:], w[:i] + c + w[i + 1:]}
    words = sorted(w for w in words if 6 <= len(w) <= 60)
    grams = collections.Counter(w[i:i + q] for w in words for q in (2, 3, 4) for i in range(len(w) - q + 1))
    for least in (10 ** 9, 300, 20, 0):  # from no frequent gram to all of them
        frequent = sorted((n, int.from_bytes(g.encode(), "little")) for g, n in grams.items() if n > least)
        ranks = {g: i for i, (_, g) in enumerate(frequent, 1)}
        letters = V.Letters(pa.array(words))
        rows, keys = V.entries(letters.matrix(np.arange(len(words))), letters.size, ranks)
        lists = collections.defaultdict(set)
        for r, k in zip(rows.tolist(), keys.tolist()):
            lists[words[r]].add(k)
        pairs = [(a, b) for a, others in plain_near(set(words)).items() for b in others]
        assert len(pairs) > 2000 and all(lists[a] & lists[b] for a, b in pairs)
        assert len(rows) < 9 * len(words)


def test_letters_and_checksums():
    words = ["abc", "éÿ×a", "", "x" * 200, "Àb"]
    letters = V.Letters(pa.array(words))
    assert letters.size.tolist() == [len(w) for w in words]
    assert [bytes(letters.codes(i)).decode("latin-1") for i in range(len(words))] == words
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    got = V.crc32s(data, np.concatenate([[0], ends[:-1]]), ends, np.array([zlib.crc32(b"17:")] * len(words), np.uint32))
    assert got.tolist() == [zlib.crc32(f"17:{w}".encode()) for w in words]


@pytest.mark.parametrize("a,b,want", [("abcdefgh", "abcdefgh", False), ("abcdefgh", "abcdefg", True), ("bcdefgh", "abcdefgh", True),
                                      ("abcxefgh", "abcdefgh", True), ("abxxefgh", "abcdefgh", False), ("abcdefgh", "abcdef", False),
                                      ("aaaaaaa", "aaaaaaaa", True), ("abababab", "babababa", False)])
def test_one_edit(a, b, want):
    for x in ("", "q" * 60):
        pair = V._Pairs(pa.array([x + a, x + b]))
        assert (len(pair.near(np.array([0]), np.array([1]))[0]) == 1) == want
        assert V.one_edit(np.frombuffer((x + a).encode(), np.uint8), np.frombuffer((x + b).encode(), np.uint8)) == want


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert {tuple(r) for r in QUERIES["op13_spelling_variants"](spark, SF).collect()} == plain(rows)
