"""Collocations against a plain version, and the guarantee of the summaries."""

import collections
import random
import re

import numpy as np
import pytest

from panelkit import scale
from panelkit.llm import collocations as C


def plain(rows, limit=2000, most=3, least=10, inside=50):
    """lang, rank, phrase, a, l, r, n, score by the definition, from (text, lang) rows."""
    f, total = collections.Counter(), collections.Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und" if lang is None else lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    f["und" if lang is None else lang, tuple(w[i:i + k])] += 1
    out = collections.defaultdict(list)
    many = {k: a for k, a in f.items() if a >= least and len(k[1]) > 1}
    for (lang, w), a in many.items():
        if any(la == lang and len(x) > len(w) and 100 * b >= inside * a and any(x[i:i + len(w)] == w for i in range(len(x) - len(w) + 1))
               for (la, x), b in many.items()):
            continue
        score, _, l, r = min((1_000_000 * a * a // (f[lang, w[:c]] * f[lang, w[c:]]), c, f[lang, w[:c]], f[lang, w[c:]]) for c in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), l, r))
    return {(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for lang, found in out.items()
            for i, (s, a, p, l, r) in enumerate(sorted(found)[:limit])}


def texts(seed, n, words=30):
    rng = random.Random(seed)
    voc = ["a", "B", "é", "Éa", "cat", "of", "the", "#x", "naïve", "日本"] + [f"w{i}" for i in range(words)]
    sep = [" "] * 12 + ["  ", "\t", ". ", ",", "\n", "!", "\x0b", " ? ", ";", "\r\n", ":"]
    return [("".join(rng.choice(voc[:rng.choice([4, 12, len(voc)])]) + rng.choice(sep) for _ in range(rng.randint(0, 60))),
             rng.choice(["en", "en", "en", "de", None, "", "und"])) for _ in range(n)]


@pytest.mark.parametrize("most,least,limit,sizes", [
    (3, 10, 2000, {}), (3, 10, 7, {"per_partition": 300, "filter_bits": 12}), (2, 3, 50, {"local": 500, "filter_bits": 3}),
    (4, 4, 100, {"per_partition": 1000, "local": 2000}), (3, 1, 100, {})])
def test_against_plain(spark, most, least, limit, sizes):
    rows = texts(most * 10 + least, 120 if most < 4 and least > 1 else 50)
    df = spark.createDataFrame([(t, la, 1, 2) for t, la in rows], "text string, lang string, n int, phrase int").repartition(5)
    assert {tuple(r) for r in C.mine(df, limit, most, least, **sizes).collect()} == plain(rows, limit, most, least)


def test_odd_rows(spark, odd):
    rows = [(r["text"], r["lang"]) for r in odd.collect()]
    got = {tuple(r) for r in C.mine(odd, 40, min_count=3).collect()}
    assert got == plain([(t, la) for t, la in rows], 40, 3, 3)
    assert C.mine(odd.where("false")).count() == 0


def test_words_named_like_languages(spark):
    rows = [("en la en la es", "es"), ("es la es la en", "en")] * 12
    assert {tuple(r) for r in C.mine(spark.createDataFrame(rows, "text string, lang string")).collect()} == plain(rows)


def test_hot_word_is_dealt_out(spark):
    """A word that is part of nearly all phrases: its look-up is split, the scores stay."""
    rows = [(f"the x{i % 40} of the y{i % 30}", "en") for i in range(600)]
    counted = C.frequent(spark.createDataFrame(rows, "text string, lang string"))
    few = {tuple(r) for r in C.score(counted, rows_per_part=5).collect()}
    assert few == {tuple(r) for r in C.score(counted).collect()}
    assert scale.hot_keys(counted.where("k = 2").selectExpr("lang", "split(phrase, ' ')[0] w"), ["lang", "w"], 5).count() > 0
    got = {tuple(r) for r in C.top(C.score(counted), 2000).select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}
    assert got == plain(rows)


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_007
    rows = [("en", 1, "x", big), ("en", 1, "y", big + 2), ("en", 2, "x y", big - 1), ("en", 0, None, 10 * big)]
    out = C.score(spark.createDataFrame(rows, "lang string, k int, phrase string, n long")).first()
    assert out["score"] == 1_000_000 * (big - 1) ** 2 // (big * (big + 2)) and out["n"] == 10 * big


def test_no_frequent_key_is_lost():
    """Merged in any order, over any number of summaries: what a counter lost is below mass / capacity."""
    rng = np.random.default_rng(5)
    for least in (2, 5, 10):
        keys = np.concatenate([rng.zipf(1.3, 4000) % 5000, rng.integers(0, 100_000, 6000)]).astype(np.uint32)
        rng.shuffle(keys)
        capacity = len(keys) // least + 1
        parts = [C.tally(x) for x in np.array_split(keys, 23)]
        now, lost, most = (keys[:0], np.zeros(0, np.int64)), 0, 0
        for a in range(0, len(parts), 3):
            *now, cut = C.merge([tuple(now), *parts[a:a + 3]], capacity)
            lost, most = lost + cut, max(most, len(now[0]))
        assert most <= capacity and lost * (capacity + 1) <= len(keys) and lost < least
        left = dict(zip(now[0].tolist(), now[1].tolist()))
        for key, n in collections.Counter(keys.tolist()).items():
            assert left.get(key, 0) <= n <= left.get(key, 0) + lost
            assert n < least or key in left
    # the cut does take place where distinct keys exceed the capacity
    assert C.merge([C.tally(np.arange(100, dtype=np.uint32))], 10)[2] == 1


def test_counts_pack():
    counts = np.array([1, 254, 255, 256, 10 ** 12, 3])
    assert C._unpack(C._pack(counts), len(counts)).tolist() == counts.tolist()
    keys = np.array([0, 1, 7, 300, 70_000, 2 ** 27 - 1], np.uint32)
    assert C._unpack_keys(C._pack_keys(keys), len(keys)).tolist() == keys.tolist()
