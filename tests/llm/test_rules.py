"""Quality rules, URL filters, sharding, mixing, packing and search against plain versions."""

import collections
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelkit.llm import mixing, packing, quality, sharding, topk, urls
from panelkit.llm.queries import tokenizer_path
from tests.llm.conftest import plain_words


def repeats(w):
    seen = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    return len({i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)})


def test_quality_counts(spark, odd):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a ", "b ", "a b c ", "\n", "#", "é ", "<|x>", " \t", "line of words\n"]) for _ in range(rng.randint(0, 60)))
             for _ in range(150)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    for df in (docs, odd.select("doc_id", "text", "lang"), odd):
        want = collections.Counter()
        for r in df.collect():
            w, t = plain_words(r["text"]), r["text"] or ""
            lines = [x for x in t.split("\n") if plain_words(x)]
            failed = len(w) < 50 or 100 * repeats(w) > 50 * len(w)
            want[(r["doc_id"], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), repeats(w), failed)] += 1
        got = quality.quality(df)
        assert collections.Counter(tuple(r)[:7] for r in got.select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()) == want
        assert got.where("kept and base_failed").count() == 0
    assert quality.quality(docs.where("false")).count() == 0


def test_quality_distance(spark):
    good = "the of and to in a is that it for was on are as with be by this from at " * 1
    rng = random.Random(2)
    clean = [" ".join(rng.choice(good.split() + ["house", "river", "garden", "letter", "window"]) for _ in range(120)) for _ in range(60)]
    noise = [" ".join("".join(rng.choice("#$%&*ABCDEF0123456789") for _ in range(6)) for _ in range(120)) for _ in range(3)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(clean + noise)], "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in quality.quality(docs).where("kept").collect()}
    assert not kept & {60, 61, 62} and len(kept) >= 55
    # the distance of a histogram, by its definition
    measured = quality.measures(docs)
    ref = {r["lang"]: r for r in quality.references(measured).collect()}["en"]
    row = quality.judge(measured, quality.references(measured)).where("doc_id = 61").first()
    m = np.array(measured.where("doc_id = 61").first()["classes"], float)
    p, q = m / m.sum(), np.array(ref["p_class"])
    half = lambda a, b: sum(x * np.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
    assert row["class_distance"] == pytest.approx(np.sqrt((half(p, q) + half(q, p)) / 2))


def test_quality_sql_on_small_languages(spark):
    """The registered SQL says what the query does where a language has too few words, or none is given."""
    import duckdb

    from panelkit.llm.queries import ORACLES

    rng = random.Random(9)
    good = "the of and to in a is that it for was on are as with be by this from at".split() + ["house", "river", "garden"]
    text = lambda voc, n: " ".join(rng.choice(voc) for _ in range(n))
    rows = [(i, text(good, 120), "en") for i in range(40)] + [(100 + i, text(["".join(rng.choice("абвгде") for _ in range(5)) for _ in range(60)], 80), "xx") for i in range(3)]
    rows += [(200 + i, text(["".join(rng.choice("#$%&*AB9") for _ in range(5)) for _ in range(60)], 90), la) for i, la in enumerate(["en", "xx", None, "", "l"])] + [(300, text(good, 60), None), (301, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["kept"] for r in quality.quality(docs).collect()}
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.execute(ORACLES["op9_quality_rules"]).df().set_index("doc_id")["kept"].to_dict()
    assert got == want and got[100] and not got[200] and got[201] and not got[202]


def test_quality_references_of_many_and_of_small_languages(spark):
    rng = random.Random(8)
    text = lambda letters, n: " ".join("".join(rng.choices(letters, k=5)) for _ in range(n))
    latin, greek = "abcdefghijklmnop", "αβγδεζηθικλμνξο"
    rows = [(i, text(latin, 2100), f"l{i:03}") for i in range(257)] + [(300, text(greek, 2050), "el"), (301, text(greek, 100), "small"),
                                                                      (302, text(greek, 100), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    got = {r["doc_id"]: r for r in quality.quality(docs).where("doc_id >= 300").collect()}
    assert got[300]["kept"] and got[300]["class_distance"] == pytest.approx(0.0, abs=1e-6)
    assert got[301]["kept"] and got[301]["class_distance"] is None and got[301]["word_distance"] is None
    assert not got[302]["kept"] and got[302]["class_distance"] > 0.32


def test_urls(spark):
    cases = ["http://A.Net/x?q=1", "https://example.net/en/1#t", "http://sub.example.net/fr/1", "x://example.com/de/a", "http://example.com/d",
             "ftp://org/fr/", "http://o.org?x", "http://net", "http://network/", "no scheme", "", None, "a://b://c/d", "http://www.net:80/x", "://net/\n/x"]
    rng = random.Random(3)
    cases += [f"http://{rng.choice('abc')}.{rng.choice(['example', 'spam'])}.{rng.choice(['net', 'com', 'org'])}/{rng.choice(['en', 'de', 'fr'])}/{i}" for i in range(300)]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(cases)], "page_id long, url string, host string").repartition(3)
    got = {r["page_id"]: r for r in urls.judge(pages).collect()}
    assert len(got) == len(cases)
    for i, u in enumerate(cases):
        host, path = "", ""
        if u and "://" in u:
            rest = u.split("://", 1)[1]
            host = re.match(r"[^/?#]*", rest).group()
            path = re.match(r"(?s)[^?#]*", rest[len(host):]).group()
            host = "".join(c.lower() if c.isascii() else c for c in host)
        fits = [(h + p, v) for v, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda x: len(x[0])) if fits else (None, None)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
        assert got[i]["verdict"] == verdict if verdict else got[i]["verdict"] in ("allow", "block")
    assert urls.judge(pages.where("false")).count() == 0


def test_mined_rules_match_by_their_tokens(spark):
    mined = [urls.Mined(("a", "b"), "block", 0.9, 0.1), urls.Mined(("c",), "allow", 0.95, 0.1), urls.Mined(("b",), "block", 0.8, 0.1)]
    rows = spark.createDataFrame([(1, ["a", "b"]), (2, ["a"]), (3, ["b", "c", "a"]), (4, []), (5, ["b", "z"]), (5, ["b", "z"])], "k int, tokens array<string>")
    assert sorted(map(tuple, urls.match(rows, mined).collect()), key=str) == sorted(
        [(1, "a b", "block"), (2, None, "allow"), (3, "c", "allow"), (4, None, "allow"), (5, "b", "block"), (5, "b", "block")], key=str)
    labelled = spark.createDataFrame([(["x", "y"], "block")] * 8 + [(["x"], None)] * 20 + [(["z"], "allow")] * 5, "tokens array<string>, verdict string")
    found = {(m.tokens, m.verdict): m.confidence for m in urls.mine(labelled, min_support=0.05, min_confidence=0.6)}
    assert found[(("y",), "block")] == 1.0 and (("x", "y"), "block") not in found and (("x",), "block") not in found


def plain_rules(rows, least, sure):
    """All rules of small token sets by counting every combination."""
    found = {}
    for k in range(1, max(len(t) for t, _ in rows) + 1):
        for x in {c for t, _ in rows for c in itertools.combinations(sorted(t), k)}:
            hits = [v for t, v in rows if set(x) <= set(t)]
            for v in {"block", "allow"}:
                c = hits.count(v)
                if c >= least and c / len(hits) >= sure and not any(set(y) < set(x) and found[y, w] >= c / len(hits) for y, w in found if w == v):
                    found[x, v] = c / len(hits)
    return found


def test_mined_rules_count_every_token(spark):
    rng = random.Random(6)
    rows = [(["t%d" % i for i in range(6) if rng.random() < 0.6], rng.choice(["block", "block", "allow", None])) for _ in range(120)]
    rows = [(t, "block" if {"t0", "t3"} <= set(t) and rng.random() < 0.9 else v) for t, v in rows]
    df = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    assert {(m.tokens, m.verdict): m.confidence for m in urls.mine(df, min_support=0.05)} == plain_rules(rows, 6, 0.7)
    # the one telling token is the rarest of a URL with 16 frequent ones
    common = [f"c{i:02}" for i in range(15)]
    rows = [([*common, "rare"], "block")] * 10 + [(common, None)] * 90
    df = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    assert [(m.tokens, m.verdict, m.confidence) for m in urls.mine(df)] == [(("rare",), "block", 1.0)]


def test_less_confident_rules_stand_beside_many_certain_ones(spark):
    # one certain token among 12 others: 4,095 redundant supersets; two such groups fill more than 5,000 places
    rows = [([f"{g}{i:02}" for i in range(13)], "block") for g in "ab" for _ in range(10)]
    rows += [(["weak"], "block")] * 8 + [(["weak"], None)] * 2
    df = spark.createDataFrame(rows, "tokens array<string>, verdict string")
    rules = urls.mined_rules(df, min_support=0.1)
    got = {(tuple(r["tokens"]), r["verdict"]): r["confidence"] for r in rules.collect()}
    assert got == {((f"{g}{i:02}",), "block"): 1.0 for g in "ab" for i in range(13)} | {(("weak",), "block"): 0.8}
    pages = spark.createDataFrame([(1, ["weak"]), (2, ["a03", "weak"]), (3, ["none"])], "k int, tokens array<string>")
    assert sorted(map(tuple, urls.match(pages, rules).collect())) == [(1, "weak", "block"), (2, "a03", "block"), (3, None, "allow")]


def test_shards(spark, odd):
    many = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "copy").otherwise(F.col("id").cast("string")).alias("text"))
    for df in (many, odd):
        source = collections.Counter((r["doc_id"], len((r["text"] or "").encode()) + 16, zlib.crc32((r["text"] or "").encode())) for r in df.collect())
        got = sharding.shard(df, rows_per_bucket=7).collect()
        assert collections.Counter(tuple(r)[:3] for r in got) == source
        slots = collections.defaultdict(list)
        for r in got:
            slots[r["shard"]].append(r["slot"])
            assert r["law"] == "key" and 0 <= r["shard"] < 40 and r["grown_shard"] in (r["shard"], 40)
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
        assert len({(r["doc_id"], r["shard"], r["grown_shard"]) for r in got}) == len({r["doc_id"] for r in got})
    assert sharding.shard(many.where("false")).count() == 0


def test_weights_move_only_their_subtree(spark):
    keys = spark.range(6000).select(F.col("id").cast("string").alias("k"))
    before = [sharding.Shard(i, f"r{i // 4}", f"k{i // 2}", 1.0 + i % 2) for i in range(8)]
    after = [sharding.Shard(s.number, s.region, s.rack, 6.0 if s.number == 7 else s.weight) for s in before]
    got = keys.select(sharding.place(F.col("k"), before).alias("a"), sharding.place(F.col("k"), after).alias("b")).collect()
    assert all(r["a"] == r["b"] or r["b"] // 4 == 1 for r in got)  # rows only go into the region that grew
    share = collections.Counter(r["a"] for r in got)
    for s in before:
        assert abs(share[s.number] / 6000 - s.weight / 12) < 0.02


def brute_subset(sizes, counts, budget):
    """Smallest difference to the budget of all sums."""
    sums = {0}
    for s, c in zip(sizes.tolist(), counts.tolist()):
        sums |= {x + s * k for x in sums for k in range(1, c + 1)}
    return min(abs(x - budget) for x in sums)


def test_knapsack():
    rng = random.Random(5)
    for turn in range(400):
        n, scale = rng.randint(1, 6), rng.choice([1, 1, 10, 997, 10 ** 9])
        sizes = np.array(rng.sample(range(1, 30), n)) * scale + rng.choice([0, 0, 1])
        counts = np.array([rng.randint(0, 4) for _ in range(n)])
        budget = rng.randint(0, 120) * scale + rng.randint(0, scale)
        for took in (mixing.nearest(sizes, counts, budget), mixing.fit(sizes, counts, budget)):
            assert (took <= counts).all() and (took >= 0).all()
            assert abs(int((took * sizes).sum()) - budget) == brute_subset(sizes, counts, budget)
    # few long documents, sums above and below the target, even and odd sizes
    for sizes, counts, budget, want in (([30_000, 20_000], [3, 2], 65_000, {60_000, 70_000}), ([1_000], [3], 1_999, {2_000}),
                                        ([40_000], [1], 39_999, {40_000}), ([2, 4], [500, 10], 501, {500, 502}), ([0, 5], [9, 3], 11, {10})):
        took = mixing.fit(np.array(sizes), np.array(counts), budget)
        assert int((took * np.array(sizes)).sum()) in want
    # many sizes, far more sums than are kept
    sizes, counts = np.arange(1, 4001) * 7 + 13, np.full(4000, 50)
    budget = int((sizes * counts).sum()) // 3
    took = mixing.fit(sizes, counts, budget)
    assert (took <= counts).all() and abs(int((took * sizes).sum()) - budget) <= 1
    share = took / counts
    assert abs(share.mean() - 1 / 3) < 0.02 and (share > 0.2).all()


def test_mix(spark, odd):
    rng = random.Random(6)
    many = spark.createDataFrame([(i, " ".join(["w"] * rng.randint(0, 40)), rng.choice("abcde")) for i in range(1500)]
                                 + [(9000 + i, "same text here", "hot") for i in range(700)], "doc_id long, text string, source string").repartition(4)
    for df in (many, odd):
        got = mixing.mix(df, rows_per_bucket=50).collect()
        again = mixing.mix(df.repartition(2), rows_per_bucket=50).collect()
        order = lambda rows: sorted((str(r["doc_id"]), r["size"], r["taken"], r["target"]) for r in rows)
        assert order(got) == order(again)
        sizes = collections.Counter()
        for r in df.collect():
            sizes[r["source"]] += len(plain_words(r["text"]))
        names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
        weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
        goal, left, open_ = {}, 1.5 * sum(sizes.values()), set(names)
        while open_:
            level = left / sum(weight[s] for s in open_)
            over = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
            if not over:
                goal |= {s: level * weight[s] for s in open_}
                break
            goal |= {s: 2.0 * sizes[s] for s in over}
            left -= sum(goal[s] for s in over)
            open_ -= over
        taken = collections.Counter()
        for r in got:
            assert r["taken"] in (0, r["size"], 2 * r["size"]) and r["source_size"] == sizes[r["source"]]
            assert r["target"] == pytest.approx(goal[r["source"]])
            taken[r["source"]] += r["taken"]
        if df is many:
            assert all(abs(goal[s] - taken[s]) < 2 for s in names)
        assert len(got) == df.count()
    twins = spark.createDataFrame([(1, "same", "x", 1), (1, "same", "x", 2), (2, "two words", "x", 3), (None, "same", "x", 4), (None, "same", "x", 5)],
                                  "doc_id long, text string, source string, other int")
    copies = collections.Counter((r["doc_id"], r["other"]) for r in mixing.repeat(twins).collect())
    plan = collections.Counter()
    for r in mixing.mix(twins).collect():
        plan[r["doc_id"]] += r["copies"]
    for i in (1, 2, None):
        own = [copies[i, r["other"]] for r in twins.collect() if r["doc_id"] == i]
        assert sum(own) == plan[i] and max(own) - min(own) <= 1
    out = mixing.repeat(odd)
    assert out.columns == odd.columns
    assert sum(len(plain_words(r["text"])) for r in out.collect()) == sum(r["taken"] for r in mixing.mix(odd).collect())
    assert mixing.mix(many.where("false")).count() == 0


def test_best_fit_is_tightest():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 21, 400)
    bins, offsets = packing.best_fit(lengths, 20)
    free, where = [], {}
    for i in np.argsort(-lengths, kind="stable"):
        room = [x for x in free if x >= lengths[i]]
        if room:
            free.remove(min(room))
            free.append(min(room) - lengths[i])
            where[i] = min(room)
        else:
            free.append(20 - lengths[i])
            where[i] = 20
    assert len(set(bins)) == len(free) and all(20 - offsets[i] == where[i] for i in where)


def test_pack(spark, odd):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    got = packing.pack(odd, tokenizer_path(), length=64, group_pieces=300).collect()
    want = collections.Counter()
    for r in odd.collect():
        ids = [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 64):
            part = np.array(ids[k:k + 64], "<u4")
            want[(r["doc_id"], k // 64, k, len(part), zlib.crc32(part.tobytes()))] += 1
    assert collections.Counter(tuple(r)[:5] for r in got) == want
    rows = collections.defaultdict(list)
    for r in got:
        rows[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in rows.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 64
    assert packing.pack(odd.where("false"), tokenizer_path()).count() == 0


def test_word_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    path = tokenizer_path()
    tok, words = Tokenizer.from_file(path), packing.WordIds(path, limit=500)
    rng = random.Random(0)
    parts = [*"aAbzé's \t\r\n09,.!<|>Σςσ'll't\u0301\u0085\u200d\u3000ﬁİß한×÷Ǆ", "<|endoftext|>", " the ", " hello's", "don't", "42nd"]
    for _ in range(400):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(5)]
        for t, ids in zip(texts, words.of(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids


def test_word_ids_of_every_latin_letter():
    from tokenizers import Tokenizer

    path = tokenizer_path()
    tok, words = Tokenizer.from_file(path), packing.WordIds(path)
    letters = [chr(c) for c in (*range(0x21, 0x7f), *range(0xc0, 0x250))]
    texts = [w.format(c) for c in letters for w in ("{}", "{}li", "a{}", "b{}a", "é{}é", "1{}'s", "{0}{0}-x")] + ["Əli Ɛnam Ɔkyena Ɓata"]
    for t, ids in zip(texts, words.of(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_word_ids_are_learnt_by_part(monkeypatch):
    """Words that differ in case or signs share their parts, a full table keeps the frequent ones, stretches cut no word."""
    from tokenizers import Tokenizer

    path = tokenizer_path()
    tok, words = Tokenizer.from_file(path), packing.WordIds(path, limit=6)
    words.of(["Alpha, beta. alpha\n(BETA) Éa, éa 12 don't"])
    assert set(words.known) == {"", "alpha", "beta", "éa", ",", ".", "(", ")", "1", "2", "don't"}
    words.of(["alpha gamma"])
    assert set(words.known) == {"", "alpha", "gamma"}

    monkeypatch.setattr(packing, "STEP_BYTES", 24)
    rng = random.Random(1)
    parts = [*"aAzÉ  \n\t09,.<|'×ǅİ漢\u0301", "<|endoftext|>", " the ", "don't", "''s's", "42nd", "Straße"]
    texts = ["".join(rng.choices(parts, k=rng.choice([0, 1, 3, 9, 200]))) for _ in range(300)] + ["", " ", "\n\n", "a" * 60, "漢" * 30 + " b"]
    for t, ids in zip(texts, words.of(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, t


def test_top_k(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((700, 12)).round(2) / 4
    x[100:160] = x[100]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(700, None), (701, [0.1, None]), (702, [float("nan")] * 12), (703, [float("inf")] * 12), (750, [0.5, -0.25]), (800, []), (None, [1.0])]
    rows += [rows[50], rows[50]]
    df = spark.createDataFrame([(*r, 0, 1) for r in rows], "vec_id long, embedding array<double>, score int, rank int").repartition(3)
    for scale, k in ((256.0, 5), (1e8, 3), (1e12, 3)):
        got = collections.defaultdict(list)
        for r in topk.top_k(df, F.col("vec_id") % 50 == 0, k, scale, block_rows=128, query_rows=4).collect():
            got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
        live = [(i, np.pad(np.floor(scale * np.array(v)).astype(np.int64), (0, 12 - len(v)))) for i, v in rows
                if i is not None and v is not None and all(c is not None and np.isfinite(c) for c in v)]
        for q in {i for i, _ in live if i % 50 == 0}:
            mine = next(v for i, v in live if i == q)
            best = sorted((-int(v @ mine), i) for i, v in live if i != q)[:k]
            want = [(n + 1, i, -s) for n, (s, i) in enumerate(best)]
            copies = sum(i == q for i, _ in live)
            assert sorted(got[q]) == sorted(want * copies), q
        assert set(got) == {i for i, _ in live if i % 50 == 0}
    assert topk.top_k(df.where("false"), F.lit(True)).count() == 0
    assert topk.top_k(df.where("vec_id = 1"), F.lit(True)).count() == 0


def test_top_k_sends_no_blocks_to_all(spark):
    """Blocks of queries and of the index meet in the tasks they are dealt to, however small their files; groups agree."""
    rng = np.random.default_rng(2)
    x = rng.integers(-3, 4, (400, 6))  # many ties
    df = spark.createDataFrame([(i % 390, (v / 4).tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(3)
    want = collections.Counter()
    for i, v in enumerate(x):
        if i % 390 % 50 == 0:
            best = sorted((-int(w @ v) * 4096, j % 390) for j, w in enumerate(x) if j % 390 != i % 390)[:5]
            want.update((i % 390, n + 1, j, -s) for n, (s, j) in enumerate(best))
    assert "Broadcast" not in topk.top_k(df, F.col("vec_id") % 50 == 0)._jdf.queryExecution().executedPlan().toString()
    for group_blocks in (1, 3, 100):
        found = topk.top_k(df, F.col("vec_id") % 50 == 0, block_rows=32, query_rows=3, group_blocks=group_blocks)
        assert collections.Counter(map(tuple, found.collect())) == want


def test_search_block_leaves_out_rows_below_a_floor():
    """A known score spares rows that cannot reach it, and no row that can, ties included."""
    rng = np.random.default_rng(3)
    q, v = rng.integers(-200, 200, (9, 16)), rng.integers(-200, 200, (300, 16))
    v[50:60] = v[50]
    ids, score = np.arange(300), q @ v.T
    best = topk.Best(9, 4)
    for a in range(0, 300, 50):
        found = list(topk.search_block(q, np.full(9, -1), topk.Segments(v[a:a + 50]), ids[a:a + 50], 4, floor=best.floor))
        best.add(found, ids[a:a + 50])
    for i in range(9):
        order = np.lexsort((ids, -score[i]))[:4]
        assert best.id[best.place == i].tolist() == order.tolist() and best.floor[i] == score[i][order[-1]]
