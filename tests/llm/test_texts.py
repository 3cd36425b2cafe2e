"""Repeated passages, near copies, personal data and toxicity against plain versions and held-out rows."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelkit.llm import common, jaccard, pii, substring, toxicity
from tests.llm.conftest import plain_words


@pytest.mark.parametrize("size", [1 << 20, 3])
def test_words(size, monkeypatch):
    monkeypatch.setattr(common, "SLICE_BYTES", size)
    texts = ["a bb  ccc\x0bd", None, "", " x", "y ", "z " * 3 + "q" * 40, "q" * 40 + "\na bb", "é à\x1cb\u00a0c", "a bb ccc d e f"]
    seen = {}
    for a, b, raw, at in common.slices(pa.array(texts)):
        w = common.words(raw, at)
        for i in range(b - a):
            span = range(w.first[i], w.first[i + 1])
            got = [bytes(w.data[w.start[j]:w.end[j]]).decode() for j in span]
            assert got == plain_words(texts[a + i])
            for j, word in zip(span, got):
                assert seen.setdefault(word, w.hash[j]) == w.hash[j]
    assert len(set(seen.values())) == len(seen)


def test_runs():
    h = np.random.default_rng(0).integers(0, 2 ** 63, 200).astype(np.uint64)
    h = np.concatenate([h, h[50:150]])
    for n in (1, 2, 5, 7, 20, 50, 64):
        r = common.runs(h, n)
        assert len(r) == 301 - n and (r[200:301 - n] == r[50:151 - n]).all()
        assert len(set(r.tolist())) == len(r) - (101 - n)
    assert len(common.runs(h[:3], 5)) == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randint(100, 400), rng.randint(100, 400)) for _ in range(200)] + [(5, 5), (900, 500)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    got = dict(map(tuple, common.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()))
    assert got == {x: find(x) for x in root if x != find(x) or any(find(y) == x and y != x for y in root)}


def plain_removed(docs):
    first, cut = {}, [(d, plain_words(t)) for d, t in docs]
    for d, w in cut:
        if d is not None:
            for i in range(len(w) - 49):
                key = tuple(w[i:i + 50])
                first[key] = min(first.get(key, d), d)
    out = collections.Counter()
    for d, w in cut:
        gone = {i + k for i in range(len(w) - 49) if d is not None and first[tuple(w[i:i + 50])] < d for k in range(50)}
        out[(d, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())] += 1
    return out


def test_substring(spark, odd):
    rng = random.Random(3)
    voc = [f"w{i}é" for i in range(40)]
    passages = [[rng.choice(voc) for _ in range(rng.choice([49, 50, 51, 60, 90, 150]))] for _ in range(12)]
    docs = []
    for d in range(120):
        w = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            w += [rng.choice(voc) for _ in range(rng.randint(0, 80))] if rng.random() < 0.5 else p[rng.choice([0, rng.randrange(len(p))]):]
        docs.append((d, rng.choice([" ", "\n", "  "]).join(["x"] * rng.randint(0, 300) if rng.random() < 0.1 else w)))
    docs += [(3, docs[3][1]), (3, docs[9][1]), (5, None), (None, docs[7][1]), (501, docs[7][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for case in (df, odd):
        rows = [(r["doc_id"], r["text"]) for r in case.collect()]
        got = substring.remove(case).collect()
        assert collections.Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == plain_removed(rows)
        for r in got:
            assert sum(f["end"] - f["start"] for f in r["factors"]) == r["n_removed"]
            assert all(f["end"] - f["start"] >= 50 for f in r["factors"]) and len(r["kept"].split()) <= r["n_words"]
    assert substring.remove(df.where("false")).count() == 0


def plain_sets(docs):
    out = []
    for _, t in docs:
        w = plain_words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        out.append(frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    return out


def plain_groups(docs):
    sets = plain_sets(docs)
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j in range(i):
            if s and 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return collections.Counter((d, len(sets[i]), least.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(docs))


def near_copies():
    rng = random.Random(5)
    voc = [f"w{i}" for i in range(3000)]
    bases = [[rng.choice(voc) for _ in range(rng.choice([3, 5, 8, 30, 100, 200]))] for _ in range(20)]
    notice = [rng.choice(voc) for _ in range(40)]
    docs = []
    for d in range(420):
        b = list(rng.choice(bases)) if rng.random() < 0.8 else [rng.choice(voc) for _ in range(rng.randint(0, 60))]
        for _ in range(rng.choice([0, 0, 1, 2, 3, 5])):
            if b:
                b[rng.randrange(len(b))] = rng.choice(voc)
        b = b + notice if rng.random() < 0.3 else notice + [rng.choice(voc) for _ in range(rng.randint(1, 12))] if rng.random() < 0.1 else b
        docs.append((d, " ".join(x.upper() for x in b) if rng.random() < 0.2 else " ".join(b)))
    return docs + [(2000, None), (2001, ""), (2002, " \n"), (7, docs[8][1]), (7, docs[7][1])]


@pytest.mark.parametrize("part", [2_000_000, 1_500])
def test_jaccard(spark, part):
    docs = near_copies()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert collections.Counter(map(tuple, jaccard.join(df, part_entries=part).collect())) == plain_groups(docs)


def test_jaccard_odd(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    assert collections.Counter(map(tuple, jaccard.join(odd).collect())) == plain_groups(rows)
    assert jaccard.join(odd.where("false")).count() == 0
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    assert collections.Counter(r["doc_id"] for r in kept.collect()) == collections.Counter([0, 2, 3, 4, 5, 6, None, 7, 8, 9])


def test_jaccard_links_sets_of_rows_without_id(spark):
    rng = random.Random(9)
    text = lambda: [f"w{rng.randrange(3000)}" for _ in range(100)]
    one, two, chain = text(), text(), text()
    docs = [(None, one), (5, one), (7, one + ["x"]), (None, two), (8, two + ["x"]), (None, two + ["y"]),
            (11, chain), (None, chain + ["a"] * 12), (12, chain + ["a"] * 12 + text()[:14]), (20, text()), (None, text())]
    docs = [(d, " ".join(w)) for d, w in docs]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert collections.Counter(map(tuple, jaccard.join(df).collect())) == plain_groups(docs)
    kept = [r["doc_id"] for r in jaccard.keep_one(df).collect()]
    assert collections.Counter(kept) == collections.Counter([5, 8, 11, 20, None])


def plain_spans(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) < 256 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = [int(c) for c in m.group() if c in "0123456789"]
        twice = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
        if 12 <= len(digits) <= 19 and (sum(twice) + sum(digits[::-2])) % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_base_spans():
    rng = random.Random(1)
    for _ in range(8000):
        t = "".join(rng.choices("ab1234567890...@@-- +()é%\n", k=rng.randint(0, 60)))
        assert pii.base_spans(t) == plain_spans(t)


def personal(rng, i):
    say = lambda n: " ".join("".join(rng.choices("aeioulmnrst", k=rng.randint(1, 8))) for _ in range(n))
    found = [f"{say(1)}.{rng.randint(0, 99)}@mail{i % 9}.example.com", ".".join(str(rng.randint(10, 255)) for _ in range(4)),
             f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}", f"token={rng.getrandbits(64):x}"]
    return f"{say(rng.randint(5, 60))} {rng.choice(found)} {say(rng.randint(0, 40))} {rng.choice(found)}."


def test_personal_data(spark, odd):
    rng = random.Random(2)
    docs = [(i, personal(rng, i) if i % 3 else "plain words and 12 numbers 3.5") for i in range(240)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    model = pii.fit(df, sample_docs=120)
    for case in (df, odd):
        texts = collections.Counter((r["doc_id"], r["text"]) for r in case.collect())
        want = collections.Counter()
        for (d, t), n in texts.items():
            base = plain_spans(t or "")
            line = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
            want[(d, *(sum(x[1] == k for x in base) for k in range(4)), hashlib.sha256(line.encode()).hexdigest())] += n
        got = pii.find(case, model).collect()
        assert collections.Counter(tuple(r)[:6] for r in got) == want
    by_id = dict(docs)
    for r in pii.find(df, model).collect():
        assert {f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in plain_spans(by_id[r["doc_id"]])} <= set(r["spans"].split(","))
    masked = pii.mask(odd.unionByName(odd.limit(1).withColumn("text", F.lit("é mail a.b@c.de now"))), model)
    assert masked.columns == odd.columns and masked.where("text = 'é mail <EMAIL> now'").count() == 1
    assert pii.find(df.where("false"), model).count() == 0 and pii.fit(df.where("false")) is not None
    # the network by itself finds most spans of texts it has not seen
    fresh = [personal(random.Random(99), i) for i in range(60)]
    hit = total = 0
    for t, tags in zip(fresh, pii.tag_texts(model, fresh)):
        for s, k, e in plain_spans(t):
            total += 1
            hit += (tags[s:e] == k + 1).mean() > 0.7
    assert hit / total > 0.7
    # spans that no pattern matches: other separators, no plus sign
    odd_rng, found, wanted = np.random.default_rng(3), 0, 0
    for t in fresh:
        other, spans = pii.variants(t, plain_spans(t), odd_rng)
        missed = [x for x in spans if not any(a < x[2] and x[0] < b for a, _, b in plain_spans(other))]
        own = next((whole for _, _, base, whole in pii._search(model, pa.array([other]))), [])
        wanted += len(missed)
        found += sum(any(a < e and s < b and kind == k for a, kind, b in own) for s, k, e in missed)
    print("spans only the network finds:", found, "of", wanted)
    assert wanted > 15 and found > wanted // 3


def plain_tags(model, text):
    """Mean emissions of all windows, one at a time, and one Viterbi pass over the whole text."""
    code = pii.classes(text)
    total, times = np.zeros((len(code), 5)), np.zeros(len(code))
    for w in range(max(0, -(-(len(code) - pii.WINDOW) // pii.STRIDE)) + 1):
        part = code[w * pii.STRIDE:w * pii.STRIDE + pii.WINDOW]
        _, score = pii._emissions(model, part[:, None].astype(np.int64), np.ones((len(part), 1), bool))
        total[w * pii.STRIDE:w * pii.STRIDE + len(part)] += score[:, 0]
        times[w * pii.STRIDE:w * pii.STRIDE + len(part)] += 1
    score = total / times[:, None]
    best, back = model["first"] + score[0], []
    for t in range(1, len(code)):
        via = best[:, None] + model["trans"]
        back.append(via.argmax(0))
        best = via.max(0) + score[t]
    tags = [int(best.argmax())]
    for choice in reversed(back):
        tags.append(int(choice[tags[-1]]))
    return np.array(tags[::-1])


def test_windows_are_reconciled(spark):
    rng = random.Random(12)
    model = pii.train([(t, plain_spans(t)) for t in (personal(rng, i)[:pii.WINDOW] for i in range(150))], epochs=4)
    texts = [personal(rng, i) + " " + personal(rng, i) + (" plain words" * 40) * (i % 3) for i in range(12)]
    long = "plain words " * 25 + "a" * 63 + "@mail.example.com and more words " * 6
    texts += [long, "", "x", "no such thing here", "1" * 700 + " words " * 60 + "+1 (212) 555-1234"]
    for t, tags in zip(texts, pii.tag_texts(model, texts, everywhere=True)):
        assert not t or (tags == plain_tags(model, t)).mean() > 0.995
    for t, part, whole in zip(texts, pii.tag_texts(model, texts), pii.tag_texts(model, texts, everywhere=True)):
        inside = np.zeros(len(t), bool)
        for s, e in pii.areas(pii.classes(t)):
            inside[s + pii.MARGIN * (s > 0):e - pii.MARGIN * (e < len(t))] = True
        assert not part[:0].any() and (not inside.any() or (part[inside] == whole[inside]).mean() > 0.99)
    at = long.index("@")
    assert any(s <= at - 63 and e >= at + 17 for s, e in pii.areas(pii.classes(long)))
    assert pii.areas(pii.classes("x" * 100_000)) == [] and pii.areas(pii.classes("a1" * 100_000)) == [(0, 200_000)]


def test_ids_of_any_type(spark):
    rng = random.Random(4)
    rows = [(f"id-{i}", personal(rng, i) + (" vile grue" if i % 2 else " mild words")) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    labels = spark.createDataFrame([(f"id-{i}", i % 2) for i in range(60)], "doc_id string, toxic int")
    assert pii.find(docs, pii.fit(docs, sample_docs=20)).count() == 60
    assert toxicity.score(docs, toxicity.fit(docs, labels)).where("score between 0 and 1").count() == 60


def slope(f, p, key, i, step):
    q = {k: v.copy() for k, v in p.items()}
    q[key].ravel()[i] += step
    return f(q)


def test_gradients():
    rng = np.random.default_rng(0)
    texts = [[" ".join("".join(rng.choice(list("abcdé"), rng.integers(1, 6))) for _ in range(rng.integers(1, 9)))] for _ in range(6)]
    w, first, _ = toxicity._as_words(texts)
    vocab, size = toxicity.Vocabulary(w), np.diff(first)
    steps = np.arange(size.max())[:, None]
    live = steps < size
    place = vocab.of[np.where(live, first[:-1] + steps, first[:-1])]
    label = np.array([0, 1, 1, 0, 1, 0.0])
    p = {k: x.astype(np.float64) for k, x in toxicity.fresh(1).items()}
    loss = lambda q: toxicity.gradients(q, vocab, place, live, label)[0]
    checks = [(loss, p, toxicity.gradients(p, vocab, place, live, label)[1])]
    codes = [pii.classes(t) for t in ("a 12.3.4.5 b", "x@y.z hello", "4111 1111", "+1 (22) 3")]
    code, live2 = pii._padded(codes)
    tags = pii._padded([np.array([(i % 3 == 0) * (1 + i % 4) for i in range(len(c))]) for c in codes])[0]
    q = {k: v.astype(np.float64) for k, v in pii.fresh(1).items()}
    checks.append((lambda x: pii.gradients(x, code, live2, tags)[0], q, pii.gradients(q, code, live2, tags)[1]))
    for f, params, g in checks:
        for key in params:
            i = int(np.abs(g[key]).argmax())
            want = (slope(f, params, key, i, 1e-3) - slope(f, params, key, i, -1e-3)) / 2e-3
            assert g[key].ravel()[i] == pytest.approx(want, rel=1e-2, abs=1e-5), key


def test_scoring_path_equals_the_training_path():
    p = toxicity.fresh(3)
    w, first, _ = toxicity._as_words([["a bb ccc a", "d", "e f a bb"]])
    vocab, size = toxicity.Vocabulary(w), np.diff(first)
    steps = np.arange(size.max())[:, None]
    live = steps < size
    place = vocab.of[np.where(live, first[:-1] + steps, first[:-1])]
    states = toxicity._states(p, toxicity._gates(p, vocab.inputs(p), place), live)
    assert np.allclose(toxicity._pool(p, states, live)[3], toxicity.score_windows(p, vocab, first[:-1], size), atol=1e-5)


def test_windows_cover_every_word():
    for n in range(0, 400):
        starts = toxicity.window_starts(n)
        assert {i for s in starts for i in range(s, min(n, s + toxicity.WINDOW))} == set(range(n))


def test_toxicity(spark, odd):
    rng = random.Random(8)
    voc = ["".join(rng.choices("aeiourstlnm", k=rng.randint(2, 7))) for _ in range(400)]
    bad = ["zukkor", "grimplo", "vexxan"]
    rows, labels = [], []
    for i in range(700):
        w = [rng.choice(voc) for _ in range(rng.randint(5, 150))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(max(1, len(w) // 30)):
                w[rng.randrange(len(w))] = rng.choice(bad) + rng.choice(["", "s", "!", ","])
        rows.append((i, " ".join(w)))
        labels += [(i, 1, int(toxic))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    known = spark.createDataFrame([*labels, (1, None, None), (None, 1, 1), (0, 1, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, known)
    scored = toxicity.score(docs, model).withColumn("held_out", toxicity.held_out(F.col("doc_id"))).collect()
    truth = {d: t for d, _, t in labels}
    out = [(r["score"] >= 0.5) == truth[r["doc_id"]] for r in scored if r["held_out"]]
    assert len(out) > 100 and np.mean(out) > 0.95
    got = toxicity.score(odd, model).collect()
    assert collections.Counter(r["doc_id"] for r in got) == collections.Counter(r["doc_id"] for r in odd.collect())
    assert all(0 <= r["score"] <= 1 for r in got)
    clean = toxicity.keep_clean(odd, model)
    assert clean.columns == odd.columns and clean.count() == sum(r["score"] < 0.5 for r in got)
    assert toxicity.score(docs.where("false"), model).count() == 0
    flat = toxicity.fit(docs, known.where("toxic = 0"))  # one class only: its share for every text
    assert len({r["score"] for r in toxicity.score(docs, flat).collect()}) == 1


def test_worker_memory_stays_bounded():
    """Digits are looked for a megabyte at a time, and parts of words are forgotten before the words are."""
    import tracemalloc

    from tokenizers import Tokenizer

    from panelkit.llm import packing
    from panelkit.llm.queries import tokenizer_path

    texts = pa.array(["plain words " * 300] * 8_000 + ["call 5"], pa.string())  # 29 MB
    tracemalloc.start()
    found = [(i, t) for i, t, _, _ in pii._search(pii.fresh(), texts)]
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(8_000, "call 5")] and most < 16 << 20

    words = packing.WordIds(tokenizer_path(), limit=400)
    plain = Tokenizer.from_file(tokenizer_path())
    for i in range(20):
        text = " ".join(f"w{chr(97 + i)}{chr(97 + j)}x{j}" for j in range(12))
        assert words.of([text]) == [np.asarray(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]
    assert len(words.known) > 200 and len(words.parts) < 200
