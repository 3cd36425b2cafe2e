"""Toxicity: a bidirectional gated recurrent network with attention pooling over words and their characters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import Words, lean, mix, slices, words
from panelkit.llm.neural import Adam, sigmoid, tanh

#: Words of a window and words between window starts.
WINDOW, STRIDE = 64, 48
#: Buckets and sizes of the character (trigram) and word vectors; hidden units of a direction.
CHAR_BUCKETS, CHAR_SIZE = 1 << 13, 12
WORD_BUCKETS, WORD_SIZE = 1 << 13, 8
HIDDEN = 8
#: The training sample: labelled documents of each class, windows of each.
SAMPLE_DOCS, SAMPLE_WINDOWS = 1_500, 8
#: Passes over the sample; small samples get more, so that there are STEPS steps at least.
EPOCHS, STEPS, BATCH, RATE = 6, 400, 64, 0.01
#: Pull of the vectors towards zero.
DECAY = 1e-4
#: Windows run together.
CHUNK = 1024


class Vocabulary:
    """The distinct words of a slice: character trigram buckets, word bucket, and each word's number."""

    def __init__(self, w: Words):
        _, first, self.of = np.unique(w.hash, return_index=True, return_inverse=True)
        start, size = w.start[first], (w.end - w.start)[first]
        self.begin = np.cumsum(size) - size
        at = np.arange(size.sum()) + np.repeat(start - self.begin, size)
        data = w.data.astype(np.uint64)
        before, after = np.full(len(at), 2, np.uint64), np.full(len(at), 3, np.uint64)
        inner = np.ones(len(at), bool)
        inner[self.begin] = False
        before[inner] = data[at[inner] - 1]
        last = np.ones(len(at), bool)
        last[self.begin + size - 1] = False
        after[last] = data[at[last] + 1]
        self.grams = (mix(before * np.uint64(65536) + data[at] * np.uint64(256) + after)
                      % np.uint64(CHAR_BUCKETS)).astype(np.int64)
        self.scale = (1 / np.sqrt(size)).astype(np.float32)[:, None]
        self.size = size
        self.bucket = (w.hash[first] % np.uint64(WORD_BUCKETS)).astype(np.int64)

    def inputs(self, p: dict[str, np.ndarray]) -> np.ndarray:
        """Vector of each distinct word: its trigrams' sum, scaled, next to its own."""
        chars = np.add.reduceat(p["chars"][self.grams], self.begin, axis=0) * self.scale
        return np.concatenate([chars, p["words"][self.bucket]], axis=1)


def window_starts(n: int) -> np.ndarray:
    """Starts of the overlapping windows of a text of n words; every word is in one, the last ends with the text."""
    return np.arange(0, max(n - (WINDOW - STRIDE), min(n, 1)), STRIDE)


def fresh(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    size = CHAR_SIZE + WORD_SIZE
    of = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
    return {"chars": of(0.02, CHAR_BUCKETS, CHAR_SIZE), "words": of(0.02, WORD_BUCKETS, WORD_SIZE),
            "W": of(size ** -0.5, 2, size, 3 * HIDDEN), "U": of(HIDDEN ** -0.5, 2, HIDDEN, 3 * HIDDEN),
            "b": np.zeros((2, 1, 3 * HIDDEN), np.float32), "att": of(0.5, 2 * HIDDEN), "out": of(0.5, 2 * HIDDEN),
            "bias": np.zeros(1, np.float32)}


def _states(p, gates, live, keep: list | None = None):
    """Hidden states (2, T, N, H) of both directions; ``gates`` are the inputs' parts, (2, T, N, 3H)."""
    _, steps, n, _ = gates.shape
    h = np.zeros((2, n, HIDDEN), np.float32)
    out = np.zeros((2, steps, n, HIDDEN), np.float32)
    for t in range(steps):  # direction 1 reads the window from its end
        g = np.stack([gates[0, t], gates[1, steps - 1 - t]])
        m = np.stack([live[t], live[steps - 1 - t]])[:, :, None]
        u = h @ p["U"]
        zr = sigmoid(g[..., :2 * HIDDEN] + u[..., :2 * HIDDEN])
        z, r = zr[..., :HIDDEN], zr[..., HIDDEN:]
        un = u[..., 2 * HIDDEN:]
        c = tanh(g[..., 2 * HIDDEN:] + r * un)
        new = (1 - z) * c + z * h
        if keep is not None:
            keep.append((h, z, r, un, c, m))
        h = np.where(m, new, h)
        out[0, t], out[1, steps - 1 - t] = h[0], h[1]
    return out


def _pool(p, states, live):
    """Attention over the words of each window: joined states, weights, pooled state, score."""
    both = np.concatenate([states[0], states[1]], axis=2)  # T, N, 2H
    e = np.where(live, both @ p["att"], -1e9)
    a = np.exp(e - e.max(0))
    a /= a.sum(0)
    pooled = np.einsum("tn,tnh->nh", a, both)
    return both, a, pooled, pooled @ p["out"] + p["bias"][0]


def _gates(p, vocab_inputs, place):
    """Input parts of the gates for windows of word numbers (T, N), computed once per distinct word."""
    by_word = vocab_inputs @ p["W"] + p["b"]
    return by_word[:, place]


def _final(p: dict, by_word: np.ndarray, place: np.ndarray, live: np.ndarray) -> np.ndarray:
    """Scores of windows of word numbers (T, N): the same as _states and _pool, in buffers that stay in cache."""
    steps, n = place.shape
    states = np.empty((steps, 2, n, HIDDEN), np.float32)
    h, u, g = (np.zeros((2, n, k * HIDDEN), np.float32) for k in (1, 3, 3))
    for t in range(steps):
        back = steps - 1 - t
        np.take(by_word[0], place[t], axis=0, out=g[0])
        np.take(by_word[1], place[back], axis=0, out=g[1])
        np.matmul(h, p["U"], out=u)
        zr, c = g[..., :2 * HIDDEN], g[..., 2 * HIDDEN:]
        zr += u[..., :2 * HIDDEN]
        zr = sigmoid(zr)
        c += zr[..., HIDDEN:] * u[..., 2 * HIDDEN:]
        c = tanh(c)
        new = c + zr[..., :HIDDEN] * (h - c)
        m = live[[t, back]]
        h = new if m.all() else np.where(m[:, :, None], new, h)
        states[t, 0], states[back, 1] = h[0], h[1]
    e = states[:, 0] @ p["att"][:HIDDEN] + states[:, 1] @ p["att"][HIDDEN:]
    e = np.where(live, e, np.float32(-1e9))
    a = np.exp(e - e.max(0))
    value = states[:, 0] @ p["out"][:HIDDEN] + states[:, 1] @ p["out"][HIDDEN:]
    return (a * value).sum(0) / a.sum(0) + p["bias"][0]


def score_windows(p: dict, vocab: Vocabulary, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Score (before the logistic function) of each window, given by its first word and its size."""
    out = np.zeros(len(first), np.float32)
    if not len(first):
        return out
    by_word = vocab.inputs(p) @ p["W"] + p["b"]
    order = np.argsort(size, kind="stable")  # windows of like size together
    for a in range(0, len(first), CHUNK):
        rows = order[a:a + CHUNK]
        steps = np.arange(int(size[rows].max()))[:, None]
        live = steps < size[rows]
        out[rows] = _final(p, by_word, vocab.of[np.where(live, first[rows] + steps, first[rows])], live)
    return out


def gradients(p: dict, vocab: Vocabulary, place: np.ndarray, live: np.ndarray, label: np.ndarray):
    """Gradients of the mean log loss over windows (T, N) with labels, by back-propagation through time."""
    x = vocab.inputs(p)
    keep: list = []
    states = _states(p, _gates(p, x, place), live, keep)
    both, a, pooled, logit = _pool(p, states, live)
    steps, n = live.shape
    d = ((sigmoid(logit) - label) / n).astype(np.float32)
    g = {"out": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
    dpool = d[:, None] * p["out"]
    da = np.einsum("nh,tnh->tn", dpool, both)
    de = a * (da - (a * da).sum(0))
    g["att"] = np.einsum("tn,tnh->h", de, both)
    dboth = a[:, :, None] * dpool + de[:, :, None] * p["att"]
    dstate = np.stack([dboth[..., :HIDDEN], dboth[..., HIDDEN:]])
    dgates = np.zeros((2, steps, n, 3 * HIDDEN), np.float32)
    dh, du = np.zeros((2, n, HIDDEN), np.float32), np.zeros_like(p["U"])
    for t in range(steps - 1, -1, -1):
        h, z, r, un, c, m = keep[t]
        dh = dh + np.stack([dstate[0, t], dstate[1, steps - 1 - t]])
        dn = np.where(m, dh, 0)
        dc = dn * (1 - z) * (1 - c ** 2)
        dz = dn * (h - c) * z * (1 - z)
        dr = dc * un * r * (1 - r)
        dpart = np.concatenate([dz, dr, dc * r], axis=2)
        du += h.transpose(0, 2, 1) @ dpart
        dgate = np.concatenate([dz, dr, dc], axis=2)
        dgates[0, t], dgates[1, steps - 1 - t] = dgate[0], dgate[1]
        dh = np.where(m, dn * z + dpart @ p["U"].transpose(0, 2, 1), dh)
    g["U"] = du
    by_word = np.zeros((2, len(x), 3 * HIDDEN), np.float32)
    np.add.at(by_word, (slice(None), place), dgates)
    g["b"] = by_word.sum(1, keepdims=True)
    g["W"] = x.T @ by_word
    dx = (by_word @ p["W"].transpose(0, 2, 1)).sum(0)
    g["chars"], g["words"] = np.zeros_like(p["chars"]), np.zeros_like(p["words"])
    np.add.at(g["chars"], vocab.grams, np.repeat(dx[:, :CHAR_SIZE] * vocab.scale, vocab.size, axis=0))
    np.add.at(g["words"], vocab.bucket, dx[:, CHAR_SIZE:])
    loss = float(np.mean(np.logaddexp(0, logit) - label * logit))
    return loss, g


def _as_words(texts: list[list[str]]) -> tuple[Words, np.ndarray, np.ndarray]:
    """Words of all windows of all documents, each window's words range start, and its document."""
    flat = [t for ts in texts for t in ts]
    raw = [t.encode() for t in flat]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    w = words(np.frombuffer(b"".join(raw), np.uint8), at, lower=True)
    return w, w.first, np.repeat(np.arange(len(texts)), [len(t) for t in texts])


def train(texts: list[list[str]], labels: list[int], epochs: int = EPOCHS, seed: int = 7) -> dict[str, np.ndarray]:
    """Fit on documents given as window texts. A document is judged by its highest window, so that window learns."""
    p = fresh(seed)
    share = (sum(labels) + 1) / (len(labels) + 2)
    if not 0 < sum(labels) < len(labels):  # nothing to tell apart: the share of the label for every text
        return {k: np.zeros_like(v) for k, v in p.items()} | {"bias": np.array([np.log(share / (1 - share))], np.float32)}
    w, first, doc = _as_words(texts)
    size = np.diff(first)
    use = np.flatnonzero(size > 0)
    vocab = Vocabulary(w)
    y = np.array(labels, np.float32)
    rng = np.random.default_rng(seed)
    adam = Adam(p, RATE)
    epochs = max(epochs, -(-STEPS * BATCH // len(texts)))
    for epoch in range(epochs):
        if epoch:
            value = score_windows(p, vocab, first[:-1][use], size[use])
        else:
            value = rng.standard_normal(len(use))
        order = np.lexsort((value, doc[use]))
        last = np.append(doc[use][order][1:] != doc[use][order][:-1], True)
        chosen = rng.permutation(use[order[last]])
        adam.rate = RATE * (1 - epoch / epochs) + RATE / 10
        for a in range(0, len(chosen), BATCH):
            rows = chosen[a:a + BATCH]
            steps = int(size[rows].max())
            live = np.arange(steps)[:, None] < size[rows]
            at = np.where(live, first[rows] + np.arange(steps)[:, None], first[rows])
            known, place = np.unique(vocab.of[at], return_inverse=True)
            part = _subset(vocab, known)
            _, grads = gradients(p, part, place.reshape(at.shape), live, y[doc[rows]])
            grads["words"] += DECAY * p["words"]
            grads["chars"] += DECAY * p["chars"]
            adam.update(grads)
    return p


def _subset(v: Vocabulary, known: np.ndarray) -> Vocabulary:
    out = Vocabulary.__new__(Vocabulary)
    out.size, out.scale, out.bucket = v.size[known], v.scale[known], v.bucket[known]
    out.begin = np.cumsum(out.size) - out.size
    out.grams = v.grams[np.arange(out.size.sum()) + np.repeat(v.begin[known] - out.begin, out.size)]
    return out


def _sample_windows(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """At most ``most`` windows of each document, spread evenly over the whole text."""
    for batch in batches:
        out = []
        for a, b, raw, at in slices(batch.column(2)):
            w = words(raw, at)
            data = raw.tobytes()
            for lo, hi in zip(w.first[:-1], w.first[1:]):
                starts = window_starts(hi - lo)
                if len(starts) > most:
                    starts = starts[np.linspace(0, len(starts) - 1, most).astype(int)]
                out.append([b" ".join(data[s:e] for s, e in zip(
                    w.start[lo + x:min(lo + x + WINDOW, hi)], w.end[lo + x:min(lo + x + WINDOW, hi)])) for x in starts])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.binary()))],
                                         ["doc_id", "toxic", "windows"])


def held_out(doc_id: Column) -> Column:
    """Rows that training never sees the labels of."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS) -> dict[str, np.ndarray]:
    """Train on at most ``sample_docs`` labelled documents of each class, drawn by a hash of doc_id.

    Of a longer document ``sample_windows`` windows over its whole length are learnt, with their whole words, so what
    reaches the driver does not grow with the corpus. Labels of held-out rows are not read; null labels are ignored; a document labelled both
    ways counts as toxic.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    draw = lambda v: known.where(F.col("toxic") == v).orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(sample_docs)
    rows = docs.join(F.broadcast(draw(0).unionByName(draw(1))), "doc_id").select("doc_id", "toxic", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = rows.withColumn("toxic", F.col("toxic").cast("int")).mapInArrow(
        lambda batches: _sample_windows(batches, sample_windows), f"doc_id {kind}, toxic int, windows array<binary>")
    got = sorted({(r["doc_id"], r["toxic"], tuple(bytes(x) for x in r["windows"])) for r in cut.collect()})
    return train([[x.decode(errors="replace") for x in t] for _, _, t in got], [y for _, y, _ in got])


def _text_scores(p: dict, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, number of windows and start of the highest window of each text of a column."""
    scores, counts, tops = [np.zeros(0)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for a, b, raw, at in slices(column):
        w = words(raw, at, lower=True)
        n = np.diff(w.first)
        starts = [window_starts(int(k)) for k in n]
        of = np.repeat(np.arange(b - a), [len(s) for s in starts])
        start = np.concatenate(starts)
        value = np.full(b - a, p["bias"][0], np.float64)
        top = np.full(b - a, -1, np.int64)
        if len(of):
            one = score_windows(p, Vocabulary(w), w.first[of] + start, np.minimum(WINDOW, n[of] - start)).astype(float)
            order = np.lexsort((-start, one, of))  # highest window, the first of equal ones
            last = order[np.append(of[order][1:] != of[order][:-1], True)]
            value[of[last]], top[of[last]] = one[last], start[last]
        scores.append(sigmoid(value))
        counts.append(np.bincount(of, minlength=b - a))
        tops.append(top)
    return np.concatenate(scores), np.concatenate(counts), np.concatenate(tops)


def _score(model):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, counts, tops = _text_scores(model.value, batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores), pa.array(counts), pa.array(tops)],
                                             ["doc_id", "score", "windows", "top_window"])

    return run


def score(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """Score of every whole text (needs doc_id, text): doc_id, score, windows, top_window.

    All overlapping windows of WINDOW words are scored, a text gets its highest. Null, empty and blank texts
    have no window and get the bias alone. The model is of fixed size and sent to every executor. Repeated
    rows are scored each; an empty table gives no rows; extra columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_score(shared), f"doc_id {kind}, score double, windows long, top_window long")


def keep_clean(docs: DataFrame, model: dict[str, np.ndarray], threshold: float = 0.5) -> DataFrame:
    """The rows, with all their columns, whose text scores below ``threshold``; no row moves.

    Null, empty and blank texts have the score of the bias alone; repeated rows are judged each; an empty table gives no
    rows; extra columns, whatever their names, are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_text_scores(shared.value, batch.column(at))[0] < threshold))

    return docs.mapInArrow(run, docs.schema)
