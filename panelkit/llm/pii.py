"""Personal data: fixed patterns, and a character-level bidirectional LSTM with a CRF that adds spans."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.llm.common import lean, slices
from panelkit.llm.neural import Adam, sigmoid, tanh

KINDS = ("email", "ip", "card", "phone")
#: Fixed patterns. They mean the same as the plain ones but never go back over characters they have passed.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*+")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Characters of a window and between window starts; hidden units of a direction.
WINDOW, STRIDE = 128, 96
HIDDEN = 16
#: The training sample: documents with a digit or @, windows of each.
SAMPLE_DOCS, SAMPLE_WINDOWS = 800, 6
EPOCHS, BATCH, RATE = 12, 64, 0.02
CHUNK = 1024
#: Characters around a word with a digit or @ that belong to its area.
MARGIN = 16

#: Characters with a class of their own; other digits, letters and signs share one each.
_SINGLE = "@.-+() _%:=/,;\"'#\n\t|"
_CLASSES = len(_SINGLE) + 6


def _class_table() -> np.ndarray:
    table = np.full(129, len(_SINGLE) + 5, np.int8)  # 128 stands for all other characters
    for c in range(128):
        ch = chr(c)
        if ch.isdigit():
            table[c] = len(_SINGLE)
        elif ch.islower():
            table[c] = len(_SINGLE) + 1
        elif ch.isupper():
            table[c] = len(_SINGLE) + 2
        else:
            table[c] = len(_SINGLE) + 3
    for i, ch in enumerate(_SINGLE):
        table[ord(ch)] = i
    return table


_TABLE = _class_table()


def classes(text: str) -> np.ndarray:
    """Class of each code point."""
    return _TABLE[np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), 128)]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: the local part is all that may stand before an @, back to the last match."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.fullmatch(text, start - 1, start):
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        free = m.end() if m else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, in order; failing matches are dropped without a retry."""
    out = [(s, 0, e) for s, e in _emails(text)]
    out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(g.lstrip("0")) < 4 and int(g.lstrip("0") or 0) < 256 for g in m.groups())]
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


# ---- the network ---------------------------------------------------------------------------------

def fresh(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    of = lambda scale, *shape: (rng.standard_normal(shape) * scale).astype(np.float32)
    k = len(KINDS) + 1
    p = {"W": of(0.3, 2, _CLASSES, 4 * HIDDEN), "U": of(HIDDEN ** -0.5, 2, HIDDEN, 4 * HIDDEN),
         "out": of(0.3, 2 * HIDDEN, k), "bias": np.zeros(k, np.float32), "trans": np.zeros((k, k), np.float32),
         "first": np.zeros(k, np.float32)}
    p["W"][..., HIDDEN:2 * HIDDEN] += 1  # a forget gate that starts open
    p["bias"][0] = 2
    return p


def _emissions(p, code, live, keep: list | None = None):
    """Hidden states (2, T, N, H) and tag scores (T, N, K) of windows of character classes (T, N)."""
    steps, n = code.shape
    h, c = np.zeros((2, n, HIDDEN), np.float32), np.zeros((2, n, HIDDEN), np.float32)
    states = np.zeros((2, steps, n, HIDDEN), np.float32)
    for t in range(steps):
        back = steps - 1 - t
        g = h @ p["U"]
        g[0] += p["W"][0][code[t]]
        g[1] += p["W"][1][code[back]]
        s = sigmoid(g[..., :3 * HIDDEN])
        i, f, o = s[..., :HIDDEN], s[..., HIDDEN:2 * HIDDEN], s[..., 2 * HIDDEN:]
        a = tanh(g[..., 3 * HIDDEN:])
        after = f * c + i * a
        tc = tanh(after)
        m = live[[t, back]][:, :, None]
        if keep is not None:
            keep.append((h, c, i, f, o, a, tc, m))
        h, c = np.where(m, o * tc, h), np.where(m, after, c)
        states[0, t], states[1, back] = h[0], h[1]
    score = states[0] @ p["out"][:HIDDEN] + states[1] @ p["out"][HIDDEN:] + p["bias"]
    return states, score


def _lse(x, axis):
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + top.squeeze(axis)


def gradients(p, code, live, tags):
    """Loss (negative log likelihood a window) and gradients by forward-backward and back-propagation."""
    keep: list = []
    states, score = _emissions(p, code, live, keep)
    steps, n, k = score.shape
    alpha, beta = np.zeros_like(score), np.zeros_like(score)
    alpha[0] = p["first"] + score[0]
    for t in range(1, steps):
        alpha[t] = np.where(live[t][:, None], _lse(alpha[t - 1][:, :, None] + p["trans"], 1) + score[t], alpha[t - 1])
    for t in range(steps - 2, -1, -1):
        beta[t] = np.where(live[t + 1][:, None], _lse(p["trans"] + (score[t + 1] + beta[t + 1])[:, None, :], 2), beta[t + 1])
    total = _lse(alpha[-1], 1)
    m = live[:, :, None]
    chance = np.where(m, np.exp(alpha + beta - total[None, :, None]), 0)
    one = np.where(m, np.eye(k, dtype=np.float32)[tags], 0)
    dscore = ((chance - one) / n).astype(np.float32)
    both = live[1:] & live[:-1]
    pair = np.exp(alpha[:-1, :, :, None] + p["trans"] + (score[1:] + beta[1:])[:, :, None, :] - total[None, :, None, None])
    dtrans = np.where(both[:, :, None, None], pair, 0).sum((0, 1)) - np.einsum("tnj,tnk->jk", one[:-1] * both[:, :, None], one[1:])
    g = {"trans": (dtrans / n).astype(np.float32), "first": dscore[0].sum(0), "bias": dscore.sum((0, 1))}
    g["out"] = np.concatenate([np.einsum("tnh,tnk->hk", states[d], dscore) for d in (0, 1)])
    dstate = np.stack([dscore @ p["out"][:HIDDEN].T, dscore @ p["out"][HIDDEN:].T])
    dW, dU = np.zeros_like(p["W"]), np.zeros_like(p["U"])
    dh, dc = np.zeros((2, n, HIDDEN), np.float32), np.zeros((2, n, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, a, tc, m = keep[t]
        back = steps - 1 - t
        dh = dh + np.stack([dstate[0, t], dstate[1, back]])
        dn, ds = np.where(m, dh, 0), np.where(m, dc, 0)
        ds = ds + dn * o * (1 - tc ** 2)
        gate = np.concatenate([ds * a * i * (1 - i), ds * c * f * (1 - f), dn * tc * o * (1 - o), ds * i * (1 - a ** 2)], axis=2)
        dU += h.transpose(0, 2, 1) @ gate
        np.add.at(dW[0], code[t], gate[0])
        np.add.at(dW[1], code[back], gate[1])
        dh = np.where(m, gate @ p["U"].transpose(0, 2, 1), dh)
        dc = np.where(m, ds * f, dc)
    g["W"], g["U"] = dW, dU
    gold = (one * score).sum((0, 2)) + p["first"][tags[0]] + (p["trans"][tags[:-1], tags[1:]] * both).sum(0)
    return float((total - gold).mean()), g


def _padded(codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(len(c) for c in codes)
    live = np.arange(steps)[:, None] < np.array([len(c) for c in codes])
    code = np.zeros((steps, len(codes)), np.int64)
    for j, c in enumerate(codes):
        code[:len(c), j] = c
    return code, live


def train(windows: list[tuple[str, list[tuple[int, int, int]]]], epochs: int = EPOCHS, seed: int = 5) -> dict[str, np.ndarray]:
    """Fit on (text, spans) windows. Without any window the model tags nothing."""
    p = fresh(seed)
    if not windows:
        return p | {"out": np.zeros_like(p["out"]), "bias": np.array([9, 0, 0, 0, 0], np.float32)}
    codes, tags = [], []
    for text, spans in windows:
        tag = np.zeros(len(text), np.int64)
        for s, kind, e in spans:
            tag[s:e] = kind + 1
        codes.append(classes(text))
        tags.append(tag)
    rng, adam = np.random.default_rng(seed), Adam(p, RATE)
    for epoch in range(epochs):
        order = rng.permutation(len(codes))
        adam.rate = RATE * (1 - epoch / epochs) + RATE / 20
        for a in range(0, len(order), BATCH):
            rows = order[a:a + BATCH]
            code, live = _padded([codes[i] for i in rows])
            adam.update(gradients(p, code, live, _padded([tags[i] for i in rows])[0])[1])
    return p


def variants(text: str, spans: list[tuple[int, int, int]], rng) -> tuple[str, list[tuple[int, int, int]]]:
    """The same window with spans written as the fixed patterns do not: no plus sign, other separators."""
    out, at, moved = [], 0, []
    for s, kind, e in spans:
        if s < at:
            continue
        part = text[s:e]
        if kind == 3:
            part = part[1:] if rng.random() < 0.5 else re.sub("[ -]+", "/", part[1:])
        elif kind == 2:
            digits = re.sub("[^0-9]", "", part)
            part = rng.choice([".", "/", "  "]).join(digits[i:i + 4] for i in range(0, len(digits), 4))
        elif kind == 1:
            part = part.replace(".", rng.choice([",", " . ", "-"]))
        elif kind == 0:
            part = part.replace("@", rng.choice([" @ ", "@", "(@)"]))
        out += [text[at:s], part]
        start = sum(map(len, out)) - len(part)
        moved.append((start, kind, start + len(part)))
        at = e
    return "".join(out) + text[at:], moved


def _sample_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows of a document around its spans, and windows with digits but no span."""
    for batch in batches:
        out = []
        for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            text, rng = value.as_py(), np.random.default_rng(int(doc) & 0xFFFFFFFF if isinstance(doc, int) else zlib.crc32(str(doc).encode()))
            spans = base_spans(text)
            spots = [s for s, _, _ in spans] or [m.start() for m in re.finditer(r"[0-9@]", text)]
            rows = []
            for i in np.unique(np.linspace(0, len(spots) - 1, min(SAMPLE_WINDOWS, len(spots))).astype(int)):
                a = max(0, spots[i] - int(rng.integers(4, WINDOW - 40)))
                b = min(len(text), a + WINDOW)
                inside = [(max(s, a) - a, k, min(e, b) - a) for s, k, e in spans if s < b and e > a]
                rows.append({"text": text[a:b], "spans": [list(x) for x in inside]})
            out.append(rows)
        kind = pa.list_(pa.struct([("text", pa.string()), ("spans", pa.list_(pa.list_(pa.int64())))]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], ["doc_id", "windows"])


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, seed: int = 5) -> dict[str, np.ndarray]:
    """Train on spans that the fixed patterns label in at most ``sample_docs`` documents, drawn by a hash of doc_id.

    Each window is learnt as it is and once more with its spans written differently. The sample is bounded in
    documents, windows and characters, so what reaches the driver does not grow with the corpus.
    """
    some = docs.where(F.col("doc_id").isNotNull() & F.col("text").rlike("[0-9@]"))
    drawn = some.select("doc_id").orderBy(F.xxhash64("doc_id", F.lit(23)), "doc_id").limit(sample_docs).distinct()
    rows = some.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    kind = docs.schema["doc_id"].dataType.simpleString()
    cut = rows.mapInArrow(_sample_windows, f"doc_id {kind}, windows array<struct<text:string,spans:array<array<bigint>>>>")
    got = sorted((w["text"], [tuple(s) for s in w["spans"]]) for r in cut.collect() for w in r["windows"])
    rng = np.random.default_rng(seed)
    return train(got + [variants(t, s, rng) for t, s in got if s])


# ---- finding -------------------------------------------------------------------------------------

def plausible(kind: int, text: str) -> bool:
    """Whether a span of the network can be what it says; it keeps other numbers alone."""
    digits = re.sub("[^0-9]", "", text)
    if kind == 0:
        return re.fullmatch(r"[^\s@]{1,64}\s?\(?@\)?\s?[^\s@]*[A-Za-z][^\s@]*\.[A-Za-z0-9.-]+", text) is not None
    if kind == 1:
        parts = re.findall("[0-9]+", text)
        return len(parts) == 4 and all(len(x) < 4 and int(x) < 256 for x in parts) and not re.search("[A-Za-z]", text)
    if kind == 2:
        return 12 <= len(digits) <= 19 and luhn(digits) and not re.search("[A-Za-z]", text)
    return 9 <= len(digits) <= 15 and not re.search("[A-Za-z]", text) and len(re.findall("[0-9]+", text)) >= 3


def areas(code: np.ndarray) -> list[tuple[int, int]]:
    """Where personal data can stand: words (no blank inside) with a digit or @, and MARGIN characters around them.

    Every kind of span holds a digit or an @, and what belongs to it but has none (separators, words of a separated address) is near.
    ``code`` has the character classes of a text.
    """
    blank = np.flatnonzero(np.isin(code, [_SINGLE.index(c) for c in " \n\t"]))
    anchors = np.flatnonzero((code == len(_SINGLE)) | (code == 0))
    word = np.unique(np.searchsorted(blank, anchors))
    edges = np.concatenate([[-1], blank, [len(code)]])
    start, end = np.maximum(0, edges[word] + 1 - MARGIN), np.minimum(len(code), edges[word + 1] + MARGIN)
    if not len(word):
        return []
    apart = np.concatenate([[True], start[1:] > np.maximum.accumulate(end)[:-1]])
    first = np.flatnonzero(apart)
    return list(zip(start[first].tolist(), np.maximum.reduceat(end, first).tolist()))


def viterbi(p, score: list[np.ndarray], first: list[bool], last: list[bool]) -> list[np.ndarray]:
    """Best tags of stretches of text from their emissions; a stretch that does not begin or end its text has tag 0 beside it."""
    out: list = [None] * len(score)
    order = sorted(range(len(score)), key=lambda i: len(score[i]))
    for a in range(0, len(order), CHUNK):
        rows = order[a:a + CHUNK]
        size = np.array([len(score[i]) for i in rows])
        steps, n, k = int(size.max()), len(rows), score[rows[0]].shape[1]
        s = np.zeros((steps, n, k), np.float32)
        for j, i in enumerate(rows):
            s[:size[j], j] = score[i]
        best = np.where(np.array([first[i] for i in rows])[:, None], p["first"], p["trans"][0]) + s[0]
        back = np.zeros((steps, n, k), np.int8)
        for t in range(1, steps):
            via = best[:, :, None] + p["trans"]
            live = t < size
            back[t] = np.where(live[:, None], via.argmax(1), np.arange(k))
            best = np.where(live[:, None], via.max(1) + s[t], best)
        best = best + np.where(np.array([last[i] for i in rows])[:, None], 0, p["trans"][:, 0])
        tags = np.zeros((steps, n), np.int8)
        tags[-1] = best.argmax(1)
        for t in range(steps - 1, 0, -1):
            tags[t - 1] = back[t][np.arange(n), tags[t]]
        for j, i in enumerate(rows):
            out[i] = tags[:size[j], j]
    return out


def tag_texts(p, texts: list[str], everywhere: bool = False) -> list[np.ndarray]:
    """Tags of whole texts from overlapping windows, reconciled by one Viterbi pass over each text.

    A character's emissions are the mean of those of all windows it is in. Every window that holds a character of an area
    is run, so inside areas nothing depends on where they are cut; characters outside have tag 0. ``everywhere``
    makes each text one area.
    """
    codes = [classes(t) for t in texts]
    spots = [([(0, len(c))] if len(c) else []) if everywhere else areas(c) for c in codes]
    base = np.concatenate([[0], np.cumsum([len(c) for c in codes])]).astype(np.int64)
    flat = np.concatenate([np.zeros(0, np.int8), *codes])
    wanted = np.zeros(len(flat), bool)
    todo = []
    for i, found in enumerate(spots):
        windows: set[int] = set()
        top = max(0, -(-(len(codes[i]) - WINDOW) // STRIDE))
        for s, e in found:
            wanted[base[i] + s:base[i] + e] = True
            windows.update(range(max(0, (s - WINDOW) // STRIDE + 1), min(top, (e - 1) // STRIDE) + 1))
        todo += [(i, w) for w in sorted(windows)]
    place = np.cumsum(wanted) - 1
    total, times = np.zeros((int(wanted.sum()), len(KINDS) + 1), np.float32), np.zeros(int(wanted.sum()), np.float32)
    for a in range(0, len(todo), CHUNK):
        part = todo[a:a + CHUNK]
        code, live = _padded([codes[i][w * STRIDE:w * STRIDE + WINDOW] for i, w in part])
        _, score = _emissions(p, code, live)
        at = np.array([base[i] + w * STRIDE for i, w in part]) + np.arange(len(live))[:, None]
        use = live & wanted[np.minimum(at, len(flat) - 1)]
        spot = place[at[use]]
        np.add.at(total, spot, score[use])
        np.add.at(times, spot, 1)
    total /= np.maximum(times, 1)[:, None]
    stretches = [(i, s, e) for i, found in enumerate(spots) for s, e in found]
    scores = [total[place[base[i] + s]:place[base[i] + e - 1] + 1] for i, s, e in stretches]
    tags = [np.zeros(len(t), np.int8) for t in texts]
    for (i, s, e), found in zip(stretches, viterbi(p, scores, [s == 0 for _, s, _ in stretches],
                                                  [e == len(texts[i]) for i, _, e in stretches])):
        tags[i][s:e] = found
    return tags


def added_spans(text: str, tags: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of the network that are plausible and touch no fixed span, stripped of blanks and signs at the ends."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], tags, [0]])))
    out = []
    for s, e in zip(edges[:-1].tolist(), edges[1:].tolist()):
        kind = int(tags[s]) - 1
        if kind < 0:
            continue
        while s < e and not (text[s].isalnum() or text[s] in "+("):
            s += 1
        while e > s and not text[e - 1].isalnum():
            e -= 1
        whole = (s == 0 or not text[s - 1].isalnum()) and (e == len(text) or not text[e].isalnum())
        if e > s and whole and not any(a < e and s < b for a, _, b in base) and plausible(kind, text[s:e]):
            out.append((s, kind, e))
    return out


def _listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind; overlapping spans become one."""
    out, at = [], 0
    for s, kind, e in spans:
        if s >= at:
            out += [text[at:s], f"<{KINDS[kind].upper()}>"]
        at = max(at, e)
    return "".join(out) + text[at:]


def _search(p: dict, column: pa.Array) -> Iterator[tuple[int, str, list, list]]:
    """Row, text, fixed spans and all spans of each text of a column that may hold any."""
    having = [np.zeros(0, np.int64)]
    for a, _, raw, at in slices(column):
        hits = np.flatnonzero(((raw >= 48) & (raw <= 57)) | (raw == 64))
        having.append(a + np.flatnonzero(np.diff(np.searchsorted(hits, at)) > 0))
    having = np.concatenate(having)
    for a in range(0, len(having), 64):
        rows = having[a:a + 64].tolist()
        texts = [column[i].as_py() for i in rows]
        for i, text, tags in zip(rows, texts, tag_texts(p, texts)):
            base = base_spans(text)
            yield i, text, base, sorted(base + added_spans(text, tags, base))


def _find(model):
    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            counts = np.zeros((len(KINDS), n), np.int64)
            sha, spans = [hashlib.sha256(b"").hexdigest()] * n, [""] * n
            for i, _, base, whole in _search(model.value, batch.column(1)):
                for _, k, _ in base:
                    counts[k, i] += 1
                sha[i], spans[i] = hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(whole)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, counts), pa.array(sha, pa.string()), pa.array(spans, pa.string())],
                ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return run


def find(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """Personal data in every whole text (needs doc_id, text): counts of the fixed patterns, their digest, all spans.

    Spans count code points and are listed as kind:start:end. Null and empty texts have none. Repeated rows
    are searched each; spans of equal start stand in the order of KINDS. The model is of fixed size and sent
    to every executor. An empty table gives no rows; extra columns are left out.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        _find(shared), f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def mask(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """The rows, with all their columns, and every span in ``text`` replaced by its kind; no row moves.

    Null and empty texts stay as they are, repeated rows are masked each, an empty table gives no rows; extra columns,
    whatever their names, are kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {i: masked(text, whole) for i, text, _, whole in _search(shared.value, batch.column(at)) if whole}
            if found:
                rows = sorted(found)
                mine = np.full(batch.num_rows, -1)
                mine[rows] = np.arange(len(rows))
                both = pa.concat_arrays([batch.column(at).cast(pa.string()), pa.array([found[i] for i in rows], pa.string())])
                new = both.take(pa.array(np.where(mine >= 0, batch.num_rows + mine, np.arange(batch.num_rows))))
                batch = batch.set_column(at, "text", new.cast(batch.column(at).type))
            yield batch

    return docs.mapInArrow(run, docs.schema)
