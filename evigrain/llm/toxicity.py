"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained here in numpy.

Words are runs of letters, digits and non-ASCII characters, lower-cased in ASCII. Each enters as an own vector (words
frequent in the training sample; others share one) beside the mean of the vectors of its hashed
character trigrams and the vector of its first four bytes, hashed. Two gated recurrent layers read a window of WINDOW words forwards and
backwards, attention pools their states, and a logistic unit scores the window. Windows overlap by
WINDOW - STRIDE words and cover the whole of every text; a document's score is its highest
window's, calibrated on the training documents.

Only documents carry labels, so training alternates: the top windows of toxic documents are
positives; top and random windows of clean documents are negatives.

Learning takes labelled rows whose crc32(doc_id as text) mod 5 is not 0, at most some MAX_TRAIN
documents and MAX_BYTES of text (a documented bound for the fit, chosen by a hash of doc_id).

Nulls and edges: a null text counts as empty; a text without words is one window of padding and
scored like others; a null doc_id is held out = false and never learned from; null labels are ignored, several labels
of one doc_id count as their largest. Without labels of both kinds every score is the share of label 1 (0
if there are none). Repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base
from .quality_rules import held_out, training_rows
from .textops import U64, hash_words, lower_ascii, mix, string_buffers

MAX_TRAIN, MAX_BYTES = 4000, 12_000_000
WINDOW, STRIDE = 24, 16
WORD_DIM, CHAR_DIM, HEAD_DIM, HIDDEN, ATTENTION = 8, 8, 4, 8, 8
VOCABULARY, TRIGRAMS, HEADS = 4096, 4096, 16384
_SEPARATES = np.arange(256, dtype=np.uint8)
_SEPARATES[[c for c in range(128) if not chr(c).isalnum()]] = 32
F32 = np.float32


def words_of(data: np.ndarray, offs: np.ndarray):
    """(distinct word hashes, slots of their heads, their trigram slots, where each word's begin, word index of every position, ptr)."""
    clean = lower_ascii(_SEPARATES[data])
    h, ptr, s, e = hash_words(clean, offs, lower=False, spans=True)
    kinds, first, where = np.unique(h, return_index=True, return_inverse=True)
    length = (e - s)[first]
    size = length + 2
    total = int(size.sum())
    begin = np.cumsum(size) - size
    marked = np.full(total + 2, 1, np.uint32)  # each word between two marks
    inside = np.arange(int(length.sum())) + np.repeat(2 * np.arange(len(first)) + 1, length)
    marked[inside] = clean[np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length) + np.repeat(s[first], length)]
    tri = marked[:-2] * np.uint32(0x01000193) ^ marked[1:-1] * np.uint32(0x9E3779B1) ^ marked[2:] * np.uint32(0x85EBCA6B)
    tri = ((tri ^ (tri >> np.uint32(15))) * np.uint32(0x2C1B3C6D)) >> np.uint32(20)
    keep = np.arange(int(length.sum())) + np.repeat(2 * np.arange(len(first)), length)
    head = np.zeros(len(first), np.uint32)
    for j in range(4):
        head = head * np.uint32(0x01000193) + np.where(length > j, clean[np.minimum(s[first] + j, max(0, len(clean) - 1))], 0).astype(np.uint32) if len(first) else head
    head = ((head ^ (head >> np.uint32(15))) * np.uint32(0x9E3779B1)) >> np.uint32(18)
    return kinds, (head % HEADS).astype(np.int32), (tri[keep] % TRIGRAMS).astype(np.int32), np.cumsum(length) - length, where.reshape(-1).astype(np.int32), ptr


def windows_of(ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start of each overlapping window, and the text it belongs to; a text has one at least, and its last word is in its last."""
    n = np.diff(ptr)
    many = np.maximum(1, 1 + -(-(n - WINDOW) // STRIDE))
    doc = np.repeat(np.arange(len(n)), many)
    k = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    return ptr[:-1][doc] + k * STRIDE, doc


def new_model(vocabulary: np.ndarray, seed: int = 7) -> dict:
    r = np.random.default_rng(seed)
    d, h = WORD_DIM + CHAR_DIM + HEAD_DIM, HIDDEN
    init = lambda *s: (r.normal(0, 1 / np.sqrt(s[0]), s)).astype(F32)
    m = {"words": (r.normal(0, 0.1, (len(vocabulary) + 1, WORD_DIM))).astype(F32), "chars": (r.normal(0, 0.1, (TRIGRAMS, CHAR_DIM))).astype(F32), "heads": np.zeros((HEADS, HEAD_DIM), F32)}
    for side in "fb":
        m |= {f"w{side}": init(d, 3 * h), f"u{side}": init(h, 3 * h), f"c{side}": np.zeros(3 * h, F32)}
    return m | {"wa": init(2 * h, ATTENTION), "va": init(ATTENTION, 1)[:, 0], "wo": init(2 * h, 1)[:, 0], "bo": np.zeros(1, F32)}


def sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + F32(0.5)


def inputs(m: dict, vocabulary: np.ndarray, kinds: np.ndarray, head: np.ndarray, tri: np.ndarray, begin: np.ndarray):
    """Input vector of each distinct word, and its row of the word table."""
    row = np.searchsorted(vocabulary, kinds)
    row[row == len(vocabulary)] = 0
    row = np.where(vocabulary[row] == kinds, row, len(vocabulary)) if len(vocabulary) else np.zeros(len(kinds), np.int64)
    count = np.diff(np.append(begin, len(tri)))
    char = np.add.reduceat(m["chars"][tri], begin, axis=0) / count[:, None].astype(F32) if len(kinds) else np.empty((0, CHAR_DIM), F32)
    return np.hstack([m["words"][row], char, m["heads"][head]]).astype(F32), row, count


def _scan(p, u, live, back: bool, keep: bool):
    """States of one direction: p[word] are projected inputs, live is (T, B). With keep also what the gradient needs."""
    t_, b = live.shape
    h = np.zeros((b, HIDDEN), F32)
    states, saved = np.empty((t_, b, HIDDEN), F32), []
    for t in range(t_ - 1, -1, -1) if back else range(t_):
        x = p(t)
        a = h @ u[:, : 2 * HIDDEN]
        a += x[:, : 2 * HIDDEN]
        zr = sigmoid(a)
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        rh = r * h
        n = np.tanh(rh @ u[:, 2 * HIDDEN :] + x[:, 2 * HIDDEN :])
        new = n + z * (h - n)
        new = h + live[t][:, None] * (new - h)
        if keep:
            saved.append((t, h, z, r, n))
        h = new
        states[t] = h
    return states, saved


def forward(m: dict, vecs: np.ndarray, idx: np.ndarray, live: np.ndarray, keep: bool = False):
    """Logit of each window. idx: (B, T) rows of vecs, live: (B, T) 1 where there is a word."""
    it, lt = idx.T, np.ascontiguousarray(live.T)
    proj = [vecs @ m[f"w{s}"] + m[f"c{s}"] for s in "fb"]
    f, sf = _scan(lambda t: proj[0][it[t]], m["uf"], lt, False, keep)
    b, sb = _scan(lambda t: proj[1][it[t]], m["ub"], lt, True, keep)
    states = np.concatenate([f, b], axis=2)
    g = np.tanh(states @ m["wa"])
    s = g @ m["va"] - 30 * (1 - lt)
    s -= s.max(axis=0)
    a = np.exp(s)
    a /= a.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", a, states)
    logit = pooled @ m["wo"] + m["bo"]
    return (logit, (it, lt, states, g, a, pooled, sf, sb)) if keep else logit


def _unscan(m, side, saved, grad, lt, it, vecs, gw, gvec):
    u = m[f"u{side}"]
    gu, dh = np.zeros_like(u), np.zeros_like(grad[0])
    gx = np.empty((*lt.shape, 3 * HIDDEN), F32)
    for t, h, z, r, n in reversed(saved):
        dh = dh + grad[t]
        dnew = dh * lt[t][:, None]
        dz, dn = dnew * (h - n) * z * (1 - z), dnew * (1 - z) * (1 - n * n)
        drh = dn @ u[:, 2 * HIDDEN :].T
        dr = drh * h * r * (1 - r)
        gu[:, 2 * HIDDEN :] += (r * h).T @ dn
        dzr = np.hstack([dz, dr])
        gu[:, : 2 * HIDDEN] += h.T @ dzr
        gx[t, :, : 2 * HIDDEN], gx[t, :, 2 * HIDDEN :] = dzr, dn
        dh = dh * (1 - lt[t][:, None]) + dnew * z + drh * r + dzr @ u[:, : 2 * HIDDEN].T
    at = it.ravel()
    order = np.argsort(at, kind="stable")
    ends = np.flatnonzero(np.diff(at[order], prepend=-1))
    gp = np.zeros((len(vecs), 3 * HIDDEN), F32)
    gp[at[order][ends]] = np.add.reduceat(gx.reshape(-1, 3 * HIDDEN)[order], ends, axis=0)
    gw[f"u{side}"] = gu
    gw[f"w{side}"] = vecs.T @ gp
    gw[f"c{side}"] = gp.sum(axis=0)
    gvec += gp @ m[f"w{side}"].T


def gradients(m: dict, vecs: np.ndarray, idx: np.ndarray, live: np.ndarray, y: np.ndarray, weight: np.ndarray):
    logit, (it, lt, states, g, a, pooled, sf, sb) = forward(m, vecs, idx, live, True)
    p = sigmoid(logit)
    d = ((p - y) * weight / len(y)).astype(F32)
    gw = {"wo": pooled.T @ d, "bo": d.sum(keepdims=True)}
    dp = d[:, None] * m["wo"]
    da = np.einsum("bh,tbh->tb", dp, states)
    ds = a * (da - (a * da).sum(axis=0))
    dg = ds[:, :, None] * m["va"] * (1 - g * g)
    gw["va"] = np.einsum("tb,tba->a", ds, g)
    gw["wa"] = np.einsum("tbh,tba->ha", states, dg)
    dstates = a[:, :, None] * dp + dg @ m["wa"].T
    gvec = np.zeros_like(vecs)
    _unscan(m, "f", sf, dstates[:, :, :HIDDEN], lt, it, vecs, gw, gvec)
    _unscan(m, "b", sb, dstates[:, :, HIDDEN:], lt, it, vecs, gw, gvec)
    return gw, gvec, p


def _windows(where, ptr, start, doc):
    """(idx, live) of the windows at start."""
    at = start[:, None] + np.arange(WINDOW)
    live = at < ptr[1:][doc][:, None]
    idx = where[np.minimum(at, max(0, len(where) - 1))] if len(where) else np.zeros(at.shape, np.int32)
    return np.where(live, idx, 0), live.astype(F32)


def logits(m: dict, vecs: np.ndarray, where: np.ndarray, ptr: np.ndarray, start: np.ndarray, doc: np.ndarray, chunk: int = 2048) -> np.ndarray:
    if not len(vecs):
        vecs = np.zeros((1, WORD_DIM + CHAR_DIM + HEAD_DIM), F32)
    out = np.empty(len(start), F32)
    for i in range(0, len(start), chunk):
        out[i : i + chunk] = forward(m, vecs, *_windows(where, ptr, start[i : i + chunk], doc[i : i + chunk]))
    return out


def top_of(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """The first place of the highest value of each text."""
    order = np.lexsort((np.arange(len(values)), -values, doc))
    return order[np.searchsorted(doc[order], np.arange(n))]


def train(data: np.ndarray, offs: np.ndarray, y: np.ndarray, rounds: int = 4, seed: int = 7) -> dict:
    """A model with its vocabulary and calibration."""
    n = len(offs) - 1
    if not n or y.min() == y.max():
        return {"constant": float(y.mean()) if n else 0.0}
    kinds, head, tri, begin, where, ptr = words_of(data, offs)
    start, doc = windows_of(ptr)
    owner = np.repeat(np.arange(n), np.diff(ptr))
    seen = np.unique(owner.astype(np.int64) * len(kinds) + where) if len(kinds) else np.empty(0, np.int64)
    df = np.bincount(seen % max(1, len(kinds)), minlength=len(kinds))
    pos = np.bincount(seen % max(1, len(kinds)), weights=y[seen // max(1, len(kinds))], minlength=len(kinds))
    often = np.flatnonzero(df >= max(4, n // 400))
    often = often[np.lexsort((often, -df[often]))][:VOCABULARY]
    often.sort()
    vocabulary = kinds[often]
    m = new_model(vocabulary, seed)
    share = y.mean()
    odds = lambda df, pos: np.log((pos + 6 * share) / (df - pos + 6 * (1 - share))) - np.log(share / (1 - share))
    m["words"][:-1, 0] = odds(df, pos)[often]  # the first input of words and heads starts as their log odds
    m["words"][-1, 0] = 0
    both = np.unique(owner.astype(np.int64) * HEADS + head[where]) if len(kinds) else np.empty(0, np.int64)
    del seen, owner
    m["heads"][:, 0] = odds(np.bincount(both % HEADS, minlength=HEADS), np.bincount(both % HEADS, weights=y[both // HEADS], minlength=HEADS))
    hint = m["heads"][head, 0] if len(kinds) else np.zeros(0, F32)
    hint[often] += m["words"][:-1, 0]
    sums = np.concatenate([[0], np.cumsum(np.maximum(hint, 0)[where], dtype=np.float64)])
    values = (sums[np.minimum(start + WINDOW, ptr[1:][doc])] - sums[start]).astype(F32)
    del both, sums
    rng = np.random.default_rng(seed)
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.items()}
    steps = 0
    yd = y.astype(F32)
    for r in range(rounds):
        if r:
            vecs, _, _ = inputs(m, vocabulary, kinds, head, tri, begin)
            values = logits(m, vecs, where, ptr, start, doc)
        top = top_of(values, doc, n)
        clean = np.flatnonzero(yd[doc] == 0)
        extra = rng.choice(clean, min(len(clean), n), replace=False)
        chosen = np.concatenate([top, extra])
        target, rate = yd[doc[chosen]], (0.01, 0.01, 0.006, 0.004, 0.002)[min(r, 4)]
        size = int(np.clip(len(chosen) // 16, 16, 256))
        for _ in range(max(2, 48 * size // len(chosen))):
            order = rng.permutation(len(chosen))
            for i in range(0, len(order), size):
                sel = chosen[order[i : i + size]]
                idx, live = _windows(where, ptr, start[sel], doc[sel])
                idx, live = np.vstack([idx, idx[:2]]), np.vstack([live, 0 * live[:2]])  # two windows without words are clean
                used, at = np.unique(idx, return_inverse=True)
                slots = [np.arange(begin[k], begin[k + 1] if k + 1 < len(begin) else len(tri)) for k in used] if len(kinds) else []
                t = tri[np.concatenate(slots)] if slots else np.empty(0, np.int32)
                b = np.cumsum([0, *map(len, slots)])[:-1] if slots else np.empty(0, np.int64)
                vecs, row, count = inputs(m, vocabulary, kinds[used], head[used], t, b)
                gw, gvec, _ = gradients(m, vecs, at.reshape(idx.shape), live, np.append(target[order[i : i + size]], [0, 0]).astype(F32)[: len(idx)], np.append(np.ones(len(sel), F32), [6, 6]).astype(F32)[: len(idx)])
                gw |= {k: np.zeros_like(m[k]) for k in ("words", "chars", "heads")}
                np.add.at(gw["words"], row, gvec[:, :WORD_DIM])
                np.add.at(gw["chars"], t, np.repeat(gvec[:, WORD_DIM : WORD_DIM + CHAR_DIM] / count[:, None], count, axis=0))
                np.add.at(gw["heads"], head[used], gvec[:, WORD_DIM + CHAR_DIM :])
                steps += 1
                for k, g in gw.items():
                    g = np.clip(g, -1, 1) + (1e-5 * m[k] if k in ("chars", "words", "heads") else 0)
                    s1, s2 = state[k]
                    s1 += 0.1 * (g - s1)
                    s2 += 0.01 * (g * g - s2)
                    m[k] -= (rate * (s1 / (1 - 0.9**steps)) / (np.sqrt(s2 / (1 - 0.99**steps)) + 1e-7)).astype(F32)
    vecs, _, _ = inputs(m, vocabulary, kinds, head, tri, begin)
    values = logits(m, vecs, where, ptr, start, doc)
    best = values[top_of(values, doc, n)].astype(np.float64)
    scale, shift = 1.0, 0.0
    for _ in range(50):  # Newton steps of a logistic regression on the highest logit, with a small ridge
        p = 1 / (1 + np.exp(-np.clip(scale * best + shift, -30, 30)))
        q = np.maximum(p * (1 - p), 1e-9)
        h11, h12, h22 = (q * best * best).sum() + 0.1, (q * best).sum(), q.sum() + 0.01
        g1, g2 = ((p - y) * best).sum() + 0.1 * (scale - 1), (p - y).sum() + 0.01 * shift
        det = h11 * h22 - h12 * h12
        d1, d2 = (h22 * g1 - h12 * g2) / det, (h11 * g2 - h12 * g1) / det
        scale, shift = scale - np.clip(d1, -0.5, 0.5), shift - np.clip(d2, -2, 2)
    return {"model": m, "vocabulary": vocabulary, "scale": float(scale), "shift": float(shift)}


def score(fitted: dict, data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Probability of label 1 for each text."""
    n = len(offs) - 1
    if "constant" in fitted:
        return np.full(n, fitted["constant"])
    kinds, head, tri, begin, where, ptr = words_of(data, offs)
    start, doc = windows_of(ptr)
    vecs, _, _ = inputs(fitted["model"], fitted["vocabulary"], kinds, head, tri, begin)
    values = logits(fitted["model"], vecs, where, ptr, start, doc)
    best = np.maximum.reduceat(values, np.searchsorted(doc, np.arange(n))).astype(np.float64) if n else np.empty(0)
    return 1 / (1 + np.exp(-np.clip(fitted["scale"] * best + fitted["shift"], -30, 30)))


def _pieces(offs: np.ndarray, most: int = 2_000_000):
    """Runs of texts of some two million bytes."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, side="right")) - 1)
        yield i, j
        i = j


def _probabilities(fitted: dict, col: pa.Array) -> pa.Array:
    data, offs = string_buffers(col)
    got = [score(fitted, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]) for i, j in _pieces(offs)]
    return pa.array(np.concatenate(got) if got else np.empty(0))


def _fitted(docs: DataFrame, labels: DataFrame, max_train: int) -> dict:
    docs = base.pick(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    base.sweep(docs.sparkSession, 0)
    sample = training_rows(docs, labels, "toxic", 5, 0, False, max_train).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "y")
    sample = sample.where(F.octet_length("text") <= MAX_BYTES // 40).limit(max_train + max_train // 20).toPandas().sort_values(["doc_id", "text"])
    sample = sample[sample["text"].str.len().cumsum() <= MAX_BYTES]
    data, offs = string_buffers(pa.array(sample["text"], pa.string()))
    y = sample["y"].to_numpy(np.float64)
    del sample
    fitted = train(data, offs, y)
    del data, offs
    base.sweep(docs.sparkSession, 0)
    return fitted


def toxicity_scores(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs (doc_id, text); labels: (doc_id, toxic)."""
    base.tune(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(_fitted(docs, labels, max_train))
    docs = base.pick(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = base.beside(docs, ["text"], lambda t: [_probabilities(model.value, t)], "score double")
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of docs that score below 0.5, all columns kept; texts are scored where they lie."""
    base.tune(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(_fitted(docs, labels, max_train))
    wide = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    scored = base.beside(wide, [f"c{docs.columns.index('text')}"], lambda t: [_probabilities(model.value, t)], "score double")
    return scored.where("score < 0.5").select(*wide.columns).toDF(*docs.columns)
