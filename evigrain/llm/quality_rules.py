"""Quality classifier: a sparse ensemble of rules over text statistics.

Boosted shallow trees are grown on the statistics of labelled documents; every path from a root
becomes a conjunctive rule; a logistic regression with an L1 penalty gives most rules weight 0; what remains is compiled
into one Spark column expression. Scoring is that expression over the statistics.

Learning takes labelled rows whose crc32(doc_id as text) mod 3 is not 1, at most MAX_TRAIN of
them (chosen by a hash of doc_id, a documented bound for the fit; statistics and scores cover every row of whole texts).

Nulls and edges: a null text counts as empty; empty texts have statistics of 0 and are scored
like others; a null doc_id is held out = false and never learned from; null labels are ignored, several labels of one
doc_id count as their largest. Without labels of both kinds every score is the share of label 1 (0.5
if there are none). Repeated rows give repeated rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import base
from .textops import hash_words, string_buffers

#: Rows that the fit may take, about; the hard bound is a twentieth more.
MAX_TRAIN = 20_000
STATS = (
    "log_bytes", "log_words", "mean_word", "upper", "digit", "symbol", "pipe", "exclaim", "punct", "non_ascii", "space",
    "lines_per_word", "mean_line", "ended_lines", "repeated_lines", "distinct_words", "top_word", "top_pair", "longest_word",
)
_CLASS = np.zeros((256, 8), np.float64)
for _j, _chars in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#$%&*@^~+=<>{}[]\\_", b"|", b"!", b".,;:?'\"()-", bytes(range(128, 256)), b" \t\n\r\x0b\x0c")):
    _CLASS[list(_chars), _j] = 1


def statistics(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row of STATS for each text."""
    n = len(offs) - 1
    out = np.zeros((n, len(STATS)))
    words, ptr, starts, ends = hash_words(data, offs, spans=True)
    length = ends - starts
    pairs = words[:-1] * np.uint64(3) + words[1:] if len(words) else words
    for i in range(n):
        a, b = offs[i], offs[i + 1]
        size, w = int(b - a), int(ptr[i + 1] - ptr[i])
        if not size:
            continue
        counts = np.bincount(data[a:b], minlength=256)
        share = counts @ _CLASS / size
        lines = [x for x in data[a:b].tobytes().split(b"\n") if x.strip()]
        row = [np.log1p(size), np.log1p(w), 0, *share, 0, 0, 0, 0, 0, 0, 0, 0]
        if w:
            own = length[ptr[i] : ptr[i + 1]]
            kinds, many = np.unique(words[ptr[i] : ptr[i + 1]], return_counts=True)
            row[2] = own.mean()
            row[11] = len(lines) / w
            row[12] = w / len(lines)
            row[13] = sum(x.rstrip()[-1:] in b".!?" for x in lines) / len(lines)
            row[14] = 1 - len(set(lines)) / len(lines)
            row[15] = len(kinds) / w
            row[16] = many.max() / w
            row[17] = np.unique(pairs[ptr[i] : ptr[i + 1] - 1], return_counts=True)[1].max() / (w - 1) if w > 1 else 0
            row[18] = np.log1p(own.max())
        out[i] = row
    return out


def _measure(batches):
    for b in batches:
        m = statistics(*string_buffers(b.column(1)))
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(m[:, j]) for j in range(m.shape[1]))], names=["doc_id", *STATS])


def with_statistics(docs: DataFrame) -> DataFrame:
    return base.pick(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_measure, "doc_id long, " + ", ".join(f"{s} double" for s in STATS))


def _tree(x: np.ndarray, cuts: list[np.ndarray], codes: np.ndarray, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int, path: tuple, paths: list, step: np.ndarray, least: int) -> None:
    """Grow a regression tree on binned statistics; add the path of each node below the root to paths and the leaf values to step."""
    g, h = grad[rows].sum(), hess[rows].sum()
    if path:
        paths.append(path)
    best = (1e-6, None, None)
    if depth and len(rows) >= 2 * least:
        for j in range(x.shape[1]):
            m = len(cuts[j]) + 1
            if m == 1:
                continue
            c = codes[rows, j]
            gl, hl, nl = (np.cumsum(np.bincount(c, w, m))[:-1] for w in (grad[rows], hess[rows], np.ones(len(rows))))
            gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
            gain[(nl < least) | (len(rows) - nl < least)] = 0
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], j, k)
    if best[1] is None:
        step[rows] = -g / (h + 1)
        return
    _, j, k = best
    low = codes[rows, j] <= k
    for side, some in (("<=", rows[low]), (">", rows[~low])):
        _tree(x, cuts, codes, grad, hess, some, depth - 1, (*path, (j, side, float(cuts[j][k]))), paths, step, least)


def grow_rules(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2, seed: int = 1) -> list[tuple]:
    """Distinct conjunctive rules from the paths of boosted trees."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0.02, 0.98, 48))) for j in range(x.shape[1])]
    codes = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    f, paths = np.zeros(len(y)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        rows = np.flatnonzero(rng.random(len(y)) < 0.7)
        if len(rows) < 10:
            rows = np.arange(len(y))
        step = np.zeros(len(y))
        own: list[tuple] = []
        _tree(x, cuts, codes, p - y, p * (1 - p), rows, depth, (), own, step, max(5, len(y) // 500))
        f += rate * step
        paths += own
    seen: dict[frozenset, tuple] = {}
    for path in paths:
        tight: dict[tuple, float] = {}
        for j, side, at in path:
            tight[j, side] = min(at, tight.get((j, side), at)) if side == "<=" else max(at, tight.get((j, side), at))
        rule = tuple(sorted((j, side, at) for (j, side), at in tight.items()))
        seen.setdefault(frozenset(rule), rule)
    return list(seen.values())


def fires(rule: tuple, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), bool)
    for j, side, at in rule:
        out &= x[:, j] <= at if side == "<=" else x[:, j] > at
    return out


def fit_lasso(r: np.ndarray, y: np.ndarray, penalty: float = 1.5e-3, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Weights and intercept of a logistic regression with an L1 penalty on the weights, by accelerated proximal gradients."""
    n, m = r.shape
    one = np.hstack([r, np.ones((n, 1), r.dtype)]).astype(np.float32)
    v = np.ones(m + 1, np.float32)
    for _ in range(30):
        v = one.T @ (one @ v)
        v /= np.linalg.norm(v) + 1e-12
    rate = 4 * n / (float(np.linalg.norm(one @ v)) ** 2 + 1e-9)
    w = z = np.zeros(m + 1, np.float32)
    t = 1.0
    for _ in range(rounds):
        g = one.T @ (1 / (1 + np.exp(-(one @ z))) - y).astype(np.float32) / n
        nxt = z - rate * g
        nxt[:m] = np.sign(nxt[:m]) * np.maximum(np.abs(nxt[:m]) - rate * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        z = (nxt + np.float32((t - 1) / t2) * (nxt - w)).astype(np.float32)
        w, t = nxt.astype(np.float32), t2
    return w[:m].astype(np.float64), float(w[m])


def fit(x: np.ndarray, y: np.ndarray) -> tuple[list[tuple], list[float], float]:
    """(rules, weights, intercept), rules of weight 0 left out."""
    if not len(y) or y.min() == y.max():
        p = np.clip(y.mean() if len(y) else 0.5, 1e-6, 1 - 1e-6)
        return [], [], float(np.log(p / (1 - p)))
    rules = grow_rules(x, y)
    if not rules:
        return [], [], float(np.log(y.mean() / (1 - y.mean())))
    w, bias = fit_lasso(np.stack([fires(r, x) for r in rules], axis=1).astype(np.float32), y)
    some = np.flatnonzero(np.abs(w) > 1e-6)
    return [rules[i] for i in some], [float(w[i]) for i in some], bias


def compile_rules(rules: list[tuple], weights: list[float], bias: float) -> Column:
    """The probability as one column expression over the statistics."""
    total = F.lit(bias)
    for rule, weight in zip(rules, weights, strict=True):
        cond = F.lit(True)
        for j, side, at in rule:
            cond = cond & (F.col(STATS[j]) <= at if side == "<=" else F.col(STATS[j]) > at)
        total = total + F.when(cond, F.lit(weight)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-total))


def held_out(mod: int, rest: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % mod == rest, F.lit(False))


def training_rows(found: DataFrame, labels: DataFrame, label: str, mod: int, rest: int, learn_equal: bool, most: int) -> DataFrame:
    """Rows of found with a 0/1 label y, of the part that may be learned from, thinned by a hash of doc_id to about `most`."""
    own = base.pick(labels, ["doc_id", label]).where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull())
    own = own.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    part = held_out(mod, rest)
    own = own.where(part if learn_equal else ~part)
    n = own.count()
    slot = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("train")), F.lit(1_000_000))
    own = own.where(slot < min(1_000_000, int(1e6 * most / max(1, n)))).withColumnRenamed("doc_id", "labelled")
    return found.join(own, F.col("doc_id") == F.col("labelled")).drop("labelled")


def _fitted(found: DataFrame, labels: DataFrame, max_train: int) -> tuple[list[tuple], Column]:
    train = training_rows(found, labels, "quality", 3, 1, False, max_train).limit(max_train + max_train // 20).toPandas().sort_values(["doc_id", *STATS])
    rules, weights, bias = fit(train[list(STATS)].to_numpy(np.float64).reshape(-1, len(STATS)), train["y"].to_numpy(np.float64))
    return rules, compile_rules(rules, weights, bias)


def quality_scores(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_rules) of every row of docs (doc_id, text); labels: (doc_id, quality)."""
    base.tune(docs.sparkSession)
    found, _ = base.stored(with_statistics(docs), "statistics")
    rules, score = _fitted(found, labels, max_train)
    out = found.select("doc_id", held_out(3, 1).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumn("n_rules", F.lit(len(rules)))


def good_documents(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """The rows of docs that the rules accept, all columns kept; texts are measured where they lie."""
    base.tune(docs.sparkSession)
    found, _ = base.stored(with_statistics(docs), "statistics")
    _, score = _fitted(found, labels, max_train)
    wide = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    text = f"c{docs.columns.index('text')}"
    full = base.beside(wide, [text], lambda t: [pa.array(c) for c in statistics(*string_buffers(t)).T], ", ".join(f"{s} double" for s in STATS))
    return full.where(score >= 0.5).select(*wide.columns).toDF(*docs.columns)
