"""Approximate nearest neighbours by additive quantisation, then exact reranking.

A vector is coded as a sum of CODEBOOKS codewords, each of full dimension, one of each codebook. Codebooks are
fitted one after the other to what the earlier ones leave over, on a bounded sample; codes are found by beam
search, which keeps BEAM partial sums a vector. The index holds every vector's codes, and its norm
beside its code's norm; what is coded is the vector's direction, so components of any size are coded alike.
A query builds a table of inner products with all codewords; a vector's
score is the sum of its codes' entries, scaled by its stored norms. The best SHORTLIST of each block of the index
are rescored with the original vectors in double precision. The index holds each distinct vector once, with its k + 1
smallest vec_ids, which is all that any query can return; they come out after rescoring, so copies never crowd the shortlist.

Queries are taken in groups of some QUERY_GROUP, which bounds what is broadcast, GROUPS_AT_ONCE of them in jobs that run side by side; each group meets every block
of the index, and a block sends back its best k alone. Every distinct vector is indexed; nothing is capped but the shortlist, whose recall tests measure.

Nulls and edges: vectors that are null, zero or hold null or non-finite components take no part, nor does a null
vec_id or a vector of another length than the most common one. Ties go to the smaller vec_id. Of repeated rows with one vec_id one counts: the smallest by
a hash of its components. A query with fewer candidates than k gets them all. An empty table gives no rows.
Other columns are ignored.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import base

CODEBOOKS, WORDS, BEAM, SAMPLE = 12, 256, 4, 16_384
SHORTLIST, QUERY_GROUP, BLOCK, GROUPS_AT_ONCE = 400, 16_384, 8192, 4


def fit_codebooks(x: np.ndarray, m: int = CODEBOOKS, k: int = WORDS, rounds: int = 8, seed: int = 3) -> np.ndarray:
    """(m, k, dim) codebooks by k-means on the residuals of the ones before."""
    rng = np.random.default_rng(seed)
    r, books = x.astype(np.float32), []
    for _ in range(m):
        c = r[rng.choice(len(r), k, replace=len(r) < k)].copy() if len(r) else np.zeros((k, x.shape[1]), np.float32)
        for _ in range(rounds):
            at = (r @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
            n = np.bincount(at, minlength=k)
            total = np.zeros_like(c)
            np.add.at(total, at, r)
            some = n > 0
            c[some] = total[some] / n[some][:, None]
            if (~some).any() and len(r):
                c[~some] = r[rng.choice(len(r), int((~some).sum()))]
        at = (r @ c.T - 0.5 * (c * c).sum(axis=1)).argmax(axis=1)
        r = r - c[at]
        books.append(c)
    return np.stack(books)


def encode(x: np.ndarray, books: np.ndarray, beam: int = BEAM) -> np.ndarray:
    """(n, m) codes by beam search: each step adds the codeword that leaves least, for the best partial sums."""
    m, k, d = books.shape
    flat = books.reshape(m * k, d)
    cross = flat @ flat.T
    norms = np.diag(cross)
    out = np.empty((len(x), m), np.uint8 if k <= 256 else np.uint16)
    for at in range(0, len(x), 1024):
        some = x[at : at + 1024].astype(np.float32)
        n = len(some)
        dots = some @ flat.T
        cost = np.zeros((n, 1), np.float32)
        codes = np.zeros((n, 1, 0), np.int64)
        for j in range(m):
            words = slice(j * k, (j + 1) * k)
            step = norms[words] - 2 * dots[:, None, words]
            new = cost[:, :, None] + step
            for i in range(j):
                new = new + 2 * cross[codes[:, :, i] + i * k][:, :, words]
            b = new.shape[1]
            keep = min(beam, b * k)
            pick = np.argpartition(new.reshape(n, -1), keep - 1, axis=1)[:, :keep]
            cost = np.take_along_axis(new.reshape(n, -1), pick, axis=1)
            codes = np.concatenate([np.take_along_axis(codes, (pick // k)[:, :, None].repeat(j, axis=2), axis=1), (pick % k)[:, :, None]], axis=2)
        out[at : at + n] = np.take_along_axis(codes, cost.argmin(axis=1)[:, None, None].repeat(m, axis=2), axis=1)[:, 0]
    return out


def decode(codes: np.ndarray, books: np.ndarray) -> np.ndarray:
    return sum(books[j][codes[:, j]] for j in range(len(books)))


def directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors, norms) of rows that are not zero, also where squares of components overflow or vanish."""
    most = np.abs(x).max(axis=1, initial=0.0, keepdims=True)
    y = x / np.where(most > 0, most, 1.0)
    norm = np.linalg.norm(y, axis=1, keepdims=True)
    with np.errstate(over="ignore"):
        return y / np.where(norm > 0, norm, 1.0), (norm * most)[:, 0]


def _as_matrix(blobs) -> np.ndarray:
    rows = blobs.to_pylist()
    return np.frombuffer(b"".join(rows)).reshape(len(rows), -1)


def _index(books):
    schema = "ids array<long>, vec binary, codes binary, scale double"

    def run(batches):
        for b in batches:
            x = _as_matrix(b.column(1))
            unit, norm = directions(x)
            codes = encode(unit, books.value)
            got = np.linalg.norm(decode(codes, books.value), axis=1)
            scale = np.where(got > 0, norm / np.maximum(got, 1e-30), 1.0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(scale)], names=["ids", "vec", "codes", "scale"])

    return run, schema


def _search(queries, books, k: int, shortlist: int):
    schema = "query_id long, vec_id long, score double"

    def block(ids, many, x, codes, scale):
        first = np.cumsum(many) - many
        qid, q = queries.value
        c, toward = books.value, directions(q)[0]
        for at in range(0, len(qid), 64):
            some = q[at : at + 64]
            table = np.einsum("qd,mkd->mqk", toward[at : at + 64].astype(np.float32), c, optimize=True)
            score = np.zeros((len(some), len(x)), np.float32)
            for j in range(len(c)):
                score += table[j][:, codes[:, j]]
            with np.errstate(over="ignore"):
                score = score * scale
            n = min(shortlist, len(x))
            near = np.argpartition(-score, n - 1, axis=1)[:, :n]
            rows = []
            for i in range(len(some)):
                some_of = many[near[i]]
                with np.errstate(over="ignore", invalid="ignore"):
                    exact = np.repeat((x[near[i]] * some[i]).sum(axis=1), some_of)
                own = ids[np.arange(len(exact)) + np.repeat(first[near[i]] - (np.cumsum(some_of) - some_of), some_of)]
                other = own != qid[at + i]
                own, exact = own[other], exact[other]
                best = np.lexsort((own, -exact))[:k]
                rows.append((np.full(len(best), qid[at + i]), own[best], exact[best]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c_)) for c_ in zip(*rows, strict=True)], names=["query_id", "vec_id", "score"])

    def run(batches):
        held, n = [], 0
        for b in batches:
            held.append(b)
            n += b.num_rows
            if n >= BLOCK:
                yield from _blocks(held, block, len(books.value))
                held, n = [], 0
        if n:
            yield from _blocks(held, block, len(books.value))

    return run, schema


def _blocks(held, block, m):
    t = pa.Table.from_batches(held)
    codes = np.frombuffer(b"".join(t["codes"].to_pylist()), np.uint8).reshape(-1, m)
    ids = t["ids"].combine_chunks()
    yield from block(ids.flatten().to_numpy(), ids.value_lengths().to_numpy().astype(np.int64), _as_matrix(t["vec"]), codes, t["scale"].to_numpy())


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(vec_id, vec) of the vectors that take part, as doubles in bytes, one for each vec_id; and their length."""
    every = base.pick(vectors, ["vec_id", "embedding"]).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
    good = every.where(F.col("vec_id").isNotNull() & F.forall("e", finite) & F.exists("e", lambda c: c != 0))
    sizes = good.groupBy(F.size("e").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dim = sizes[0]["d"] if sizes else 1

    def run(batches):
        for b in batches:
            e = b.column(1)
            x = e.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1) + 0.0  # no negative zeros: equal vectors have equal bytes
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([v.tobytes() for v in x], pa.binary())], names=["vec_id", "vec"])

    out = good.where(F.size("e") == dim).mapInArrow(run, "vec_id long, vec binary")
    out, _ = base.stored(out, "vectors")
    if out.groupBy("vec_id").count().where("count > 1").limit(1).count():
        out, _ = base.stored(out.groupBy("vec_id").agg(F.min_by("vec", F.struct(F.xxhash64("vec"), F.hash("vec"))).alias("vec")), "vectors")
    return out, dim


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, shortlist: int = SHORTLIST) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found for each query among all other rows."""
    spark = vectors.sparkSession
    base.tune(spark)
    found, dim = usable(vectors)
    n = found.count()
    slot = F.pmod(F.xxhash64("vec_id", F.lit("fit")), F.lit(1_000_000))
    sample = found.where(slot < min(1_000_000, int(1e6 * SAMPLE / max(1, n)))).orderBy(F.xxhash64("vec_id")).limit(SAMPLE)
    sample = [np.frombuffer(r["vec"]) for r in sample.select("vec").collect()]  # SAMPLE vectors at most
    books = spark.sparkContext.broadcast(fit_codebooks(directions(np.array(sample).reshape(len(sample), dim))[0]))
    run, schema = _index(books)
    parts = max(1, -(-n // BLOCK))
    copy = F.row_number().over(Window.partitionBy("vec").orderBy("vec_id"))
    one_each = found.withColumn("copy", copy).where(F.col("copy") <= k + 1).groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select("ids", "vec")
    index, _ = base.stored(one_each.mapInArrow(run, schema).repartition(parts), "index")
    asked, _ = base.stored(found.where(is_query), "asked")
    groups = max(1, -(-asked.count() // QUERY_GROUP))

    def answer(g: int) -> DataFrame:
        rows = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == g).collect()  # some QUERY_GROUP queries
        q = spark.sparkContext.broadcast((np.array([r["vec_id"] for r in rows], np.int64), np.array([np.frombuffer(r["vec"]) for r in rows]).reshape(len(rows), dim)))
        run, schema = _search(q, books, k, shortlist)
        out, _ = base.stored(index.mapInArrow(run, schema), "near")
        q.unpersist()
        return out

    with ThreadPoolExecutor(min(GROUPS_AT_ONCE, groups)) as pool:
        results = list(pool.map(answer, range(groups)))
    best = results[0]
    for r in results[1:]:
        best = best.unionByName(r)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
