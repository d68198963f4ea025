"""Embedding near-dedup: cross-polytope hashing after fast Hadamard rotations, with multiprobe buckets.

Vectors are scaled to length 1. A hash takes three rounds of random signs and a fast Hadamard
transform and names the coordinate of largest absolute value with its sign. A table's key joins
HASHES such names; a vector stands in its own bucket and in PROBES more, named by the runner-up
coordinates that come closest. Pairs that share a bucket in any of TABLES tables are verified by
their cosine in double precision; only those of at least `threshold` link.

A bucket is split into blocks of about BLOCK vectors, dealt by a hash, and pairs of blocks are compared
by matrix products, so no bucket meets in one task and no pair is emitted: a pair of blocks yields for each vector its
count of links and its component within the two blocks. A pair that shares more buckets counts in the first of them only.

Nulls and edges: vectors that are null, empty, zero or hold null or non-finite components link with nothing
(n_links 0, component_id the own vec_id); so do vectors of another length than the most common one. A null vec_id is not compared. Repeated
rows with one vec_id count as one vector (of the smallest hash) and each gives a row. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import base

TABLES, HASHES, PROBES, BLOCK = 6, 2, 3, 512


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows; their length is a power of 2."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


def keys_of(x: np.ndarray, tables: int = TABLES, seed: int = 11) -> np.ndarray:
    """(n, tables, 1 + PROBES) bucket keys of rows of length 1: the own bucket first."""
    n, dim = x.shape
    d = 1 << max(1, (dim - 1).bit_length())
    wide = np.zeros((n, d))
    wide[:, :dim] = x
    rng = np.random.default_rng(seed)
    out = np.empty((n, tables, 1 + PROBES), np.int64)
    for t in range(tables):
        best, gap, names = [], [], []
        for _ in range(HASHES):
            y = wide
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], d))
            top = np.argpartition(-np.abs(y), min(PROBES, d - 1), axis=1)[:, : PROBES + 1]
            size = np.take_along_axis(np.abs(y), top, axis=1)
            order = np.lexsort((top, -size), axis=1)
            top, size = np.take_along_axis(top, order, axis=1), np.take_along_axis(size, order, axis=1)
            names.append(2 * top + (np.take_along_axis(y, top, axis=1) < 0))
            best.append(names[-1][:, 0])
            gap.append(size[:, :1] - size[:, 1:])
        own = np.zeros(n, np.int64)
        for b in best:
            own = own * (2 * d) + b
        out[:, t, 0] = own
        # a probe changes one of the names to a runner-up; the smallest losses come first
        loss = np.concatenate(gap, axis=1)
        pick = np.argsort(loss, axis=1, kind="stable")[:, :PROBES]
        for p in range(PROBES):
            h, r = pick[:, p] // gap[0].shape[1], pick[:, p] % gap[0].shape[1]
            key = np.zeros(n, np.int64)
            for j in range(HASHES):
                key = key * (2 * d) + np.where(h == j, np.take_along_axis(names[j], (r + 1)[:, None], axis=1)[:, 0], best[j])
            out[:, t, 1 + p] = key
        out[:, t] += t << 48
    return out


def unit_rows(col: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors, which rows they are): rows that are null, zero, of another length or hold null or non-finite components are left out."""
    good, rows = [], []
    for i, v in enumerate(col.to_pylist()):
        if v is not None and len(v) == dim and not any(c is None for c in v):
            rows.append(v)
            good.append(i)
    x = np.array(rows, np.float64).reshape(len(rows), dim)
    with np.errstate(all="ignore"):
        top = np.abs(x).max(axis=1, initial=0)
        ok = np.isfinite(x).all(axis=1) & (top > 0)
        x = x[ok] / top[ok][:, None]  # first by the largest component, so that squares neither overflow nor vanish
        x /= np.linalg.norm(x, axis=1)[:, None]
    return x, np.array(good, np.int64)[ok] if len(good) else np.empty(0, np.int64)


def _hashed(dim: int):
    schema = "vec_id long, vec binary, keys array<long>"

    def run(batches):
        for b in batches:
            x, at = unit_rows(b.column(1), dim)
            keys = keys_of(x).reshape(len(x), -1) if len(x) else np.empty((0, 0), np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), pa.array([v.tobytes() for v in x], pa.binary()), pa.array(list(keys), pa.list_(pa.int64()))], names=["vec_id", "vec", "keys"])

    return run, schema


def _spread(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest label over links (i, j), carried on until nothing changes."""
    while True:
        low = np.minimum(labels[i], labels[j])
        new = labels.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        if (new == labels).all():
            return labels
        labels = new


def _pairs_within(group: np.ndarray, some: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows of the same group; groups are runs."""
    size = np.diff(np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group)))
    begin = np.cumsum(size) - size
    at, room = np.arange(len(group)) - np.repeat(begin, size), np.repeat(size, size)
    one, two = [], []
    for d in range(1, min(some, int(size.max(initial=1)))):  # small groups: all rows that have a d-th next one
        i = np.flatnonzero((room <= some) & (at + d < room))
        one.append(i)
        two.append(i + d)
    for k in np.flatnonzero(size > some):
        i, j = np.triu_indices(size[k], 1)
        one.append(i + begin[k])
        two.append(j + begin[k])
    return (np.concatenate(one), np.concatenate(two)) if one else (np.empty(0, np.int64), np.empty(0, np.int64))


def _links(ids, x, keys, key, block, between, group, threshold):
    """Counts and components of the vectors linked inside the given groups."""
    i, j = _pairs_within(group)
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), 100_000):
        p, q = i[at : at + 100_000], j[at : at + 100_000]
        keep[at : at + 100_000] = (~between[p] | (block[p] != block[q])) & (np.einsum("ij,ij->i", x[p], x[q]) >= threshold)
    i, j = i[keep], j[keep]
    first = np.ones(len(i), bool)
    width = 1 + PROBES
    for t in range(keys.shape[1] // width):  # a pair counts in the smallest bucket that holds both
        one, two = keys[i, t * width : (t + 1) * width], keys[j, t * width : (t + 1) * width]
        for c in range(width):
            first &= ~((one[:, c : c + 1] == two).any(axis=1) & (one[:, c] < key[i]))
    i, j = i[first], j[first]
    kinds, where = np.unique(ids, return_inverse=True)
    i, j = where[i], where[j]
    n = np.bincount(i, minlength=len(kinds)) + np.bincount(j, minlength=len(kinds))
    low = kinds[_spread(np.arange(len(kinds)), i, j)]
    some = n > 0
    return kinds[some], n[some], low[some]


def _compare(threshold: float):
    """Links within blocks and between them, over rows sorted by (key, one, two)."""
    schema = "vec_id long, n long, low long"

    def some(table: pa.Table):
        key, one, two = (table[c].to_numpy() for c in ("key", "one", "two"))
        x = np.frombuffer(b"".join(table["vec"].to_pylist())).reshape(len(key), -1)
        keys = np.array(table["keys"].to_pylist(), np.int64)
        edge = np.ones(len(key), bool)
        edge[1:] = (key[1:] != key[:-1]) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        got = _links(table["vec_id"].to_numpy(), x, keys, key, table["block"].to_numpy(), one != two, np.cumsum(edge), threshold)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in got], names=["vec_id", "n", "low"])

    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            t = pa.concat_tables([held, t]) if held is not None else t
            key, one, two = (t[c].to_numpy() for c in ("key", "one", "two"))
            last = np.flatnonzero((key != key[-1]) | (one != one[-1]) | (two != two[-1])) if len(key) else []
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut >= 4096:
                yield some(t.slice(0, cut))
                t = t.slice(cut)
            held = t
        if held is not None and held.num_rows:
            yield some(held)

    return run, schema


def near_vectors(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of vectors (vec_id, embedding)."""
    base.tune(vectors.sparkSession)
    every = base.pick(vectors, ["vec_id", "embedding"]).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    sizes = every.where("size(embedding) > 0").groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dim = sizes[0]["d"] if sizes else 1
    run, schema = _hashed(dim)
    found = every.where("vec_id is not null").mapInArrow(run, schema)
    own, _ = base.stored(found, "vectors")
    twice = own.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.hash("vec")).alias("h")).where("n > 1")
    if twice.limit(1).count():
        own = own.join(twice.withColumnRenamed("vec_id", "v"), F.col("vec_id") == F.col("v"), "left").where("h is null or hash(vec) = h").select("vec_id", "vec", "keys").dropDuplicates(["vec_id"])
        own, _ = base.stored(own, "vectors")
    member = own.select("vec_id", F.explode(F.array_distinct("keys")).alias("key"))
    load = member.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("key").alias("k"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    member = member.join(load, F.col("key") == F.col("k")).select("vec_id", "key", "blocks", F.pmod(F.xxhash64("vec_id", "key"), F.col("blocks")).cast("int").alias("block"))
    member = member.select("vec_id", "key", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    member = member.select("vec_id", "key", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))
    full = member.join(own.withColumnRenamed("vec_id", "v"), F.col("vec_id") == F.col("v")).select("vec_id", "key", "block", "one", "two", "vec", "keys")
    run, schema = _compare(threshold)
    full = full.repartition("key", "one", "two").sortWithinPartitions("key", "one", "two", "vec_id")
    found, _ = base.stored(full.mapInArrow(run, schema), "found")
    counts = found.groupBy(F.col("vec_id").alias("v")).agg(F.sum("n").alias("n"))
    comp = base.components(found.select(F.col("vec_id").alias("a"), F.col("low").alias("b")))
    out = every.select("vec_id").join(counts, F.col("vec_id") == F.col("v"), "left").join(comp, F.col("vec_id") == F.col("node"), "left")
    out = out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
