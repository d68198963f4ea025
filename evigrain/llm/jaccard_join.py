"""N-gram Jaccard join: a size-aware heavy-light join over sets of word shingles.

Two documents link when 100 * |A & B| >= percent * |A | B|. Every document gets the size of its
set and the smallest doc_id reachable by links. Sets are told apart by 128 bits, shingles by 64.

* Documents with the same set are one node from the start, so copies are never paired.
* Sets of at most `boundary` shingles are small: each lists the hashes of its subsets of the
  overlap size that a partner needs, for each partner size it can have, below its own and above. Two small
  sets that link share a subset of the size that the two need.
* Larger sets are found by inverted lists over their rarest shingles. A set of n shingles posts
  its first n - ceil(t n) + 1 in one order of all shingles, by frequency level, then by hash; two
  sets that link meet in the list of their first common shingle, at places that leave room
  for the overlap they need. Small sets that can link to a larger one post too.
* `boundary` is the largest size at which listing subsets costs no more than scanning lists.

Frequency levels come from a count sketch over all shingles of all documents (fixed size).
A candidate pair is first held against an upper bound of its overlap, from the counts of each set
over SIGNATURE hash ranges, and only then against the sets themselves.

In each list only the member with the fewest rarer shingles (the hub) is compared with the others; what is then
in one component needs no more pairs. Members outside the hub's component are compared with
every member of another component, so no link between components is lost, whatever the group.

Nulls and empties: a null or empty text, or one of blanks, has an empty set and links to
nothing (component_id is its own doc_id). A null doc_id forms its own node by its text but never names a component. Repeated
rows give repeated rows. Ties have no effect: components do not depend on order. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import base, buckets
from .textops import U64, mix, shingle_sets, string_buffers

#: Hash ranges over which a set's members are counted, for an upper bound of overlaps.
SIGNATURE = 256
#: Least and most bits of the filter that says whose sets a comparison needs, and bits for each of them.
FILTER_BITS, MOST_BITS, BITS_EACH = 1 << 16, 1 << 27, 16
#: Largest size for which subsets are ever listed.
MOST_SMALL = 40


def need(n: int, m: int, percent: int) -> int:
    """Smallest overlap of sets of n and m members that links them."""
    return -(-percent * (n + m) // (100 + percent))


def subset_sizes(n: int, percent: int) -> list[int]:
    """Overlaps that a set of n members needs, over the sizes of all partners, smaller and larger, that it can link to."""
    return sorted({need(n, m, percent) for m in range(-(-percent * n // 100), 100 * n // percent + 1)})


def subset_cost(n: int, percent: int) -> int:
    """Subsets that a set of n members lists, over the sizes of its partners."""
    return sum(comb(n, c) for c in subset_sizes(n, percent))


def pick_boundary(list_length: float, percent: int) -> int:
    """Largest size whose subsets cost no more than its lists, of list_length members each."""
    best = 0
    for n in range(1, MOST_SMALL + 1):
        prefix = n - -(-percent * n // 100) + 1
        if subset_cost(n, percent) > prefix * (1 + list_length):
            break
        best = n
    return best


def _text_and_id(docs: DataFrame) -> DataFrame:
    return base.pick(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def _fingerprints(s: np.ndarray) -> tuple[int, int]:
    with np.errstate(over="ignore"):
        a = int(mix(s + U64(len(s))).sum(dtype=U64)) if len(s) else 0
        b = int(np.bitwise_xor.reduce(mix(s * U64(0xD6E8FEB86659FD93) + U64(7)))) if len(s) else 0
    return a, b


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _signature(s: np.ndarray) -> bytes:
    counts = np.bincount((s >> U64(56)).astype(np.int64), minlength=SIGNATURE)
    return counts.astype(np.uint8 if counts.max() < 256 else np.uint32).tobytes()


def _counts(blob) -> np.ndarray:
    return np.frombuffer(blob, np.uint8 if len(blob) == SIGNATURE else np.uint32).astype(np.int64)


def _census(k: int):
    """Of each document its set's size and fingerprints; at the end of a task its share of the sketch."""
    schema = "kind int, doc_id long, fp long, fp2 long, n long, blob binary"

    def run(batches):
        sketch = buckets.Sketch()
        for b in batches:
            sets = shingle_sets(*string_buffers(b.column(1)), k)
            for s in sets:
                sketch.add(s)
            fps = [_fingerprints(s) for s in sets]
            m = len(sets)
            yield pa.RecordBatch.from_arrays(
                [pa.array([0] * m, pa.int32()), b.column(0), pa.array([_signed(a) for a, _ in fps], pa.int64()), pa.array([_signed(a) for _, a in fps], pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([_signature(s) for s in sets], pa.binary())],
                names=["kind", "doc_id", "fp", "fp2", "n", "blob"],
            )
        some, salt, blobs = sketch.blocks()
        if some:
            m = len(blobs)
            yield pa.RecordBatch.from_arrays(
                [pa.array([1] * m, pa.int32()), pa.array(some, pa.int64()), pa.array([salt] * m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.array(blobs, pa.binary())],
                names=["kind", "doc_id", "fp", "fp2", "n", "blob"],
            )

    return run, schema


def _postings(k: int, percent: int, boundary: int, level):
    schema = "token long, doc_id long, n int, pos int"

    def run(batches):
        lv = np.frombuffer(zlib.decompress(level.value), np.uint8)
        for b in batches:
            ids = b.column(0).to_numpy()
            token, who, n_, pos = [], [], [], []
            for i, s in enumerate(shingle_sets(*string_buffers(b.column(1)), k)):
                n = len(s)
                if not n:
                    continue
                if n <= boundary:
                    keys = []
                    with np.errstate(over="ignore"):
                        for c in subset_sizes(n, percent):
                            idx = np.array(list(combinations(range(n), c)))
                            keys.append(mix(mix(s)[idx].sum(axis=1, dtype=U64) * U64(2 * c + 1) + U64(c)))
                    keys = np.unique(np.concatenate(keys))
                    places = np.zeros(len(keys), np.int32)
                else:
                    keys, places = np.empty(0, U64), np.empty(0, np.int32)
                if 100 * n // percent > boundary:
                    rare = buckets.prefix(s, lv, percent)
                    keys = np.concatenate([keys, rare])
                    places = np.concatenate([places, np.arange(len(rare), dtype=np.int32)])
                token.append(keys)
                pos.append(places)
                who.append(np.full(len(keys), ids[i], np.int64))
                n_.append(np.full(len(keys), n, np.int32))
            if token:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in ([t.view(np.int64) for t in token], who, n_, pos)], names=["token", "doc_id", "n", "pos"])

    return run, schema


def _chosen(k: int, bits):
    """The sets of the documents whose doc_id the filter may hold."""
    schema = "doc_id long, own long, own2 long, shingles binary"

    def run(batches):
        flags = np.frombuffer(zlib.decompress(bits.value), np.uint64)
        for b in batches:
            slot = b.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            keep = (flags[slot >> 6] >> (slot & 63).astype(U64)) & U64(1) > 0
            b = b.filter(pa.array(keep))
            if b.num_rows:
                sets = shingle_sets(*string_buffers(b.column(1)), k)
                fps = [_fingerprints(s) for s in sets]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([_signed(x) for x, _ in fps], pa.int64()), pa.array([_signed(y) for _, y in fps], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc_id", "own", "own2", "shingles"])

    return run, schema


def _bound(batches):
    for b in batches:
        left, right = b.column(2), b.column(3)
        most = [int(np.minimum(_counts(left[i].as_py()), _counts(right[i].as_py())).sum()) for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(most, pa.int64()), b.column(4)], names=["a", "b", "inter", "total"])


def _overlap(batches):
    for b in batches:
        left, right = b.column(2), b.column(3)
        size = [len(np.intersect1d(np.frombuffer(left[i].as_buffer(), U64), np.frombuffer(right[i].as_buffer(), U64), assume_unique=True)) for i in range(b.num_rows)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(size, pa.int64()), b.column(4)], names=["a", "b", "inter", "total"])


def _enough(pairs: DataFrame, sets: DataFrame, what: str, measure, percent: int) -> DataFrame:
    """The pairs (a, b) for which measure, over the column `what` of sets (fp, n, what), still reaches the overlap needed."""
    one = pairs.join(sets.select(F.col("fp").alias("a"), F.col(what).alias("left"), F.col("n").alias("na")), "a")
    two = one.join(sets.select(F.col("fp").alias("b"), F.col(what).alias("right"), F.col("n").alias("nb")), "b")
    found = two.select("a", "b", "left", "right", (F.col("na") + F.col("nb")).alias("total")).mapInArrow(measure, "a long, b long, inter long, total long")
    return found.where(F.col("inter") * (100 + percent) >= F.col("total") * percent).select("a", "b")


def flags_of(wanted: DataFrame, name: str):
    """(bits, broadcast): a bit map of the hashes of the ids in wanted, sized by their number up to MOST_BITS."""
    bits = FILTER_BITS
    n = wanted.count()
    while bits < min(MOST_BITS, BITS_EACH * n):
        bits *= 2
    words = wanted.select(F.pmod(F.xxhash64(name), F.lit(bits)).alias("h")).groupBy(F.shiftright("h", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(h & 63 as int)))").alias("v"))
    flags = np.zeros(bits // 64, np.int64)
    got = words.toArrow()  # at most MOST_BITS / 64 rows, whatever the input
    flags[got["w"].to_numpy()] = got["v"].to_numpy()
    return bits, wanted.sparkSession.sparkContext.broadcast(zlib.compress(flags.tobytes(), 1))


def _verify(docs: DataFrame, reps: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Of pairs (a, b) of representatives' ids, those that link."""
    spark = docs.sparkSession
    pairs, pairs_path = base.stored(_enough(pairs, reps, "signature", _bound, percent), "likely")
    base.sweep(spark)
    wanted = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()
    wanted, wanted_path = base.stored(wanted.join(reps, wanted["rep"] == reps["fp"]).select("fp", "doc", "one", "two", "n"), "wanted")
    bits, flags = flags_of(wanted, "doc")
    run, schema = _chosen(k, flags)
    sets = docs.where("doc_id is not null").select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(bits)).alias("slot")).mapInArrow(run, schema)
    # a doc_id that is not unique may bring other texts: each set must have the fingerprints it is to stand for
    sets = wanted.join(sets, (wanted["doc"] == sets["doc_id"]) & (wanted["one"] == sets["own"]) & (wanted["two"] == sets["own2"])).select("fp", "n", "shingles").dropDuplicates(["fp"])
    sets, sets_path = base.stored(sets, "sets")
    links, _ = base.stored(_enough(pairs, sets, "shingles", _overlap, percent), "links")
    for path in (pairs_path, wanted_path, sets_path):
        base.drop_path(spark, path)
    base.sweep(spark)
    return links


def jaccard_groups(docs: DataFrame, k: int = 4, percent: int = 85) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text)."""
    spark = docs.sparkSession
    base.tune(spark)
    docs = _text_and_id(docs)
    run, schema = _census(k)
    found, found_path = base.stored(docs.mapInArrow(run, schema), "census")
    level, load = buckets.levels(found.where("kind = 1").select(F.col("doc_id").alias("block"), F.col("fp").alias("salt"), "blob"))
    boundary = pick_boundary(load, percent)
    mine, mine_path = base.stored(found.where("kind = 0").select("doc_id", "fp", "fp2", "n"), "own")
    # a set is named by its smallest doc_id; sets that share it, as doc_ids may repeat, get a hash beside it
    unique = found.where("kind = 0 and n > 0 and doc_id is not null")
    each = unique.groupBy("fp", "fp2").agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("blob").alias("signature"))
    first = F.row_number().over(Window.partitionBy("doc").orderBy("fp", "fp2")) == 1
    each = each.withColumn("node", F.when(first, F.col("doc")).otherwise(F.xxhash64("doc", "fp", "fp2")))
    reps, reps_path = base.stored(each.select(F.col("node").alias("fp"), "doc", F.col("fp").alias("one"), F.col("fp2").alias("two"), "n", "signature"), "reps")
    base.drop_path(spark, found_path)
    base.sweep(spark)
    run, schema = _postings(k, percent, boundary, spark.sparkContext.broadcast(level))
    rows, rows_path = base.stored(docs.where("doc_id is not null").mapInArrow(run, schema), "postings")
    parts = buckets.shared_lists(rows, "doc_id")
    base.drop_path(spark, rows_path)
    named, named_path = base.stored(mine.where("n > 0 and doc_id is not null").join(reps.select(F.col("fp").alias("node"), "one", "two"), (F.col("fp") == F.col("one")) & (F.col("fp2") == F.col("two"))).select(F.col("doc_id").alias("d"), "node", F.col("n").alias("size")).distinct(), "named")
    lists, lists_path = base.stored(buckets.union(parts).join(named, (F.col("doc_id") == F.col("d")) & (F.col("n") == F.col("size"))).select("token", F.col("node").alias("fp"), "n", "pos").distinct(), "lists")
    for _, path in parts:
        base.drop_path(spark, path)
    base.sweep(spark)
    comp = base.components(buckets.resolve(lists, percent, lambda pairs: _verify(docs, reps, pairs, k, percent)))
    base.drop_path(spark, lists_path)
    whole = mine.join(reps.select(F.col("fp").alias("node"), "one", "two"), (F.col("fp") == F.col("one")) & (F.col("fp2") == F.col("two")), "left")
    whole = whole.join(comp.withColumnRenamed("node", "x"), F.col("node") == F.col("x"), "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("c"))
    whole, _ = base.stored(whole, "classes")
    for path in (mine_path, reps_path, named_path):
        base.drop_path(spark, path)
    # stored, so that the join on a large component can be split
    first, _ = base.stored(whole.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("first")).withColumnRenamed("c", "g"), "first")
    return whole.join(first, F.col("c") == F.col("g"), "left").select("doc_id", "n_shingles", F.coalesce("first", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of docs whose document is the smallest of its component, all columns kept; of rows with one doc_id one stays."""
    groups, _ = base.stored(jaccard_groups(docs, k, percent), "groups")
    keep = groups.where("doc_id = component_id").select(F.col("doc_id").alias("kept_id"))
    wide = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    key = F.col(f"c{docs.columns.index('doc_id')}")
    out = wide.join(keep, key.cast("long") == F.col("kept_id"), "left_semi")
    if keep.groupBy("kept_id").count().where("count > 1").limit(1).count():
        out = out.dropDuplicates([f"c{docs.columns.index('doc_id')}"])
    return out.unionByName(wide.where(key.isNull())).toDF(*docs.columns)
