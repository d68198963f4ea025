"""Links among the members of shared lists, without pairing all members of a list."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import base
from .textops import U64

#: Lists before this one, in a member's order, that are looked at to see whether a pair met there already.
LOOK_BACK = 12
#: Counters of the frequency sketch, and the blocks in which they are summed.
WIDTH, BLOCKS = 1 << 22, 64
#: Hash classes that are looked at in turn, at most, and rows of one: this bounds the shuffle files on disk.
PASSES, PASS_ROWS = 2, 5_000_000


class Sketch:
    """One task's counts of hashes by slot, sent as compressed blocks of (kind, block, salt, blob)."""

    def __init__(self):
        self.counts = np.zeros(WIDTH, np.uint32)

    def add(self, s: np.ndarray) -> None:
        self.counts[(s & U64(WIDTH - 1)).astype(np.int64)] += 1  # a set has few equal slots; those count once

    def blocks(self) -> tuple[list[int], int, list[bytes]]:
        step = WIDTH // BLOCKS
        some = [i for i in range(BLOCKS) if self.counts[i * step : (i + 1) * step].any()]
        return some, int(self.counts.sum()) % 64, [zlib.compress(self.counts[i * step : (i + 1) * step].tobytes(), 1) for i in some]


def _merge(pdf):
    total = sum(np.frombuffer(zlib.decompress(x), np.uint32).astype(np.int64) for x in pdf["blob"])
    return pdf.iloc[:1].assign(blob=[zlib.compress(np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes(), 1)])[["block", "salt", "blob"]]


def levels(part: DataFrame) -> tuple[bytes, float]:
    """Of blocks (block, salt, blob): the frequency level of each slot, compressed, 0 for the usual load, and the mean length of a level-0 list."""
    part = part.groupBy("block", "salt").applyInPandas(_merge, "block long, salt long, blob binary")
    part = part.withColumn("salt", F.lit(0).cast("long")).groupBy("block", "salt").applyInPandas(_merge, "block long, salt long, blob binary")
    counts = np.zeros(WIDTH, np.uint32)
    step = WIDTH // BLOCKS
    for r in part.select("block", "blob").collect():  # at most BLOCKS rows, WIDTH counters in all
        counts[r["block"] * step : (r["block"] + 1) * step] = np.frombuffer(zlib.decompress(r["blob"]), np.uint32)
    usual = 4 * counts.mean() + 16
    level = np.clip(np.floor(np.log2(np.maximum(counts, 1) / usual)) + 1, 0, 15).astype(np.uint8)
    low = counts[level == 0].astype(np.float64)
    return zlib.compress(level.tobytes(), 1), float(low.sum() / max(1, np.count_nonzero(low)))


def prefix(s: np.ndarray, level: np.ndarray, percent: int) -> np.ndarray:
    """The rarest members of a set, by level, then hash: two sets that link share one of these."""
    n = len(s)
    return s[np.argsort(level[(s & U64(WIDTH - 1)).astype(np.int64)], kind="stable")[: n - -(-percent * n // 100) + 1]]


#: Columns of a 256-bit map of a set's members; a bit that only one of two sets has stands for a member that only one has.
BITS = ("b0", "b1", "b2", "b3")


def bit_maps(sets: list[np.ndarray]) -> np.ndarray:
    """(len(sets), 4) words of the sets' bit maps."""
    out = np.zeros((len(sets), 256), np.uint8)
    for i, s in enumerate(sets):
        out[i, (s >> U64(40)).astype(np.int64) & 255] = 1
    return np.packbits(out, axis=1, bitorder="little").view(np.int64)


def _sketch_sets(batches):
    sketch = Sketch()
    for b in batches:
        for x in b.column(0):
            sketch.add(np.frombuffer(x.as_buffer(), U64))
    some, salt, blobs = sketch.blocks()
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([salt] * len(some), pa.int64()), pa.array(blobs, pa.binary())], names=["block", "salt", "blob"])


def prefix_lists(sets: DataFrame, percent: int) -> DataFrame:
    """(token, fp, n, pos, bit map) of the prefixes of sets (fp, n, shingles), in the order of frequencies among these sets."""
    packed, _ = levels(sets.select("shingles").mapInArrow(_sketch_sets, "block long, salt long, blob binary"))
    level = sets.sparkSession.sparkContext.broadcast(packed)

    def run(batches):
        lv = np.frombuffer(zlib.decompress(level.value), np.uint8)
        for b in batches:
            own = [np.frombuffer(x.as_buffer(), U64) for x in b.column(2)]
            keys = [prefix(s, lv, percent) for s in own]
            many = [len(k) for k in keys]
            maps = np.repeat(bit_maps(own), many, axis=0)
            token = np.concatenate([*keys, np.empty(0, U64)]).view(np.int64)
            pos = np.concatenate([*(np.arange(m, dtype=np.int32) for m in many), np.empty(0, np.int32)])
            yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(np.repeat(b.column(0).to_numpy(), many)), pa.array(np.repeat(b.column(1).to_numpy(), many).astype(np.int32)), pa.array(pos), *(pa.array(maps[:, j].copy()) for j in range(len(BITS)))], names=["token", "fp", "n", "pos", *BITS])

    return sets.select("fp", "n", "shingles").mapInArrow(run, "token long, fp long, n int, pos int, b0 long, b1 long, b2 long, b3 long")


def passes(rows: int) -> int:
    """Hash classes in which to look at so many rows."""
    return max(1, min(PASSES, -(-rows // PASS_ROWS)))


def shared_lists(rows: DataFrame, member: str = "fp") -> list[DataFrame]:
    """The rows whose token more than one member has, by hash class of the token, each stored; rows must be a stored table."""
    found, many = [], passes(rows.count())
    for p in range(many):
        part = rows.where(F.pmod("token", F.lit(many)) == p)
        # stored before the join, so that a long list is counted by parts and its join can be split
        shared, path = base.stored(part.groupBy("token").agg(F.min(member).alias("lo"), F.max(member).alias("hi")).where("lo <> hi").select("token"), "tokens")
        base.sweep(rows.sparkSession)
        found.append(base.stored(part.join(shared, "token"), "shared"))
        base.drop_path(rows.sparkSession, path)
        base.sweep(rows.sparkSession)
    return found


def union(parts: list[tuple[DataFrame, str]]) -> DataFrame:
    out = parts[0][0]
    for df, _ in parts[1:]:
        out = out.unionByName(df)
    return out


def _me(members: DataFrame) -> Column:
    return F.struct("pos", "n", "fp", "c", *(b for b in BITS if b in members.columns)).alias("me")


def _room(percent: int, one: str, two: str, mapped: bool) -> Column:
    """Whether two members of a list can still overlap enough if this is the first list that they share; by their bit maps too, if they have any."""
    total = F.col(f"{one}.n") + F.col(f"{two}.n")
    least = F.ceil(total * percent / (100 + percent) - 1e-9)
    left = F.least(F.col(f"{one}.n") - F.col(f"{one}.pos"), F.col(f"{two}.n") - F.col(f"{two}.pos"))
    if mapped:
        apart = sum((F.bit_count(F.col(f"{one}.{b}").bitwiseXOR(F.col(f"{two}.{b}"))) for b in BITS[1:]), F.bit_count(F.col(f"{one}.b0").bitwiseXOR(F.col(f"{two}.b0"))))
        left = F.least(left, F.floor((total - apart) / 2))
    return (left >= least) & (F.least(F.col(f"{one}.n"), F.col(f"{two}.n")) * 100 >= F.greatest(F.col(f"{one}.n"), F.col(f"{two}.n")) * percent)


def _placed(members: DataFrame, comp: DataFrame | None) -> DataFrame:
    """members with c, the component of each, itself where it has no link yet."""
    if comp is None:
        return members.withColumn("c", F.col("fp"))
    return members.join(comp.withColumnRenamed("node", "x"), F.col("fp") == F.col("x"), "left").select(*members.columns, F.coalesce("component", "fp").alias("c"))


def hub_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a, b) of each member of (token, fp, n, pos, c) with its list's hub, the one of least pos, where components differ."""
    hubs, _ = base.stored(members.groupBy("token").agg(F.min(_me(members)).alias("hub")), "hubs")
    star = members.select("token", _me(members)).join(hubs, "token").where(_room(percent, "me", "hub", BITS[0] in members.columns) & (F.col("me.c") != F.col("hub.c")))
    return star.select(F.least("me.fp", "hub.fp").alias("a"), F.greatest("me.fp", "hub.fp").alias("b")).distinct()


def _open(members: DataFrame) -> DataFrame:
    """Members but the hubs, of lists in which those lie in several components: (token, me, ch), ch the hub's component."""
    hubs = members.groupBy("token").agg(F.min(_me(members)).alias("hub"), F.count(F.lit(1)).alias("many"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    hubs, hubs_path = base.stored(hubs.where("many > 2 and lo <> hi").select("token", "hub"), "hubs")
    rest = members.select("token", _me(members)).join(hubs, "token").where(F.col("me.fp") != F.col("hub.fp"))
    rest, path = base.stored(rest.select("token", "me", F.col("hub.c").alias("ch")), "rest")
    unlike, unlike_path = base.stored(rest.groupBy("token").agg(F.min("me.c").alias("lo"), F.max("me.c").alias("hi")).where("lo <> hi").select("token"), "unlike")
    out, _ = base.stored(rest.join(unlike, "token", "left_semi"), "open")
    for p in (path, hubs_path, unlike_path):
        base.drop_path(members.sparkSession, p)
    return out


def resolve(members: DataFrame, percent: int, verify: Callable[[DataFrame], DataFrame], known: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Links (a, b) that join the same components as all links among members of the same list would.

    members: distinct (token, fp, n, pos): member fp of list token, its set's size, and how many of its
    members stand before token in the order of all lists. known: links found before, and their components.
    verify: keeps of candidate pairs (a, b) those that link; percent: their Jaccard index is at least that.

    In each list the member with the least pos (the hub) is held against all others. Members that are then in
    another component than their hub are held against the other members of yet other components; each
    such pair is made in the first list that both share, so far as LOOK_BACK reaches.
    """
    spark = members.sparkSession
    links = verify(hub_pairs(_placed(members, known and known[1]), percent))
    links = known[0].unionByName(links) if known else links
    base.sweep(spark)
    comp, comp_path = base.stored(base.components(links), "comp")
    placed, placed_path = base.stored(_placed(members, comp), "placed")
    open_ = _open(placed)
    base.drop_path(spark, placed_path)
    base.drop_path(spark, comp_path)
    base.sweep(spark)
    earlier = Window.partitionBy("fp").orderBy("pos", "token").rowsBetween(-LOOK_BACK, -1)
    seen = open_.withColumns({"fp": F.col("me.fp"), "pos": F.col("me.pos")}).withColumn("earlier", F.collect_list("token").over(earlier)).select("token", "me", "ch", "earlier")
    seen, path = base.stored(seen, "seen")
    base.sweep(spark)
    stray = seen.where(F.col("me.c") != F.col("ch")).select("token", F.col("me").alias("one"), F.col("earlier").alias("e1"))
    rest = seen.select("token", F.col("me").alias("two"), F.col("ch").alias("c3"), F.col("earlier").alias("e2"))
    once = (F.col("two.c") == F.col("c3")) | (F.col("one.fp") < F.col("two.fp"))
    cross = stray.join(rest, "token").where((F.col("one.c") != F.col("two.c")) & once & _room(percent, "one", "two", BITS[0] in members.columns) & ~F.arrays_overlap("e1", "e2"))
    pairs, pairs_path = base.stored(cross.select(F.least("one.fp", "two.fp").alias("a"), F.greatest("one.fp", "two.fp").alias("b")).distinct(), "pairs")
    base.drop_path(spark, path)
    base.sweep(spark)
    out, _ = base.stored(links.unionByName(verify(pairs)), "all-links")
    base.drop_path(spark, pairs_path)
    return out
