"""Substring dedup: passages that repeat across documents go from all but the first document that has them.

A passage is a run of words, or a paragraph, of at least `least_words` words, as in the shingle joins. Two kinds are compared.

* Paragraphs (lines): MinHash signatures of their 5-word shingles are cut into bands, tuned for
  a recall of RECALL at the threshold at least cost. The paragraphs of a band are held against one of them, the one that meets most others;
  paragraphs that then lie in other clusters than the rest of their band are held against each other by the
  rarest shingles of their sets, without loss. Every pair is verified by its exact
  Jaccard index (at least `percent`), and links are clustered into components.
* Runs of `least_words` words: every such run of a document that one earlier document also has, word for word, wherever
  either stands. A run's seed is the least hash of its shorter shingles, so equal runs have equal seeds and
  neighbouring runs mostly share one; only runs whose seed stands in two documents are compared, by the hash of all their words.

The occurrences in the first document (smallest doc_id) of a component, or of a run, stay. In later documents all words of
repeated runs and repeated paragraphs are removed, the rest of
the text stays as it is byte for byte, but for line ends next to lines that go whole.

`least_words` says what a passage is, at any size of the corpus: shorter lines, such as headings, are common to documents of every kind and stay.

Nulls and edges: a null text stays null and an empty text stays empty, with nothing removed; rows with a null doc_id keep their text;
a passage that repeats only within one document stays; rows of one doc_id are one document to
the choice of the first and each is cut by its own text. Ties cannot occur, as doc_id orders documents. Columns of other names are ignored, or kept by `dedup_table`.
"""

from __future__ import annotations

import math
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import base, buckets
from .jaccard_join import flags_of
from .textops import U64, hash_words, mix, shingle_hashes, string_buffers

LEAST_WORDS, PERCENT, RECALL = 24, 80, 0.995


@lru_cache
def tune_bands(threshold: float, recall: float, most: int = 64) -> tuple[int, int]:
    """(bands, rows) of least cost whose recall at the threshold suffices; one row in as many bands as it takes, where `most` hashes do not do.

    The cost counts band keys, and 10 for each band in which a paragraph meets one that is half as like as the threshold.
    """
    found = []
    for rows in range(1, 9):
        bands = max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows))) if threshold < 1 else 1
        if rows == 1 or bands * rows <= most:
            found.append((bands * (1 + 10 * (threshold / 2) ** rows), rows, bands))
    _, rows, bands = min(found)
    return bands, rows


def units_of(data: np.ndarray, offs: np.ndarray):
    """Of all texts' words: (hashes, starts, ends, line_begin, ptr), with byte spans and the first words of lines."""
    h, ptr, starts, ends = hash_words(data, offs, spans=True)
    n = len(h)
    if not n:
        return h, starts, ends, np.empty(0, np.int64), ptr
    breaks = np.cumsum(data == 10)
    line = np.zeros(n, bool)
    line[1:] = breaks[starts[1:]] != breaks[starts[:-1]]
    line[ptr[:-1][np.diff(ptr) > 0]] = True
    return h, starts, ends, np.flatnonzero(line), ptr


def _within(n: int, ptr: np.ndarray, least: int) -> np.ndarray:
    """Words of n at which a run of `least` words begins that ends in the same text."""
    left = np.repeat(ptr[1:], np.diff(ptr)) - np.arange(n)
    return np.flatnonzero(left >= least)


def seeds_of(h: np.ndarray, ptr: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(first words, seeds) of all runs of `least` words within a text: the least hash of the run's shingles of a third of its length."""
    half = (least + 2) // 3
    low = shingle_hashes(h, half)
    room = len(h) - least + 1
    if room <= 0:
        return np.empty(0, np.int64), np.empty(0, U64)
    seed = low[:room].copy()
    for j in range(1, least - half + 1):
        np.minimum(seed, low[j : j + room], out=seed)
    at = _within(len(h), ptr, least)
    return at, seed[at]


def run_hashes(h: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A hash of each run of words from one of begin to the next."""
    if not len(begin):
        return np.empty(0, U64)
    with np.errstate(over="ignore"):
        size = np.diff(np.append(begin, len(h)))
        pos = (np.arange(len(h)) - np.repeat(begin, size)).astype(U64)
        return mix(np.add.reduceat(mix(h ^ (pos * U64(0x9E3779B97F4A7C15))), begin) + size.astype(U64))


def _paragraphs(h: np.ndarray, begin: np.ndarray, least: int):
    size = np.diff(np.append(begin, len(h)))
    return np.flatnonzero(size >= least), size


def _census(least: int, percent: int, k: int):
    """Rows of kind 0: a seed of a document; 1: a band of a paragraph; 2: a paragraph."""
    schema = "kind int, key long, fp long, n int, doc_id long, place int"
    bands, rows = tune_bands(percent / 100, RECALL)
    seeds = np.random.default_rng(5).integers(1, 2**62, bands * rows).astype(U64) * U64(2) + U64(1)

    def some(ids, data, offs):
        h, _, _, lines, ptr = units_of(data, offs)
        out = []
        at, seed = seeds_of(h, ptr, least)
        doc = np.searchsorted(ptr, at, side="right") - 1
        new = np.ones(len(at), bool)
        new[1:] = (seed[1:] != seed[:-1]) | (doc[1:] != doc[:-1])
        m = int(new.sum())
        out.append((np.zeros(m, np.int32), seed[new].view(np.int64), np.zeros(m, np.int64), np.zeros(m, np.int32), ids[doc[new]], np.zeros(m, np.int32)))
        which, size = _paragraphs(h, lines, least)
        fps = run_hashes(h, lines).view(np.int64)
        sh = shingle_hashes(h, k)
        if len(which):
            first, count = lines[which], size[which] - k + 1
            idx = np.arange(int(count.sum())) + np.repeat(first - (np.cumsum(count) - count), count)
            own, begin = sh[idx], np.cumsum(count) - count
            doc = np.searchsorted(ptr, first, side="right") - 1
            place = which - np.searchsorted(lines, ptr[:-1])[doc]
            m = len(which)
            of = np.repeat(np.arange(m), count)
            order = np.lexsort((own, of))
            fresh = np.ones(len(own), bool)
            fresh[1:] = (own[order][1:] != own[order][:-1]) | (of[1:] != of[:-1])
            distinct = np.bincount(of[fresh], minlength=m).astype(np.int32)
            out.append((np.full(m, 2, np.int32), np.zeros(m, np.int64), fps[which], distinct, ids[doc], place.astype(np.int32)))
            with np.errstate(over="ignore"):
                for b in range(bands):
                    key = np.full(m, b + 1, U64)
                    for r in range(rows):
                        key = mix(key * U64(31) + np.minimum.reduceat(mix_light(own * seeds[b * rows + r]), begin))
                    out.append((np.ones(m, np.int32), key.view(np.int64), fps[which], distinct, np.zeros(m, np.int64), np.zeros(m, np.int32)))
        return [np.concatenate(c) for c in zip(*out, strict=True)]

    def run(batches):
        for b in batches:
            data, offs = string_buffers(b.column(1))
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for i, j in _pieces(offs):
                got = some(ids[i:j], data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in got], names=["kind", "key", "fp", "n", "doc_id", "place"])

    return run, schema


def mix_light(h: np.ndarray) -> np.ndarray:
    return h ^ (h >> U64(29))


def _pieces(offs: np.ndarray, most: int = 1 << 20):
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, side="right")) - 1)
        yield i, j
        i = j


def _sets(least: int, k: int, bits):
    """Shingle sets of the paragraphs of documents that the filter may hold."""
    schema = "fp long, shingles binary"

    def run(batches):
        flags = np.frombuffer(zlib.decompress(bits.value), np.uint64)
        for b in batches:
            slot = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            b = b.filter(pa.array((flags[slot >> 6] >> (slot & 63).astype(U64)) & U64(1) > 0))
            if not b.num_rows:
                continue
            data, offs = string_buffers(b.column(0))
            for i, j in _pieces(offs):
                h, _, _, lines, _ = units_of(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])
                which, size = _paragraphs(h, lines, least)
                fps, sh = run_hashes(h, lines).view(np.int64), shingle_hashes(h, k)
                yield pa.RecordBatch.from_arrays([pa.array(fps[which]), pa.array([np.unique(sh[lines[w] : lines[w] + size[w] - k + 1]).tobytes() for w in which], pa.binary())], names=["fp", "shingles"])

    return run, schema


def _jaccard(batches):
    for b in batches:
        left, right = b.column(2), b.column(3)
        both, either = [], []
        for i in range(b.num_rows):
            x, y = np.frombuffer(left[i].as_buffer(), U64), np.frombuffer(right[i].as_buffer(), U64)
            n = len(np.intersect1d(x, y, assume_unique=True))
            both.append(n)
            either.append(len(x) + len(y) - n)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(both, pa.int64()), pa.array(either, pa.int64())], names=["a", "b", "both", "either"])


def _sets_of(docs: DataFrame, wanted: DataFrame, least: int, k: int) -> tuple[DataFrame, str]:
    """(fp, n, shingles) of the paragraphs (fp, doc_id) of wanted, stored."""
    bits, flags = flags_of(wanted, "doc_id")
    run, schema = _sets(least, k, flags)
    sets = docs.where("doc_id is not null").select("text", F.pmod(F.xxhash64("doc_id"), F.lit(bits)).alias("slot")).mapInArrow(run, schema)
    one_each = sets.join(wanted.select("fp"), "fp", "left_semi").dropDuplicates(["fp"])
    return base.stored(one_each.select("fp", (F.octet_length("shingles") / 8).cast("int").alias("n"), "shingles"), "sets")


def _verify(sets: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of paragraphs, those whose exact Jaccard index reaches percent."""
    two = pairs.join(sets.select(F.col("fp").alias("a"), F.col("shingles").alias("left")), "a").join(sets.select(F.col("fp").alias("b"), F.col("shingles").alias("right")), "b")
    found = two.select("a", "b", "left", "right").mapInArrow(_jaccard, "a long, b long, both long, either long")
    links, _ = base.stored(found.where(F.col("both") * 100 >= F.col("either") * percent).select("a", "b"), "links")
    base.sweep(sets.sparkSession)
    return links


def _size_ratio(percent: int, one: Column, two: Column) -> Column:
    return F.least(one, two) * 100 >= F.greatest(one, two) * percent


def paragraph_links(docs: DataFrame, bands: DataFrame, where: DataFrame, least: int, percent: int, k: int) -> DataFrame:
    """Links (a, b) of paragraphs that share a band; bands: (token, fp, n), where: (fp, doc_id) of each paragraph."""
    spark = docs.sparkSession
    parts = buckets.shared_lists(bands)
    members, members_path = base.stored(buckets.union(parts).distinct(), "members")
    for _, path in parts:
        base.drop_path(spark, path)
    wanted, wanted_path = base.stored(members.select("fp").distinct().join(where.select("fp", "doc_id"), "fp"), "wanted")
    sets, sets_path = _sets_of(docs, wanted, least, k)
    base.drop_path(spark, wanted_path)
    base.sweep(spark)
    # the hub of a band is the paragraph that meets most others in all of its bands
    size, _ = base.stored(members.groupBy("token").agg(F.count(F.lit(1)).alias("many")), "sizes")
    met = members.join(size, "token").groupBy("fp").agg(F.sum("many").alias("met"))
    ranked, ranked_path = base.stored(members.join(met, "fp").select("token", "n", F.struct((-F.col("met")).alias("least"), "fp", "n").alias("me")), "ranked")
    hubs, _ = base.stored(ranked.groupBy("token").agg(F.min("me").alias("hub")), "hubs")
    star = ranked.join(hubs, "token").where((F.col("me.fp") != F.col("hub.fp")) & _size_ratio(percent, F.col("me.n"), F.col("hub.n")))
    pairs, pairs_path = base.stored(star.select(F.least("me.fp", "hub.fp").alias("a"), F.greatest("me.fp", "hub.fp").alias("b")).distinct(), "pairs")
    base.drop_path(spark, ranked_path)
    base.sweep(spark)
    links = _verify(sets, pairs, percent)
    base.drop_path(spark, pairs_path)
    comp, _ = base.stored(base.components(links), "comp")
    placed = members.join(comp, members["fp"] == comp["node"], "left").select("token", "fp", F.coalesce("component", "fp").alias("c"))
    placed, placed_path = base.stored(placed, "placed")
    unlike, _ = base.stored(placed.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.count(F.lit(1)).alias("many")).where("lo <> hi and many > 2").select("token"), "unlike")
    open_ = placed.join(unlike, "token", "left_semi").select("fp").distinct()
    open_sets, open_path = base.stored(sets.join(open_, "fp", "left_semi"), "open-sets")
    base.drop_path(spark, placed_path)
    base.drop_path(spark, members_path)
    base.sweep(spark)
    rows, rows_path = base.stored(buckets.prefix_lists(open_sets, percent), "prefixes")
    parts = buckets.shared_lists(rows)
    base.drop_path(spark, rows_path)
    out = buckets.resolve(buckets.union(parts), percent, lambda p: _verify(open_sets, p, percent), known=(links, comp))
    for path in (sets_path, open_path, *(p for _, p in parts)):
        base.drop_path(spark, path)
    return out


def _runs(least: int):
    """The hashes of the runs of each document whose seed another document has too."""
    schema = "key long, doc_id long"

    def run(batches):
        for b in batches:
            data, offs = string_buffers(b.column(1))
            for i in range(b.num_rows):
                h, ptr = hash_words(data[offs[i] : offs[i + 1]], np.array([0, offs[i + 1] - offs[i]]))
                at, seed = seeds_of(h, ptr, least)
                shared = b.column(2)[i].values.to_numpy(zero_copy_only=False)
                own = np.unique(shingle_hashes(h, least)[at[np.isin(seed.view(np.int64), shared)]])
                yield pa.RecordBatch.from_arrays([pa.array(own.view(np.int64)), pa.array(np.full(len(own), b.column(0)[i].as_py(), np.int64))], names=["key", "doc_id"])

    return run, schema


def spans_to_cut(data: np.ndarray, repeated: np.ndarray, paragraphs: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Byte spans of one text to remove: the words of runs that an earlier document has, and repeated paragraphs.

    repeated: hashes of those runs of `least` words; paragraphs: numbers of the repeated lines with words.
    """
    h, starts, ends, lines, _ = units_of(data, np.array([0, len(data)]))
    if not len(h):
        return []
    again = np.flatnonzero(np.isin(shingle_hashes(h, least).view(np.int64), repeated))
    change = np.zeros(len(h) + 1, np.int64)
    change[again] += 1
    change[again + least] -= 1
    cut = np.cumsum(change) > 0
    stop = np.append(lines[1:], len(h))
    for p in paragraphs:
        if p < len(lines):
            cut[lines[p] : stop[p]] = True
    edge = np.flatnonzero(np.diff(cut, prepend=False))
    return [(int(starts[a]), int(ends[b - 1])) for a, b in zip(edge[::2], edge[1::2], strict=True)]


def cut_text(raw: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the spans; a line that goes whole takes its line end along, a gap within a line keeps one side's blank."""
    out, at = [], 0
    for a, b in spans:
        opens = a == 0 or raw[a - 1 : a] == b"\n"
        if opens and raw[b : b + 1] == b"\n":
            b += 1
        elif (opens or raw[a - 1 : a] == b" ") and raw[b : b + 1] == b" ":
            b += 1
        out.append(raw[at:a])
        at = b
    return b"".join([*out, raw[at:]])


def _cutter(least: int):
    """The new text of (text, runs, paragraphs), how many spans went, their bytes, and the spans."""

    def measure(texts, runs, paragraphs):
        rows = []
        for text, again, paras in zip(texts.to_pylist(), runs.to_pylist(), paragraphs.to_pylist(), strict=True):
            raw = (text or "").encode()
            spans = spans_to_cut(np.frombuffer(raw, np.uint8), np.array(again or [], np.int64), np.array(paras or [], np.int64), least) if raw and (again or paras) else []
            new = cut_text(raw, spans) if spans else raw
            rows.append((None if text is None else new.decode(), len(spans), len(raw) - len(new), [{"start": s, "length": e - s} for s, e in spans]))
        cols = list(zip(*rows, strict=True)) if rows else [()] * 4
        return [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))]

    return measure, "new_text string, n_removed int, removed_bytes long, spans array<struct<start:long,length:long>>"


def _repeated_runs(docs: DataFrame, seeds: DataFrame, least: int) -> DataFrame:
    """(doc_id, runs): the runs of each document that an earlier one has too; seeds: (key, doc_id), stored."""
    spark = docs.sparkSession
    parts = buckets.shared_lists(seeds.select(F.col("key").alias("token"), "doc_id"), "doc_id")
    run, schema = _runs(least)
    every, many = [], len(parts)
    for p in range(many):  # documents by hash class, which bounds the shuffled texts on disk
        mine = F.pmod(F.xxhash64("doc_id"), F.lit(many)) == p
        own = buckets.union(parts).where(mine).groupBy(F.col("doc_id").alias("d")).agg(F.collect_set("token").alias("seeds"))
        some = docs.where("text is not null").where(mine).join(own, F.col("doc_id") == F.col("d")).select("doc_id", "text", "seeds")
        every.append(base.stored(some.mapInArrow(run, schema), "runs"))
        base.sweep(spark)
    for _, path in parts:
        base.drop_path(spark, path)
    runs, found = buckets.union(every), []
    many = buckets.passes(runs.count())
    for p in range(many):
        part = runs.where(F.pmod("key", F.lit(many)) == p)
        first, first_path = base.stored(part.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").select("key", "first"), "first")
        base.sweep(spark)
        later = part.join(first, "key").where("doc_id > first").groupBy("doc_id").agg(F.collect_set("key").alias("some"))
        found.append(base.stored(later, "later"))
        base.drop_path(spark, first_path)
        base.sweep(spark)
    for _, path in every:
        base.drop_path(spark, path)
    out, _ = base.stored(buckets.union(found).groupBy("doc_id").agg(F.flatten(F.collect_list("some")).alias("runs")), "repeated")
    for _, path in found:
        base.drop_path(spark, path)
    base.sweep(spark)
    return out


def repeated_units(docs: DataFrame, least: int = LEAST_WORDS, percent: int = PERCENT, k: int = 5) -> DataFrame:
    """(repeats_of, runs, paragraphs): what each document repeats of an earlier one."""
    spark = docs.sparkSession
    run, schema = _census(least, percent, k)
    found, found_path = base.stored(docs.where("doc_id is not null").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema), "units", by="kind")
    again = _repeated_runs(docs, found.where("kind = 0").select("key", "doc_id"), least)
    base.drop_path(spark, f"{found_path}/kind=0")
    paras, bands = found.where("kind = 2").select("fp", "doc_id", "n", "place"), found.where("kind = 1").select(F.col("key").alias("token"), "fp", "n")
    where, where_path = base.stored(paras.groupBy("fp").agg(F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last")), "first")
    base.sweep(spark)
    links = paragraph_links(docs, bands, where, least, percent, k)
    comp = base.components(links)
    placed = where.join(comp, where["fp"] == comp["node"], "left").select("fp", "doc_id", "last", F.coalesce("component", "fp").alias("c"))
    placed, _ = base.stored(placed, "placed")
    start, _ = base.stored(placed.groupBy("c").agg(F.min("doc_id").alias("first"), F.max("last").alias("last")).where("first < last").select("c", "first"), "start")
    copies, _ = base.stored(placed.join(start, "c").select(F.col("fp").alias("f"), "first"), "copies")
    base.sweep(spark)
    lines = paras.join(copies, F.col("fp") == F.col("f")).where("doc_id > first").groupBy(F.col("doc_id").alias("d")).agg(F.collect_set("place").alias("paragraphs"))
    out = again.join(lines, F.col("doc_id") == F.col("d"), "full").select(F.coalesce("doc_id", "d").alias("repeats_of"), "runs", "paragraphs")
    out, _ = base.stored(out, "repeats")
    for path in (found_path, where_path):
        base.drop_path(spark, path)
    base.sweep(spark)
    return out


def dedup_passages(docs: DataFrame, least: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text, n_removed, removed_bytes, spans) of every row of docs (doc_id, text); spans are byte places in the old text."""
    base.tune(docs.sparkSession)
    docs = base.pick(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = repeated_units(docs, least, percent)
    full = docs.join(out, F.col("doc_id") == F.col("repeats_of"), "left")
    measure, fields = _cutter(least)
    return base.beside(full, ["text", "runs", "paragraphs"], measure, fields).select("doc_id", F.col("new_text").alias("text"), "n_removed", "removed_bytes", "spans")


def dedup_table(docs: DataFrame, least: int = LEAST_WORDS, percent: int = PERCENT) -> DataFrame:
    """docs with the repeated passages cut from text (and n_chars, if there, brought up to date), all columns kept."""
    base.tune(docs.sparkSession)
    out = repeated_units(base.pick(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), "text"), least, percent)
    wide = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = {n: F.col(f"c{i}") for i, n in enumerate(docs.columns)}
    full = wide.join(out, at["doc_id"].cast("long") == F.col("repeats_of"), "left")
    measure, fields = _cutter(least)
    text = f"c{docs.columns.index('text')}"
    full = base.beside(full, [text, "runs", "paragraphs"], measure, fields)
    new = {"text": F.col("new_text"), "n_chars": F.length("new_text").cast("long")}
    return full.select(*[new.get(n, at[n]).alias(n) for n in docs.columns])
