"""Best-fit packing of documents into sequences of at most `capacity` tokens by a grouping genetic algorithm.

A document is its token ids and the id 2. Only documents longer than a sequence are cut: all pieces but the first
are full, the first takes what is left over. Full pieces are sequences of their own; the others
are packed.

Documents of one length are alike to a packing, so it is planned on the counts of each length
(`capacity` numbers, whatever the input) and then dealt to documents by their rank within their length.
A plan is a list of patterns (the lengths in a sequence) with multiplicities. Large
counts are planned in levels: at multiplicity m the instance holds count // m of each length, at most
about BASE documents; its well-filled sequences are taken m times and the rest goes to m / 2, to 1 at last, where all is packed.

Each instance is solved by islands, one task each: populations start from best fit on jittered
orders and from bins filled with the least slack; crossover injects whole well-filled bins of one parent, drops the other's bins that now
hold documents twice, and places displaced documents by best fit, largest first; mutation empties the worst bins and some others and
fills them anew with the least slack. After each epoch the elite of each
island moves on to the next; epochs end when one brings no gain, or the bound is met.

Nulls and edges: a null text counts as empty, which is one piece of length 1 (the id 2); a null
doc_id is packed like others; repeated rows are packed each; an empty table gives no rows. Other columns are ignored.
Ranks among documents of one length follow a hash, then doc_id and piece, so ties only swap equal rows.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import base

CAPACITY, END_ID = 1024, 2
#: Documents of one planned instance, about; islands, epochs and generations of an epoch, and of the one epoch of a level whose loose bins are packed again.
BASE, ISLANDS, EPOCHS, GENERATIONS, ROUGH, POPULATION = 3000, 6, 8, 60, 10, 10
#: Generations without a gain after which an island waits for the next epoch.
PATIENCE = 8
#: Pieces of one length and share, about, among which ranks are counted in one task.
SHARE_ROWS = 4096
#: Word pieces that a worker remembers.
REMEMBERED = 300_000

# fixed values: letters and blanks that the pre-tokenizer's pattern tells apart, of ASCII and the first two Latin blocks
_LETTERS, _BLANKS = "A-Za-zÀ-ÖØ-öø-ſ", "\t-\r "
_ODD = re.compile(rf"[^\x00-\x7f{_LETTERS}]")
_PIECE = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^{_BLANKS}{_LETTERS}0-9]+|[{_BLANKS}]+(?![^{_BLANKS}])|[{_BLANKS}]+")


class ByteLevelEncoder:
    """Ids of whole texts as the tokenizers library gives them for a byte-level BPE file with the usual pattern.

    Texts of ASCII and Latin letters are cut into pieces here; a piece's ids are asked of the library once and
    remembered. Other texts, and those with an added token's text, go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        kept = json.loads(self.library.to_str())
        self.added = [t["content"] for t in kept["added_tokens"]]
        pre = kept.get("pre_tokenizer") or {}
        self.plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space") and not kept.get("normalizer") and kept["model"]["type"] == "BPE"
        self.known: dict[str, bytes] = {}
        self.ranks = self._by_rank(kept["model"]) if self.plain else None

    @staticmethod
    def _by_rank(model: dict):
        """Ids of one piece by merging in the order of ids, where the file's merges stand in that very order; else None."""
        import tiktoken

        vocab, merges = model["vocab"], model["merges"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        first = len(vocab) - len(merges)
        if first != 256 or any(vocab.get(a + b) != first + i for i, (a, b) in enumerate(pairs)):
            return None
        # the printable stand-ins of bytes: those that print stand for themselves, the others follow from 256 on
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
        ranks = {bytes(byte[c] for c in token): i for token, i in vocab.items() if all(c in byte for c in token)}
        if len(ranks) < len(vocab):
            return None
        return tiktoken.Encoding("pieces", pat_str=r"(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        cut = [_PIECE.findall(t) if self.plain and not _ODD.search(t) and not any(a in t for a in self.added) else None for t in texts]
        here = set().union(*(c for c in cut if c is not None))
        if len(self.known) > REMEMBERED:
            self.known = {p: self.known[p] for p in here & self.known.keys()}  # what is at hand is common
        fresh = list(here.difference(self.known))
        if self.ranks:
            self.known |= {p: array("I", self.ranks(p)).tobytes() for p in fresh}
        else:
            for p, e in zip(fresh, self.library.encode_batch_fast(fresh, add_special_tokens=False) if fresh else [], strict=True):
                self.known[p] = np.array(e.ids, "<u4").tobytes()
        get = self.known.__getitem__
        return [np.frombuffer(b"".join(map(get, c)), "<u4") if c is not None else np.array(self.library.encode(t, add_special_tokens=False).ids, "<u4") for t, c in zip(texts, cut, strict=True)]


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteLevelEncoder:
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ByteLevelEncoder(path)


def pieces_of(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def _pieces(path: str, capacity: int):
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def run(batches):
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows = []
            for i in range(0, len(texts), 128):
                for d, got in zip(ids[i : i + 128], encoder(path)([t or "" for t in texts[i : i + 128]]), strict=True):
                    full = np.append(got, np.uint32(END_ID)).astype("<u4")
                    rows += [(d, k, s, n, zlib.crc32(full[s : s + n].tobytes())) for k, (s, n) in enumerate(pieces_of(len(full), capacity))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 5, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run, schema


class Bins:
    """Bins found by what room they have left."""

    def __init__(self, capacity: int, bins: list[list[int]] = ()):
        self.capacity, self.rooms, self.mask = capacity, {}, 0
        for b in bins:
            self.put(b, capacity - sum(b))

    def put(self, b: list[int], room: int) -> None:
        self.rooms.setdefault(room, []).append(b)
        self.mask |= 1 << room

    def best_fit(self, size: int) -> None:
        fit = self.mask >> size
        if not fit:
            self.put([size], self.capacity - size)
            return
        room = size + (fit & -fit).bit_length() - 1
        some = self.rooms[room]
        b = some.pop()
        if not some:
            self.mask &= ~(1 << room)
        b.append(size)
        self.put(b, room - size)

    def all(self) -> list[list[int]]:
        return [b for some in self.rooms.values() for b in some]


def fitness(bins: list[list[int]], capacity: int) -> float:
    """Falkenauer's mean of squared fills, less one for each bin."""
    return sum((sum(b) / capacity) ** 2 for b in bins) / max(1, len(bins)) - len(bins)


def place(bins: list[list[int]], sizes, capacity: int) -> list[list[int]]:
    room = Bins(capacity, [list(b) for b in bins])
    for s in sizes:
        room.best_fit(int(s))
    return room.all()


def crossover(one: list[list[int]], two: list[list[int]], counts: np.ndarray, capacity: int, rng) -> list[list[int]]:
    """Well-filled bins of two enter one; bins of one that now hold a document twice go, and what they held is placed anew."""
    left = counts.copy()
    order = sorted(two, key=sum, reverse=True)
    good = order[: max(1, len(order) // 2)]
    start = int(rng.integers(0, len(good)))
    child = [list(b) for b in good[start : start + max(1, int(len(good) * rng.uniform(0.2, 0.8)))]]
    for b in child:
        for s in b:
            left[s] -= 1
    for b in sorted(one, key=sum, reverse=True):
        need = {s: b.count(s) for s in b}
        if all(left[s] >= n for s, n in need.items()):
            for s, n in need.items():
                left[s] -= n
            child.append(list(b))
    return place(child, np.repeat(np.arange(len(left)), left)[::-1], capacity)


def complete(mask: int, counts, room: int, depth: int, tries: int) -> list[int]:
    """At most `depth` lengths in stock that fill room with little slack; tries: firsts that are looked at."""
    low = mask & ((1 << (room + 1)) - 1)
    if not low:
        return []
    top = low.bit_length() - 1
    if depth == 1 or top == room:
        return [top]
    best, size, first = [top], top, top
    while first > 0 and tries > 0 and first * depth > size:
        counts[first] -= 1
        rest = complete(mask if counts[first] else mask & ~(1 << first), counts, room - first, depth - 1, 8)
        counts[first] += 1
        got = first + sum(rest)
        if got > size:
            best, size = [first, *rest], got
            if size == room:
                break
        tries -= 1
        first = (mask & ((1 << first) - 1)).bit_length() - 1
    return best


def fill(counts: np.ndarray, capacity: int, rng) -> list[list[int]]:
    """Bins of counts[length] documents, each the largest that is left and what fills it up with little slack."""
    left = counts.tolist()
    mask = sum(1 << s for s, n in enumerate(left) if n)
    out = []
    while mask:
        b = [mask.bit_length() - 1]
        while True:
            for s in b[-1:] if len(b) == 1 else more:
                left[s] -= 1
                if not left[s]:
                    mask &= ~(1 << s)
            room = capacity - sum(b)
            more = complete(mask, left, room, 3, int(rng.integers(8, 40))) if room else []
            if not more:
                break
            b += more
        out.append(b)
    return out


def mutate(bins: list[list[int]], capacity: int, rng) -> list[list[int]]:
    """Empty the worst bins and some others; fill them anew with the least slack, then place what lies in bad bins by best fit."""
    order = sorted(bins, key=sum)
    worst = int(np.searchsorted([sum(b) for b in order], capacity - 1))
    some = max(2, len(order) // 12)
    at = set(rng.choice(len(order), min(len(order), some), replace=False).tolist()) | set(rng.permutation(worst)[: 2 * some].tolist()) | set(range(min(worst, some)))
    counts = np.zeros(capacity + 1, np.int64)
    for i in at:
        for s in order[i]:
            counts[s] += 1
    new = sorted(fill(counts, capacity, rng), key=sum)
    lost = max(1, len(new) // 10)
    return place([b for i, b in enumerate(order) if i not in at] + new[lost:], sorted((s for b in new[:lost] for s in b), reverse=True), capacity)


def evolve(counts: np.ndarray, capacity: int, population: list, generations: int, seed: int) -> list:
    """The population after some generations, best first. An empty one starts from best fit on jittered orders and from filled bins."""
    rng = np.random.default_rng(seed)
    items = np.repeat(np.arange(len(counts)), counts)
    while len(population) < POPULATION:
        if len(population) % 2:
            population.append(fill(counts, capacity, rng))
            continue
        jitter = 0 if not population and seed % ISLANDS == 0 else rng.uniform(0, 0.15)
        order = np.argsort(-items * (1 + jitter * rng.standard_normal(len(items))), kind="stable")
        population.append(place([], items[order], capacity))
    least = -(-int(items.sum()) // capacity)
    best, since = -np.inf, 0
    for _ in range(generations):
        population.sort(key=lambda b: -fitness(b, capacity))
        now = fitness(population[0], capacity)
        best, since = (now, 0) if now > best + 1e-4 else (best, since + 1)
        if len(population[0]) <= least or since > PATIENCE:
            break
        child = crossover(population[0], population[int(rng.integers(1, len(population)))], counts, capacity, rng)
        other = crossover(population[int(rng.integers(1, len(population)))], population[0], counts, capacity, rng)
        population[-2:] = [mutate(child, capacity, rng), mutate(other, capacity, rng)]
    return sorted(population, key=lambda b: -fitness(b, capacity))


def solve(spark: SparkSession, counts: np.ndarray, capacity: int, epochs: int = EPOCHS, generations: int = GENERATIONS) -> list[list[int]]:
    """Bins for counts[length] documents of each length, by islands with migration of the elite."""
    state: list[list] = [[] for _ in range(ISLANDS)]
    shared, least = [int(x) for x in counts], -(-int(sum(s * int(n) for s, n in enumerate(counts))) // capacity)
    score = None
    for epoch in range(epochs):
        now = [json.dumps(p) for p in state]

        def island(pdfs, now=now, epoch=epoch):
            import pandas as pd

            for pdf in pdfs:
                for k in pdf["id"]:
                    found = evolve(np.array(shared), capacity, json.loads(now[k]), generations, int(k + ISLANDS * epoch))
                    yield pd.DataFrame({"island": [int(k)], "blob": [json.dumps(found)]})

        for r in spark.range(0, ISLANDS, 1, ISLANDS).mapInPandas(island, "island int, blob string").collect():  # ISLANDS populations of one bounded instance
            state[r["island"]] = json.loads(r["blob"])
        elite = [p[0] for p in state]
        best = max(elite, key=lambda b: fitness(b, capacity))
        if len(best) <= least or (score is not None and fitness(best, capacity) <= score + 1e-3):
            break
        score = fitness(best, capacity)
        for k in range(ISLANDS):
            state[k] = [*state[k][: POPULATION - 1], elite[k - 1]]
    return best


def plan(spark: SparkSession, counts: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """(lengths, multiplicity) of the patterns that hold counts[length] documents of each length."""
    counts = counts.copy()
    m = 1
    while counts.sum() > BASE * m:
        m *= 2
    out = []
    while counts.sum():
        part = counts // m
        if part.sum():
            bins = [sorted(b, reverse=True) for b in solve(spark, part, capacity, *((1, ROUGH) if m > 1 else ()))]
            good = bins if m == 1 else [b for b in bins if sum(b) >= capacity - 1]
            for b in good:
                for s in b:
                    counts[s] -= m
            out += [(b, m) for b in good]
        m //= 2
    return out


def _dealt(runs):
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def deal(batches):
        first, size, seq, many, begin = (np.asarray(x) for x in runs.value)
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            key = length * (1 << 44) + rank
            k = np.searchsorted(first, key, side="right") - 1
            t = key - first[k]
            place_ = begin[k] + (t % many[k]) * size[k]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(5)), pa.array(seq[k] + t // many[k]), pa.array(place_)], names=names)

    return deal, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def runs_of(patterns: list[tuple[list[int], int]], counts: np.ndarray, capacity: int):
    """For each run of ranks of one length: its first key, length, first sequence, documents a sequence, and first offset."""
    taken = np.zeros(capacity + 1, np.int64)
    rows, seq = [], 0
    for b, m in patterns:
        at = 0
        for s in sorted(set(b), reverse=True):
            n = b.count(s)
            rows.append((s * (1 << 44) + int(taken[s]), s, seq, n, at))
            taken[s] += n * m
            at += n * s
        seq += m
    rows.append((capacity * (1 << 44), capacity, seq, 1, 0))
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows, strict=True))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of docs (doc_id, text)."""
    spark = docs.sparkSession
    base.tune(spark)
    docs = base.pick(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    run, schema = _pieces(tokenizer, capacity)
    pieces, _ = base.stored(docs.mapInArrow(run, schema), "pieces")
    # by the digest too, so that rows without a doc_id do not share one
    share = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(max(1, pieces.count() // SHARE_ROWS)))
    pieces = pieces.withColumn("share", share)
    tally = pieces.groupBy("length", "share").agg(F.count(F.lit(1)).alias("n"))
    tally, _ = base.stored(tally, "tally")
    counts = np.zeros(capacity + 1, np.int64)
    for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[r["length"]] = r["n"]
    packed = counts.copy()
    packed[capacity] = 0
    runs = spark.sparkContext.broadcast(runs_of(plan(spark, packed, capacity), counts, capacity))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1))
    tally = tally.select(F.col("length").alias("l"), F.col("share").alias("s"), F.coalesce(before, F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("length", "share").orderBy("doc_id", "piece", "start"))
    ranked = pieces.withColumn("own", own).join(tally, (F.col("length") == F.col("l")) & (F.col("share") == F.col("s")))
    deal, out = _dealt(runs)
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("own") - 1).cast("long").alias("rank")).mapInArrow(deal, out)
