"""LM scoring: stupid backoff from n-gram counts over all documents.

A word's score is c(n-gram) / c(context) for the longest n-gram, of at most `order` words, that the
corpus has; each order given up costs a factor of `backoff`; a single word
scores c(word) / total, or `backoff` ** order / total if the corpus lacks it. Words are runs of non-blank characters, A-Z lower-cased; contexts do not cross documents, and at a document's start the
longer orders do not exist and cost nothing. A document gets the sum of the logarithms and their mean.

`backoff_scores` scores the documents that are counted. Each of their n-grams is in the tables, so no order is given up, and the
sum of log c(n-gram) - log c(context) over a document is that of its `order`-grams' entries less that of the shorter
n-grams between its first and its last. Hash class by hash class,
* documents are exploded to rows (gram, count), summed within tasks, dealt by gram and summed into a count table;
  n-grams that occur once need no row, as their logarithm is 0;
* documents are exploded again to rows (gram, document, weight), joined to the table on gram, and weight * log(count) is summed per document.
The table's most common grams, a bounded number, are broadcast and joined where documents are exploded, so a common n-gram is not shuffled;
all others are joined by a shuffle. A bit map of the table's grams, of bounded size, spares most rows that would find nothing.
Both are of fixed size, so for a corpus of more than LARGE bytes another way is taken, whose work a byte does not grow:
* documents are exploded once a class to (gram, document, count, weight), one entry for each gram of a document. Entries are packed, many to a row,
  for the task that gets all of their grams; it counts them and sums weight * log(count) by document;
* those sums are packed and dealt by document, and summed. Nothing is joined, broadcast or collected, and a common n-gram has at most one entry for each document.

`score_against` scores documents by the counts of another corpus: n-grams by position, joined to the tables, with every order that is given up.

Logarithms are summed in units of 1e-9, so sums do not depend on their order. Counts are exact 64-bit integers, up to 64-bit hash ties of n-grams and of rows.

Nulls and edges: a null or empty text has 0 words, log_score 0.0 and null mean; a null doc_id is scored like others;
repeated rows count and score each; an empty table or corpus gives no rows, or words that are all unseen (total 1). Other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import base
from .textops import _STEP, U64, hash_words, is_space, lower_ascii, mix, string_buffers

ORDER, BACKOFF = 3, 0.4
#: Bytes of text whose n-grams make a class, about, and most classes.
CLASS_BYTES, CLASSES = 100_000_000, 4
#: Bytes of text beyond which entries are packed for the tasks that count them, and nothing is joined; classes then.
LARGE, LARGE_CLASSES = 400_000_000, 6
#: Least and most bits of the map of a table's grams, and bits for each.
LEAST_BITS, MOST_BITS, BITS_EACH = 1 << 16, 1 << 26, 16
#: Most n-grams of a class that are broadcast, and how often they occur at least.
COMMON, COMMON_LEAST = 1 << 20, 8
#: N-grams that a task sums at once, rows of an Arrow batch between stages, rows that a task of the counts' sum gets, about.
HELD, ROWS, PART_ROWS = 1 << 21, 1 << 16, 1_000_000
#: Rows of a table that a task of the join may hold as a hash table.
HASHED = 2_000_000
#: Logarithms are whole numbers of this part.
UNIT = 1_000_000_000
#: Bytes whose words are hashed at once, and the longest word that is hashed by eight bytes.
BLOCK, SHORT_WORD = 1 << 18, 32
_MASK = np.array([(1 << (8 * i)) - 1 for i in range(9)], U64)
_ODD = U64(0x9E3779B97F4A7C15)


def _block(data: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the words of some bytes; texts begin at breaks."""
    n = len(data)
    at, before = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    at[:-1] = before[1:] = ~is_space(data)
    opens, closes = at & ~before, before & ~at
    opens[breaks], closes[breaks] = at[breaks], before[breaks]
    start = np.flatnonzero(opens)
    size = np.flatnonzero(closes) - start
    low = np.zeros((n // 8 + 2) * 8, np.uint8)
    low[:n] = lower_ascii(data)
    eights = low.view(U64)

    def eight(place: np.ndarray, most: np.ndarray) -> np.ndarray:
        word, shift = place >> 3, ((place & 7) << 3).astype(U64)
        high = np.where(shift > 0, eights[word + 1] << ((U64(64) - shift) & U64(63)), U64(0))
        return ((eights[word] >> shift) | high) & _MASK[np.minimum(most, 8)]

    with np.errstate(over="ignore"):
        h = mix(eight(start, size) + size.astype(U64) * _ODD)
        rest = np.flatnonzero(size > 8)
        for done in range(8, SHORT_WORD, 8):
            rest = rest[size[rest] > done]
            if not len(rest):
                break
            h[rest] = mix(h[rest] * _ODD + eight(start[rest] + done, size[rest] - done))
        rest = rest[size[rest] > SHORT_WORD]
        if len(rest):
            h[rest] = hash_words(np.concatenate([data[i : i + k] for i, k in zip(start[rest], size[rest], strict=True)]), np.concatenate([[0], np.cumsum(size[rest])]))[0]
    return h, start


def word_hashes(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and ptr: words of text i are ptr[i]:ptr[i+1]. As `textops.hash_words`, by eight bytes at a time, and other hashes."""
    total, at, hashes, starts = len(data), 0, [], []
    breaks = offs[1:-1]
    while at < total:
        end = min(total, at + BLOCK)
        while end < total and not is_space(data[end : end + 1])[0]:
            gap = np.flatnonzero(is_space(data[end : end + 4096]))
            end = end + int(gap[0]) if len(gap) else min(total, end + 4096)
        lo, hi = np.searchsorted(breaks, (at, end + 1))
        h, start = _block(data[at:end], breaks[lo:hi] - at)
        hashes.append(h)
        starts.append(start + at)
        at = end
    h = np.concatenate(hashes) if hashes else np.empty(0, U64)
    s = np.concatenate(starts) if starts else np.empty(0, np.int64)
    ptr = np.searchsorted(s, offs)
    ptr[-1] = len(s)
    return h, ptr


def grams(h: np.ndarray, ptr: np.ndarray, n: int, p: int = 0, classes: int = 1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all n-grams of class p within texts: (hash, text, place in the text); n-grams of different lengths differ."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, U64), np.empty(0, np.int64), np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        key = h[:m] * _STEP[0]
        for j in range(1, n):
            key += h[j : j + m] * _STEP[j]
        key += U64(n) * _ODD
        want = ((key >> U64(40)) * U64(classes)) >> U64(24) == U64(p) if classes > 1 else np.ones(m, bool)
        for j in range(1, n):  # those that begin in a text's last words run out of it
            over = ptr[1:] - j
            want[over[(over >= 0) & (over < m)]] = False
        at = np.flatnonzero(want)
        of = np.repeat(np.arange(len(ptr) - 1), np.diff(np.searchsorted(at, ptr)))
        return mix(key[at]), of, at - ptr[:-1][of]


def _spans(offs: np.ndarray, most: int = 1 << 19):
    """Runs of texts of some `most` bytes."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + most, side="right")) - 1)
        yield i, j
        i = j


def _texts(b: pa.RecordBatch, at: int):
    """(first row, last row, word hashes, ptr) of parts of a batch."""
    data, offs = string_buffers(b.column(at))
    for i, j in _spans(offs):
        yield i, j, *word_hashes(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i])


def _lengths(order: int):
    """Of each row its words, and the gram of a text shorter than `order` words."""

    def run(batches):
        for b in batches:
            for i, j, h, ptr in _texts(b, 2):
                n = np.diff(ptr)
                short = np.zeros(j - i, np.int64)
                for k in range(1, order):
                    key, of, _ = grams(h, ptr, k)
                    mine = n[of] == k
                    short[of[mine]] = key[mine].view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(short, mask=(n == 0) | (n >= order))], names=["key", "doc_id", "n_words", "short"])

    return run, "key long, doc_id long, n_words long, short long"


def _in_map(key: np.ndarray, flags: np.ndarray) -> np.ndarray:
    slot = key & U64(64 * len(flags) - 1)
    return (flags[(slot >> U64(6)).astype(np.int64)] >> (slot & U64(63))) & U64(1) > 0


def _folded(gram: list[np.ndarray], many: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams, in order, and their sums."""
    g, m = np.concatenate(gram), np.concatenate(many)
    by = np.argsort(g)
    g = g[by]
    first = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
    return g[first], np.add.reduceat(m[by], first)


def _batches(gram: np.ndarray, many: np.ndarray):
    for i in range(0, len(gram), ROWS):
        yield pa.RecordBatch.from_arrays([pa.array(gram[i : i + ROWS]), pa.array(many[i : i + ROWS])], names=["gram", "many"])


def _counted(orders: list[int], p: int, classes: int, asked):
    """(gram, many) of a class, summed over some HELD n-grams. Of orders other than the two longest only those that `asked` may hold."""

    def sums(held: list[np.ndarray]):
        kinds, many = np.unique(np.concatenate(held), return_counts=True)
        return _batches(kinds.view(np.int64), many.astype(np.int64))

    def run(batches):
        flags = np.frombuffer(zlib.decompress(asked.value), np.uint64)
        held, size = [], 0
        for b in batches:
            for _, _, h, ptr in _texts(b, 0):
                for n in orders:
                    if n < orders[-1] - 1 and not flags.any():
                        continue
                    key, _, _ = grams(h, ptr, n, p, classes)
                    if n < orders[-1] - 1:
                        key = key[_in_map(key, flags)]
                    held.append(key)
                    size += len(key)
                if size >= HELD:
                    yield from sums(held)
                    held, size = [], 0
        if size:
            yield from sums(held)

    return run, "gram long, many long"


def _summed(batches):
    """(gram, many) of those grams that occur more than once; a task gets all rows of its grams."""
    held, size, least = [], 0, 2 * HELD
    for b in batches:
        held.append((b.column(0).to_numpy(), b.column(1).to_numpy()))
        size += b.num_rows
        if size >= least:
            held = [_folded(*zip(*held, strict=True))]
            size = len(held[0][0])
            least = max(least, 2 * size)
    if size:
        gram, many = _folded(*zip(*held, strict=True))
        yield from _batches(gram[many > 1], many[many > 1])


def _slots(grams_: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A gram and its logarithm in each slot of a table of twice the size: gram g may be in slot g & (slots - 1) only, the one with the largest logarithm is. Others are left to the join."""
    bits = max(4, int(2 * max(1, len(grams_)) - 1).bit_length())
    gram, log = np.zeros(1 << bits, U64), np.zeros(1 << bits, np.int64)
    by = np.argsort(logs, kind="stable")
    slot = (grams_.view(U64)[by] & U64((1 << bits) - 1)).astype(np.int64)
    gram[slot], log[slot] = grams_.view(U64)[by], logs[by]
    return gram, log


def _weighted(order: int, p: int, classes: int, known, common):
    """(gram, key, weight, own) of a class. weight: 1 for each n-gram of `order`, -1 for each shorter one inside; texts of fewer words have their whole as one.

    Common n-grams are joined here: their weighted logarithms go into own, on one row of weight 0 a text.
    """

    def run(batches):
        flags = np.frombuffer(zlib.decompress(known.value), np.uint64)
        there, logs = _slots(*(np.frombuffer(x, np.int64) for x in common.value))
        for b in batches:
            keys = b.column(0).to_numpy()
            out = []
            for i, j, h, ptr in _texts(b, 1):
                size = np.diff(ptr)
                own = np.zeros(j - i, np.int64)
                for n in range(1, order + 1):
                    if n < order - 1 and not (size == n).any():
                        continue
                    gram, of, place = grams(h, ptr, n, p, classes)
                    if n == order:
                        sign = np.ones(len(gram), np.int64)
                    else:
                        whole = size[of] == n
                        want = whole | ((place > 0) & (place + n < size[of])) if n == order - 1 else whole
                        gram, of, sign = gram[want], of[want], np.where(whole[want], 1, -1)
                    slot = (gram & U64(len(there) - 1)).astype(np.int64)
                    hit = (there[slot] == gram) & (logs[slot] > 0)
                    to = np.concatenate([[0], np.cumsum(np.where(hit, sign * logs[slot], 0))])
                    own += np.diff(to[np.searchsorted(of, np.arange(j - i + 1))])
                    seen = ~hit & _in_map(gram, flags)
                    out.append((gram[seen].view(np.int64), keys[i + of[seen]], sign[seen].astype(np.int32), np.zeros(int(seen.sum()), np.int64)))
                some = np.flatnonzero(own)
                out.append((keys[i + some], keys[i + some], np.zeros(len(some), np.int32), own[some]))
            if out:
                columns = [np.concatenate(x) for x in zip(*out, strict=True)]
                for i in range(0, len(columns[0]), ROWS):
                    yield pa.RecordBatch.from_arrays([pa.array(x[i : i + ROWS]) for x in columns], names=["gram", "key", "weight", "own"])

    return run, "gram long, key long, weight int, own long"


def _dealt(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where keys in order are cut for `parts` tasks: those of task i are [i]:[i+1]."""
    of = ((keys >> U64(32)) * U64(parts)) >> U64(32)
    return np.searchsorted(of, np.arange(parts + 1, dtype=np.int64).astype(U64))


def _packed(keys: np.ndarray, parts: int, *columns: np.ndarray):
    """Batches of (part, and bytes of keys and columns): a row for each part that has any. keys are unsigned, in order."""
    cut = _dealt(keys, parts)
    some = np.flatnonzero(np.diff(cut))
    fields = [pa.array([x[cut[i] : cut[i + 1]].tobytes() for i in some], pa.binary()) for x in (keys, *columns)]
    if len(some):
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *fields], names=["part", *_PACKED[: len(fields)]])


#: Names of packed columns and their types.
_PACKED, _TYPES = ["a", "b", "c", "d"], [U64, np.int64, np.int32, np.int32]


def _unpacked(batches, types: list) -> list[np.ndarray]:
    held = [[] for _ in types]
    for b in batches:
        for to, column, kind in zip(held, b.columns[1:], types, strict=True):
            data, offs = (np.frombuffer(column.buffers()[2], np.uint8), np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]) if len(column) else (np.empty(0, np.uint8), [0])
            to.append(data[offs[0] : offs[-1]].copy().view(kind))
    return [np.concatenate(x) if x else np.empty(0, kind) for x, kind in zip(held, types, strict=True)]


def _entries(order: int, p: int, classes: int, asked, parts: int):
    """Packed (gram, key, count, weight) of a class: one entry for each gram of a text, within some HELD n-grams. Weights are those of `_weighted`; of shorter orders only grams that `asked` may hold."""

    def merged(held):
        gram, key, weight = (np.concatenate(x) for x in zip(*held, strict=True))
        by = np.argsort(gram, kind="stable")
        gram, key, weight = gram[by], key[by], weight[by]
        first = np.flatnonzero(np.concatenate([[True], (gram[1:] != gram[:-1]) | (key[1:] != key[:-1])]))
        many = np.diff(np.append(first, len(gram))).astype(np.int32)
        return _packed(gram[first], parts, key[first], many, np.add.reduceat(weight, first, dtype=np.int32))

    def run(batches):
        flags = np.frombuffer(zlib.decompress(asked.value), np.uint64)
        held, size = [], 0
        for b in batches:
            keys = b.column(0).to_numpy()
            for i, _, h, ptr in _texts(b, 1):
                words = np.diff(ptr)
                for n in range(1, order + 1):
                    if n < order - 1 and not flags.any():
                        continue
                    gram, of, place = grams(h, ptr, n, p, classes)
                    if n < order - 1:
                        want = _in_map(gram, flags)
                        gram, of, place = gram[want], of[want], place[want]
                    whole = words[of] == n
                    inside = (place > 0) & (place + n < words[of]) if n == order - 1 else False
                    weight = np.ones(len(gram), np.int32) if n == order else np.where(whole, 1, np.where(inside, -1, 0)).astype(np.int32)
                    held.append((gram, keys[i + of], weight))
                    size += len(gram)
                if size >= HELD:
                    yield from merged(held)
                    held, size = [], 0
        if size:
            yield from merged(held)

    return run, "part int, a binary, b binary, c binary, d binary"


def _counted_entries(parts: int):
    """Packed (key, sum of weight * log(count)) of entries; a task gets all entries of its grams."""

    def run(batches):
        gram, key, many, weight = _unpacked(batches, _TYPES)
        if not len(gram):
            return
        by = np.argsort(gram)
        gram = gram[by]
        first = np.flatnonzero(np.concatenate([[True], gram[1:] != gram[:-1]]))
        del gram
        count = np.add.reduceat(many[by], first, dtype=np.int64)
        log = np.repeat(np.rint(np.log(count) * UNIT).astype(np.int64), np.diff(np.append(first, len(by))))
        some = np.flatnonzero(log)
        if not len(some):
            return
        by, log = by[some], log[some]
        log *= weight[by]
        key, log = _folded([key[by].view(U64)], [log])
        yield from _packed(key[log != 0], parts, log[log != 0])

    return run, "part int, a binary, b binary"


def _totals(batches):
    """(key, log) of packed sums; a task gets all sums of its keys."""
    key, log = _unpacked(batches, _TYPES[:2])
    if len(key):
        key, log = _folded([key], [log])
        for b in _batches(key.view(np.int64), log):
            yield b.rename_columns(["key", "log"])


def _common(table: DataFrame):
    """Broadcast grams and logarithms, as bytes, of the most common of table (gram, log): at most COMMON, that occur COMMON_LEAST times and more."""
    part = UNIT // 16
    least = -(-int(np.log(COMMON_LEAST) * UNIT) // part)
    sizes = table.where(F.col("log") >= least * part).groupBy(F.expr(f"log div {part}").alias("at")).count().collect()  # some hundred rows, whatever the input
    n = 0
    for at, many in sorted(sizes, reverse=True):
        n += many
        if n > COMMON:
            least = at + 1
            break
    got = table.where(F.col("log") >= least * part).toArrow()
    return table.sparkSession.sparkContext.broadcast(tuple(got[x].to_numpy().astype(np.int64).tobytes() for x in ("gram", "log")))


def _bit_map(grams_: DataFrame, n: int):
    """A broadcast bit map over the low bits of n grams, sized by their number up to MOST_BITS."""
    bits = LEAST_BITS
    while bits < min(MOST_BITS, BITS_EACH * n):
        bits *= 2
    slot = F.col("gram").bitwiseAND(F.lit(bits - 1))
    words = grams_.select(slot.alias("h")).groupBy(F.shiftright("h", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(h & 63 as int)))").alias("v"))
    flags = np.zeros(bits // 64, np.int64)
    got = words.toArrow()  # at most MOST_BITS / 64 rows, whatever the input
    flags[got["w"].to_numpy()] = got["v"].to_numpy()
    return grams_.sparkSession.sparkContext.broadcast(zlib.compress(flags.tobytes(), 1))


def units(c: Column) -> Column:
    """A logarithm in whole units."""
    return F.round(F.ln(c) * UNIT).cast("long")


def _rows(docs: DataFrame) -> DataFrame:
    """(key, doc_id, text): key stands for rows of one doc_id and text."""
    docs = base.pick(docs, ["doc_id", "text"]).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return docs.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")


def _result(found: DataFrame, log: Column) -> DataFrame:
    score = F.when(F.col("n_words") > 0, log / F.lit(float(UNIT))).otherwise(0.0)
    return found.select("doc_id", "n_words", score.alias("log_score"), F.when(F.col("n_words") > 0, score / F.col("n_words")).alias("mean_log_score"))


def backoff_scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) of every row of docs (doc_id, text), by the counts of all docs."""
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = docs.sparkSession
    base.tune(spark)
    docs = _rows(docs)
    run, schema = _lengths(order)
    found, _ = base.stored(docs.mapInArrow(run, schema), "lengths")
    whole = found.where("short is not null").select(F.col("short").alias("gram")).distinct()
    short = _bit_map(whole, whole.count())
    total, size = found.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0], docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    classes = LARGE_CLASSES if size > LARGE else max(1, min(CLASSES, -(-size // CLASS_BYTES)))
    dealt = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = max(dealt, min(order, 2) * total // classes // PART_ROWS)
    sums = []
    for p in range(classes):
        if size > LARGE:
            sums.append(_class_sums(docs, order, p, classes, short, parts))
            base.sweep(spark)
            continue
        run, schema = _counted(list(range(1, order + 1)), p, classes, short)
        rows = docs.select("text").mapInArrow(run, schema).repartition(parts, "gram")
        with base.setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS)):
            table, table_path = base.stored(rows.mapInArrow(_summed, schema).select("gram", units(F.col("many")).alias("log")), "counts")
        del rows
        base.sweep(spark)
        n = table.count()
        known, common = _bit_map(table.select("gram"), n), _common(table)
        run, schema = _weighted(order, p, classes, known, common)
        asked = docs.select("key", "text").mapInArrow(run, schema)
        joined = asked.join(table.hint("shuffle_hash") if n <= HASHED * dealt else table, "gram", "left")
        part = joined.groupBy("key").agg(F.sum(F.coalesce(F.col("weight") * F.col("log"), F.lit(0)) + F.col("own")).alias("log"))
        sums.append(base.stored(part, "sums")[0])
        known.destroy()
        common.destroy()
        base.drop_path(spark, table_path)
        del asked, joined, part, table
        base.sweep(spark)
    every = sums[0]
    for s in sums[1:]:
        every = every.unionByName(s)
    every = every.groupBy(F.col("key").alias("k")).agg(F.sum("log").alias("log"))
    # rows that repeat have all sent the same: each gets its share
    times = found.groupBy(F.col("key").alias("k")).agg(F.count(F.lit(1)).alias("times"))
    each, _ = base.stored(times.join(every, "k", "left").select("k", F.expr("coalesce(log, 0L) div times").alias("log")), "each")
    whole = found.join(each, F.col("key") == F.col("k"))
    return _result(whole, F.col("log") - F.round(F.ln(F.lit(max(1, total))) * UNIT).cast("long"))


def _class_sums(docs: DataFrame, order: int, p: int, classes: int, short, parts: int) -> DataFrame:
    """(key, log) of the n-grams of a class, by packed entries."""
    run, schema = _entries(order, p, classes, short, parts)
    rows = docs.select("key", "text").mapInArrow(run, schema).repartitionById(parts, F.col("part"))
    run, schema = _counted_entries(parts)
    rows = rows.mapInArrow(run, schema).repartitionById(parts, F.col("part"))
    return base.stored(rows.mapInArrow(_totals, "key long, log long"), "sums")[0]


def _exploded(order: int):
    """(key, place, n, gram) of every n-gram of every text, by the place of its last word."""

    def run(batches):
        for b in batches:
            keys = b.column(0).to_numpy()
            for i, _, h, ptr in _texts(b, 1):
                for n in range(1, order + 1):
                    gram, of, place = grams(h, ptr, n)
                    yield pa.RecordBatch.from_arrays([pa.array(keys[i + of]), pa.array(place + n - 1), pa.array(np.full(len(gram), n, np.int32)), pa.array(gram.view(np.int64))], names=["key", "place", "n", "gram"])

    return run, "key long, place long, n int, gram long"


def score_against(docs: DataFrame, corpus: DataFrame, order: int = ORDER, backoff: float = BACKOFF) -> DataFrame:
    """(doc_id, n_words, log_score, mean_log_score) of every row of docs (doc_id, text), by the counts of corpus (doc_id, text)."""
    spark = docs.sparkSession
    base.tune(spark)
    run, schema = _exploded(order)
    counted = _rows(corpus).select("key", "text").mapInArrow(run, schema).groupBy("gram", "n").agg(F.count(F.lit(1)).alias("c"))
    table, _ = base.stored(counted, "counts")
    total = max(1, table.where("n = 1").agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0])
    rows = _rows(docs)
    asked = rows.dropDuplicates(["key"]).select("key", "text").mapInArrow(run, schema)
    joined = asked.join(table.select("gram", "c"), "gram", "left")
    at = joined.groupBy("key", "place").agg(F.max("n").alias("most"), *[F.coalesce(F.max(F.when(F.col("n") == n, F.col("c"))), F.lit(0)).alias(f"c{n}") for n in range(1, order + 1)])
    before = Window.partitionBy("key").orderBy("place")
    at = at.select("*", *[F.lag(f"c{n}").over(before).alias(f"b{n}") for n in range(1, order)])
    down = units(F.lit(backoff))
    log = F.when(F.col("c1") > 0, units(F.col("c1"))).otherwise(down * order - down * (F.col("most") - 1)) - units(F.lit(total)) + down * (F.col("most") - 1)
    for n in range(2, order + 1):
        log = F.when(F.col(f"c{n}") > 0, units(F.col(f"c{n}")) - units(F.col(f"b{n - 1}")) + down * (F.col("most") - n)).otherwise(log)
    each = at.groupBy(F.col("key").alias("k")).agg(F.sum(log).alias("log"), F.count(F.lit(1)).alias("n_words"))
    each, _ = base.stored(each, "each")
    whole = rows.join(each, F.col("key") == F.col("k"), "left").select("doc_id", F.coalesce("n_words", F.lit(0)).cast("long").alias("n_words"), F.coalesce("log", F.lit(0)).alias("log"))
    return _result(whole, F.col("log"))
