"""Operators against brute force on the smallest tables."""

import collections
import hashlib
import math
import re
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evigrain.llm import additive_ann, base, bpe_codec, buckets, html_layout, jaccard_join, ngram_lm, packing, passage_dedup, quality_rules, queries, textops, toxicity, vector_dedup

P = pytest.importorskip("public_tokenizers")
DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


def shingles(t, k):
    w = WORD.findall((t or "").translate(LOWER))
    return frozenset(zip(*[w[i:] for i in range(k)])) if len(w) >= k else frozenset([tuple(w)] if w else [])


def roots(ids, links):
    par = {i: i for i in ids}

    def find(x):
        while par[x] != x:
            par[x] = par[par[x]]
            x = par[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        par[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_word_hashes_do_not_depend_on_slices(monkeypatch):
    col = pa.array(["", "a", "A b", " x y\tz ", "ab", "cd ef", None, "é É", "q" * 50])
    data, offs = textops.string_buffers(col)
    want, ptr = textops.hash_words(data, offs)
    assert list(np.diff(ptr)) == [len(WORD.findall(t or "")) for t in col.to_pylist()]
    for n in (1, 3, 7):
        monkeypatch.setattr(textops, "SLICE", n)
        got, p = textops.hash_words(data, offs)
        assert (got == want).all() and (p == ptr).all()


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(i, i + 1) for i in range(500, 540)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in base.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    links = [(a, b) for a, b in edges if a is not None and a != b]
    want = roots({x for e in links for x in e}, links)
    assert got == want


@pytest.mark.parametrize("k,percent", [(4, 85), (2, 60)])
def test_jaccard_groups(spark, texts, k, percent):
    extra = {10_000 + i: " ".join(f"t{j}" for j in range(n) if j != i % 5) for i, n in enumerate([3, 5, 6, 7, 8, 9, 12, 13, 14, 15, 20, 21, 40, 41])}
    both = {**dict(list(texts.items())[:120]), **extra}
    df = spark.createDataFrame(list(both.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_groups(df, k, percent).collect()}
    sets = {i: shingles(t, k) for i, t in both.items()}
    ids = sorted(sets)
    links = [(a, b) for x, a in enumerate(ids) for b in ids[x + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = roots(ids, links)
    assert got == {i: (len(sets[i]), want[i]) for i in ids}


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("boundary", [0, 6, 11, 12, 20])
def test_nested_sets_share_a_list(percent, boundary):
    level = types.SimpleNamespace(value=zlib.compress(np.zeros(buckets.WIDTH, np.uint8).tobytes()))
    run, _ = jaccard_join._postings(4, percent, boundary, level)
    texts = [" ".join(f"t{j}" for j in range(n + 3)) for n in range(1, 41)]
    (out,) = run([pa.record_batch([pa.array(range(40)), pa.array(texts)], names=["doc_id", "text"])])
    lists = collections.defaultdict(set)
    for token, n in zip(out["token"].to_pylist(), out["n"].to_pylist(), strict=True):
        lists[n].add(token)
    assert sorted(lists) == list(range(1, 41))
    assert all(lists[n] & lists[m] for n in lists for m in lists if n < m and 100 * n >= percent * m)


def test_nested_short_texts_are_one_component(spark):
    rows = [(100 * n + m, " ".join(f"p{n}q{j}" for j in range(m + 3))) for n in range(6, 12) for m in (n, n + 1)]
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[100 * n + m] == 100 * n + n for n in range(6, 12) for m in (n, n + 1))


def plain_backoff(words, count, total, order=3, backoff=0.4):
    s = 0.0
    for i in range(len(words)):
        top = min(order, i + 1)
        n = next((n for n in range(top, 0, -1) if count[n][tuple(words[i - n + 1 : i + 1])]), 0)
        if not n:
            s += order * math.log(backoff) - math.log(total)
            continue
        below = total if n == 1 else count[n - 1][tuple(words[i - n + 1 : i])]
        s += math.log(count[n][tuple(words[i - n + 1 : i + 1])] / below) + (top - n) * math.log(backoff)
    return s


def plain_counts(words):
    return [collections.Counter(tuple(w[i : i + n]) for w in words for i in range(len(w) - n + 1)) for n in range(4)]


def test_backoff_query_counts_every_ngram(spark, texts, monkeypatch):
    monkeypatch.setattr(ngram_lm, "CLASS_BYTES", 200_000)
    got = {r["doc_id"]: r for r in queries.op3_stupid_backoff(spark, DATA).collect()}
    words = {i: WORD.findall(t.translate(LOWER)) for i, t in texts.items()}
    count = plain_counts(words.values())
    for d, w in words.items():
        assert got[d]["n_words"] == len(w) and got[d]["log_score"] == pytest.approx(plain_backoff(w, count, sum(count[1].values())), rel=1e-9, abs=1e-5)


@pytest.mark.parametrize("common", [0, 50, 1 << 20])
def test_backoff_by_broadcast_and_by_shuffle(spark, monkeypatch, common):
    rng = np.random.default_rng(5)
    texts = {i: " ".join(f"w{x}" for x in rng.zipf(1.5, rng.integers(0, 40)) if x < 500) for i in range(120)}
    for name, value in (("CLASS_BYTES", 4000), ("COMMON", common), ("COMMON_LEAST", 3), ("HELD", 200), ("PART_ROWS", 300), ("ROWS", 70)):
        monkeypatch.setattr(ngram_lm, name, value)
    got = {r["doc_id"]: r for r in ngram_lm.backoff_scores(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    words = {i: t.split() for i, t in texts.items()}
    count = plain_counts(words.values())
    for d, w in words.items():
        assert got[d]["n_words"] == len(w) and got[d]["log_score"] == pytest.approx(plain_backoff(w, count, sum(count[1].values())), rel=1e-9, abs=1e-6)


def test_backoff_scans_texts_few_times_and_shuffles_no_common_ngram(spark, monkeypatch):
    scans, was = [], ngram_lm._weighted

    def weighted(*args):
        scans.append((*args[:3], *(types.SimpleNamespace(value=x.value) for x in args[3:])))  # the broadcasts go after use
        return was(*args)

    monkeypatch.setattr(ngram_lm, "CLASS_BYTES", 100)
    monkeypatch.setattr(ngram_lm, "_weighted", weighted)
    ngram_lm.backoff_scores(spark.createDataFrame([(i, "a b c d " * 9) for i in range(40)], "doc_id long, text string"))
    assert 1 < len(scans) <= 4
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array(["a b c d " * 9] * 2)], names=["key", "text"])
    rows = [r for args in scans for b in was(*args)[0]([batch]) for r in b.to_pylist()]
    assert len(rows) <= 2 * len(scans) and not any(r["weight"] for r in rows)  # every n-gram is common: no row but a sum for each text and class


@pytest.mark.parametrize("order", [2, 3, 4])
def test_backoff_of_a_large_corpus_packs_entries_and_joins_nothing(spark, monkeypatch, order):
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{x}" for x in rng.zipf(1.5, rng.integers(0, 40)) if x < 500)) for i in range(150)]
    rows += [(1, "a"), (1, "a"), (200, "a b"), (None, "b"), (201, None), (202, "w1 w1 w1 w1 w1"), *rows[:9]]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    found = lambda: sorted((tuple(r) for r in ngram_lm.backoff_scores(df, order).collect()), key=key)
    want = found()  # one class, joined

    def no(*_):
        raise AssertionError("of fixed size, so no use for a large corpus")

    for name, value in (("LARGE", 0), ("CLASS_BYTES", 1000), ("HELD", 300), ("PART_ROWS", 400), ("_weighted", no), ("_common", no)):
        monkeypatch.setattr(ngram_lm, name, value)
    assert found() == want


def test_backoff_entries_are_one_for_each_document_of_a_gram():
    asked = types.SimpleNamespace(value=zlib.compress(np.zeros(4, np.int64).tobytes()))
    batch = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array(["a b c d " * 900] * 2)], names=["key", "text"])
    run, _ = ngram_lm._entries(3, 0, 1, asked, 5)
    gram, key, many, weight = ngram_lm._unpacked(run([batch]), ngram_lm._TYPES)
    assert len(gram) == len(set(zip(gram.tolist(), key.tolist(), strict=True))) == 2 * 8
    assert many.sum() == 2 * (3598 + 3599) and weight.sum() == 2 * (3598 - 3597)


def test_backoff_word_hashes_stand_for_words(monkeypatch):
    rng = np.random.default_rng(3)
    parts = ["a", "B", "\0", "é", " ", "\t", "\x0b", "x" * 9, "y" * 33, "\x85", "Z" * 70]
    col = pa.array(["".join(rng.choice(parts, rng.integers(0, 60))) for _ in range(400)] + [None, ""])
    words = [WORD.findall((t or "").translate(LOWER)) for t in col.to_pylist()]
    data, offs = textops.string_buffers(col)
    for block in (1, 64, 1 << 18):
        monkeypatch.setattr(ngram_lm, "BLOCK", block)
        h, ptr = ngram_lm.word_hashes(data, offs)
        assert list(np.diff(ptr)) == list(map(len, words))
        flat = [x for w in words for x in w]
        assert len(set(zip(flat, h.tolist(), strict=True))) == len(set(flat)) == len(set(h.tolist()))
    for n in (1, 2, 3):
        whole = ngram_lm.grams(h, ptr, n)
        parts = [ngram_lm.grams(h, ptr, n, p, 3) for p in range(3)]
        assert sorted(zip(*map(list, whole))) == sorted(x for part in parts for x in zip(*map(list, part)))
        assert len(whole[0]) == sum(max(0, len(w) - n + 1) for w in words)


def test_backoff_of_short_and_repeated_rows(spark):
    rows = [(1, "a"), (1, "a"), (2, "a b"), (3, "a b c"), (4, "a b c"), (5, "b c d a b"), (6, ""), (7, None), (None, "b"), (8, "a"), (8, "b c")]
    words = [(i, (t or "").split()) for i, t in rows]
    count = plain_counts([w for _, w in words])
    got = [(r["doc_id"], r["n_words"], r["log_score"]) for r in ngram_lm.backoff_scores(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    want = [(i, len(w), plain_backoff(w, count, sum(count[1].values()))) for i, w in words]
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=1e-6)


def test_backoff_against_another_corpus(spark, docs, texts):
    got = {r["doc_id"]: r for r in ngram_lm.score_against(docs, docs.where("doc_id % 3 = 0")).collect()}
    words = {i: WORD.findall(t.translate(LOWER)) for i, t in texts.items()}
    count = plain_counts([w for i, w in words.items() if i % 3 == 0])
    for d, w in words.items():
        assert got[d]["n_words"] == len(w) and got[d]["log_score"] == pytest.approx(plain_backoff(w, count, sum(count[1].values())), rel=1e-9, abs=1e-4)


def test_codec_round_trip(spark, texts):
    from tokenizers import Tokenizer

    path = P.path("word_bpe_49k.json")
    t, c = Tokenizer.from_file(path), bpe_codec.ChunkCodec(path)
    odd = ["", " ", "don't DON'T it's", "a b", "İstanbul ſß ŉ", "éé x", "x" * 9000 + " y", "<|endoftext|> hi", "日本語 テスト " * 500, "a b\x1cc", "Σίσυφος ΣΣ", "١٢٣ ½ ²", "the'll 'll '", "😀" * 2000]
    for x in [*odd, *list(texts.values())[:60], *list(texts.values())[:5]]:
        ids = t.encode(x, add_special_tokens=False).ids
        dec = t.decode(ids, skip_special_tokens=False)
        assert c.text(x) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(dec.encode()).hexdigest()), x[:50]
    assert c.reused > 0


def test_packing_is_whole_and_tight(spark, docs, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    out = packing.pack(docs, P.path("byte_bpe_50k.json")).toPandas()
    for d, own in out.groupby("doc_id"):
        ids = np.array([*t.encode(texts[d], add_special_tokens=False).ids, 2], "<u4")
        own = own.sort_values("piece")
        assert own["length"].sum() == len(ids) and (own["start"].to_numpy() == np.cumsum(own["length"]) - own["length"]).all()
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in own.itertuples())
        assert (own["length"].to_numpy()[1:] == 1024).all()
    assert out["sequence_id"].nunique() <= 1.02 * math.ceil(out["length"].sum() / 1024)


def test_search_beats_best_fit_where_that_is_far_off(spark):
    items = np.random.default_rng(1).integers(250, 501, 1500)
    counts, least = np.bincount(items, minlength=1025), -(-int(items.sum()) // 1024)
    plain = len(packing.place([], np.sort(items)[::-1], 1024))
    found = packing.solve(spark, counts, 1024)
    assert sorted(s for b in found for s in b) == sorted(items.tolist()) and max(map(sum, found)) <= 1024
    assert len(found) - least <= 0.5 * (plain - least)


def test_genetic_operators_keep_documents():
    rng = np.random.default_rng(1)
    counts = np.bincount(rng.integers(1, 1000, 300), minlength=1025)
    items = np.repeat(np.arange(1025), counts)
    one, two = packing.place([], rng.permutation(items), 1024), packing.place([], items[::-1], 1024)
    for child in (packing.crossover(one, two, counts, 1024, rng), packing.mutate(one, 1024, rng)):
        assert sorted(s for b in child for s in b) == sorted(items.tolist()) and all(sum(b) <= 1024 for b in child)


def test_vector_links(spark):
    rng = np.random.default_rng(0)
    c = rng.normal(size=(30, 64))
    x = np.vstack([c[rng.integers(0, 30, 500)] + rng.normal(size=(500, 64)) * rng.uniform(0, 0.6, (500, 1)), rng.normal(size=(200, 64))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = vector_dedup.near_vectors(df).toPandas().sort_values("vec_id")
    u = x / np.linalg.norm(x, axis=1)[:, None]
    s = u @ u.T >= 0.9
    np.fill_diagonal(s, False)
    assert (got["n_links"].to_numpy() <= s.sum(axis=1)).all() and got["n_links"].sum() >= 0.97 * s.sum()


def test_search_recall(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 64))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = additive_ann.nearest(df, F.col("vec_id") % 20 == 0).toPandas()
    hit = 0
    for q, own in got.groupby("query_id"):
        s = x @ x[q]
        s[q] = -np.inf
        hit += len(set(own["vec_id"]) & set(np.argsort(-s)[:20]))
        assert np.allclose(own.sort_values("rank")["score"], [x[i] @ x[q] for i in own.sort_values("rank")["vec_id"]], rtol=0, atol=1e-9)
    assert hit >= 0.9 * 20 * got["query_id"].nunique()


def test_many_copies_of_a_vector_tie_to_the_smallest_ids(spark):
    rng = np.random.default_rng(7)
    x = np.vstack([np.repeat(rng.normal(size=(1, 16)), 1500, axis=0), rng.normal(size=(100, 16))])
    ids = rng.permutation(len(x))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>")
    got = additive_ann.nearest(df, F.col("vec_id") % 200 == 0, k=20).toPandas()
    by_id = x[np.argsort(ids)]
    for q, own in got.groupby("query_id"):
        s = (by_id * by_id[q]).sum(axis=1)
        s[q] = -np.inf
        assert own.sort_values("rank")["vec_id"].tolist() == np.lexsort((np.arange(len(s)), -s))[:20].tolist()


def test_search_among_components_of_any_size(spark):
    rng = np.random.default_rng(12)
    x = rng.standard_normal((6000, 24))
    x[17] *= 1e39
    x[18] *= 1e-39
    x[19:25] *= 1e6
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = additive_ann.nearest(df, F.col("vec_id") % 100 == 0, k=20).toPandas()
    hits = []
    for q, own in got.groupby("query_id"):
        s = (x * x[q]).sum(axis=1)
        s[q] = -np.inf
        hits.append(len(set(own["vec_id"]) & set(np.lexsort((np.arange(len(s)), -s))[:20])) / 20)
    assert len(hits) == 60 and np.mean(hits) >= 0.9


def test_passages(spark):
    rng = np.random.default_rng(4)
    word = lambda n: " ".join(f"v{i}" for i in rng.integers(0, 10**6, n))
    shared = [word(70) for _ in range(12)]
    rows, first = [], {}
    for i, p in enumerate(shared):
        for c in range(3):
            rows.append((10 * i + c, word(50) + (" ", "\n", ". ")[c] + p + ("\n", " ", " ")[c] + word(50)))
    clean = [(1000 + i, word(200)) for i in range(10)]
    got = {r["doc_id"]: r for r in passage_dedup.dedup_passages(spark.createDataFrame(rows + clean, "doc_id long, text string")).collect()}
    for i, p in enumerate(shared):
        assert got[10 * i]["n_removed"] == 0
        assert all(0.5 * len(p) < got[10 * i + c]["removed_bytes"] < len(p) + 40 for c in (1, 2))
    assert all(got[i]["text"] == t for i, t in clean)


def test_passages_of_any_length_and_place_go_whole(spark):
    rng = np.random.default_rng(8)
    word = lambda n: " ".join(f"v{i}" for i in rng.integers(0, 10**6, n))
    rows, want = [], {}
    for i in range(300):
        p, sides = word(24 + i % 40), [word(40) for _ in range(4)]
        rows += [(2 * i, f"{sides[0]} {p} {sides[1]}"), (2 * i + 1, f"{sides[2]} {p} {sides[3]}")]
        want |= {2 * i: rows[-2][1], 2 * i + 1: f"{sides[2]} {sides[3]}"}
    got = {r["doc_id"]: r["text"] for r in passage_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_pieces_of_different_documents_are_no_passage(spark):
    line = lambda i: " ".join(f"p{i}w{j}" for j in range(6))
    rows = [(i, f"{line(100 + i)}\n{line(i)}\n{line(200 + i)}") for i in range(20)]
    mosaic = "\n".join(line(i) for i in range(20))
    passage = "\n".join([line(300), line(3), line(301), line(5), line(302)])
    rows += [(50, mosaic), (60, f"{line(400)}\n{passage}\n{line(401)}"), (61, f"{line(500)}\n{passage}\n{line(501)}")]
    got = {r["doc_id"]: r["text"] for r in passage_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got.pop(61) == f"{line(500)}\n{line(501)}"
    assert got == dict(rows[:-1])


def test_near_paragraphs_cluster(spark):
    w = [f"u{i}" for i in range(120)]
    rows = [(i, " ".join(x if j != 7 * i else f"e{i}" for j, x in enumerate(w))) for i in range(4)]
    got = {r["doc_id"]: r["text"] for r in passage_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1] and all(got[i] == "" for i in (1, 2, 3))


def test_paragraph_that_says_twice_what_another_says_once(spark):
    w = [f"u{i}" for i in range(120)]
    twice = " ".join([*w[:60], "else", *w[61:]] * 2)
    rows = [(0, " ".join(w)), (1, twice)]
    got = {r["doc_id"]: r["text"] for r in passage_dedup.dedup_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: rows[0][1], 1: ""}


def test_quality_on_held_out(spark):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    p = quality_rules.quality_scores(d, lab).join(lab, "doc_id").toPandas()
    own = p[p["held_out"]]
    assert len(own) > 50 and (own["predicted"] == own["quality"]).mean() > 0.9
    assert (p["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in p["doc_id"]]).all()


def test_compiled_rules_equal_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.uniform(size=(400, len(quality_rules.STATS)))
    rules, w, b = quality_rules.fit(x, ((x[:, 3] > 0.5) & (x[:, 5] < 0.4)).astype(float))
    assert rules
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{s} double" for s in quality_rules.STATS))
    got = np.array([r[0] for r in df.select(quality_rules.compile_rules(rules, w, b)).collect()])
    assert np.allclose(got, 1 / (1 + np.exp(-(b + sum(v * quality_rules.fires(r, x) for r, v in zip(rules, w, strict=True))))))


def test_toxicity_learns_words_and_windows_cover(spark):
    rng = np.random.default_rng(5)
    text = lambda bad: " ".join("zork" if bad and j % 40 == 20 else f"n{k}" for j, k in enumerate(rng.integers(0, 400, 200)))
    y = np.array([i % 4 == 0 for i in range(200)], float)
    fitted = toxicity.train(*textops.string_buffers(pa.array([text(v) for v in y])), y)
    z = np.array([i % 2 for i in range(60)], float)
    p = toxicity.score(fitted, *textops.string_buffers(pa.array([text(v) for v in z])))
    assert ((p >= 0.5) == (z == 1)).mean() > 0.95
    for n in (0, 1, 24, 25, 100, 1000):
        start, _ = toxicity.windows_of(np.array([0, n]))
        assert set(range(n)) <= {i for s in start for i in range(s, s + toxicity.WINDOW)}


def test_gradients_of_the_network():
    rng = np.random.default_rng(6)
    m = {k: v.astype(np.float64) for k, v in toxicity.new_model(np.zeros(3, np.uint64)).items()}
    vecs = rng.normal(size=(7, toxicity.WORD_DIM + toxicity.CHAR_DIM + toxicity.HEAD_DIM))
    idx, live = rng.integers(0, 7, (4, 6)), (rng.random((4, 6)) < 0.8).astype(float)
    y = np.array([0.0, 1, 1, 0])
    loss = lambda: float(np.mean(-(y * np.log(p := toxicity.sigmoid(toxicity.forward(m, vecs, idx, live))) + (1 - y) * np.log(1 - p))))
    gw, gv, _ = toxicity.gradients(m, vecs, idx, live, y, np.ones(4))
    for name, g, at in [("wf", gw["wf"], (2, 5)), ("ub", gw["ub"], (1, 20)), ("wa", gw["wa"], (3, 2)), ("uf", gw["uf"], (4, 3)), ("va", gw["va"], (1,))]:
        keep = m[name][at]
        m[name][at] = keep + 1e-3
        up = loss()
        m[name][at] = keep - 1e-3
        down = loss()
        m[name][at] = keep
        assert (up - down) / 2e-3 == pytest.approx(float(g[at]), rel=0.05, abs=2e-4)


LAYOUT = [
    ("<p>one<p>two <b>bold</b>   text<br>next", "one\n\ntwo bold text\nnext"),
    ("<ul><li>a<li>b<ol><li>c<li value=7>d</ol><li>e</ul>", "- a\n- b\n  1. c\n  7. d\n- e"),
    ("<table><tr><th>Name<th>Qty<tr><td>apple<td>3<tr><td colspan=2>wide cell here<tr><td>pear<td>12</table>", "Name   Qty\napple  3\nwide cell here\npear   12"),
    ("<table><tr><td rowspan=2>A<td>b<tr><td>c</table>", "A  b\n   c"),
    ("<div style='display: none'>no</div><p hidden>no</p><span style='visibility:hidden'>no<i style='visibility:visible'>yes</i></span>", "yes"),
    ("<head><title>t</title></head>x<script>var a='</p>'</script><!-- c --> &copy; 3 < 4 &amp 5", "x © 3 < 4 & 5"),
    ("<pre>\n  keep   this\n   line</pre>after", "  keep   this\n   line\n\nafter"),
    ("a<table><tr><td>x</table>b", "a\n\nx\n\nb"),
    ("<blockquote>q<p>r</blockquote>", "  q\n\n  r"),
]


@pytest.mark.parametrize("source,want", LAYOUT)
def test_layout(source, want):
    assert html_layout.render(source) == want


DRAWN = [
    ("<p>area is <math><mi>x</mi><mo>=</mo><mn>3</mn></math></p>", "area is x=3"),
    ("<p>sum <math><semantics><mi>y</mi><annotation>no</annotation></semantics></math>", "sum y"),
    ("a <svg><title>no</title><desc>no</desc><defs/><style/><path d='M0'/><text>label</text></svg> b", "a label b"),
    ("<select><option>one<option>two</select>", "one\ntwo"),
    ("<textarea>\nkept   as\n  is</textarea>", "kept   as\n  is"),
    ("<video>no</video><noscript>no</noscript><datalist><option>no</datalist>yes", "yes"),
]


@pytest.mark.parametrize("source,want", DRAWN)
def test_text_that_browsers_draw_comes_out(source, want):
    assert html_layout.render(source) == want


@pytest.mark.parametrize("deep", [50, 130, 5000])
def test_hidden_text_and_layout_at_any_depth(deep):
    assert html_layout.render("<font>" * deep + "a<div style='display:none'>no</div><ul><li>b<li>c</ul>") == "a\n\n- b\n- c"
    assert html_layout.render("<div>" * deep + "a<div hidden>no<div>no</div>no</div><b>b</b> c") == "ab c"
    assert html_layout.render("<ul><li>" * deep + "<p>x").strip(" -") == "x"
    assert html_layout.render("<table><tr><td>" * min(deep, 500) + "x<td>y") == "x  y"


def test_all_visible_words_come_out(spark):
    rows = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    for r in rows:
        plain = re.sub(r"(?s)<head>.*?</head>|<script>.*?</script>|<style>.*?</style>|<!--.*?-->|<[^>]*>", " ", r["html"])
        import html

        assert [w for w in html_layout.render(r["html"]).split() if w != "-"] == [w for w in html.unescape(plain).split() if w != "-"]
