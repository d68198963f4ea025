"""The corpus pipeline, its stages against brute force; toxicity on held-out labels; the bound by bit maps."""

import collections

import numpy as np
import pytest

from evigrain.llm import buckets, queries
from test_exact import DATA, roots, shingles

P = pytest.importorskip("public_tokenizers")


def test_stages_against_brute_force(spark):
    import corpus_pipeline as c

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stages, rows = dict(c.STAGES), [docs]
    for name, stage in c.STAGES:
        rows.append(c.base.stored(stage(spark, rows[-1], DATA), f"test-{name}")[0])
    texts = [{r["doc_id"]: r["text"] for r in df.collect()} for df in rows[:5]]
    first, good, clean, single, cut = texts
    assert list(stages) == ["quality", "toxicity", "near_copies", "passages", "packing"]
    assert all(df.columns == docs.columns for df in rows[:5]) and set(clean) <= set(good) <= set(first)
    sets = {i: shingles(t, 5) for i, t in clean.items()}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    top = roots(ids, links)
    assert set(single) == {i for i in ids if top[i] == i}
    # no run of 24 words is left in a later document that an earlier one has
    assert set(cut) == set(single)
    seen = {}
    for i in sorted(single):
        w = (single[i] or "").lower().split()
        for run in set(zip(*[w[j:] for j in range(24)])):
            seen.setdefault(run, i)
    for i, t in cut.items():
        w = (t or "").lower().split()
        before = (single[i] or "").lower()
        assert len(w) <= len(before.split())
        if t == single[i]:
            assert all(seen[run] == i for run in zip(*[w[j:] for j in range(24)]))
    pieces = rows[5].collect()
    assert {r["doc_id"] for r in pieces} == set(cut)
    fill = collections.defaultdict(list)
    for r in pieces:
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in fill.values():
        ends = np.cumsum([n for _, n in sorted(parts)])
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 1024


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [(labels[r["doc_id"]], r["predicted"]) for r in queries.op6_toxicity(spark, sf).collect() if r["held_out"] and labels.get(r["doc_id"]) is not None]
    assert len(got) > 50 and np.mean([a == b for a, b in got]) >= 0.9


def test_bit_maps_never_say_more_than_sets():
    rng = np.random.default_rng(3)
    pool = rng.integers(0, 2**63, 400).astype(np.uint64)
    sets = [np.unique(rng.choice(pool, n)) for n in (1, 5, 40, 90, 200, 300)]
    maps = buckets.bit_maps(sets)
    for a, x in zip(sets, maps, strict=True):
        for b, y in zip(sets, maps, strict=True):
            apart = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
            assert apart <= len(set(a.tolist()) ^ set(b.tolist()))
