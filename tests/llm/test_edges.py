"""Nulls, empties, repeated rows, long texts, clashing columns and empty tables, for every operator over documents."""

import pytest
from pyspark.sql import functions as F

from evigrain.llm import additive_ann, bpe_codec, html_layout, jaccard_join, ngram_lm, packing, passage_dedup, quality_rules, toxicity, vector_dedup

P = pytest.importorskip("public_tokenizers")
WORDS = " ".join(f"w{i % 41}x{i % 7}" for i in range(400))
ROWS = [(1, WORDS), (1, WORDS), (2, WORDS), (None, WORDS), (None, None), (3, None), (4, ""), (5, " \n\t "), (6, "one"), (7, "Ünï 😀 \x00   mixed\nlines\n\nmore"), (8, "long " * 60_000), (9, "y" * 70_000)]
CLASH = ["lang", "fp", "n", "token", "a", "b", "key", "component", "score", "batch", "share", "y", "kind", "doc", "c0", "_0", "upper"]


def docs(spark, rows=ROWS):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return df.select("*", *[F.lit(None if i % 2 else "x").cast("string").alias(c) for i, c in enumerate(CLASH)])


def labels(spark, rows=((1, 1, 0), (2, 0, 1), (2, None, None), (None, 1, 1), (8, 1, 0))):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int").withColumn("text", F.lit("z")).withColumn("score", F.lit(1.0))


BYTE, WORD = (lambda: P.path("byte_bpe_50k.json")), (lambda: P.path("word_bpe_49k.json"))
OPERATORS = {
    "quality": lambda d, s: quality_rules.quality_scores(d, labels(s)),
    "toxicity": lambda d, s: toxicity.toxicity_scores(d, labels(s)),
    "jaccard": lambda d, s: jaccard_join.jaccard_groups(d),
    "passages": lambda d, s: passage_dedup.dedup_passages(d),
    "codec": lambda d, s: bpe_codec.encode_decode(d, WORD()),
    "lm": lambda d, s: ngram_lm.backoff_scores(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_give_one_row_each(spark, name):
    out = OPERATORS[name](docs(spark), spark).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out) == sorted((i is None, i or 0) for i, _ in ROWS)


@pytest.mark.parametrize("name", [*OPERATORS, "packing"])
def test_empty_table(spark, name):
    run = OPERATORS.get(name) or (lambda d, s: packing.pack(d, BYTE()))
    assert run(docs(spark, []), spark).count() == 0


def test_packing_of_odd_rows(spark):
    out = packing.pack(docs(spark), BYTE()).collect()
    pieces = {}
    for r in out:
        pieces.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in pieces.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(r["doc_id"] == 4 for r in out) == 1 and sum(r["doc_id"] is None for r in out) >= 2


def test_stages_keep_columns_and_rows(spark):
    d = docs(spark)
    assert quality_rules.good_documents(d, labels(spark, [])).columns == d.columns
    assert toxicity.clean_documents(d, labels(spark, [])).count() == len(ROWS)
    kept = jaccard_join.one_of_each(d)
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [1, 3, 4, 5, 6, 7, 8, 9]
    cut = passage_dedup.dedup_table(d)
    assert cut.columns == d.columns and cut.count() == len(ROWS)


VECTORS = [(0, [1.0, 0.0, 0.0]), (0, [1.0, 0.0, 0.0]), (20, [0.99, 0.05, 0.0]), (2, [0.0, 1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0, 0.0]), (6, [float("nan"), 1.0, 0.0]), (7, [None, 1.0, 0.0]), (8, [1e300, 0.0, 0.0]), (9, [1e-300, 0.0, 0.0]), (None, [1.0, 0.0, 0.0]), (40, [0.0, 1.0])]


def vectors(spark, rows=VECTORS):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("keys", F.lit(1)).withColumn("label", F.lit(2)).withColumn("n", F.lit(3))


def test_odd_vectors_link_with_cosine(spark):
    rows = vector_dedup.near_vectors(vectors(spark)).collect()
    assert len(rows) == len(VECTORS)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in rows if r["vec_id"] is not None}
    assert got[0] == (3, 0, True) and got[20] == (3, 0, False) and got[8][1] == got[9][1] == 0
    assert all(got[i] == (0, i, True) for i in (2, 3, 4, 5, 6, 7, 40))


def test_odd_vectors_are_left_out_of_search(spark):
    rows = additive_ann.nearest(vectors(spark), F.col("vec_id") % 20 == 0).collect()
    assert {r["query_id"] for r in rows} == {0, 20}
    assert [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == 0] == [8, 20, 9, 2]


def test_no_vectors(spark):
    assert vector_dedup.near_vectors(vectors(spark, [])).count() == 0
    assert additive_ann.nearest(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_pages(spark):
    rows = [(1, None), (1, ""), (None, "<p>x"), (2, "<script>no</script>"), (3, "<td>a<td>b" * 3000), (4, "<div>" * 3000 + "deep")]
    df = spark.createDataFrame(rows, "page_id long, html string").withColumn("text", F.lit("q")).withColumn("n_chars", F.lit(1))
    got = [(r["page_id"], r["text"]) for r in html_layout.extract(df).collect()]
    assert (1, None) in got and (1, "") in got and (None, "x") in got and (2, "") in got and (4, "deep") in got and len(got) == 6
    assert html_layout.extract(df.limit(0)).count() == 0
