"""Gates, alignment, repairs and reviews on hand-made records."""

import pytest
from pyspark.sql import functions as F

from evigrain.config import Config, Deduplication, Generation
from evigrain.functions import geometry, graph
from evigrain.operators import gates, select

BOX = "struct<x0:double,y0:double,x1:double,y1:double>"
NODE = f"struct<id:string,page:int,bbox:{BOX},role:string,excerpt:string,key:boolean>"
GRAPH = f"struct<nodes:array<{NODE}>,operations:array<struct<op:string,inputs:array<string>,output:string>>,final_output:string>"
SCHEMA = f"""sample_id string, document_id string, document_view_id string, input_profile string, prompt string, primary_evidence_type string,
requires_visual_evidence boolean, supported_input_profiles array<string>, capability_axes array<string>, graph {GRAPH},
claims array<struct<claim_id:string,text:string,supported_by:array<string>>>, derivations array<struct<result_claim:string,expression:string,inputs:array<string>>>,
rubric array<struct<criterion_id:string,criterion:string,criterion_type:string,severity:string,supported_by:array<string>>>,
page_count int, empty_pages array<int>, view_id string, view_pages array<int>,
pages array<struct<page_number:int,extracted_text:string,blocks:array<struct<block_id:string,bbox:{BOX},text:string,reading_order:int>>>>"""


def node(i, page=1, box=(0.1, 0.1, 0.4, 0.2), role="base_value", excerpt="revenue 100", key=True):
    return (i, page, box, role, excerpt, key)


def row(**change):
    out = dict(
        sample_id="s1", document_id="d1", document_view_id="v1", input_profile="multimodal", prompt="How much (a) is left and (b) why?", primary_evidence_type="structured_layout",
        requires_visual_evidence=True, supported_input_profiles=["multimodal"], capability_axes=["standard_table_parsing", "cross_referencing"],
        graph=([node("e1"), node("e2", 2, role="footnote", excerpt="less 10 units")], [("join", ["e1", "e2"], "o1"), ("calculate", ["o1"], "o2")], "o2"),
        claims=[("c1", "leaves 90", ["e1"])], derivations=[("c1", "100 - 10", ["e1"])],
        rubric=[("r1", "says 90", "primary_intent", "major", ["c1"]), ("r2", "ignores the footnote", "dodged_bullet", "major", ["e2"])],
        page_count=2, empty_pages=[], view_id="v1", view_pages=[1, 2],
        pages=[(1, "revenue 100 in total", [("b1", (0.1, 0.1, 0.5, 0.2), "revenue 100", 0), ("b2", (0.1, 0.5, 0.5, 0.6), "in total", 1)]), (2, "less 10 units", [("b3", (0.1, 0.7, 0.5, 0.8), "less 10 units", 0)])],
    )
    return tuple((out | change).values())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows) or [row()], SCHEMA)


def failed(df):
    return set(df.select(F.explode("checks").alias("c")).where("not c.passed").select("c.check").toPandas()["check"])


def test_valid_candidate_passes_fourteen_checks(spark):
    out = gates.static_verify(frame(spark)).first()
    assert out["static_checks_passed"] and len(out["checks"]) == 14 and all(c["details"] is None for c in out["checks"])
    assert len(gates.static_verify(frame(spark, row(view_id=None, view_pages=None))).first()["checks"]) == 12


@pytest.mark.parametrize(
    "change,names",
    [
        ({"input_profile": "text_only"}, {"generation_profile_supported", "text_only_visibility"}),
        ({"page_count": 1}, {"evidence_pages_in_range"}),
        ({"view_pages": [1]}, {"evidence_pages_in_document_view"}),
        ({"document_view_id": "other"}, {"document_view_id_matches"}),
        ({"claims": [("c1", "t", ["c2"]), ("c2", "t", ["c1"])]}, {"claims_resolve_to_evidence", "rubric_covers_all_gold_claims"}),
        ({"claims": [("c1", "t", ["nowhere"])]}, {"claims_resolve_to_evidence"}),
        ({"claims": [("c1", "t", ["c2"]), ("c2", "t", ["e1"])]}, {"rubric_covers_all_gold_claims"}),
        ({"derivations": [("c9", "1", ["e1"])]}, {"derivation_claims_exist"}),
        ({"rubric": [("r1", "x", "primary_intent", "m", ["c1"]), ("r1", "y", "supporting", "m", ["zz"])]}, {"rubric_references_exist", "rubric_ids_unique", "has_dodged_bullet"}),
        ({"capability_axes": ["cross_referencing"]}, {"gdp_like_structural_gate"}),
    ],
)
def test_each_check(spark, change, names):
    assert failed(gates.static_verify(frame(spark, row(**change)))) == names


def test_text_only_pages_need_text(spark):
    out = gates.static_verify(frame(spark, row(input_profile="text_only", supported_input_profiles=["text_only"], requires_visual_evidence=False, empty_pages=[2])))
    assert failed(out) == {"text_only_evidence_has_extracted_text"}


def test_structural_reasons(spark):
    g = ([node("e1"), node("e2", key=True)], [("lookup", ["e1"], "o1")], "o1")
    out = gates.structural_gate(frame(spark, row(graph=g))).first()["structural_gate"]
    assert not out["passed"] and out["reasons"] == ["insufficient_dependent_operations", "lookup_only", "missing_controlling_evidence", "key_evidence_not_connected_to_final_output"]


def test_graph_errors(spark):
    g = ([node("e1"), node("e1")], [("join", ["e1", "o2"], "o1"), ("join", ["o1"], "o1")], "o9")
    out = frame(spark, row(graph=g)).select(graph.graph_errors(F.col("graph")).alias("e")).first()["e"]
    assert out == ["repeated_node_id", "undefined_input:o2", "repeated_output:o1", "undefined_final_output"]


def test_alignment_states_and_suggestions(spark):
    nodes = [node("ok"), node("off", 1, (0.6, 0.8, 0.9, 0.9), excerpt="revenue 100"), node("none", 1, excerpt=None), node("gone", 9), node("ocr", 1, excerpt="quite another sentence"), node("fig", 1, excerpt="Figure 3 shows")]
    df = gates.repair_suggestions(gates.alignment(frame(spark, row(graph=(nodes, [("join", ["ok"], "o1")], "o1")))))
    out = df.first()
    assert [a["status"] for a in out["alignments"]] == ["aligned", "misaligned", "not_checkable_no_excerpt", "missing_page", "not_checkable_visual_or_ocr", "not_checkable_visual_or_ocr"]
    off, gone = out["suggestions"]
    assert off["confidence"] == "high" and off["matched_block_ids"] == ["b1"] and tuple(off["suggested_bbox"]) == (0.1, 0.1, 0.5, 0.2)
    assert gone["confidence"] == "none" and gone["suggested_bbox"] is None


def repaired(spark, decision, box=None, reviewer="ann", moved=False):
    df = frame(spark, row(graph=([node("e1", box=(0.6, 0.8, 0.9, 0.9))], [("join", ["e1"], "o1")], "o1")))
    df = gates.repair_suggestions(gates.alignment(gates.static_verify(df))).withColumn("independent_verifier_status", F.lit("passed"))
    if moved:
        df = df.withColumn("graph", F.col("graph").withField("nodes", F.transform("graph.nodes", lambda n: n.withField("bbox", geometry.box(*[F.lit(x) for x in (0.0, 0.0, 0.1, 0.1)])))))
    kind = f"array<struct<node_id:string,decision:string,reviewer:string,accepted_bbox:{BOX}>>"
    d = spark.createDataFrame([([("e1", decision, reviewer, box)],)], f"decisions {kind}")
    return gates.apply_repairs(df.crossJoin(d))


def test_repairs(spark):
    out = repaired(spark, "accepted").first()
    assert tuple(out["graph"]["nodes"][0]["bbox"]) == (0.1, 0.1, 0.5, 0.2) and out["checks"][-1]["passed"] and out["independent_verifier_status"] == "not_run"
    out = repaired(spark, "pending").first()
    assert tuple(out["graph"]["nodes"][0]["bbox"]) == (0.6, 0.8, 0.9, 0.9) and not out["checks"][-1]["passed"] and out["independent_verifier_status"] == "passed"
    for bad in (dict(decision="accepted", reviewer=" "), dict(decision="maybe"), dict(decision="accepted", moved=True)):
        with pytest.raises(Exception, match="reviewer|invalid|stale"):
            repaired(spark, **bad).collect()


REVIEW = "struct<decision:string,reviewer:string,reviewer_type:string,checklist:map<string,boolean>,rubric_overrides:array<struct<criterion_id:string,criterion:string,severity:string,reason:string>>>"
ALL = {k: True for k in ("question_unambiguous", "gold_answer_verified", "rubric_negative_cases_verified", "derivations_verified", "visual_evidence_verified")}


def final(spark, review=("approved", "ann", "human", ALL, None), **over):
    df = gates.alignment(gates.static_verify(frame(spark, row(graph=([node("e1"), node("e2", 2, (0.1, 0.7, 0.4, 0.8), "footnote", "less 10 units")], [("join", ["e1", "e2"], "o1"), ("calculate", ["o1"], "o2")], "o2")))))
    base = {"license_status": "approved", "source_url": "https://x.org/a", "package_fits": True, "package_view_id": "v1", "view_scope": "full_pdf", "independent_verifier_status": "passed"} | over
    for k, v in base.items():
        df = df.withColumn(k, F.lit(v))
    r = spark.createDataFrame([(review,)], f"review {REVIEW}")
    df = df.withColumn("derivation_status", F.transform("derivations", lambda d: F.lit(over.get("derived", "verified")))).crossJoin(r)
    return gates.finalize(gates.apply_rubric_overrides(df))


def test_finalize(spark):
    assert final(spark).first()["final_validation_status"] == "passed"
    assert final(spark, ("approved", "ann", "human", ALL | {"gold_answer_verified": False}, None)).first()["final_validation_status"] == "needs_review"
    assert final(spark, ("rejected", "ann", "human", ALL, None)).first()["human_review_status"] == "rejected"
    assert final(spark, license_status="rejected").first()["final_validation_status"] == "failed"
    assert final(spark, derived="mismatch").first()["final_validation_status"] == "failed"
    assert final(spark, independent_verifier_status="needs_review").first()["final_validation_status"] == "needs_review"


def test_overrides(spark):
    out = final(spark, ("approved", "ann", "human", ALL, [("r1", None, "minor", "too strict")])).first()
    assert out["rubric"][0]["severity"] == "minor" and out["rubric_overrides"][0]["original_severity"] == "major"
    for bad in ([("r9", "x", None, "y")], [("r1", None, "minor", " ")], [("r1", None, "major", "y")]):
        with pytest.raises(Exception, match="override"):
            final(spark, ("approved", "ann", "human", ALL, bad)).collect()
    with pytest.raises(Exception, match="approved human"):
        final(spark, ("pending", "ann", "human", ALL, [("r1", "x", None, "y")])).collect()


def test_reconstruction_errors(spark):
    df = spark.createDataFrame([("(a) x (b) y", "(A) " + "z" * 300, "stop"), ("(a) x (b) y", "(a) (b)", "length"), ("(a)", "q" * 300, None)], "p string, a string, f string")
    got = [r[0] for r in df.select(gates.reconstruction_errors(F.col("p"), F.col("a"), F.col("f"))).collect()]
    assert got == [["missing_labels"], ["finish_reason", "answer_too_short"], []]


def test_policy_errors(spark):
    df = frame(spark).withColumn("required_type", F.lit("text_reasoning"))
    hard = Config(generation=Generation(target_difficulty="hard"))
    assert gates.batch_policy_errors(df, hard).first()["policy_errors"] == ["primary_evidence_type", "too_few_evidence_nodes", "too_few_operations"]


def test_selection_keeps_other_types_and_caps(spark):
    def task(i, kind, page, prompt, score):
        return ("d", i, kind, score, prompt, ([node(f"{i}n", page, (0.1, 0.1, 0.4, 0.4))], [("join", ["x"], "y")], "y"), True)

    rows = [task("a", "t1", 1, "alpha beta", 0.9), task("b", "t1", 1, "alpha beta", 0.8), task("c", "t2", 5, "gamma", 0.5), task("e", "t1", 7, "delta", 0.7), task("f", "t1", 8, "eps", 0.6)]
    df = spark.createDataFrame(rows, f"document_id string, sample_id string, primary_evidence_type string, structural_score double, prompt string, graph {GRAPH}, static_checks_passed boolean")
    got = {r["sample_id"]: (r["status"], r["matched_sample_id"]) for r in select.select_diverse(df, Deduplication()).collect()}
    assert got == {"a": ("selected", None), "c": ("selected", None), "b": ("rejected_duplicate", "a"), "e": ("selected", None), "f": ("rejected_document_cap", None)}


def test_region_match_is_greedy_and_one_to_one(spark):
    left = [node("a", 1, (0.0, 0.0, 0.4, 0.4)), node("b", 1, (0.0, 0.0, 0.4, 0.4)), node("c", 2)]
    right = [node("x", 1, (0.0, 0.0, 0.4, 0.4)), node("y", 3)]
    df = spark.createDataFrame([(left, right), ([], [])], f"l array<{NODE}>, r array<{NODE}>")
    assert [r[0] for r in df.select(select.region_jaccard(F.col("l"), F.col("r"), 0.3)).collect()] == [0.25, 1.0]


def test_region_match_works_out_each_part_once(spark):
    sides = F.col("l"), F.transform("r", lambda x: x.withField("mark", F.lit("once")))
    said = str(select.region_jaccard(*sides, 0.3))
    assert said.count("once") == 1 and said.count("array_max") == 1


def test_a_page_is_found_by_its_place_and_hashed_once(spark):
    from evigrain.plans import derived

    plan = derived.candidates(spark, "/root/testdata/sf0.001", False).select("graph.nodes")._jdf.queryExecution().analyzed().toString()
    assert plan.count("filter(pages") == 1  # that for empty pages
    assert plan.count(":p:") == 1


def test_selection_compares_a_candidate_with_those_that_stay_only(spark, monkeypatch):
    n, seen = 60, spark.sparkContext.accumulator(0)

    @F.udf("array<string>")
    def alike(a, b):
        if b is not None:
            seen.add(1)
        return ["same"] if b is not None and a["tokens"] == b["tokens"] else []

    monkeypatch.setattr(select, "why_alike", lambda a, b, _: alike(a, b))
    rows = [("d" if i % 2 else None, f"s{i:02}", "t", 1.0 - i / 100, f"word{i % 7}" if i % 2 else "same", ([], [], "y"), True) for i in range(2 * n)]
    df = spark.createDataFrame(rows, f"document_id string, sample_id string, primary_evidence_type string, structural_score double, prompt string, graph {GRAPH}, static_checks_passed boolean")
    got = {r["sample_id"]: (r["status"], r["matched_sample_id"], r["reasons"]) for r in select.select_diverse(df, Deduplication()).collect()}
    assert len(got) == 2 * n and [i for i, x in got.items() if x[0] == "selected"] and seen.value <= 2 * n * Deduplication().max_tasks_per_document
    assert got["s00"] == ("selected", None, []) and all(got[f"s{i:02}"] == ("rejected_duplicate", "s00", ["same"]) for i in range(2, 2 * n, 2))
    assert [i for i, x in sorted(got.items()) if x[0] == "selected"] == ["s00", "s01", "s03", "s05"] and got["s07"] == ("rejected_document_cap", None, ["max_tasks_per_document"])


def test_tokens_are_counted_by_slices_of_bounded_size(monkeypatch):
    import sys
    import types

    import pandas as pd

    most = []

    class Tokenizer:
        def encode_batch(self, texts, add_special_tokens):
            most.append(sum(map(len, texts)) if len(texts) > 1 else 0)
            return [types.SimpleNamespace(ids=list(x.split())) for x in texts]

    monkeypatch.setitem(sys.modules, "tokenizers", types.SimpleNamespace(Tokenizer=types.SimpleNamespace(from_file=lambda _: Tokenizer())))
    texts = ["a b " * n for n in (1, 40_000, 90_000, 3, 0, 60_000, 2)] * 9 + [None]
    got = [n for s in select.count_tokens("x").func(iter([pd.Series(texts), pd.Series([], dtype=str)])) for n in s]
    assert got == [len((x or "").split()) for x in texts] and max(most) <= 1 << 18
