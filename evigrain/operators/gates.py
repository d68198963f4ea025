"""Gates over candidates with nested columns.

A candidate row has sample_id, document_id, document_view_id, input_profile, supported_input_profiles,
requires_visual_evidence, capability_axes, graph struct<nodes,operations,final_output>, claims,
derivations and rubric; `flattened` makes one of a generated record. Gates add columns and never move rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evigrain.config import Config, Difficulty, Verification
from evigrain.constants import CONTROLLING_ROLES, TIER_2_AXES, TIER_3_AXES
from evigrain.functions import budget, geometry, graph, text
from evigrain.functions.checks import all_passed, check, passed_or_absent, reasons, replaced, replaced_all

FLAT = ("sample_id", "document_id", "document_view_id", "input_profile")
TASK = ("prompt", "gold_answer", "primary_evidence_type", "requires_visual_evidence", "supported_input_profiles", "capability_axes", "claims", "derivations")


def flattened(df: DataFrame, candidate: str = "candidate") -> DataFrame:
    """The columns that gates read, beside what df has, from a generated record in `candidate`."""
    c = F.col(candidate)
    return df.select("*", *[c[n].alias(n) for n in FLAT], *[c["task"][n].alias(n) for n in TASK], c["task"]["evidence_graph"].alias("graph"), c["rubric"].alias("rubric"))


def in_set(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def ids_of(items: Column, name: str) -> Column:
    return F.transform(items, lambda x: x[name])


def let(value: Column, use) -> Column:
    """use(value) with value computed once: the optimiser does not share subexpressions inside lambdas."""
    return F.get(F.transform(F.array(value), use), 0)


def features(df: DataFrame) -> DataFrame:
    """df with `features`, the counts that structural decisions rest on."""
    g = F.col("graph")
    return df.withColumn(
        "features",
        F.struct(
            F.size(g["nodes"]).alias("evidence_node_count"),
            F.size(g["operations"]).alias("dependent_operation_count"),
            F.size(F.filter(g["operations"], lambda o: o["op"] != "lookup")).alias("non_lookup_operation_count"),
            F.size(F.filter(g["nodes"], lambda n: F.array_contains(in_set(CONTROLLING_ROLES), n["role"]))).alias("controlling_evidence_count"),
            F.size(F.array_intersect("capability_axes", in_set(TIER_2_AXES))).alias("tier_2_axis_count"),
            F.size(F.array_intersect("capability_axes", in_set(TIER_3_AXES))).alias("tier_3_axis_count"),
            F.size(F.array_distinct(ids_of(g["nodes"], "page"))).alias("evidence_page_count"),
            (F.size(graph.disconnected_key_nodes(g)) == 0).alias("all_key_nodes_reach_final"),
        ),
    )


def structural_gate(df: DataFrame, conf: Difficulty | None = None) -> DataFrame:
    """df with `features` and `structural_gate` struct<passed,reasons>."""
    conf = conf or Difficulty()
    f = F.col("features")
    why = reasons(
        ("insufficient_evidence_nodes", f["evidence_node_count"] < conf.minimum_evidence_nodes),
        ("insufficient_dependent_operations", f["dependent_operation_count"] < conf.minimum_dependent_operations),
        ("lookup_only", F.lit(conf.require_non_lookup_operation) & (f["non_lookup_operation_count"] == 0)),
        ("missing_controlling_evidence", F.lit(conf.require_controlling_evidence) & (f["controlling_evidence_count"] == 0)),
        ("missing_tier_2_axis", F.lit(conf.require_tier_2_axis) & (f["tier_2_axis_count"] == 0)),
        ("missing_tier_3_axis", F.lit(conf.require_tier_3_axis) & (f["tier_3_axis_count"] == 0)),
        ("key_evidence_not_connected_to_final_output", ~f["all_key_nodes_reach_final"]),
    )
    out = features(df).withColumn("gate_reasons", why)
    return out.withColumn("structural_gate", F.struct((F.size("gate_reasons") == 0).alias("passed"), F.col("gate_reasons").alias("reasons"))).drop("gate_reasons")


def difficulty(df: DataFrame) -> DataFrame:
    """df (with features) with `structural_score` and `predicted_label`."""
    f = F.col("features")
    tiers = f["tier_2_axis_count"] + f["tier_3_axis_count"]
    score = budget.difficulty_score(f["evidence_node_count"], f["dependent_operation_count"], f["evidence_page_count"], f["controlling_evidence_count"], tiers, F.col("requires_visual_evidence"))
    return df.withColumn("structural_score", score).withColumn("predicted_label", budget.difficulty_label(F.col("structural_score")))


def static_verify(df: DataFrame, conf: Config | None = None) -> DataFrame:
    """df with `checks` and `static_checks_passed`.

    Beside a candidate's columns df has page_count, empty_pages (pages without text) and, for the two checks on the frozen
    view, view_id and view_pages (both null where there is no view; then those checks are left out).
    """
    conf = conf or Config()
    df = structural_gate(df, conf.difficulty)
    g = F.col("graph")
    pages, nodes, claims = ids_of(g["nodes"], "page"), ids_of(g["nodes"], "id"), ids_of(F.col("claims"), "claim_id")
    text_only = F.col("input_profile") == "text_only"
    listed = lambda c: F.array_join(F.array_sort(F.array_distinct(c.cast("array<string>"))), ", ")
    unseen = F.when(text_only, F.array_intersect(pages, F.col("empty_pages"))).otherwise(F.array().cast("array<int>"))
    outside = F.array_except(pages, F.col("view_pages"))
    beyond = F.filter(pages, lambda p: p > F.col("page_count"))
    known = F.concat(nodes, claims)
    loose_claims = F.array_union(graph.unknown_claim_references(F.col("claims"), nodes), F.array_union(graph.ungrounded_claims(F.col("claims"), nodes), graph.circular_claims(F.col("claims"))))
    bad_rubric = ids_of(F.filter("rubric", lambda r: F.size(F.array_except(r["supported_by"], known)) > 0), "criterion_id")
    bad_derived = ids_of(F.filter("derivations", lambda d: ~F.array_contains(claims, d["result_claim"]) | (F.size(F.array_except(d["inputs"], known)) > 0)), "result_claim")
    criteria, kinds = ids_of(F.col("rubric"), "criterion_id"), ids_of(F.col("rubric"), "criterion_type")
    uncovered = F.array_except(claims, F.flatten(ids_of(F.col("rubric"), "supported_by")))
    always = [
        check("generation_profile_supported", F.array_contains("supported_input_profiles", F.col("input_profile")), F.concat(F.lit("unsupported profile "), F.col("input_profile"))),
        check("text_only_visibility", ~(text_only & F.col("requires_visual_evidence")), "text-only task depends on visual evidence"),
        check("text_only_evidence_has_extracted_text", F.size(unseen) == 0, F.concat(F.lit("pages without text: "), listed(unseen))),
    ]
    viewed = [
        check("document_view_id_matches", F.col("document_view_id").eqNullSafe(F.col("view_id")), "another frozen view"),
        check("evidence_pages_in_document_view", F.size(outside) == 0, F.concat(F.lit("pages outside the view: "), listed(outside))),
    ]
    rest = [
        check("evidence_pages_in_range", F.size(beyond) == 0, F.concat(F.lit("pages beyond the document: "), listed(beyond))),
        check("claims_resolve_to_evidence", F.size(loose_claims) == 0, F.concat(F.lit("unresolved: "), listed(loose_claims))),
        check("rubric_references_exist", F.size(bad_rubric) == 0, F.concat(F.lit("unknown references in: "), listed(bad_rubric))),
        check("derivation_claims_exist", F.size(bad_derived) == 0, F.concat(F.lit("unknown references in: "), listed(bad_derived))),
        check("rubric_ids_unique", F.size(F.array_distinct(criteria)) == F.size(criteria), "repeated criterion ids"),
        check("has_dodged_bullet", F.array_contains(kinds, "dodged_bullet"), "no dodged-bullet criterion"),
        check("has_primary_intent", F.array_contains(kinds, "primary_intent"), "no primary-intent criterion"),
        check("rubric_covers_all_gold_claims", F.size(uncovered) == 0, F.concat(F.lit("claims without a criterion: "), listed(uncovered))),
        check("gdp_like_structural_gate", F.col("structural_gate.passed"), F.array_join("structural_gate.reasons", ", ")),
    ]
    every = F.concat(F.array(*always), F.when(F.col("view_pages").isNotNull(), F.array(*viewed)).otherwise(F.filter(F.array(*viewed), lambda _: F.lit(False))), F.array(*rest))
    return df.withColumn("checks", every).withColumn("static_checks_passed", all_passed(F.col("checks")))


def carried_forward(new: DataFrame, old: DataFrame) -> DataFrame:
    """new with `independent_` checks and statuses of old rows whose candidate is the same struct."""
    o = old.select(F.col("candidate").alias("old_candidate"), F.col("checks").alias("old_checks"), F.col("independent_verifier_status").alias("old_status"), F.col("candidate.sample_id").alias("old_id"))
    same = (F.col("candidate.sample_id") == F.col("old_id")) & F.col("candidate").eqNullSafe(F.col("old_candidate"))
    kept = F.filter("old_checks", lambda c: F.startswith(c["check"], F.lit("independent_")))
    out = new.join(o, same, "left").withColumn("checks", F.when(F.col("old_id").isNotNull(), F.concat("checks", kept)).otherwise(F.col("checks")))
    return out.withColumn("independent_verifier_status", F.coalesce("old_status", F.lit("not_run"))).drop("old_candidate", "old_checks", "old_status", "old_id")


def alignment(df: DataFrame, conf: Verification | None = None) -> DataFrame:
    """df (graph, pages, requires_visual_evidence) with `alignments`, one struct for each evidence node."""
    conf = conf or Verification()
    pages = F.col("pages")

    def one(n: Column) -> Column:
        page = F.get(F.filter(pages, lambda p: p["page_number"] == n["page"]), 0)
        blocks = F.filter(page["blocks"], lambda b: geometry.intersect(n["bbox"], b["bbox"]))
        inside = F.array_join(F.transform(blocks, lambda b: F.coalesce(b["text"], F.lit(""))), "\n")
        want = text.alignment_tokens(n["excerpt"])
        on_page, on_box = text.coverage(want, text.alignment_tokens(page["extracted_text"])), text.coverage(want, text.alignment_tokens(inside))
        matches = on_page >= conf.audit_bbox_min_page_token_coverage
        near = on_box >= on_page * conf.audit_bbox_min_relative_token_coverage
        empty = F.coalesce(n["excerpt"], F.lit("")) == ""
        status = (
            F.when(page.isNull(), "missing_page")
            .when(empty, "not_checkable_no_excerpt")
            .when(F.col("requires_visual_evidence") & text.is_figure_caption(n["excerpt"]), "not_checkable_visual_or_ocr")
            .when(matches & near, "aligned")
            .when(matches, "misaligned")
            .otherwise("not_checkable_visual_or_ocr")
        )
        shown = lambda c: F.when(page.isNull(), F.lit(0.0)).when(empty, F.lit(None).cast("double")).otherwise(F.round(c, 4))
        hit = F.when(page.isNull() | empty, F.array().cast("array<string>")).otherwise(F.transform(blocks, lambda b: b["block_id"]))
        return F.struct(n["id"].alias("node_id"), n["page"].alias("page_number"), status.alias("status"), shown(on_page).alias("page_token_coverage"), shown(on_box).alias("bbox_token_coverage"), hit.alias("intersecting_block_ids"))

    return df.withColumn("alignments", F.transform(F.col("graph.nodes"), one))


def repair_suggestions(df: DataFrame, conf: Verification | None = None) -> DataFrame:
    """df (graph, pages, alignments) with `suggestions` for misaligned nodes and missing pages; nothing is changed.

    Of all windows of one to audit_bbox_repair_max_blocks consecutive blocks with text the best by score, coverage and
    shortness is taken, the first in reading order where they tie.
    """
    conf = conf or Verification()
    pages = F.col("pages")

    def one(a: Column) -> Column:
        node = F.get(F.filter(F.col("graph.nodes"), lambda n: n["id"] == a["node_id"]), 0)
        page = F.get(F.filter(pages, lambda p: p["page_number"] == a["page_number"]), 0)
        usable = F.coalesce(F.filter(page["blocks"], lambda b: ~text.is_blank(b["text"])), F.array().cast("array<struct<block_id:string,bbox:struct<x0:double,y0:double,x1:double,y1:double>,text:string,reading_order:int>>"))
        blocks = F.array_sort(F.transform(usable, lambda b: F.struct(b["reading_order"].cast("int").alias("reading_order"), b["block_id"].alias("block_id"), b["bbox"].alias("bbox"), b["text"].alias("text"))), lambda x, y: x["reading_order"] - y["reading_order"])
        lost = page.isNull() | (F.coalesce(node["excerpt"], F.lit("")) == "")
        return let(F.struct(node.alias("node"), F.coalesce(lost, F.lit(True)).alias("lost"), blocks.alias("blocks"), text.alignment_tokens(node["excerpt"]).alias("want")), lambda k: suggest(a, k))

    def suggest(a: Column, k: Column) -> Column:
        n = F.size(k["blocks"])

        def scored(part: Column, start: Column, size: Column) -> Column:
            seen = text.alignment_tokens(F.array_join(F.transform(part, lambda b: b["text"]), "\n"))
            counts = let(seen, lambda v: F.struct(F.size(F.array_intersect(k["want"], v)).alias("both"), F.size(v).alias("seen")))

            def window(c: Column) -> Column:
                cover, precise = text.ratio(c["both"], F.size(k["want"]), 0.0), text.ratio(c["both"], c["seen"], 0.0)
                return F.struct(budget.repair_score(cover, precise, size).alias("score"), cover.alias("coverage"), (-size).alias("short"), (-start).alias("first"))

            return let(counts, window)

        starts = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
        sizes = lambda s: F.sequence(F.lit(1), F.least(F.lit(conf.audit_bbox_repair_max_blocks), n - s + 1))
        every = F.flatten(F.transform(starts, lambda s: F.transform(sizes(s), lambda z: scored(F.slice(k["blocks"], s, z), s, z))))
        return let(F.array_max(every), lambda best: decided(a, k, best))

    def decided(a: Column, k: Column, best: Column) -> Column:
        part = F.slice(k["blocks"], -best["first"], -best["short"])
        gain = best["coverage"] - F.coalesce(a["bbox_token_coverage"], F.lit(0.0))
        lost = k["lost"] | best.isNull()
        ok = F.coalesce(~lost & (best["coverage"] >= conf.audit_bbox_repair_min_token_coverage) & (gain >= conf.audit_bbox_repair_min_improvement), F.lit(False))
        return F.struct(
            a["node_id"].alias("node_id"),
            a["page_number"].alias("page_number"),
            a["status"].alias("alignment_status"),
            k["node"]["bbox"].alias("original_bbox"),
            F.when(ok, geometry.union_of(F.transform(part, lambda b: b["bbox"]))).alias("suggested_bbox"),
            a["bbox_token_coverage"].alias("original_token_coverage"),
            F.when(~lost, F.round(best["coverage"], 4)).alias("suggested_token_coverage"),
            F.when(~lost, F.round(best["score"], 4)).alias("score"),
            F.when(ok, budget.repair_confidence(best["coverage"], gain)).otherwise("none").alias("confidence"),
            F.when(lost, F.array().cast("array<string>")).otherwise(F.transform(part, lambda b: b["block_id"])).alias("matched_block_ids"),
        )

    bad = F.filter("alignments", lambda a: a["status"].isin("misaligned", "missing_page"))
    return df.withColumn("suggestions", F.transform(bad, one))


def apply_repairs(df: DataFrame) -> DataFrame:
    """df (graph, suggestions, decisions) with accepted boxes in the graph, `bbox_repairs`, and the check that all are resolved.

    decisions: array<struct<node_id,decision,reviewer,accepted_bbox>>. An accepted decision without a reviewer or a box, one
    with an unknown state, and one whose node has moved since it was suggested, fail the job.
    """
    g = F.col("graph")
    decision = lambda s: F.get(F.filter("decisions", lambda d: d["node_id"] == s["node_id"]), 0)
    node = lambda s: F.get(F.filter(g["nodes"], lambda n: n["id"] == s["node_id"]), 0)
    refuse = lambda cond, why, s, value: F.when(cond, F.raise_error(F.concat(F.lit(why + " "), F.col("sample_id"), F.lit("/"), s["node_id"])).cast("string")).otherwise(value)

    def state(s: Column) -> Column:
        d = decision(s)
        got = F.coalesce(d["decision"], F.lit("missing_decision"))
        got = refuse(~got.isin("pending", "accepted", "rejected", "missing_decision"), "invalid decision", s, got)
        taken = d["decision"] == "accepted"
        got = refuse(taken & text.is_blank(d["reviewer"]), "accepted repair needs a reviewer", s, got)
        got = refuse(taken & F.coalesce(d["accepted_bbox"], s["suggested_bbox"]).isNull(), "accepted repair needs a box", s, got)
        return refuse(taken & ~node(s)["bbox"].eqNullSafe(s["original_bbox"]), "stale suggestion", s, got)

    judged = F.transform("suggestions", lambda s: F.struct(s["node_id"].alias("node_id"), state(s).alias("state"), s["original_bbox"].alias("original_bbox"), F.coalesce(decision(s)["accepted_bbox"], s["suggested_bbox"]).alias("accepted_bbox"), decision(s)["reviewer"].alias("reviewer")))
    df = df.withColumn("judged", judged)
    applied = F.filter("judged", lambda j: j["state"] == "accepted")
    open_ = F.transform(F.filter("judged", lambda j: j["state"] != "accepted"), lambda j: F.concat_ws(":", j["node_id"], j["state"]))
    box = lambda n: F.coalesce(F.get(F.filter(F.col("bbox_repairs"), lambda j: j["node_id"] == n["id"]), 0)["accepted_bbox"], n["bbox"])
    df = df.withColumn("bbox_repairs", applied).withColumn("unresolved", open_)
    df = df.withColumn("graph", g.withField("nodes", F.transform(g["nodes"], lambda n: n.withField("bbox", box(n)))))
    done = check("bbox_repair_decisions_resolved", F.size("unresolved") == 0, F.concat(F.lit("unresolved: "), F.array_join("unresolved", ", ")))
    df = df.withColumn("checks", replaced(F.col("checks"), done))
    # a row that changed has to be verified anew
    return df.withColumn("independent_verifier_status", F.when(F.size("bbox_repairs") > 0, "not_run").otherwise(F.col("independent_verifier_status"))).drop("judged", "unresolved")


def apply_rubric_overrides(df: DataFrame) -> DataFrame:
    """df (rubric, review) with approved changes of criterion and severity, and `rubric_overrides` for the record.

    review.rubric_overrides: array<struct<criterion_id,criterion,severity,reason>>. Overrides without an approved human
    review, with an unknown or repeated id, without a reason or without effect fail the job.
    """
    r, rows = F.col("review"), F.coalesce(F.col("review.rubric_overrides"), F.array().cast("array<struct<criterion_id:string,criterion:string,severity:string,reason:string>>"))
    own = lambda o: F.get(F.filter("rubric", lambda c: c["criterion_id"] == o["criterion_id"]), 0)
    ids = ids_of(rows, "criterion_id")
    bad = (
        F.when((F.size(rows) > 0) & ~((r["decision"] == "approved") & (r["reviewer_type"] == "human") & ~text.is_blank(r["reviewer"])), "overrides need an approved human review")
        .when(F.size(F.array_distinct(ids)) < F.size(ids), "repeated override")
        .when(F.exists(rows, lambda o: own(o).isNull()), "override of an unknown criterion")
        .when(F.exists(rows, lambda o: text.is_blank(o["reason"])), "override without a reason")
        .when(F.exists(rows, lambda o: F.coalesce(o["criterion"], own(o)["criterion"]).eqNullSafe(own(o)["criterion"]) & F.coalesce(o["severity"], own(o)["severity"]).eqNullSafe(own(o)["severity"])), "override changes nothing")
    )
    done = F.transform(rows, lambda o: F.struct(o["criterion_id"].alias("criterion_id"), own(o)["criterion"].alias("original_criterion"), F.coalesce(o["criterion"], own(o)["criterion"]).alias("updated_criterion"), own(o)["severity"].alias("original_severity"), F.coalesce(o["severity"], own(o)["severity"]).alias("updated_severity"), F.trim(r["reviewer"]).alias("reviewer"), F.trim(o["reason"]).alias("reason")))
    df = df.withColumn("rubric_overrides", F.when(bad.isNotNull(), F.raise_error(F.concat_ws(": ", F.col("sample_id"), bad)).cast("array<struct<criterion_id:string,original_criterion:string,updated_criterion:string,original_severity:string,updated_severity:string,reviewer:string,reason:string>>")).otherwise(done))
    change = lambda c: F.get(F.filter("rubric_overrides", lambda o: o["criterion_id"] == c["criterion_id"]), 0)
    return df.withColumn("rubric", F.transform("rubric", lambda c: c.withField("criterion", F.coalesce(change(c)["updated_criterion"], c["criterion"])).withField("severity", F.coalesce(change(c)["updated_severity"], c["severity"]))))


def finalize(df: DataFrame, conf: Config | None = None) -> DataFrame:
    """df with final checks, human_review_status, final_validation_status and eligible_for_difficulty.

    Beside a statically verified candidate df has: license_status and source_url (null without a document),
    package_fits and package_view_id (null without a package), view_scope (null without a view), alignments,
    independent_verifier_status, derivation_status array<string>, and review struct<decision,reviewer,reviewer_type,checklist map<string,boolean>>.
    """
    conf = conf or Config()
    r = F.col("review")
    decision = F.coalesce(r["decision"], F.lit("pending"))
    item = lambda name: F.coalesce(F.try_element_at(r["checklist"], F.lit(name)), F.lit(False))
    needed = item("question_unambiguous") & item("gold_answer_verified") & item("rubric_negative_cases_verified")
    needed = needed & ((F.size("derivations") == 0) | item("derivations_verified")) & (~F.col("requires_visual_evidence") | item("visual_evidence_verified"))
    needed = needed & (~F.coalesce(F.col("view_scope") == "bounded", F.lit(False)) | item("omitted_page_audit_verified"))
    complete = F.coalesce((decision == "approved") & ~text.is_blank(r["reviewer"]) & (r["reviewer_type"] == "human") & needed, F.lit(False))
    forbidden = F.lit(False)
    for marker in conf.security.forbidden_source_substrings:
        forbidden = forbidden | F.contains(F.lower("source_url"), F.lit(marker.lower()))
    source = F.coalesce((F.col("license_status") == "approved") & ~forbidden, F.lit(False))
    package = F.coalesce(F.col("package_fits") & F.col("document_view_id").eqNullSafe(F.col("package_view_id")), F.lit(False))
    view = F.coalesce((F.col("view_scope") == "full_pdf") | (F.col("view_scope").isNotNull() & complete & item("omitted_page_audit_verified")), F.lit(False))
    bad = F.exists("alignments", lambda a: a["status"].isin("misaligned", "missing_page"))
    unknown = F.exists("alignments", lambda a: F.startswith(a["status"], F.lit("not_checkable")))
    boxes = ~bad & (~unknown | (complete & item("visual_evidence_verified"))) & passed_or_absent(F.col("checks"), "bbox_repair_decisions_resolved")
    mismatch, open_ = F.array_contains("derivation_status", "mismatch"), F.array_contains("derivation_status", "not_checkable")
    derived = ~mismatch & (~open_ | (complete & item("derivations_verified")))
    kinds, claims = ids_of(F.col("rubric"), "criterion_type"), ids_of(F.col("claims"), "claim_id")
    structure = F.array_contains(kinds, "primary_intent") & F.array_contains(kinds, "dodged_bullet") & (F.size(F.array_except(claims, F.flatten(ids_of(F.col("rubric"), "supported_by")))) == 0)
    final = F.array(
        check("final_source_and_license", source, "source or license missing, rejected or forbidden"),
        check("final_input_package", package, "input package missing, of another view or over budget"),
        check("final_document_view_audit", view, "view missing, or bounded without an approved audit of its omitted pages"),
        check("final_independent_gold_verification", F.col("independent_verifier_status") == "passed", F.concat(F.lit("verifier: "), F.col("independent_verifier_status"))),
        check("final_evidence_bbox_alignment", boxes, "boxes misaligned, unchecked or with open repairs"),
        check("final_deterministic_derivations", derived, "derivations wrong or unchecked"),
        check("final_rubric_unit_review", structure & complete & item("rubric_negative_cases_verified"), "rubric incomplete or not reviewed"),
        check("final_human_review", complete, F.concat(F.lit("decision: "), decision)),
    )
    fatal = ~F.col("static_checks_passed") | ~source | mismatch | ~structure | (decision == "rejected") | (F.col("independent_verifier_status") == "failed")
    out = df.withColumn("final_checks", F.when(~decision.isin("pending", "approved", "rejected"), F.raise_error(F.concat(F.lit("invalid review decision: "), decision)).cast("array<struct<check:string,passed:boolean,details:string>>")).otherwise(final))
    out = out.withColumn("human_review_status", F.when(complete, "approved").when(decision == "rejected", "rejected").otherwise("not_reviewed"))
    passed = F.col("static_checks_passed") & all_passed(F.col("final_checks"))
    out = out.withColumn("final_validation_status", F.when(passed, "passed").when(fatal, "failed").otherwise("needs_review"))
    out = out.withColumn("checks", replaced_all(F.col("checks"), "final_", F.col("final_checks"))).drop("final_checks")
    return out.withColumn("eligible_for_difficulty", F.col("final_validation_status") == "passed")


def verifier_status(reconstruction_complete: Column, audit_complete: Column, needs_human: Column, boxes_passed: Column, supported: Column, disputed: Column) -> Column:
    """Status of an independent verification."""
    return F.when(needs_human | ~reconstruction_complete | ~audit_complete | ~boxes_passed, "needs_review").when(supported & (F.size(disputed) == 0), "passed").otherwise("failed")


def reconstruction_errors(prompt: Column, answer: Column, finish_reason: Column, conf: Verification | None = None) -> Column:
    """What is incomplete about a blind reconstruction."""
    conf = conf or Verification()
    gone = text.missing_labels(prompt, answer)
    return reasons(
        ("finish_reason", finish_reason.isNotNull() & (finish_reason != "stop")),
        ("answer_too_short", F.length(text.stripped(answer)) < conf.minimum_reconstructed_answer_chars),
        ("missing_labels", F.lit(conf.require_labeled_subquestion_coverage) & (F.size(gone) > 0)),
    )


def difficulty_gate(df: DataFrame, judged: bool = False) -> DataFrame:
    """Rows that may be assessed, with admission: all are kept, hard or not.

    Predicted: admitted if the label is hard. Judged (columns solver_correct, failure_attribution, judge_error): also the
    solver has to fail for genuine reasoning; a service error never admits.
    """
    df = difficulty(features(df.where("eligible_for_difficulty and final_validation_status = 'passed'")))
    hard = F.col("predicted_label") == "hard"
    verified = (F.col("judge_error").isNull() & ~F.col("solver_correct") & (F.col("failure_attribution") == "genuine_reasoning_failure")) if judged else F.lit(False)
    admitted = hard & F.coalesce(verified, F.lit(False)) if judged else hard
    return df.withColumn("admitted_as_hard", admitted).withColumn("difficulty_verified", F.lit(judged) & (F.col("judge_error").isNull() if judged else F.lit(False)))


def export_reasons(allow_predicted: bool = False) -> Column:
    return reasons(
        ("final_validation_not_passed", ~((F.col("final_validation_status") == "passed") & F.col("eligible_for_difficulty"))),
        ("not_admitted_as_hard", ~F.col("admitted_as_hard")),
        ("difficulty_not_verified", ~F.col("difficulty_verified") & F.lit(not allow_predicted)),
        ("human_review_not_approved", F.col("human_review_status") != "approved"),
    )


def batch_policy_errors(df: DataFrame, conf: Config | None = None) -> DataFrame:
    """df (candidate columns, required_type) with `policy_errors` of a generated draft."""
    conf = conf or Config()
    g, hard, least = F.col("graph"), F.lit(conf.generation.target_difficulty == "hard"), conf.generation
    claims = ids_of(F.col("claims"), "claim_id")
    why = reasons(
        ("primary_evidence_type", F.col("primary_evidence_type") != F.col("required_type")),
        ("profile_not_supported", ~F.array_contains("supported_input_profiles", F.col("input_profile"))),
        ("visual_evidence_under_text_only", (F.col("input_profile") == "text_only") & F.col("requires_visual_evidence")),
        ("claims_without_criterion", F.size(F.array_except(claims, F.flatten(ids_of(F.col("rubric"), "supported_by")))) > 0),
        ("key_evidence_disconnected", F.size(graph.disconnected_key_nodes(g)) > 0),
        ("too_few_evidence_nodes", hard & (F.size(g["nodes"]) < least.hard_min_evidence_nodes)),
        ("too_few_evidence_pages", hard & (F.size(F.array_distinct(ids_of(g["nodes"], "page"))) < least.hard_min_evidence_pages)),
        ("too_few_operations", hard & (F.size(g["operations"]) < least.hard_min_dependent_operations)),
        ("too_few_non_lookup_operations", hard & (F.size(F.filter(g["operations"], lambda o: o["op"] != "lookup")) < 2)),
    )
    return df.withColumn("policy_errors", why)
