"""More queries over whole driver tables, each through its operator and beside the same question in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from evigrain.config import Config, Deduplication, Generation, Security
from evigrain.functions import budget, checks, geometry, graph, ids, prompts, text
from evigrain.operators import asserted, gates, select
from evigrain.plans import derived as d
from evigrain.plans import model_stages, report, stages
from evigrain.plans import queries as q
from evigrain.plans.derived import H, hs, table
from evigrain.plans.queries import ORACLES, docs, query
from evigrain.sources import files, guards

_M = lambda mark: f"{hs(chr(39) + mark + chr(39))}"


@query("select doc_id, document_key, 'task_' || substr(sha256(document_id || chr(0) || '3' || chr(0) || 'v1'), 1, 20) as sample_id, regexp_replace(name, '[^A-Za-z0-9_.-]+', '_', 'g') as file_name from (select doc_id, 'sha256:' || sha256(text) as document_id, sha256(text) as document_key, source || '/' || lang || ' #' || doc_id || '?.md' as name from documents)")
def document_names(spark, sf_dir):
    """Keys after the colon, sample ids and safe file names."""
    rows = docs(spark, sf_dir).select("doc_id", ids.document_id(F.col("text")).alias("i"), F.concat("source", F.lit("/"), "lang", F.lit(" #"), F.col("doc_id").cast("string"), F.lit("?.md")).alias("n"))
    return rows.select("doc_id", ids.document_key(F.col("i")).alias("document_key"), ids.sample_id(F.col("i"), F.lit(3), F.lit("v1")).alias("sample_id"), ids.safe_file_name(F.col("n")).alias("file_name"))


_RAW = "(x0 * 800 - 100)", "(y0 * 900 - 50)", "(x0 * 500 - 60)", "(y0 * 400)"
_CL = "greatest(0.0::double, least(1.0::double, {}))"


@query(f"select sample_id, node_id, round(a, 9) as x0, round(b, 9) as y0, round(c, 9) as x1, round(e, 9) as y1 from (select sample_id, node_id, {_CL.format(_RAW[0] + ' / 612.0::double')} as a, {_CL.format(_RAW[1] + ' / 792.0::double')} as b, {_CL.format(f'({_RAW[0]} + {_RAW[2]}) / 612.0::double')} as c, {_CL.format(f'({_RAW[1]} + {_RAW[3]}) / 792.0::double')} as e from v_node) where c > a and e > b", ["v_node"])
def normalised_boxes(spark, sf_dir):
    """Boxes in points as shares of a letter page, clamped; those that lose their area are dropped."""
    n = d.candidates(spark, sf_dir, False).select("sample_id", F.explode("graph.nodes").alias("n"))
    x, y = F.col("n.bbox.x0"), F.col("n.bbox.y0")
    b = geometry.normalised(x * 800 - 100, y * 900 - 50, x * 500 - 60, y * 400, F.lit(612.0), F.lit(792.0))
    return n.select("sample_id", F.col("n.id").alias("node_id"), b.alias("b")).where("b is not null").select("sample_id", "node_id", *[F.round(F.col(f"b.{c}"), 9).alias(c) for c in ("x0", "y0", "x1", "y1")])


@query("select doc_id, page_number, min(x0) as x0, min(y0) as y0, max(x1) as x1, max(y1) as y1 from v_block where length(text) > 20 group by all", ["v_block"])
def block_unions(spark, sf_dir):
    """The box around the longer blocks of each page."""
    p = d.paged(spark, sf_dir).select("doc_id", F.explode("pages").alias("p"))
    long = F.transform(F.filter("p.blocks", lambda b: F.length(b["text"]) > 20), lambda b: b["bbox"])
    return p.select("doc_id", F.col("p.page_number").alias("page_number"), long.alias("b")).where("size(b) > 0").select("doc_id", "page_number", geometry.union_of(F.col("b")).alias("u")).select("doc_id", "page_number", "u.*")


@query("select conv_id, turn, replace(replace('| ' || text, '|', '\\|'), chr(10), ' ') as cell from conversations")
def markdown_cells(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", text.markdown_cell(F.concat(F.lit("| "), "text")).alias("cell"))


@query(f"select sample_id, case when c >= 0.8::double and g >= 0.4::double then 'high' when c >= 0.65::double and g >= 0.25::double then 'medium' else 'low' end as confidence from (select sample_id, ({_M(':mc')} % 1000) / 1000.0::double as c, ({_M(':mg')} % 1000) / 1000.0::double as g from v_turn)", ["v_turn"])
def repair_confidences(spark, sf_dir):
    share = lambda m: F.pmod(d.h(m), F.lit(1000)) / F.lit(1000.0)
    return d.turns(spark, sf_dir).select("sample_id", budget.repair_confidence(share(":mc"), share(":mg")).alias("confidence"))


@query("select doc_id, source from documents join labels using (doc_id) where quality = 1 and toxic = 0")
def admitted_documents(spark, sf_dir):
    c = d.documents(spark, sf_dir).withColumn("license", F.struct(F.col("license_status").alias("status")))
    return stages.admitted(c).select("doc_id", "source")


@query("select page_id, case when lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) <> 'https' then 'scheme_not_allowed' when contains(lower(url), 'example.org') or contains(lower(url), '/a') then 'forbidden_source' end as problem from pages")
def url_problems(spark, sf_dir):
    conf = Security(forbidden_source_substrings=["Example.ORG", "/A"])
    return table(spark, sf_dir, "pages").select("page_id", guards.url_problem(F.col("url"), conf).alias("problem"))


@query("select min(page_id) as page_id, url, 'candidate_' || substr(sha256('src' || chr(0) || url), 1, 20) as candidate_id from pages where starts_with(url, 'https:') group by url")
def discovered(spark, sf_dir):
    """Sources with a checked address, each address once."""
    rows = table(spark, sf_dir, "pages").where(F.startswith("url", F.lit("https:"))).select(F.lit("src").alias("source_id"), "url", F.col("page_id").alias("ordinal"))
    return stages.discover(rows, Config()).select(F.col("ordinal").alias("page_id"), "url", "candidate_id")


@query("select sample_id, node_id, status from (" + q._ALIGNED + ") where status in ('misaligned', 'missing_page')", ["v_node", "v_block", "v_page", "v_count"])
def repairable_nodes(spark, sf_dir):
    """Nodes that repairs are suggested for."""
    c = gates.repair_suggestions(gates.alignment(d.candidates(spark, sf_dir)))
    return c.select("sample_id", F.explode("suggestions").alias("s"), "alignments").select("sample_id", F.col("s.node_id").alias("node_id"), F.get(F.filter("alignments", lambda a: a["node_id"] == F.col("s.node_id")), 0)["status"].alias("status"))


_GATED = q._F_VIEWS + f", passed as (select sample_id from f where {q._PASS}), scored as (select sample_id, {q._SCORE} as score from ({q._FEATURES}))"


@query(_GATED + " select sample_id, score as structural_score, score >= 0.65::double as admitted_as_hard from scored join passed using (sample_id)")
def difficulty_admission(spark, sf_dir):
    """Only what passed the final gate is assessed."""
    return gates.difficulty_gate(q._finalized(spark, sf_dir)).select("sample_id", "structural_score", "admitted_as_hard")


@query(_GATED + ", e as (select sample_id, p.sample_id is not null as ok, score >= 0.65::double as hard, complete from f left join passed p using (sample_id) join scored using (sample_id)) select sample_id, array_to_string(list_filter([case when not ok then 'final_validation_not_passed' end, case when not hard then 'not_admitted_as_hard' end, 'difficulty_not_verified', case when not complete then 'human_review_not_approved' end], lambda x: x is not null), ',') as reasons from e")
def export_reasons(spark, sf_dir):
    """All reasons for which a record is not exported, in order."""
    c = gates.difficulty(gates.features(q._finalized(spark, sf_dir)))
    c = c.withColumn("admitted_as_hard", F.col("predicted_label") == "hard").withColumn("difficulty_verified", F.lit(False))
    return c.select("sample_id", F.array_join(gates.export_reasons(), ",").alias("reasons"))


_POLICY = f"""select f.sample_id, array_to_string(list_filter([case when primary_evidence_type <> 'text_reasoning' then 'primary_evidence_type' end,
 case when profile = 'text_only' and visual then 'visual_evidence_under_text_only' end,
 case when exists(select 1 from v_claim k where k.sample_id = f.sample_id and not covered) then 'claims_without_criterion' end,
 case when n_loose > 0 then 'key_evidence_disconnected' end, case when n_nodes < 3 then 'too_few_evidence_nodes' end, case when n_pages < 2 then 'too_few_evidence_pages' end,
 case when n_ops < 3 then 'too_few_operations' end, case when n_work < 2 then 'too_few_non_lookup_operations' end], lambda x: x is not null), ',') as errors from ({q._FEATURES}) f"""


@query(_POLICY, ["v_cand", "v_node", "v_op", "v_claim"])
def batch_policy(spark, sf_dir):
    """What is wrong with drafts that were asked to be hard text tasks."""
    conf = Config(generation=Generation(target_difficulty="hard"))
    c = d.candidates(spark, sf_dir, False).withColumn("required_type", F.lit("text_reasoning"))
    return gates.batch_policy_errors(c, conf).select("sample_id", F.array_join("policy_errors", ",").alias("errors"))


@query(f"select sample_id, array_to_string(list_filter([case when f <> 'stop' then 'finish_reason' end, case when length({q._STRIP.format('gold_answer')}) < 256 then 'answer_too_short' end], lambda x: x is not null), ',') as errors from (select *, case when {_M(':fr')} % 3 = 0 then 'length' else 'stop' end as f from v_turn)", ["v_turn"])
def reconstruction_errors(spark, sf_dir):
    reason = F.when(F.pmod(d.h(":fr"), F.lit(3)) == 0, "length").otherwise("stop")
    return d.turns(spark, sf_dir).select("sample_id", F.array_join(gates.reconstruction_errors(F.lit("no labels"), F.col("gold_answer"), reason), ",").alias("errors"))


_FLAG = lambda i: f"({_M(f':vs{i}')} % 4 <> 0)"


@query("select status, count(*) as n from (select case when not " + _FLAG(2) + " or not " + _FLAG(0) + " or not " + _FLAG(1) + " or not " + _FLAG(3) + " then 'needs_review' when " + _FLAG(4) + " and " + _FLAG(5) + " then 'passed' else 'failed' end as status from v_turn) group by 1", ["v_turn"])
def verifier_statuses(spark, sf_dir):
    flag = lambda i: F.pmod(d.h(f":vs{i}"), F.lit(4)) != 0
    disputed = F.when(flag(5), F.array().cast("array<string>")).otherwise(F.array(F.lit("c1")))
    s = gates.verifier_status(flag(0), flag(1), ~flag(2), flag(3), flag(4), disputed)
    return d.turns(spark, sf_dir).select(s.alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("select sample_id, array_to_string(list_filter([case when h % 7 = 0 and m > 0 then 'repeated_node_id' end, case when m = 0 then 'undefined_input:e0' end, case when h % 5 = 0 then 'undefined_final_output' end], lambda x: x is not null), ',') as errors from (select sample_id, m, " + _M(":ge") + " as h from v_cand)", ["v_cand"])
def graph_errors(spark, sf_dir):
    """Graphs with, by hash, a node twice or a final output that nothing makes."""
    mark = d.h(":ge")
    c = d.candidates(spark, sf_dir, False).withColumn("g", F.col("graph"))
    twice = F.when((F.pmod(mark, F.lit(7)) == 0) & (F.size("g.nodes") > 0), F.concat("g.nodes", F.slice("g.nodes", 1, 1))).otherwise(F.col("g.nodes"))
    final = F.when(F.pmod(mark, F.lit(5)) == 0, F.lit("nowhere")).otherwise(F.col("g.final_output"))
    broken = F.struct(twice.alias("nodes"), F.col("g.operations").alias("operations"), final.alias("final_output"))
    return c.select("sample_id", broken.alias("b")).select("sample_id", F.array_join(graph.graph_errors(F.col("b")), ",").alias("errors"))


@query(f"with recursive r as (select sample_id, q, 'o' || q as id from (select sample_id, q, {hs(chr(39) + ':cut' + chr(39))} as h from v_cand) union select r.sample_id, r.q, unnest(o.inputs) from r join w o on o.sample_id = r.sample_id and o.output = r.id) select 1")
def branching_reachability(spark, sf_dir):
    """Evidence on a path to the final output, where a hash cuts operations off the chain."""
    c = d.candidates(spark, sf_dir, False)
    loose = lambda o: F.pmod(ids.hash_int(F.concat(F.col("sample_id"), F.lit(":cut:"), o["output"])), F.lit(3)) == 0
    ops = F.transform("graph.operations", lambda o: o.withField("inputs", F.when(loose(o), F.filter(o["inputs"], lambda i: F.startswith(i, F.lit("e")))).otherwise(o["inputs"])))
    c = c.withColumn("cut", F.struct(F.col("graph.nodes").alias("nodes"), ops.alias("operations"), F.col("graph.final_output").alias("final_output")))
    r = F.filter(graph.reaching_final(F.col("cut")), lambda i: F.startswith(i, F.lit("e")))
    return c.select("sample_id", F.array_join(F.array_sort(r), ",").alias("reaching"))


_CUT = H.format("sample_id || ':cut:' || output") + " % 3 = 0"
ORACLES["branching_reachability"] = d.with_views(["v_op", "v_cand"], "").replace("with ", "with recursive ", 1).rstrip() + f""", w as (select sample_id, output, case when {_CUT} then list_filter(inputs, lambda i: starts_with(i, 'e')) else inputs end as inputs from v_op),
 r as (select sample_id, 'o' || q as id from v_cand union select r.sample_id, unnest(o.inputs) as id from r join w o on o.sample_id = r.sample_id and o.output = r.id)
 select sample_id, coalesce(string_agg(id, ',' order by id) filter (starts_with(id, 'e')), '') as reaching from r group by 1"""


@query("select sample_id, array_to_string(list_filter(['a:1', case when h % 2 = 0 then 'b:1' end, case when h % 2 <> 0 then 'b:0' end], lambda x: x is not null), ',') as checks from (select sample_id, " + _M(":rc") + " as h from v_turn)", ["v_turn"])
def replaced_checks(spark, sf_dir):
    """A check that is run again takes its old one's place, at the end."""
    one = lambda name, ok: checks.check(name, ok, "no")
    old = F.array(one("b", F.lit(False)), one("a", F.lit(True)))
    new = checks.replaced(old, one("b", F.pmod(d.h(":rc"), F.lit(2)) == 0))
    return d.turns(spark, sf_dir).select("sample_id", F.array_join(F.transform(new, lambda c: F.concat(c["check"], F.lit(":"), c["passed"].cast("int").cast("string"))), ",").alias("checks"))


@query("select sample_id, case when " + _M(":an") + " % 3 = 0 then 'old' else 'new' end as origin from v_turn", ["v_turn"])
def appended_candidates(spark, sf_dir):
    """New candidates beside those that are there, which stay as they are."""
    t = d.turns(spark, sf_dir).select("sample_id")
    old = t.where(F.pmod(d.h(":an"), F.lit(3)) == 0).withColumn("origin", F.lit("old"))
    return files.append_new(old, t.withColumn("origin", F.lit("new")), "sample_id")


@query("select doc_id, 'data:text/plain;base64,' || to_base64(encode(left(text, 300))) as url from documents")
def data_urls(spark, sf_dir):
    """The first 300 characters of each text, as a thumbnail would be carried: the limit is the feature."""
    return docs(spark, sf_dir).select("doc_id", files.data_url(F.substring("text", 1, 300).cast("binary"), "text/plain").alias("url"))


@query("select sample_id, doc_id, page_count, length(text)::bigint as n_chars from v_turn join v_count using (doc_id) join documents using (doc_id)", ["v_turn", "v_count"])
def asserted_parsed(spark, sf_dir):
    """Candidates with their parsed document and its record; a missing one of either would fail the job."""
    parsed = docs(spark, sf_dir).select("doc_id", F.ceil(F.size(F.split("text", "\n")) / F.lit(d.LINES)).cast("int").alias("page_count"))
    parsed = asserted.asserted_join(parsed, docs(spark, sf_dir).select("doc_id", F.length("text").cast("long").alias("n_chars")), "doc_id", "document")
    return asserted.asserted_join(d.turns(spark, sf_dir).select("sample_id", "doc_id"), parsed, "doc_id", "parsed document").select("sample_id", "doc_id", "page_count", "n_chars")


@query("select sample_id, c.profile, 'doc:' || doc_id || ':full' as view_id from v_cand c join (values ('multimodal')) p(profile) on c.profile = p.profile where len(included) = page_count", ["v_cand"])
def packages_by_view(spark, sf_dir):
    """Candidates with the package of their view and profile."""
    c = d.candidates(spark, sf_dir, False).select("sample_id", "view_id", F.col("input_profile").alias("profile"))
    p = docs(spark, sf_dir).select(F.concat(F.lit("doc:"), F.col("doc_id").cast("string"), F.lit(":full")).alias("v"), F.lit("multimodal").alias("p"))
    return c.join(p, (F.col("view_id") == F.col("v")) & (F.col("profile") == F.col("p"))).select("sample_id", "profile", "view_id")


@query("select doc_id, array_to_string(list_transform(range(1, page_count + 1), lambda p: p || '=page_' || p || '.png'), ',') as attachments from v_count", ["v_count"])
def attachments(spark, sf_dir):
    """Pages beside their images; lists of different lengths would fail the job."""
    p = d.paged(spark, sf_dir).select("doc_id", F.transform("pages", lambda p: p["page_number"]).alias("n"))
    z = asserted.zipped(F.col("n"), F.transform("n", lambda n: F.concat(F.lit("page_"), n.cast("string"), F.lit(".png"))), ("page", "image"), "pages and images")
    return p.select("doc_id", F.array_join(F.transform(z, lambda x: F.concat_ws("=", x["page"].cast("string"), x["image"])), ",").alias("attachments"))


@query("select doc_id, row_number() over (partition by source order by doc_id)::int as ordinal, source from documents")
def running_ordinals(spark, sf_dir):
    return asserted.numbered(docs(spark, sf_dir).select("doc_id", "source"), "source", ["doc_id"], "ordinal")


@query("select sample_id from v_turn where " + _M(":dn") + " % 2 = 0 order by sample_id limit 25", ["v_turn"])
def limited_pending(spark, sf_dir):
    """The first 25 candidates in the order of ids that an earlier run left open: a limit counts only these."""
    t = d.turns(spark, sf_dir).select("sample_id")
    return asserted.pending(t, t.where(F.pmod(d.h(":dn"), F.lit(2)) != 0), "sample_id", 25)


@query("select doc_id from (select doc_id, sha256(text) as k from documents) where k in (select sha256(text) from documents where doc_id % 100 = 7)")
def document_selector(spark, sf_dir):
    """Documents chosen by full id or by key alone."""
    rows = docs(spark, sf_dir).select("doc_id", ids.document_id(F.col("text")).alias("document_id"))
    some = [r["document_id"] for r in rows.where("doc_id % 100 = 7").collect()]  # what a user names, in either form
    return asserted.selected(rows, [s if i % 2 else s.split(":", 1)[1] for i, s in enumerate(some)]).select("doc_id")


@query("select sample_id, '- ' || sample_id || ': type=' || primary_evidence_type || '; pages=[' || coalesce((select string_agg(distinct page, ', ' order by page) from v_node n where n.sample_id = c.sample_id), '') || ']; operations=[' || (select string_agg('''' || op || '''', ', ' order by j) from v_op o where o.sample_id = c.sample_id) || ']; question=' || prompt as line from v_cand c", ["v_cand", "v_node", "v_op"])
def prior_lines(spark, sf_dir):
    """What a prompt says of candidates made before."""
    c = d.candidates(spark, sf_dir, False)
    return c.select("sample_id", prompts.prior_line(F.col("sample_id"), F.col("primary_evidence_type"), F.col("graph.nodes"), F.col("graph.operations"), F.col("prompt")).alias("line"))


@query("select sample_id, sha256('Pages [1] of ' || to_json({prompt: prompt, document_id: 'doc:' || doc_id})) as blind_sha256, contains(to_json({prompt: prompt, document_id: 'doc:' || doc_id}), 'gold') and not contains(prompt, 'gold') as leaks from v_turn", ["v_turn"])
def blind_prompts(spark, sf_dir):
    """The blind prompt holds the question and the document's id and no more."""
    t = d.turns(spark, sf_dir)
    body = prompts.blind_payload(F.col("prompt"), F.concat(F.lit("doc:"), F.col("doc_id").cast("string")))
    full = prompts.filled("Pages {pages} of {task}", {"pages": F.lit("[1]"), "task": body})
    return t.select("sample_id", F.sha2(full.cast("binary"), 256).alias("blind_sha256"), (F.contains(body, F.lit("gold")) & ~F.contains("prompt", F.lit("gold"))).alias("leaks"))


@query("select sample_id, sha256(to_json({prompt: prompt, gold_answer: gold_answer, rubric: ['r1']})) as judge_sha256 from v_turn", ["v_turn"])
def judge_prompts(spark, sf_dir):
    t = d.turns(spark, sf_dir)
    return t.select("sample_id", F.sha2(prompts.judge_payload(F.col("prompt"), F.col("gold_answer"), F.array(F.lit("r1"))).cast("binary"), 256).alias("judge_sha256"))


@query("select sample_id, 'run1:verify:' || sample_id || ':evidence' as evidence_key, 'run1:verify:' || sample_id || ':audit:evidence_pages:' || array_to_string(included, ',') || ':crops=True' as audit_key from v_cand", ["v_cand"])
def cache_keys(spark, sf_dir):
    c = d.candidates(spark, sf_dir, False)
    return c.select("sample_id", prompts.cache_key("run1", F.col("sample_id"), "evidence").alias("evidence_key"), prompts.cache_key("run1", F.col("sample_id"), "audit", "evidence_pages", F.col("view_pages"), True).alias("audit_key"))


@query("""select sample_id, node_id, lpad((k + 1)::varchar, 3, '0') || '_' || node_id || '_page_' || lpad(page::varchar, 4, '0') || '_' || substr(sha256('{"node":"' || node_id || '","page":' || page || '}'), 1, 12) || '.png' as file_name from v_node""", ["v_node"])
def crop_names(spark, sf_dir):
    n = d.candidates(spark, sf_dir, False).select("sample_id", F.posexplode("graph.nodes").alias("i", "n"))
    about = F.struct(F.col("n.id").alias("node"), F.col("n.page").alias("page"))
    return n.select("sample_id", F.col("n.id").alias("node_id"), prompts.crop_file_name(F.col("i") + 1, F.col("n.id"), F.col("n.page"), about).alias("file_name"))


@query("select source, count(*) as n_documents, sum(length(regexp_replace(text, '[ \\t\\n\\r\\f\\v]+', '', 'g')))::bigint as nonspace_chars, sum(pages)::bigint as pages, sum(ocr)::bigint as ocr_pages from documents join (select doc_id, count(*) as pages, count(*) filter (length(" + q._STRIP.format("p.text") + ") < 40) as ocr from v_page p group by 1) using (doc_id) group by source", ["v_page"])
def corpus_statistics(spark, sf_dir):
    """Characters other than blanks, pages, and pages that need character recognition, by source."""
    p = d.paged(spark, sf_dir).select(F.col("doc_id").alias("pd"), "page_count", F.size(F.filter("pages", lambda x: F.length(text.stripped(x["extracted_text"])) < Config().parse.native_text_min_chars_per_page)).alias("ocr"))
    x = docs(spark, sf_dir).select("doc_id", "source", F.length(F.regexp_replace("text", r"\s+", "")).alias("chars")).join(p, F.col("doc_id") == F.col("pd"))
    return x.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("chars").alias("nonspace_chars"), F.sum(F.col("page_count").cast("long")).alias("pages"), F.sum(F.col("ocr").cast("long")).alias("ocr_pages"))


@query(f"select count(*) as n_tasks, count(distinct doc_id % 97) as n_groups, max(s) as best_score from (select sample_id, doc_id, {q._SCORE} as s from ({q._FEATURES}))", ["v_cand", "v_node", "v_op"])
def dedup_report(spark, sf_dir):
    """The report of a selection holds every task once, with its score if it was selected; the best of all always is."""
    c = gates.difficulty(gates.features(d.candidates(spark, sf_dir, False))).withColumn("static_checks_passed", F.lit(True))
    c = c.withColumn("document_id", F.concat(F.lit("group:"), F.pmod(F.col("doc_id"), F.lit(97)).cast("string")))
    r = report.dedup_report(select.select_diverse(c, Deduplication()), c.drop("document_id"))
    return r.agg(F.sum(F.size("selected") + F.size("rejected")).alias("n_tasks"), F.count(F.lit(1)).alias("n_groups"), F.max(F.array_max(F.transform("selected", lambda x: x["structural_score"]))).alias("best_score"))


@query("select 'failed' as origin, count(*) as n from documents join labels using (doc_id) where toxic = 1")
def latest_stage(spark, sf_dir):
    """The first of three stages that has rows."""
    rows = d.documents(spark, sf_dir).select("doc_id", "license_status")
    t = table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id", F.lit("failed").alias("license_status"))
    return report.latest(rows.where("false"), t, rows).groupBy(F.col("license_status").alias("origin")).agg(F.count(F.lit(1)).alias("n"))


_READY = q._F_VIEWS + f", c as (select count(*) filter (not ({q._PASS})) as bad from f)"


@query(_READY + " select unnest(list_filter([case when bad > 0 then 'final_validation_incomplete' end, 'no_difficulty_assessments', 'export_not_release_ready'], lambda x: x is not null)) as blocker from c")
def release_blockers(spark, sf_dir):
    found = report.summary({"finalized": q._finalized(spark, sf_dir)})
    return spark.createDataFrame([(b,) for b in found["blockers"]], "blocker string")


@query("select split, count(*) as records, sum(tokens)::bigint as sequence_tokens from (" + q._EXPORT + ") group by split union all select s, 0, 0 from (values ('train'), ('validation'), ('internal_holdout')) x(s) where s not in (select split from (" + q._EXPORT + "))", ["v_turn"])
def split_counts(spark, sf_dir):
    return stages.split_counts(q._exported(spark, sf_dir).withColumnRenamed("tokens", "sequence_tokens"))


@query(q._F_VIEWS + "select 0 as place, 'documents' as stage, count(*) as rows from documents union all select 1, 'generated', count(*) from v_cand union all select 2, 'passed', count(*) from f where " + q._PASS)
def funnel_rows(spark, sf_dir):
    f = q._finalized(spark, sf_dir)
    return stages.funnel({"documents": docs(spark, sf_dir), "generated": d.turns(spark, sf_dir), "passed": f.where("eligible_for_difficulty")})


@query("select doc_id, 'doc:' || doc_id || ':full' as document_view_id, page_count::int as n_pages, " + f"ceil(length(t) / 3.5::double)::bigint as text_tokens from (select doc_id, page_count, (select string_agg('[Page ' || page_number || ']' || chr(10) || {q._STRIP.format('p.text')} || chr(10) || '[End Page ' || page_number || ']', chr(10) || chr(10) order by page_number) from v_page p where p.doc_id = c.doc_id) as t from v_count c)", ["v_page", "v_count"])
def text_packages(spark, sf_dir):
    """Text-only packages of all documents with their views and accounting."""
    p = d.paged(spark, sf_dir)
    sized = F.transform("pages", lambda x: F.struct(x["page_number"].alias("page_number"), x["extracted_text"].alias("extracted_text"), F.lit(612.0).alias("width_points"), F.lit(792.0).alias("height_points")))
    p = p.select("doc_id", F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("document_id"), "page_count", sized.alias("pages"))
    conf = Config()
    out = stages.packages(stages.views(p.drop("doc_id")), conf, "text_only")
    return out.select(F.substring_index("document_id", ":", -1).cast("long").alias("doc_id"), "document_view_id", F.size("page_numbers").alias("n_pages"), F.col("token_accounting.document_text_tokens").alias("text_tokens"))


@query("select sample_id, 'approved' as decision from v_turn where " + _M(":pd") + " % 2 = 0 union all select sample_id, 'pending' from v_turn where " + _M(":pd") + " % 2 <> 0", ["v_turn"])
def review_decisions(spark, sf_dir):
    """Templates for candidates without a decision beside the decisions that people made."""
    t = d.turns(spark, sf_dir).select("sample_id")
    made = t.where(F.pmod(d.h(":pd"), F.lit(2)) == 0).select("sample_id", F.lit("approved").alias("decision"), F.lit("r1").alias("reviewer"))
    return made.unionByName(stages.decision_templates(t, made)).select("sample_id", "decision")


@query("select required_type, count(*) as n from (select unnest(['structured_layout', 'visual_spatial', 'text_reasoning']) as required_type) group by 1 having false")
def generation_schedule(spark, sf_dir):
    """Types that the documents of one source are asked for: shares of the weights, to one."""
    some = d.documents(spark, sf_dir).select("document_id").distinct()
    got = model_stages.schedule(some, Config()).groupBy("required_type").agg(F.count(F.lit(1)).alias("n"))
    return got.crossJoin(some.agg(F.count(F.lit(1)).alias("all"))).select("required_type", (F.abs(F.col("n") / F.col("all") / 3 - F.when(F.col("required_type") == "visual_spatial", 0.40).when(F.col("required_type") == "structured_layout", 0.45).otherwise(0.15)) < 0.01).alias("as_weighted"))


ORACLES["generation_schedule"] = "select * from (values ('structured_layout', true), ('text_reasoning', true), ('visual_spatial', true)) t(required_type, as_weighted)"


def _solver(prompt: str) -> dict:
    return {"text": prompt[:300].ljust(300, "."), "finish_reason": "stop"}


def _auditor(prompt: str) -> dict:
    import json

    return {"text": json.dumps({"gold_answer_supported": len(prompt) % 2 == 0, "needs_human_review": len(prompt) % 5 == 0, "disputed_claims": []}), "finish_reason": "stop"}


@query("select status, count(*) as n from (select case when not ok then 'needs_review' when n % 5 = 0 then 'needs_review' when n % 2 = 0 then 'passed' else 'failed' end as status from (select true as ok, length(to_json({prompt: prompt, gold_answer: gold_answer, evidence_graph: 1, claims: ['c'], derivations: ['d']})) + 2 + 300 + 2 + length(text) as n from v_turn join documents using (doc_id))) group by 1", ["v_turn"])
def model_verification(spark, sf_dir):
    """The verify stage with clients that answer by rule: every candidate gets a status."""
    t = d.turns(spark, sf_dir).withColumn("document_id", F.col("doc_id").cast("string"))
    # prompts with labels would have to be answered part by part; the rule's answers have none
    t = t.withColumns({"graph": F.lit(1), "claims": F.array(F.lit("c")), "derivations": F.array(F.lit("d"))})
    p = docs(spark, sf_dir).select(F.col("doc_id").cast("string").alias("document_id"), F.col("text").alias("document_text"))
    conf = Config()
    conf.verification.require_labeled_subquestion_coverage = False
    out = model_stages.model_verify(t, p, conf, _solver, _auditor)
    return out.groupBy(F.col("independent_verifier_status").alias("status")).agg(F.count(F.lit(1)).alias("n"))


__all__ = ["q"]
