"""One query for each group of operators, over whole driver tables, beside the same question in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evigrain.config import Config, ContextBudget, Deduplication, Model
from evigrain.constants import ALIGNMENT_STOPWORDS, CONTROLLING_ROLES
from evigrain.functions import budget, geometry, graph, ids, text
from evigrain.functions.checks import all_passed
from evigrain.operators import gates, select
from evigrain.plans import derived as d
from evigrain.plans.derived import H, hs, listed, table, with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
B = ContextBudget()
_WORDS = "list_distinct(regexp_extract_all(lower({}), '[a-z0-9]+'))"
_ALIGN = "list_filter(" + _WORDS + f", lambda t: not list_contains({listed(ALIGNMENT_STOPWORDS)}, t) and (length(t) >= 2 or regexp_full_match(t, '[0-9]+')))"
_STRIP = "regexp_replace({}, '^[ \\t\\n\\r\\f\\v]+|[ \\t\\n\\r\\f\\v]+$', '', 'g')"
_TOKENS = f"ceil(length(text) / {B.provisional_chars_per_token}::double)::bigint"
_FITS = f"({{0}} / {B.model_context_tokens}.0::double <= {B.maximum_input_utilization}::double and {{0}} + {B.minimum_output_and_safety_reserve_tokens} <= {B.model_context_tokens})"
_RESERVES = B.question_reserve_tokens + B.system_prompt_reserve_tokens


def query(sql: str | None = None, views: list[str] | None = None):
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = with_views(views, sql) if views else sql
        return f

    return keep


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


_SPLIT = "case when {0} % 100 < 90 then 'train' when {0} % 100 < 95 then 'validation' else 'internal_holdout' end"
_DOC_SPLIT = _SPLIT.format(H.format("'sha256:' || sha256(text)"))


@query(f"select split, count(*) as n_documents, sum(tokens)::bigint as text_tokens, sum(tokens + {_RESERVES})::bigint as input_tokens, count(*) filter ({_FITS.format(f'(tokens + {_RESERVES})')}) as n_fit from (select {_DOC_SPLIT} as split, {_TOKENS} as tokens from documents) group by split")
def split_token_report(spark, sf_dir):
    t = budget.text_tokens(F.length("text"), B)
    rows = docs(spark, sf_dir).select(ids.split_of(ids.document_id(F.col("text"))).alias("split"), t.alias("tokens"))
    rows = rows.withColumn("input", budget.estimated_input(F.col("tokens"), F.lit(0), B))
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("tokens").alias("text_tokens"), F.sum("input").alias("input_tokens"), F.count_if(budget.fits(F.col("input"), B)).alias("n_fit"))


@query("select 'sha256:' || sha256(text) as document_id, count(*) as n_rows, min(doc_id) as first_doc, max(doc_id) as last_doc from documents group by 1 having count(*) > 1")
def content_identity(spark, sf_dir):
    g = docs(spark, sf_dir).groupBy(ids.document_id(F.col("text")).alias("document_id"))
    return g.agg(F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")).where("n_rows > 1")


@query("select license_status, source, count(*) as n, sum(strlen(text))::bigint as bytes from (select d.*, case when l.doc_id is null then 'needs_review' when quality = 1 and toxic = 0 then 'approved' else 'rejected' end as license_status from documents d left join labels l using (doc_id)) group by all")
def license_funnel(spark, sf_dir):
    return d.documents(spark, sf_dir).groupBy("license_status", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("size_bytes").alias("bytes"))


@query("select page_id, url, 'candidate_' || substr(sha256(host || chr(0) || url), 1, 20) as candidate_id, scheme, scheme = 'https' as allowed, contains(lower(url), 'example.org') as forbidden from (select *, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) as host, regexp_extract(url, '^([a-z]+)://', 1) as scheme, row_number() over (partition by url order by page_id) as rn from pages) where rn = 1")
def url_guard(spark, sf_dir):
    """Exact URLs once, with their candidate id, the scheme allowed, and a forbidden marker found."""
    w = Window.partitionBy("url").orderBy("page_id")
    p = table(spark, sf_dir, "pages").select("page_id", "url", F.row_number().over(w).alias("rn")).where("rn = 1")
    host, scheme = F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1), F.regexp_extract("url", "^([a-z]+)://", 1)
    conf = Config().security
    return p.select("page_id", "url", ids.candidate_id(host, F.col("url")).alias("candidate_id"), scheme.alias("scheme"), scheme.isin(conf.allowed_download_schemes).alias("allowed"), F.contains(F.lower("url"), F.lit("example.org")).alias("forbidden"))


@query("select doc_id, sha256(string_agg('[Page ' || page_number || ']' || chr(10) || " + _STRIP.format("text") + " || chr(10) || '[End Page ' || page_number || ']', chr(10) || chr(10) order by page_number)) as text_sha256, count(*) as n_pages from v_page group by doc_id", ["v_page"])
def page_text(spark, sf_dir):
    return d.paged(spark, sf_dir).select("doc_id", F.sha2(text.marked_pages(F.col("pages")).cast("binary"), 256).alias("text_sha256"), F.size("pages").cast("long").alias("n_pages"))


@query("select doc_id, page_number, count(*) as n_blocks, sum(length(text))::bigint as n_chars, max(reading_order) as last_order, max(y1) as bottom from v_block group by all", ["v_block"])
def page_blocks(spark, sf_dir):
    b = d.blocks(spark, sf_dir).groupBy("doc_id", "page_number")
    return b.agg(F.count(F.lit(1)).alias("n_blocks"), F.sum(F.length("text").cast("long")).alias("n_chars"), F.max("reading_order").alias("last_order"), F.max("bbox.y1").alias("bottom"))


@query("select doc_id, count(*) filter (length(s) < 40) as n_need_ocr, count(*) filter (s = '') as n_empty, sum(length(s))::bigint as chars from (select doc_id, " + _STRIP.format("text") + " as s from v_page) group by doc_id", ["v_page"])
def needs_ocr_pages(spark, sf_dir):
    s = F.transform("pages", lambda p: F.length(text.stripped(p["extracted_text"])))
    p = d.paged(spark, sf_dir).select("doc_id", s.alias("n"))
    return p.select("doc_id", F.size(F.filter("n", lambda x: x < Config().parse.native_text_min_chars_per_page)).cast("long").alias("n_need_ocr"), F.size(F.filter("n", lambda x: x == 0)).cast("long").alias("n_empty"), F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x).alias("chars"))


@query("select doc_id, row_number() over (partition by doc_id order by s)::int as range_no, s as start, e as end from (select doc_id, min(page)::int as s, max(page)::int as e from (select doc_id, page, page - row_number() over (partition by doc_id order by page) as island from (select doc_id, unnest(included) as page from v_kept)) group by doc_id, island)", ["v_kept"])
def page_range_islands(spark, sf_dir):
    k = d.kept_pages(spark, sf_dir).select("doc_id", F.explode("included").alias("page"))
    return select.page_ranges(k, "doc_id", "page")


@query("select doc_id, case when len(included) = page_count then 'doc:' || doc_id || ':full' else 'doc:' || doc_id || ':bounded-' || substr(sha256('doc:' || doc_id || chr(0) || array_to_string(included, ',')), 1, 16) end as view_id, len(included)::int as n_included from v_kept", ["v_kept"])
def view_ids(spark, sf_dir):
    key = F.concat(F.lit("doc:"), F.col("doc_id").cast("string"))
    return d.kept_pages(spark, sf_dir).select("doc_id", ids.view_id(key, F.col("included"), F.size("included") == F.col("page_count")).alias("view_id"), F.size("included").alias("n_included"))


def _budgeted(spark, sf_dir):
    """Input budget of each document at each resolution step, for a window that long documents overflow."""
    own = ContextBudget(model_context_tokens=65_536)
    chars = docs(spark, sf_dir).select("doc_id", F.length("text").alias("n"), F.ceil(F.size(F.split("text", "\n")) / F.lit(d.LINES)).cast("long").alias("pages"))
    steps = []
    for dpi in budget.dpi_steps(150, 72):
        image = budget.image_tokens(F.col("pages").cast("double") * budget.megapixels(F.lit(612.0), F.lit(792.0), F.lit(float(dpi))), own)
        total = budget.estimated_input(budget.text_tokens(F.col("n"), own), image, own)
        steps.append(F.struct(F.lit(dpi).alias("dpi"), total.alias("input_tokens"), budget.fits(total, own).alias("fits")))
    return chars.withColumn("steps", F.array(*steps))


_DPI = " ".join(f"when fits{x} then {x}" for x in (150, 120, 96, 72))


@query(
    "select doc_id, case " + _DPI + " end as dpi, case when fits150 then t150 when fits120 then t120 when fits96 then t96 else t72 end as input_tokens, fits150 or fits120 or fits96 or fits72 as fits from (select *, "
    + ", ".join(f"(t{x} / 65536.0::double <= 0.9::double and t{x} + 32768 <= 65536) as fits{x}" for x in (150, 120, 96, 72))
    + " from (select doc_id, " + ", ".join(f"{_TOKENS} + ceil(ceil(len(string_split(text, chr(10))) / 8)::double * ((612.0::double * {x}.0::double / 72.0::double) * (792.0::double * {x}.0::double / 72.0::double) / 1000000.0::double) * 1200.0::double)::bigint + {_RESERVES} as t{x}" for x in (150, 120, 96, 72)) + " from documents))"
)
def view_budget_dpi(spark, sf_dir):
    """The highest resolution at which a document fits; the lowest one's figures where none does."""
    first = F.get(F.filter("steps", lambda s: s["fits"]), 0)
    return _budgeted(spark, sf_dir).select("doc_id", first["dpi"].alias("dpi"), F.coalesce(first["input_tokens"], F.element_at("steps", -1)["input_tokens"]).alias("input_tokens"), first.isNotNull().alias("fits"))


@query("select doc_id, profile, 'input_' || substr(sha256('doc:' || doc_id || ':full' || chr(0) || profile || chr(0) || coalesce(dpi::varchar, 'None')), 1, 20) as package_id from documents, (values ('text_only', null), ('multimodal', 150)) p(profile, dpi)")
def package_ids(spark, sf_dir):
    key = F.concat(F.lit("doc:"), F.col("doc_id").cast("string"), F.lit(":full"))
    kinds = F.explode(F.array(F.struct(F.lit("text_only").alias("profile"), F.lit(None).cast("int").alias("dpi")), F.struct(F.lit("multimodal").alias("profile"), F.lit(150).alias("dpi"))))
    return docs(spark, sf_dir).select("doc_id", key.alias("k"), kinds.alias("p")).select("doc_id", "p.profile", ids.package_id(F.col("k"), F.col("p.profile"), F.col("p.dpi")).alias("package_id"))


_ROUTES = [Model(model="short", context_window_tokens=4096, max_output_tokens=1024), Model(model="long", context_window_tokens=16_384, max_output_tokens=4096)]


@query(f"select doc_id, case when t + 1024 <= 4096 then 'short' when t + 4096 <= 16384 then 'long' end as model from (select doc_id, {_TOKENS} as t from documents)")
def model_routing(spark, sf_dir):
    t = budget.text_tokens(F.length("text"), B)
    fit = F.array(*[F.struct(F.lit(m.model).alias("model"), (t + m.max_output_tokens <= m.context_window_tokens).alias("fits")) for m in _ROUTES])
    return docs(spark, sf_dir).select("doc_id", F.get(F.filter(fit, lambda m: m["fits"]), 0)["model"].alias("model"))


_NAMES = ["Org/Qwen3-27B", "zai-org/GLM-5", "glm-4", "deepseek-r1", "Moonshot-v1", "kimi-k2", " Other-Model ", "zai-org/x"]


@query(f"select a.n as left_model, b.n as right_model, fa as left_family, fb as right_family, fa <> fb as independent from (select n, " + "case when contains(x, 'qwen') then 'qwen' when contains(x, 'glm') or starts_with(x, 'zai-org/') then 'glm' when contains(x, 'deepseek') then 'deepseek' when contains(x, 'kimi') or contains(x, 'moonshot') then 'kimi' else x end" + f" as fa from (select n, lower(trim(n)) as x from (select unnest({listed(_NAMES)}) as n))) a join (select n, " + "case when contains(x, 'qwen') then 'qwen' when contains(x, 'glm') or starts_with(x, 'zai-org/') then 'glm' when contains(x, 'deepseek') then 'deepseek' when contains(x, 'kimi') or contains(x, 'moonshot') then 'kimi' else x end" + f" as fb from (select n, lower(trim(n)) as x from (select unnest({listed(_NAMES)}) as n))) b on a.n < b.n")
def family_independence(spark, sf_dir):
    n = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in _NAMES])).alias("n"))
    a, b = n.select(F.col("n").alias("left_model"), text.model_family(F.col("n")).alias("left_family")), n.select(F.col("n").alias("right_model"), text.model_family(F.col("n")).alias("right_family"))
    return a.join(b, F.col("left_model") < F.col("right_model")).withColumn("independent", F.col("left_family") != F.col("right_family"))


@query(f"select doc_id, len(t)::int as n_tokens, sha256(array_to_string(list_sort(t), ' ')) as tokens_sha256 from (select doc_id, {_ALIGN.format('text')} as t from documents)")
def alignment_token_sets(spark, sf_dir):
    t = text.alignment_tokens(F.col("text"))
    return docs(spark, sf_dir).select("doc_id", t.alias("t")).select("doc_id", F.size("t").alias("n_tokens"), F.sha2(F.array_join(F.array_sort("t"), " ").cast("binary"), 256).alias("tokens_sha256"))


@query(f"select sample_id, case when len(e) = 0 then 0.0::double else len(list_intersect(e, s))::double / len(e) end as coverage from (select sample_id, {_ALIGN.format('prompt')} as e, {_ALIGN.format('gold_answer')} as s from v_turn)", ["v_turn"])
def excerpt_coverage(spark, sf_dir):
    t = d.turns(spark, sf_dir)
    return t.select("sample_id", text.coverage(text.alignment_tokens(F.col("prompt")), text.alignment_tokens(F.col("gold_answer"))).alias("coverage"))


@query(f"select sample_id, case when len(a) + len(b) = 0 then 1.0::double else len(list_intersect(a, b))::double / (len(a) + len(b) - len(list_intersect(a, b))) end as jaccard from (select sample_id, {_WORDS.format('prompt')} as a, {_WORDS.format('gold_answer')} as b from v_turn)", ["v_turn"])
def prompt_jaccard(spark, sf_dir):
    t = d.turns(spark, sf_dir)
    return t.select("sample_id", text.jaccard(text.token_set(F.col("prompt")), text.token_set(F.col("gold_answer"))).alias("jaccard"))


@query(r"select doc_id, len(n)::int as n_numbers, coalesce(list_sum(n), 0.0)::double as total from (select doc_id, list_transform(regexp_extract_all(regexp_replace(text, '([A-Za-z])[-+0-9]', '\1 ', 'g'), '[-+]?[0-9][0-9,]*(?:\.[0-9]+)?'), lambda x: replace(x, ',', '')::double) as n from (select page_id as doc_id, url as text from pages))")
def numeric_literals(spark, sf_dir):
    n = table(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), text.numbers_in(F.col("url")).alias("n"))
    return n.select("doc_id", F.size("n").alias("n_numbers"), F.aggregate("n", F.lit(0.0), lambda a, x: a + x).alias("total"))


@query(r"select sample_id, array_to_string(l, ',') as labels, case when len(l) >= 2 then array_to_string(list_filter(l, lambda x: not contains(lower(a), '(' || lower(x) || ')')), ',') else '' end as missing from (select sample_id, a, list_sort(list_distinct(regexp_extract_all(p, '\(([a-zA-Z])\)', 1))) as l from (select sample_id, '(a) ' || prompt || ' (' || substr(gold_answer, 1, 1) || ') (B) (c)' as p, '(A) ' || gold_answer || ' (c)' as a from v_turn))", ["v_turn"])
def subquestion_labels(spark, sf_dir):
    t = d.turns(spark, sf_dir)
    p = F.concat(F.lit("(a) "), F.col("prompt"), F.lit(" ("), F.substring("gold_answer", 1, 1), F.lit(") (B) (c)"))
    a = F.concat(F.lit("(A) "), F.col("gold_answer"), F.lit(" (c)"))
    return t.select("sample_id", F.array_join(text.labels_in(p), ",").alias("labels"), F.array_join(text.missing_labels(p, a), ",").alias("missing"))


@query("select doc_id, count(*) filter (regexp_matches(text, '^(?i)\\s*(figure|fig\\.)\\s*[0-9]')) as n_captions from (select doc_id, case when p % 5 = 0 then 'Fig. ' || p || ' ' || text else text end as text from v_line) group by doc_id", ["v_line"])
def figure_captions(spark, sf_dir):
    lines = F.split("text", "\n")
    marked = F.transform(lines, lambda t, i: F.when(i % 5 == 0, F.concat(F.lit("Fig. "), i.cast("string"), F.lit(" "), t)).otherwise(t))
    return docs(spark, sf_dir).select("doc_id", F.size(F.filter(marked, text.is_figure_caption)).cast("long").alias("n_captions"))


_IOU = "(greatest(0.0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0.0, least(a.y1, b.y1) - greatest(a.y0, b.y0)))"


@query(f"select a.sample_id, a.node_id as left_id, b.node_id as right_id, round({_IOU} / ((a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - {_IOU}), 6) as iou, (a.x0 < b.x1 and b.x0 < a.x1 and a.y0 < b.y1 and b.y0 < a.y1) as touches from v_node a join v_node b on a.sample_id = b.sample_id and a.k < b.k", ["v_node"])
def bbox_iou_pairs(spark, sf_dir):
    n = d.candidates(spark, sf_dir, False).select("sample_id", F.col("graph.nodes").alias("n"))
    a = n.select("sample_id", "n", F.posexplode("n").alias("i", "a"))
    p = a.select("sample_id", "a", F.explode(F.slice("n", F.col("i") + 2, F.greatest(F.size("n") - F.col("i") - 1, F.lit(0)))).alias("b"))
    return p.select("sample_id", F.col("a.id").alias("left_id"), F.col("b.id").alias("right_id"), F.round(geometry.iou(F.col("a.bbox"), F.col("b.bbox")), 6).alias("iou"), geometry.intersect(F.col("a.bbox"), F.col("b.bbox")).alias("touches"))


def _crop_sql(lo: str, hi: str, px: str) -> tuple[str, str]:
    size = f"least(1.0::double, greatest(({hi} - {lo}) * 1.2::double, 256.0::double / {px}::double))"
    start = f"least(greatest(({lo} + {hi}) / 2 - {size} / 2, 0.0::double), 1.0::double - {size})"
    return start, f"{start} + {size}"


_CX, _CY = _crop_sql("x0", "x1", "1275.0"), _crop_sql("y0", "y1", "1650.0")


@query(f"select sample_id, node_id, round({_CX[0]}, 9) as x0, round({_CX[1]}, 9) as x1, round({_CY[0]}, 9) as y0, round({_CY[1]}, 9) as y1 from v_node", ["v_node"])
def padded_crops(spark, sf_dir):
    n = d.candidates(spark, sf_dir, False).select("sample_id", F.explode("graph.nodes").alias("n"))
    c = geometry.crop(F.col("n.bbox"), F.lit(1275.0), F.lit(1650.0), 0.10, 256)
    return n.select("sample_id", F.col("n.id").alias("node_id"), c.alias("c")).select("sample_id", "node_id", *[F.round(F.col(f"c.{x}"), 9).alias(x) for x in ("x0", "x1", "y0", "y1")])


@query("select n.sample_id, n.node_id, b.block_id from v_node n join v_block b on b.doc_id = n.doc_id and b.page_number = n.page and n.x0 < b.x1 and b.x0 < n.x1 and n.y0 < b.y1 and b.y0 < n.y1", ["v_node", "v_block"])
def node_block_intersections(spark, sf_dir):
    """The spatial join as an equi-join on document and page with the boxes as its condition."""
    n = d.candidates(spark, sf_dir, False).select("sample_id", "doc_id", F.explode("graph.nodes").alias("n"))
    b = d.blocks(spark, sf_dir).withColumnRenamed("doc_id", "bd").withColumnRenamed("bbox", "bb")
    on = (F.col("doc_id") == F.col("bd")) & (F.col("n.page") == F.col("page_number")) & geometry.intersect(F.col("n.bbox"), F.col("bb"))
    return n.join(b, on).select("sample_id", F.col("n.id").alias("node_id"), "block_id")


_COVER = "case when len({0}) = 0 then 0.0::double else len(list_intersect({0}, {1}))::double / len({0}) end"
_ALIGNED = f"""
select sample_id, doc_id, page, excerpt, node_id, s as status, cast(case when s = 'missing_page' then 0.0 when s = 'not_checkable_no_excerpt' then null else bc end as double) as bbox_coverage from (
select *, case when page > page_count then 'missing_page' when coalesce(excerpt, '') = '' then 'not_checkable_no_excerpt'
 when visual and regexp_matches(excerpt, '^(?i)\\s*(figure|fig\\.)\\s*[0-9]') then 'not_checkable_visual_or_ocr'
 when pc >= 0.45::double and bc >= pc * 0.5::double then 'aligned' when pc >= 0.45::double then 'misaligned' else 'not_checkable_visual_or_ocr' end as s
from (select n.*, c.page_count, {_COVER.format(_ALIGN.format("coalesce(excerpt, '')"), _ALIGN.format("coalesce(p.text, '')"))} as pc, {_COVER.format(_ALIGN.format("coalesce(excerpt, '')"), _ALIGN.format("coalesce(bt.t, '')"))} as bc
 from v_node n join v_count c using (doc_id) left join v_page p on p.doc_id = n.doc_id and p.page_number = n.page
 left join (select n.sample_id as s2, n.k as k2, string_agg(b.text, chr(10) order by b.reading_order) as t from v_node n join v_block b on b.doc_id = n.doc_id and b.page_number = n.page and n.x0 < b.x1 and b.x0 < n.x1 and n.y0 < b.y1 and b.y0 < n.y1 group by 1, 2) bt on bt.s2 = n.sample_id and bt.k2 = n.k))
"""


@query(f"select sample_id, node_id, status, round(bbox_coverage, 6) as bbox_coverage from ({_ALIGNED})", ["v_node", "v_block", "v_page", "v_count"])
def alignment_status(spark, sf_dir):
    c = gates.alignment(d.candidates(spark, sf_dir)).select("sample_id", F.explode("alignments").alias("a"))
    # the operator shows four places; the SQL's six agree where both are rounded from the same ratio
    return c.select("sample_id", F.col("a.node_id").alias("node_id"), F.col("a.status").alias("status"), F.col("a.bbox_token_coverage").alias("bbox_coverage"))


ORACLES["alignment_status"] = ORACLES["alignment_status"].replace("round(bbox_coverage, 6)", "round(bbox_coverage, 4)")


@query(
    f"""select sample_id, node_id, round(cov, 4) as coverage, round(score, 4) as score, len::int as n_blocks, first::int as first_block from (
select *, row_number() over (partition by sample_id, node_id order by score desc, cov desc, len, first) as rn from (
select *, greatest(0.0::double, 0.85::double * cov + 0.15::double * prec - 0.005::double * (len - 1)::double) as score from (
select sample_id, node_id, len, first, {_COVER.format("w", "v")} as cov, {_COVER.format("v", "w")} as prec from (
select n.sample_id, n.node_id, z.len, b.reading_order as first, {_ALIGN.format("n.excerpt")} as w, {_ALIGN.format("string_agg(x.text, chr(10) order by x.reading_order)")} as v
from v_node n join v_count c using (doc_id) join (select * from v_block where {_STRIP.format("text")} <> '') b on b.doc_id = n.doc_id and b.page_number = n.page cross join (select unnest(range(1, 7)) as len) z
join (select *, row_number() over (partition by doc_id, page_number order by reading_order) as ord from v_block where {_STRIP.format("text")} <> '') x on x.doc_id = b.doc_id and x.page_number = b.page_number
join (select doc_id, page_number, reading_order, row_number() over (partition by doc_id, page_number order by reading_order) as ord, count(*) over (partition by doc_id, page_number) as tot from v_block where {_STRIP.format("text")} <> '') o on o.doc_id = b.doc_id and o.page_number = b.page_number and o.reading_order = b.reading_order
where coalesce(n.excerpt, '') <> '' and n.page <= c.page_count and x.ord >= o.ord and x.ord < o.ord + z.len and o.ord + z.len - 1 <= o.tot
group by n.sample_id, n.node_id, z.len, b.reading_order, n.excerpt)))) where rn = 1""",
    ["v_node", "v_block", "v_count"],
)
def best_block_window(spark, sf_dir):
    """The window of up to six blocks that fits an excerpt best, for every node whose page and excerpt are there."""
    c = d.candidates(spark, sf_dir)
    some = F.filter(F.col("graph.nodes"), lambda n: (F.coalesce(n["excerpt"], F.lit("")) != "") & (n["page"] <= F.col("page_count")))
    # the suggestion operator looks at misaligned nodes; here every node is declared so, to compare all windows
    c = c.withColumn("alignments", F.transform(some, lambda n: F.struct(n["id"].alias("node_id"), n["page"].alias("page_number"), F.lit("misaligned").alias("status"), F.lit(0.0).alias("bbox_token_coverage"))))
    s = gates.repair_suggestions(c).select("sample_id", F.explode("suggestions").alias("s")).where("size(s.matched_block_ids) > 0")
    first = F.split(F.get("s.matched_block_ids", 0), "_")
    return s.select("sample_id", F.col("s.node_id").alias("node_id"), F.col("s.suggested_token_coverage").alias("coverage"), F.col("s.score").alias("score"), F.size("s.matched_block_ids").alias("n_blocks"), F.get(first, 1).cast("int").alias("first_block"))


_REACHED = "(select o.sample_id, o.q, list_distinct(flatten(list(v.inputs))) as reached from (select sample_id, q from v_cand) o join v_op v using (sample_id) group by all)"
_CTRL = listed(CONTROLLING_ROLES)
_FEATURES = f"""select c.*, n.n_nodes, n.n_pages, n.n_ctrl, n.n_loose, o.n_ops, o.n_work from v_cand c
join (select c.sample_id, count(k) as n_nodes, count(distinct page) as n_pages, count(*) filter (list_contains({_CTRL}, role)) as n_ctrl, count(*) filter (key and k >= q) as n_loose from v_cand c left join v_node n using (sample_id) group by 1) n using (sample_id)
join (select sample_id, count(*) as n_ops, count(*) filter (op <> 'lookup') as n_work from v_op group by 1) o using (sample_id)"""


@query("select sample_id, array_to_string(list_sort(list_filter(list_distinct(flatten(list(inputs))), lambda i: starts_with(i, 'e'))), ',') as reaching from v_op group by sample_id", ["v_op"])
def graph_reachability(spark, sf_dir):
    """Evidence ids on a path to the final output. The chain of derived operations uses every one, which SQL counts flat."""
    r = F.filter(graph.reaching_final(F.col("graph")), lambda i: F.startswith(i, F.lit("e")))
    return d.candidates(spark, sf_dir, False).select("sample_id", F.array_join(F.array_sort(r), ",").alias("reaching"))


@query(f"select sample_id, array_to_string(list_filter([case when n_nodes < 2 then 'insufficient_evidence_nodes' end, case when n_ops < 2 then 'insufficient_dependent_operations' end, case when n_work = 0 then 'lookup_only' end, case when n_ctrl = 0 then 'missing_controlling_evidence' end, case when not tier2 then 'missing_tier_2_axis' end, case when not tier3 then 'missing_tier_3_axis' end, case when n_loose > 0 then 'key_evidence_not_connected_to_final_output' end], lambda r: r is not null), ',') as reasons, n_nodes::int as n_nodes, n_ops::int as n_ops, n_loose = 0 as connected from ({_FEATURES})", ["v_cand", "v_node", "v_op"])
def structural_gate(spark, sf_dir):
    g = gates.structural_gate(d.candidates(spark, sf_dir, False))
    return g.select("sample_id", F.array_join("structural_gate.reasons", ",").alias("reasons"), F.col("features.evidence_node_count").alias("n_nodes"), F.col("features.dependent_operation_count").alias("n_ops"), F.col("features.all_key_nodes_reach_final").alias("connected"))


_SCORE = "round(0.2::double * (least(n_nodes, 6)::double / 6.0::double) + 0.2::double * (least(n_ops, 6)::double / 6.0::double) + 0.2::double * (least(n_pages, 4)::double / 4.0::double) + 0.15::double * (least(n_ctrl, 2)::double / 2.0::double) + 0.15::double * (least(tier2::int + tier3::int, 4)::double / 4.0::double) + 0.1::double * visual::int, 4)"


@query(f"select sample_id, s as structural_score, case when s >= 0.65::double then 'hard' when s >= 0.45::double then 'medium' else 'reject' end as predicted_label from (select sample_id, {_SCORE} as s from ({_FEATURES}))", ["v_cand", "v_node", "v_op"])
def difficulty_score(spark, sf_dir):
    g = gates.difficulty(gates.features(d.candidates(spark, sf_dir, False)))
    return g.select("sample_id", "structural_score", "predicted_label")


_STATIC = f"""select f.*, f.profile = 'text_only' and f.visual as bad_visual,
 exists(select 1 from v_node n join v_page p on p.doc_id = n.doc_id and p.page_number = n.page where n.sample_id = f.sample_id and f.profile = 'text_only' and {_STRIP.format('p.text')} = '') as unseen,
 exists(select 1 from v_node n where n.sample_id = f.sample_id and not list_contains(f.included, n.page)) as outside,
 exists(select 1 from v_node n where n.sample_id = f.sample_id and n.page > f.page_count) as beyond,
 exists(select 1 from v_claim k where k.sample_id = f.sample_id and starts_with(on_ref, 'e') and substr(on_ref, 2)::int >= k.m) as loose,
 exists(select 1 from v_claim k where k.sample_id = f.sample_id and not covered) as uncovered,
 exists(select 1 from v_claim k where k.sample_id = f.sample_id and i = 1 and covered) as primary_ok,
 (n_nodes < 2 or n_ops < 2 or n_work = 0 or n_ctrl = 0 or not tier2 or not tier3 or n_loose > 0) as gate_bad
 from ({_FEATURES}) f"""
_FAILED = {"text_only_visibility": "bad_visual", "text_only_evidence_has_extracted_text": "unseen", "evidence_pages_in_document_view": "outside", "evidence_pages_in_range": "beyond", "claims_resolve_to_evidence": "loose", "has_dodged_bullet": "not dodged", "has_primary_intent": "not primary_ok", "rubric_covers_all_gold_claims": "uncovered", "gdp_like_structural_gate": "gate_bad"}


@query("select \"check\", count(*) as n_failed from (" + " union all ".join(f"select '{k}' as \"check\" from s where {v}" for k, v in _FAILED.items()) + ") group by 1", None)
def static_check_histogram(spark, sf_dir):
    c = gates.static_verify(d.candidates(spark, sf_dir, False))
    return c.select(F.explode("checks").alias("c")).where("not c.passed").groupBy(F.col("c.check").alias("check")).agg(F.count(F.lit(1)).alias("n_failed"))


ORACLES["static_check_histogram"] = with_views(["v_cand", "v_node", "v_op", "v_claim", "v_page"], "").rstrip() + f", s as ({_STATIC}) " + ORACLES["static_check_histogram"]


@query("select sample_id, not (" + " or ".join(_FAILED.values()) + ") as passed from s", None)
def static_verdicts(spark, sf_dir):
    return gates.static_verify(d.candidates(spark, sf_dir, False)).select("sample_id", F.col("static_checks_passed").alias("passed"))


ORACLES["static_verdicts"] = with_views(["v_cand", "v_node", "v_op", "v_claim", "v_page"], "").rstrip() + f", s as ({_STATIC}) " + ORACLES["static_verdicts"]


@query("select k.sample_id, k.claim_id, k.on_ref as reference from v_claim k left join v_node n on n.sample_id = k.sample_id and n.node_id = k.on_ref left join v_claim c on c.sample_id = k.sample_id and c.claim_id = k.on_ref where n.node_id is null and c.claim_id is null", ["v_claim", "v_node"])
def referential_orphans(spark, sf_dir):
    """References of claims that are neither evidence nor claim, as a left anti join of exploded references."""
    c = d.candidates(spark, sf_dir, False)
    refs = c.select("sample_id", F.explode("claims").alias("c")).select("sample_id", F.col("c.claim_id").alias("claim_id"), F.explode("c.supported_by").alias("reference"))
    known = c.select(F.col("sample_id").alias("s"), F.explode(F.concat(gates.ids_of(F.col("graph.nodes"), "id"), gates.ids_of(F.col("claims"), "claim_id"))).alias("r"))
    return refs.join(known, (F.col("sample_id") == F.col("s")) & (F.col("reference") == F.col("r")), "left_anti")


@query("select a.sample_id, array_to_string(list_sort(list(a.claim_id) filter (not exists(select 1 from v_claim r where r.sample_id = a.sample_id and r.i <= a.i and starts_with(r.on_ref, 'e') and substr(r.on_ref, 2)::int < r.m and (r.i = a.i or (select count(*) from v_claim z where z.sample_id = a.sample_id and z.i > r.i and z.i <= a.i and starts_with(z.on_ref, 'c')) = a.i - r.i)))), ',') as ungrounded from v_claim a group by 1", ["v_claim"])
def claim_grounding(spark, sf_dir):
    """Claims that no chain of claims ties to existing evidence."""
    c = d.candidates(spark, sf_dir, False)
    u = graph.ungrounded_claims(F.col("claims"), gates.ids_of(F.col("graph.nodes"), "id"))
    return c.select("sample_id", F.array_join(F.array_sort(u), ",").alias("ungrounded"))


ORACLES["claim_grounding"] = ORACLES["claim_grounding"].replace("array_to_string(list_sort(list(a.claim_id)", "coalesce(array_to_string(list_sort(list(a.claim_id)").replace("), ',') as ungrounded", "), ','), '') as ungrounded")


@query()
def dedup_selected(spark, sf_dir):
    """Greedy diverse selection per document; tested against a plain loop."""
    c = gates.difficulty(gates.features(d.candidates(spark, sf_dir, False))).withColumn("static_checks_passed", F.lit(True))
    # candidates of one source meet, as the derived documents have one each
    c = c.withColumn("document_id", F.concat(F.lit("group:"), F.pmod(F.col("doc_id"), F.lit(97)).cast("string")))
    return select.select_diverse(c, Deduplication())


@query()
def greedy_region_match(spark, sf_dir):
    """Region overlap of each candidate's evidence with itself moved by a fixed step; tested against a plain loop."""
    c = d.candidates(spark, sf_dir, False).select("sample_id", F.col("graph.nodes").alias("n"))
    moved = F.transform("n", lambda x: x.withField("bbox", geometry.box(x["bbox"]["x0"] + 0.1, x["bbox"]["y0"], x["bbox"]["x1"] + 0.1, x["bbox"]["y1"])))
    return c.select("sample_id", select.region_jaccard(F.col("n"), moved, 0.30).alias("region_jaccard"))


def _finalized(spark, sf_dir):
    """Candidates with hash-made reviews, verifier results and licenses from labels, through the final gate."""
    c = gates.alignment(gates.static_verify(d.candidates(spark, sf_dir)))
    lic = d.documents(spark, sf_dir).select(F.col("doc_id").alias("ld"), "license_status")
    c = c.join(lic, F.col("doc_id") == F.col("ld"))
    n = F.pmod(d.h(":w"), F.lit(3))
    tick = lambda i: F.pmod(d.h(":q:", F.lit(i)), F.lit(4)) != 0
    items = ["question_unambiguous", "gold_answer_verified", "rubric_negative_cases_verified", "visual_evidence_verified", "omitted_page_audit_verified"]
    sheet = F.create_map(*[x for i, name in enumerate(items) for x in (F.lit(name), tick(i))])
    review = F.struct(F.when(n == 0, "approved").when(n == 1, "pending").otherwise("rejected").alias("decision"), F.lit("r1").alias("reviewer"), F.lit("human").alias("reviewer_type"), sheet.alias("checklist"))
    v = F.pmod(d.h(":i"), F.lit(4))
    c = c.withColumn("review", review).withColumn("independent_verifier_status", F.when(v < 2, "passed").when(v == 2, "failed").otherwise("needs_review"))
    c = c.withColumn("source_url", F.lit("https://example.com/")).withColumn("package_fits", F.lit(True)).withColumn("package_view_id", F.col("view_id")).withColumn("derivation_status", F.array().cast("array<string>"))
    return gates.finalize(c)


def _q(mark: str, n: int) -> str:
    return f"{hs(chr(39) + mark + chr(39))} % {n}"


_COMPLETE = f"({_q(':w', 3)} = 0 and " + " and ".join(f"{_q(f':q:{i}', 4)} <> 0" for i in range(3)) + f" and (not visual or {_q(':q:3', 4)} <> 0) and (len(included) = page_count or {_q(':q:4', 4)} <> 0))"
_FINAL = f"""select s.*, {_COMPLETE} as complete, {_q(':w', 3)} = 2 as refused, {_q(':i', 4)} as verifier, coalesce(lq.st, 'needs_review') = 'approved' as licensed,
 a.bad > 0 as bbox_bad, a.unknown > 0 as bbox_unknown, {_q(':q:3', 4)} <> 0 as saw_visual, {_q(':q:4', 4)} <> 0 as saw_pages
 from s left join (select sample_id, count(*) filter (status in ('misaligned', 'missing_page')) as bad, count(*) filter (starts_with(status, 'not_checkable')) as unknown from ({_ALIGNED}) group by 1) a using (sample_id)
 left join (select doc_id, case when quality = 1 and toxic = 0 then 'approved' else 'rejected' end as st from labels) lq using (doc_id)"""


@query(
    "select final_status, human_status, count(*) as n from (select case when " + "{P}" + " then 'passed' when {F} then 'failed' else 'needs_review' end as final_status, case when complete then 'approved' when refused then 'rejected' else 'not_reviewed' end as human_status from f) group by all"
)
def final_status_matrix(spark, sf_dir):
    return _finalized(spark, sf_dir).groupBy(F.col("final_validation_status").alias("final_status"), F.col("human_review_status").alias("human_status")).agg(F.count(F.lit(1)).alias("n"))


_OK = "not (" + " or ".join(_FAILED.values()) + ")"
_STRUCT = "(primary_ok and dodged and not uncovered)"
_BOX = "(not coalesce(bbox_bad, false) and (not coalesce(bbox_unknown, false) or (complete and saw_visual)))"
_VIEW = "(len(included) = page_count or (complete and saw_pages))"
_PASS = f"{_OK} and licensed and {_VIEW} and verifier < 2 and {_BOX} and {_STRUCT} and complete"
_FATAL = f"(not ({_OK}) or not licensed or not {_STRUCT} or refused or verifier = 2)"
_F_VIEWS = with_views(["v_cand", "v_node", "v_op", "v_claim", "v_page", "v_block", "v_count"], "").rstrip() + f", s as ({_STATIC}), f as ({_FINAL}) "
ORACLES["final_status_matrix"] = _F_VIEWS + ORACLES["final_status_matrix"].replace("{P}", _PASS).replace("{F}", _FATAL)


@query(_F_VIEWS + f"""select "check", count(*) as n_failed from (
select unnest(list_filter([case when not licensed then 'final_source_and_license' end, case when not {_VIEW} then 'final_document_view_audit' end, case when verifier >= 2 then 'final_independent_gold_verification' end, case when not {_BOX} then 'final_evidence_bbox_alignment' end, case when not ({_STRUCT} and complete) then 'final_rubric_unit_review' end, case when not complete then 'final_human_review' end], lambda x: x is not null)) as "check" from f) group by 1""")
def final_blockers(spark, sf_dir):
    c = _finalized(spark, sf_dir).select(F.explode("checks").alias("c")).where("not c.passed").select(F.col("c.check").alias("check")).where(F.startswith("check", F.lit("final_")))
    return c.groupBy("check").agg(F.count(F.lit(1)).alias("n_failed"))


def _exported(spark, sf_dir):
    """Turns as training records: user content, answer, split and tokens."""
    t = d.turns(spark, sf_dir)
    x = docs(spark, sf_dir).select(F.col("doc_id").alias("d"), F.col("text").alias("document_text"))
    t = t.join(x, F.col("doc_id") == F.col("d"))
    user = F.concat("prompt", F.lit("\n\n"), "document_text")
    split = ids.split_of(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")))
    tokens = budget.text_tokens(F.length(user) + F.length("gold_answer"), B)
    return t.select("sample_id", split.alias("split"), user.alias("user"), F.col("gold_answer").alias("answer"), tokens.alias("tokens"))


_EXPORT = "select sample_id, " + _SPLIT.format(H.format("'doc:' || doc_id")) + f" as split, prompt || chr(10) || chr(10) || d.text as u, gold_answer as a, ceil((length(prompt || chr(10) || chr(10) || d.text) + length(gold_answer)) / {B.provisional_chars_per_token}::double)::bigint as tokens from v_turn join documents d using (doc_id)"


@query(f"select sample_id, split, sha256(u) as user_sha256, sha256(a) as answer_sha256, tokens, tokens / {B.model_context_tokens}.0::double as utilization from ({_EXPORT})", ["v_turn"])
def export_conversations(spark, sf_dir):
    e = _exported(spark, sf_dir)
    return e.select("sample_id", "split", F.sha2(F.col("user").cast("binary"), 256).alias("user_sha256"), F.sha2(F.col("answer").cast("binary"), 256).alias("answer_sha256"), "tokens", budget.utilization(F.col("tokens"), B).alias("utilization"))


@query(f"select s.split, count(e.sample_id) as n_records, coalesce(sum(tokens), 0)::bigint as tokens from (values ('train'), ('validation'), ('internal_holdout')) s(split) left join ({_EXPORT}) e using (split) group by 1", ["v_turn"])
def export_manifest(spark, sf_dir):
    """Records and tokens of each split, those without any too."""
    names = spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in ("train", "validation", "internal_holdout")])).alias("split"))
    e = _exported(spark, sf_dir).groupBy(F.col("split").alias("s")).agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"))
    return names.join(e, F.col("split") == F.col("s"), "left").select("split", F.coalesce("n", F.lit(0)).alias("n_records"), F.coalesce("t", F.lit(0)).alias("tokens"))


@query("select sample_id, case when (" + _q(":g", 3) + ") <> 0 then 'passed' else 'not_run' end as status, case when (" + _q(":g", 3) + ") <> 0 then 3 else 1 end as n_checks from v_turn", ["v_turn"])
def carry_forward(spark, sf_dir):
    """Verifier results move to a new run for candidates that did not change: two of three here."""
    t = d.turns(spark, sf_dir)
    one = lambda name: F.struct(F.lit(name).alias("check"), F.lit(True).alias("passed"), F.lit(None).cast("string").alias("details"))
    new = t.select(F.struct("sample_id", "prompt").alias("candidate"), F.array(one("has_primary_intent")).alias("checks"))
    changed = F.when(F.pmod(d.h(":g"), F.lit(3)) == 0, F.concat("prompt", F.lit("!"))).otherwise(F.col("prompt"))
    old = t.select(F.struct("sample_id", changed.alias("prompt")).alias("candidate"), F.array(one("has_primary_intent"), one("independent_audit_output_complete"), one("independent_verifier_service")).alias("checks"), F.lit("passed").alias("independent_verifier_status"))
    out = gates.carried_forward(new, old)
    return out.select(F.col("candidate.sample_id").alias("sample_id"), F.col("independent_verifier_status").alias("status"), F.size("checks").alias("n_checks"))


@query("select doc_id, n, value from (unpivot (select doc_id, nullif(string_split(text, chr(10))[1], '') as r1, nullif(string_split(text, chr(10))[2], '') as r2, nullif(string_split(text, chr(10))[3], '') as r3, nullif(string_split(text, chr(10))[4], '') as r4 from documents) on r1, r2, r3, r4 into name n value value)")
def rubric_unpivot(spark, sf_dir):
    """Numbered columns to rows, empty ones left out."""
    lines = F.split("text", "\n")
    wide = docs(spark, sf_dir).select("doc_id", *[F.get(lines, i).alias(f"r{i + 1}") for i in range(4)])
    return wide.unpivot("doc_id", ["r1", "r2", "r3", "r4"], "n", "value").where("value is not null and value <> ''")


_SUMS = [("100 - 10", "leaves 90 units", 90.0, "verified"), ("2^3 × 1.5", "12", 12.0, "verified"), ("1 / 0", "0", None, "not_checkable"), ("x + 1", "2", None, "not_checkable"), ("(1,200)", "1,200", None, "not_checkable"), ("-5 + 2", "about 3", -3.0, "mismatch"), ("7 ÷ 2 = 3.5", "3.5", None, "not_checkable"), ("1000 * 1.004", "a total of 1,000", 1004.0, "verified")]


@query("select * from (values " + ", ".join(f"('{e}', {'null' if v is None else v}::double, '{s}')" for e, _, v, s in _SUMS) + ") t(expression, value, status)")
def safe_arithmetic(spark, sf_dir):
    rows = spark.createDataFrame([(e, c) for e, c, _, _ in _SUMS], "expression string, claim string")
    rows = rows.withColumn("value", select.safe_arithmetic("expression"))
    return rows.select("expression", "value", select.derivation_status(F.col("value"), F.col("claim")).alias("status"))


@query("select * from (values (20, 'structured_layout', 9), (20, 'text_reasoning', 3), (20, 'visual_spatial', 8), (3, 'structured_layout', 1), (3, 'visual_spatial', 1), (3, 'text_reasoning', 1)) t(total, name, n)")
def type_schedule(spark, sf_dir):
    weights = Config().generation.primary_evidence_type_weights
    rows = [(total, i, name) for total in (3, 20) for i, name in enumerate(select.type_schedule(weights, total))]
    return spark.createDataFrame(rows, "total int, place int, name string").groupBy("total", "name").agg(F.count(F.lit(1)).cast("int").alias("n"))


@query("select primary_evidence_type, profile, count(*) as n, count(distinct doc_id) as n_docs, sum(m)::bigint as nodes, coalesce(bool_and(visual), false) as all_visual, array_to_string(list_sort(list(distinct profile)), ',') as profiles from v_cand group by all", ["v_cand"])
def candidate_histogram(spark, sf_dir):
    g = d.candidates(spark, sf_dir, False).groupBy("primary_evidence_type", F.col("input_profile").alias("profile"))
    return g.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("n_docs"), F.sum(F.size("graph.nodes").cast("long")).alias("nodes"), F.coalesce(F.bool_and("requires_visual_evidence"), F.lit(False)).alias("all_visual"), F.array_join(F.array_sort(F.collect_set("input_profile")), ",").alias("profiles"))


@query("select sample_id, node_id, array_to_string(list_sort(list(claim_id)), ',') as claims from v_node n join v_claim k using (sample_id) where on_ref = node_id group by all", ["v_node", "v_claim"])
def claims_by_node(spark, sf_dir):
    """The reverse index from evidence to the claims that rest on it."""
    c = d.candidates(spark, sf_dir, False)
    refs = c.select("sample_id", gates.ids_of(F.col("graph.nodes"), "id").alias("known"), F.explode("claims").alias("c")).select("sample_id", "known", F.col("c.claim_id").alias("claim_id"), F.explode("c.supported_by").alias("node_id"))
    return refs.where(F.array_contains("known", F.col("node_id"))).groupBy("sample_id", "node_id").agg(F.array_join(F.array_sort(F.collect_list("claim_id")), ",").alias("claims"))


@query("select sample_id, doc_id from v_turn where sample_id not in (select sample_id from (select sample_id from v_turn where " + _q(":y", 2) + " = 0)) order by sample_id", ["v_turn"])
def resume_pending(spark, sf_dir):
    """What a first run left open: a left anti join on ids."""
    t = d.turns(spark, sf_dir).select("sample_id", "doc_id")
    done = t.where(F.pmod(d.h(":y"), F.lit(2)) == 0).select("sample_id")
    return t.join(done, "sample_id", "left_anti")


@query("select source, max(doc_id) as doc_id, arg_max(lang, doc_id) as lang, arg_max(n_chars, doc_id) as n_chars from documents group by source")
def latest_per_key(spark, sf_dir):
    """The last row of each key wins."""
    return docs(spark, sf_dir).groupBy("source").agg(F.max("doc_id").alias("doc_id"), F.max_by("lang", "doc_id").alias("lang"), F.max_by("n_chars", "doc_id").alias("n_chars"))


@query("select count(*) as n_candidates, sum(m)::bigint as n_nodes, sum(q)::bigint as n_operations, count(*) filter (visual) as n_visual, count(distinct doc_id) as n_documents from v_cand", ["v_cand"])
def funnel_scalars(spark, sf_dir):
    c = d.candidates(spark, sf_dir, False)
    return c.agg(F.count(F.lit(1)).alias("n_candidates"), F.sum(F.size("graph.nodes").cast("long")).alias("n_nodes"), F.sum(F.size("graph.operations").cast("long")).alias("n_operations"), F.count_if("requires_visual_evidence").alias("n_visual"), F.count_distinct("doc_id").alias("n_documents"))


@query()
def exact_text_tokens(spark, sf_dir):
    """Exact token counts; tested against the tokenizer library."""
    import public_tokenizers

    select.small_batches(spark)
    return docs(spark, sf_dir).select("doc_id", select.count_tokens(public_tokenizers.path("byte_bpe_50k.json"))("text").alias("n_tokens"))


@query("select distinct doc_id from v_cand where page_count <= 8", ["v_cand"])
def packages_of_generated(spark, sf_dir):
    """Packages of documents that have tasks: a left semi join."""
    c = d.turns(spark, sf_dir).select("doc_id")
    k = d.kept_pages(spark, sf_dir).where("page_count <= 8").select("doc_id")
    return k.join(c, "doc_id", "left_semi")


__all__ = ["ORACLES", "QUERIES", "all_passed"]
