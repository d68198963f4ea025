"""Task records derived from the driver tables, by formulas that SQL can repeat (h: first 32 bits of a SHA-256).

A document is its lines as blocks, eight to a page. A candidate is a user turn with the assistant turn
after it; hashes of its id pick its document, evidence, operations, claims and rubric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evigrain.constants import EVIDENCE_TYPES, ROLES, TIER_2_AXES, TIER_3_AXES, VERBS
from evigrain.functions import geometry, ids
from evigrain.operators import gates

LINES = 8


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, document_id, size_bytes, source, license_status)"""
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("l"), "quality", "toxic")
    d = table(spark, sf_dir, "documents").join(labels, F.col("doc_id") == F.col("l"), "left")
    status = F.when(F.col("l").isNull(), "needs_review").when((F.col("quality") == 1) & (F.col("toxic") == 0), "approved").otherwise("rejected")
    return d.select("doc_id", ids.document_id(F.col("text")).alias("document_id"), F.octet_length("text").alias("size_bytes"), "source", status.alias("license_status"))


def paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_count, pages array<struct<page_number,extracted_text,blocks>>), nested, so that nothing is shuffled."""
    lines = F.split("text", "\n")
    n = F.ceil(F.size("lines") / F.lit(LINES)).cast("int")

    def block(t: Column, i: Column, page: Column) -> Column:
        y = i.cast("double") / LINES
        return F.struct(F.concat(F.lit("b"), page.cast("string"), F.lit("_"), i.cast("string")).alias("block_id"), geometry.box(F.lit(0.05), y, F.lit(0.95), (i + 1).cast("double") / LINES).alias("bbox"), t.alias("text"), i.cast("int").alias("reading_order"))

    def page(p: Column) -> Column:
        part = F.slice("lines", (p - 1) * LINES + 1, F.lit(LINES))
        return F.struct(p.cast("int").alias("page_number"), F.array_join(part, "\n").alias("extracted_text"), F.transform(part, lambda t, i: block(t, i, p)).alias("blocks"))

    d = table(spark, sf_dir, "documents").select("doc_id", lines.alias("lines")).withColumn("page_count", n)
    return d.select("doc_id", "page_count", F.transform(F.sequence(F.lit(1), F.col("page_count")), page).alias("pages"))


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_number, reading_order, block_id, bbox, text)"""
    p = paged(spark, sf_dir).select("doc_id", F.explode("pages").alias("p"))
    return p.select("doc_id", F.col("p.page_number").alias("page_number"), F.explode("p.blocks").alias("b")).select("doc_id", "page_number", "b.reading_order", "b.block_id", "b.bbox", "b.text")


def kept_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, page_count, included): pages kept by a hash; a document that would lose all keeps the first."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.ceil(F.size(F.split("text", "\n")) / F.lit(LINES)).cast("int").alias("page_count"))
    keep = F.filter(F.sequence(F.lit(1), F.col("page_count")), lambda p: F.pmod(ids.hash_int(F.concat_ws(":", F.col("doc_id").cast("string"), p.cast("string"))), F.lit(4)) != 0)
    return d.select("doc_id", "page_count", F.when(F.size(keep) > 0, keep).otherwise(F.array(F.lit(1))).alias("included"))


def h(*parts) -> Column:
    """Hash of the sample id with a mark and numbers."""
    return ids.hash_int(F.concat(F.col("sample_id"), *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]))


def pick(values: list[str], at: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), at.cast("int"))


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(sample_id, doc_id, prompt, gold_answer): user turns and the assistant turns that follow at once."""
    c = table(spark, sf_dir, "conversations")
    ask = c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    tell = c.where("role = 'assistant'").select(F.col("conv_id").alias("c2"), (F.col("turn") - 1).alias("t2"), F.col("text").alias("gold_answer"))
    n = table(spark, sf_dir, "documents").count()
    out = ask.join(tell, (F.col("conv_id") == F.col("c2")) & (F.col("turn") == F.col("t2"))).withColumn("sample_id", F.concat_ws("_", F.lit("conv"), "conv_id", "turn"))
    return out.select("sample_id", F.pmod(ids.hash_int(F.col("sample_id")), F.lit(max(1, n))).alias("doc_id"), "prompt", "gold_answer")


def candidates(spark: SparkSession, sf_dir: str, with_pages: bool = True) -> DataFrame:
    """Candidates with nested evidence, beside their document's pages, page_count and frozen view."""
    t = turns(spark, sf_dir)
    p = paged(spark, sf_dir).withColumnRenamed("doc_id", "d")
    v = kept_pages(spark, sf_dir).select(F.col("doc_id").alias("v"), F.col("included").alias("view_pages"))
    t = t.join(p, F.col("doc_id") == F.col("d")).join(v, F.col("doc_id") == F.col("v"))
    m, q, c = (F.pmod(h(":n"), F.lit(6)).cast("int"), (F.pmod(h(":o"), F.lit(5)) + 1).cast("int"), (F.pmod(h(":c"), F.lit(3)) + 1).cast("int"))
    t = t.select("*", m.alias("m"), q.alias("q"), c.alias("c"))
    text = lambda n: F.concat(n[0], n[1].cast("string")) if isinstance(n, tuple) else n

    def node(k: Column) -> Column:
        hp = h(":p:", k)
        page = gates.let(hp, lambda x: (F.pmod(x, F.col("page_count")) + 1 + F.when(F.pmod(x, F.lit(17)) == 0, 1).otherwise(0)).cast("int"))
        x, y = F.pmod(h(":x:", k), F.lit(700)) / 1000.0, F.pmod(h(":y:", k), F.lit(700)) / 1000.0
        place = F.pmod(h(":b:", k), F.lit(LINES)).cast("int")
        # pages are in order from 1, so a page is found by its place; the page is bound, so that its hash is worked out once
        return gates.let(page, lambda p: F.struct(text((F.lit("e"), k)).alias("id"), p.alias("page"), geometry.box(x, y, x + 0.25, y + 0.25).alias("bbox"), pick(ROLES, F.pmod(h(":r:", k), F.lit(13))).alias("role"), F.get(F.get("pages", p - 1)["blocks"], place)["text"].alias("excerpt"), (F.pmod(h(":k:", k), F.lit(5)) != 0).alias("key")))

    def operation(j: Column) -> Column:
        before = F.when(j > 1, text((F.lit("o"), j - 1)))
        fresh = F.when((j - 1 < F.col("m")) | (j == 1), text((F.lit("e"), j - 1)))
        return F.struct(pick(VERBS, F.pmod(h(":v:", j), F.lit(15))).alias("op"), F.array_compact(F.array(before, fresh)).alias("inputs"), text((F.lit("o"), j)).alias("output"))

    def claim(i: Column) -> Column:
        chained = (i > 1) & (F.pmod(h(":s2:", i), F.lit(2)) == 0)
        on = F.when(chained, text((F.lit("c"), i - 1))).otherwise(F.concat(F.lit("e"), F.pmod(h(":s:", i), F.lit(7)).cast("string")))
        return F.struct(text((F.lit("c"), i)).alias("claim_id"), F.array(on).alias("supported_by"))

    def criterion(i: Column) -> Column:
        return F.struct(text((F.lit("r"), i)).alias("criterion_id"), F.when(i == 1, "primary_intent").otherwise("supporting").alias("criterion_type"), F.array(text((F.lit("c"), i))).alias("supported_by"))

    upto = lambda name, n: F.when(F.col(name) > 0, F.sequence(F.lit(1), F.col(name))).otherwise(F.array().cast("array<int>"))
    nodes = F.transform(upto("m", 6), lambda i: node(i - 1))
    graph = F.struct(nodes.alias("nodes"), F.transform(upto("q", 5), operation).alias("operations"), F.concat(F.lit("o"), F.col("q").cast("string")).alias("final_output"))
    dodged = F.array(F.struct(F.lit("rd").alias("criterion_id"), F.lit("dodged_bullet").alias("criterion_type"), F.array().cast("array<string>").alias("supported_by")))
    rubric = F.filter(F.transform(upto("c", 3), lambda i: F.when(F.pmod(h(":u:", i), F.lit(11)) != 0, criterion(i))), lambda r: r.isNotNull())
    rubric = F.concat(rubric, F.when(F.pmod(h(":d"), F.lit(7)) != 0, dodged).otherwise(F.filter(dodged, lambda _: F.lit(False))))
    a2, a3 = F.pmod(h(":a2"), F.lit(6)), F.pmod(h(":a3"), F.lit(6))
    axes = F.array_compact(F.array(F.when(a2 < 4, pick(TIER_2_AXES, a2)), F.when(a3 < 4, pick(TIER_3_AXES, a3))))
    full = F.size("view_pages") == F.col("page_count")
    key = F.concat(F.lit("doc:"), F.col("doc_id").cast("string"))
    cols = [
        "sample_id", "doc_id", key.alias("document_id"), "prompt", "gold_answer", "page_count",
        pick(EVIDENCE_TYPES, F.pmod(h(":t"), F.lit(3))).alias("primary_evidence_type"),
        (F.pmod(h(":z"), F.lit(2)) == 0).alias("requires_visual_evidence"),
        F.when(F.pmod(h(":f"), F.lit(3)) == 0, "text_only").otherwise("multimodal").alias("input_profile"),
        F.array(F.lit("multimodal"), F.lit("text_only")).alias("supported_input_profiles"),
        axes.alias("capability_axes"), graph.alias("graph"), F.transform(upto("c", 3), claim).alias("claims"), rubric.alias("rubric"),
        F.array().cast("array<struct<result_claim:string,expression:string,inputs:array<string>>>").alias("derivations"),
        "view_pages", ids.view_id(key, F.col("view_pages"), full).alias("view_id"), ids.view_id(key, F.col("view_pages"), full).alias("document_view_id"),
        F.when(full, "full_pdf").otherwise("bounded").alias("view_scope"),
        F.transform(F.filter("pages", lambda g: F.coalesce(F.regexp_replace(g["extracted_text"], r"^\s+|\s+$", ""), F.lit("")) == ""), lambda g: g["page_number"]).alias("empty_pages"),
    ]
    return t.select(*cols, *(["pages"] if with_pages else []))


#: The same views for DuckDB, as common table expressions.
H = "('0x' || substr(sha256({}), 1, 8))::bigint"


def hs(*parts: str) -> str:
    return H.format(" || ".join(["sample_id", *parts]))


def listed(values: list[str]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_NODE_PAGE = f"({hs(chr(39) + ':p:' + chr(39), 'k')} % page_count + 1 + case when {hs(chr(39) + ':p:' + chr(39), 'k')} % 17 = 0 then 1 else 0 end)"
VIEWS = {
    "v_line": f"select doc_id, unnest(string_split(text, chr(10))) as text, unnest(range(len(string_split(text, chr(10))))) as p from documents",
    "v_block": f"select doc_id, (p // {LINES} + 1)::int as page_number, (p % {LINES})::int as reading_order, text, 'b' || (p // {LINES} + 1) || '_' || (p % {LINES}) as block_id, 0.05::double as x0, (p % {LINES})::double / {LINES} as y0, 0.95::double as x1, (p % {LINES} + 1)::double / {LINES} as y1 from v_line",
    "v_page": "select doc_id, page_number, string_agg(text, chr(10) order by reading_order) as text, count(*) as n_blocks from v_block group by all",
    "v_count": f"select doc_id, ceil(len(string_split(text, chr(10))) / {LINES})::int as page_count from documents",
    "v_kept": "select doc_id, page_count, case when len(k) > 0 then k else [1] end as included from (select doc_id, page_count, list_filter(range(1, page_count + 1), lambda p: " + H.format("doc_id || ':' || p") + " % 4 <> 0) as k from v_count)",
    "v_turn": f"select 'conv_' || a.conv_id || '_' || a.turn as sample_id, {H.format(chr(39) + 'conv_' + chr(39) + ' || a.conv_id || ' + chr(39) + '_' + chr(39) + ' || a.turn')} % (select count(*) from documents) as doc_id, a.text as prompt, b.text as gold_answer from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1 where a.role = 'user' and b.role = 'assistant'",
    "v_cand": f"select t.*, c.page_count, v.included, ({hs(chr(39) + ':n' + chr(39))} % 6)::int as m, ({hs(chr(39) + ':o' + chr(39))} % 5 + 1)::int as q, ({hs(chr(39) + ':c' + chr(39))} % 3 + 1)::int as c, {listed(EVIDENCE_TYPES)}[{hs(chr(39) + ':t' + chr(39))} % 3 + 1] as primary_evidence_type, {hs(chr(39) + ':z' + chr(39))} % 2 = 0 as visual, case when {hs(chr(39) + ':f' + chr(39))} % 3 = 0 then 'text_only' else 'multimodal' end as profile, {hs(chr(39) + ':a2' + chr(39))} % 6 < 4 as tier2, {hs(chr(39) + ':a3' + chr(39))} % 6 < 4 as tier3, {hs(chr(39) + ':d' + chr(39))} % 7 <> 0 as dodged from v_turn t join v_count c using (doc_id) join v_kept v using (doc_id)",
    "v_node": f"select sample_id, doc_id, k, 'e' || k as node_id, page, role, key, visual, profile, x0, y0, x0 + 0.25 as x1, y0 + 0.25 as y1, b.text as excerpt from (select *, {_NODE_PAGE}::int as page, {listed(ROLES)}[{hs(chr(39) + ':r:' + chr(39), 'k')} % 13 + 1] as role, {hs(chr(39) + ':k:' + chr(39), 'k')} % 5 <> 0 as key, ({hs(chr(39) + ':x:' + chr(39), 'k')} % 700) / 1000.0::double as x0, ({hs(chr(39) + ':y:' + chr(39), 'k')} % 700) / 1000.0::double as y0, ({hs(chr(39) + ':b:' + chr(39), 'k')} % {LINES})::int as at from (select *, unnest(range(m)) as k from v_cand)) n left join (select doc_id as bd, page_number, reading_order, text from v_block) b on b.bd = n.doc_id and b.page_number = n.page and b.reading_order = n.at",
    "v_op": f"select sample_id, j, {listed(VERBS)}[{hs(chr(39) + ':v:' + chr(39), 'j')} % 15 + 1] as op, 'o' || j as output, list_filter([case when j > 1 then 'o' || (j - 1) end, case when j - 1 < m or j = 1 then 'e' || (j - 1) end], lambda i: i is not null) as inputs from (select *, unnest(range(1, q + 1)) as j from v_cand)",
    "v_claim": f"select sample_id, m, i, 'c' || i as claim_id, case when i > 1 and {hs(chr(39) + ':s2:' + chr(39), 'i')} % 2 = 0 then 'c' || (i - 1) else 'e' || ({hs(chr(39) + ':s:' + chr(39), 'i')} % 7) end as on_ref, {hs(chr(39) + ':u:' + chr(39), 'i')} % 11 <> 0 as covered from (select *, unnest(range(1, c + 1)) as i from v_cand)",
}
_NEEDS = {"v_block": ["v_line"], "v_page": ["v_block"], "v_kept": ["v_count"], "v_cand": ["v_turn", "v_count", "v_kept"], "v_node": ["v_cand", "v_block"], "v_op": ["v_cand"], "v_claim": ["v_cand"]}


def with_views(names: list[str], query: str) -> str:
    """query with the views it needs as common table expressions."""
    order: list[str] = []

    def need(n: str) -> None:
        for x in _NEEDS.get(n, []):
            need(x)
        if n not in order:
            order.append(n)

    for n in names:
        need(n)
    return "with " + ", ".join(f"{n} as ({VIEWS[n]})" for n in order) + " " + query
