"""Stages over record tables: discover, build input, deduplicate, export, report, review. Each is DataFrames to DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from evigrain.config import Config
from evigrain.functions import budget, ids, text
from evigrain.operators import gates, select
from evigrain.sources import guards

SPLITS = ["train", "validation", "internal_holdout"]


def discover(sources: DataFrame, conf: Config) -> DataFrame:
    """Candidates of sources (source_id, url, ordinal, license, ...): addresses checked, each once, the first wins."""
    first = Window.partitionBy("url").orderBy("ordinal")
    out = sources.withColumn("url", guards.checked_url(F.col("url"), conf.security)).withColumn("_n", F.row_number().over(first)).where("_n = 1").drop("_n")
    return out.withColumn("candidate_id", ids.candidate_id(F.col("source_id"), F.col("url")))


def admitted(candidates: DataFrame) -> DataFrame:
    """Candidates whose license is approved."""
    return candidates.where("license.status = 'approved'")


def views(parsed: DataFrame, overrides: dict[str, list[str]] | None = None, reasons: dict[str, str] | None = None) -> DataFrame:
    """parsed (document_id, page_count, pages) with its frozen view: all pages, or those of an override by full id or key."""
    rules = [(k, v) for k, v in (overrides or {}).items()]
    key = ids.document_key(F.col("document_id"))
    wanted = F.lit(None).cast("array<int>")
    why = F.lit(None).cast("string")
    for name, ranges in rules:  # the settings file lists a few
        hit = (F.col("document_id") == name) | (key == name)
        wanted = F.when(hit, F.array(*[F.lit(p) for p in select.parse_ranges(ranges, 10**6)])).otherwise(wanted)
        why = F.when(hit, F.lit((reasons or {}).get(name))).otherwise(why)
    beyond = F.exists(F.coalesce(wanted, F.array().cast("array<int>")), lambda p: p > F.col("page_count"))
    every = F.sequence(F.lit(1), F.col("page_count"))
    pages = F.when(beyond, F.raise_error(F.concat(F.lit("view beyond the document: "), F.col("document_id"))).cast("array<int>")).otherwise(F.coalesce(wanted, every))
    out = parsed.withColumn("view_pages", pages).withColumn("view_reason", why)
    full = F.size("view_pages") == F.col("page_count")
    return out.withColumn("view_scope", F.when(full, "full_pdf").otherwise("bounded")).withColumn("view_id", ids.view_id(F.col("document_id"), F.col("view_pages"), full))


def packages(viewed: DataFrame, conf: Config, profile: str, text_tokens: Column | None = None) -> DataFrame:
    """Input packages of documents with views: text, resolution and token accounting; what fits nowhere fails the job.

    text_tokens: an exact count over document_text, in place of the estimate from characters.
    """
    b, t = conf.context_budget, conf.target_input
    own = F.filter("pages", lambda p: F.array_contains("view_pages", p["page_number"]))
    df = viewed.withColumn("own", own).withColumn("document_text", text.marked_pages(F.col("own")))
    df = df.withColumn("text_tokens", budget.text_tokens(F.length("document_text"), b) if text_tokens is None else text_tokens)
    steps = [None] if profile == "text_only" else budget.dpi_steps(t.page_image_dpi, t.minimum_page_image_dpi)

    def step(dpi: int | None) -> Column:
        area = F.lit(0.0) if dpi is None else F.aggregate("own", F.lit(0.0), lambda s, p: s + budget.megapixels(p["width_points"], p["height_points"], F.lit(float(dpi))))
        image = budget.image_tokens(area, b)
        total = budget.estimated_input(F.col("text_tokens"), image, b)
        return F.struct(F.lit(dpi).cast("int").alias("dpi"), image.alias("image_tokens"), total.alias("estimated_input_tokens"), budget.utilization(total, b).alias("input_utilization"), budget.fits(total, b).alias("fits_context"))

    df = df.withColumn("_steps", F.array(*[step(x) for x in steps]))
    chosen = F.get(F.filter("_steps", lambda s: s["fits_context"]), 0)
    tight = F.raise_error(F.concat(F.lit("does not fit at any resolution; choose page ranges: "), F.col("document_id")))
    df = df.withColumn("accounting", F.when(chosen.isNull(), tight.cast("struct<dpi:int,image_tokens:bigint,estimated_input_tokens:bigint,input_utilization:double,fits_context:boolean>")).otherwise(chosen))
    blank = F.transform(F.filter("own", lambda p: text.is_blank(p["extracted_text"])), lambda p: p["page_number"])
    return df.select(
        ids.package_id(F.col("view_id"), F.lit(profile), F.col("accounting.dpi")).alias("package_id"), "document_id", F.col("view_id").alias("document_view_id"), F.lit(profile).alias("profile"),
        F.col("accounting.dpi").alias("page_image_dpi"), F.col("view_pages").alias("page_numbers"), blank.alias("text_empty_page_numbers"), "document_text",
        F.struct(F.col("text_tokens").alias("document_text_tokens"), F.col("accounting.image_tokens").alias("page_image_tokens"), "accounting.estimated_input_tokens", "accounting.input_utilization", "accounting.fits_context", F.lit(b.model_context_tokens).alias("context_window_tokens")).alias("token_accounting"),
    )


def export(records: DataFrame, inputs: DataFrame, conf: Config, allow_predicted: bool = False) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of assessed records against their packages.

    accepted: sample_id, split, messages, token counts and, apart from them, `audit`; what a model reads has no audit data.
    """
    b = conf.context_budget
    p = inputs.select(F.col("document_id").alias("pd"), F.col("profile").alias("pp"), F.col("document_view_id").alias("pv"), F.col("document_text").alias("body"), F.col("token_accounting.page_image_tokens").alias("image_tokens"))
    df = records.withColumn("reasons", gates.export_reasons(allow_predicted))
    df = df.join(p, (F.col("document_id") == F.col("pd")) & (F.col("input_profile") == F.col("pp")), "left")
    user = F.concat("prompt", F.lit("\n\n"), "body")
    df = df.withColumn("user_text", user).withColumn("sequence_tokens", budget.text_tokens(F.length("user_text") + F.length("gold_answer"), b) + F.col("image_tokens"))
    late = F.when(F.size("reasons") > 0, F.col("reasons")).when(~F.coalesce(F.col("pv").eqNullSafe(F.col("document_view_id")), F.lit(False)) | F.col("pd").isNull(), F.array(F.lit("input_package_mismatch"))).when(F.col("sequence_tokens") > b.model_context_tokens, F.array(F.lit("export_sequence_over_context"))).otherwise(F.col("reasons"))
    df = df.withColumn("reasons", late).withColumn("split", ids.split_of(F.col("document_id")))
    messages = F.array(F.struct(F.lit("user").alias("role"), F.col("user_text").alias("content")), F.struct(F.lit("assistant").alias("role"), F.col("gold_answer").alias("content")))
    accepted = df.where(F.size("reasons") == 0).select("sample_id", "document_id", "document_view_id", "input_profile", "split", messages.alias("messages"), "sequence_tokens", budget.utilization(F.col("sequence_tokens"), b).alias("sequence_utilization"), F.struct("claims", "derivations", "graph", "rubric", "checks").alias("audit"))
    return accepted, df.where(F.size("reasons") > 0).select("sample_id", "reasons")


def split_counts(accepted: DataFrame) -> DataFrame:
    """Records and tokens of each split, those without any too."""
    names = accepted.sparkSession.range(1).select(F.explode(F.array(*[F.lit(s) for s in SPLITS])).alias("split"))
    own = accepted.groupBy(F.col("split").alias("s")).agg(F.count(F.lit(1)).alias("n"), F.sum("sequence_tokens").alias("t"))
    return names.join(own, F.col("split") == F.col("s"), "left").select("split", F.coalesce("n", F.lit(0)).alias("records"), F.coalesce("t", F.lit(0)).alias("sequence_tokens"))


def funnel(stages: dict[str, DataFrame]) -> DataFrame:
    """(place, stage, rows) of the tables of a run, one count each in a single job."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(i).alias("place"), F.lit(n).alias("stage"), "rows") for i, (n, df) in enumerate(stages.items())]
    return reduce(DataFrame.unionByName, parts)


def blockers(checked: DataFrame, prefix: str = "") -> DataFrame:
    """How many rows fail each check."""
    c = checked.select(F.explode("checks").alias("c")).where(~F.col("c.passed") & F.startswith("c.check", F.lit(prefix)))
    return c.groupBy(F.col("c.check").alias("check")).agg(F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows"), "check")


def review_markdown(df: DataFrame) -> DataFrame:
    """(sample_id, markdown): a page for the human reviewer of each candidate, evidence by page, claims beside it."""
    cell = lambda c: text.markdown_cell(F.coalesce(c.cast("string"), F.lit("")))
    box = lambda b: F.format_string("%.4f, %.4f, %.4f, %.4f", b["x0"], b["y0"], b["x1"], b["y1"])
    on = lambda n: F.array_join(F.transform(F.filter("claims", lambda c: F.array_contains(c["supported_by"], n["id"])), lambda c: c["claim_id"]), ", ")
    line = lambda n: F.concat(F.lit("| "), cell(n["id"]), F.lit(" | "), cell(n["page"]), F.lit(" | "), cell(n["role"]), F.lit(" | "), box(n["bbox"]), F.lit(" | "), on(n), F.lit(" | "), cell(n["excerpt"]), F.lit(" |"))
    by_page = F.array_sort("graph.nodes", lambda a, b: a["page"] - b["page"])
    checks = F.transform("checks", lambda c: F.concat(F.when(c["passed"], "- [x] ").otherwise("- [ ] "), c["check"], F.coalesce(F.concat(F.lit(": "), c["details"]), F.lit(""))))
    parts = [F.concat(F.lit("# "), F.col("sample_id")), F.col("prompt"), F.lit("| node | page | role | box | claims | excerpt |\n|-|-|-|-|-|-|"), F.array_join(F.transform(by_page, line), "\n"), F.array_join(checks, "\n")]
    return df.select("sample_id", F.concat_ws("\n\n", *parts).alias("markdown"))


def decision_templates(df: DataFrame, existing: DataFrame) -> DataFrame:
    """Pending decisions for candidates that have none yet; what reviewers wrote is left alone."""
    fresh = df.select("sample_id").join(existing.select("sample_id"), "sample_id", "left_anti")
    return fresh.select("sample_id", F.lit("pending").alias("decision"), F.lit("").alias("reviewer"))
