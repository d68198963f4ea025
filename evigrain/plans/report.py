"""Reports of a run: counts of every stage, release readiness, and the same as Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evigrain.operators.asserted import first_with_rows

#: Name of each distribution, the table it is of and its column.
SPREADS = {
    "task_types": ("generated", "primary_evidence_type"),
    "verifier_statuses": ("latest", "independent_verifier_status"),
    "human_review_statuses": ("finalized", "human_review_status"),
    "final_statuses": ("finalized", "final_validation_status"),
    "difficulty_labels": ("assessed", "predicted_label"),
}


def latest(finalized: DataFrame, repaired: DataFrame, verified: DataFrame) -> DataFrame:
    """The table of the latest stage that has rows."""
    return first_with_rows(finalized, repaired, verified)


def release(final_failures: int, assessed: int, export_ready: bool) -> tuple[bool, list[str]]:
    """(ready, blockers): an export that is ready makes a release ready; what still stands in the way is named in either case."""
    why = {"final_validation_incomplete": final_failures > 0, "no_difficulty_assessments": not assessed, "export_not_release_ready": not export_ready}
    return export_ready, [name for name, holds in why.items() if holds]


def dedup_report(verdicts: DataFrame, scored: DataFrame) -> DataFrame:
    """(document_id, selected, rejected) of verdicts (document_id, sample_id, status, matched_sample_id, reasons), beside type and score of scored (sample_id, ...)."""
    s = scored.select(F.col("sample_id").alias("_s"), "primary_evidence_type", "structural_score", "predicted_label")
    rows = verdicts.join(s, F.col("sample_id") == F.col("_s"))
    kept = F.struct("sample_id", "primary_evidence_type", "structural_score", "predicted_label")
    lost = F.struct("sample_id", "status", "matched_sample_id", "reasons")
    chosen = F.col("status") == "selected"
    return rows.groupBy("document_id").agg(F.array_sort(F.collect_list(F.when(chosen, kept))).alias("selected"), F.array_sort(F.collect_list(F.when(~chosen, lost))).alias("rejected"))


def _counts(df: DataFrame, name: str, spreads: dict[str, str], failed: dict[str, str]) -> dict:
    """Rows of df, of each value of the columns of spreads, and of its failed checks by prefix: one job, so df is worked out once."""

    def value(of: str, c: Column) -> Column:
        return F.struct(F.lit(of).alias("of"), c.cast("string").alias("value"))

    def bad(of: str, prefix: str) -> Column:
        found = F.filter("checks", lambda c: ~c["passed"] & F.startswith(c["check"], F.lit(prefix)))
        return F.coalesce(F.transform(found, lambda c: value(of, c["check"])), F.array().cast("array<struct<of:string,value:string>>"))

    items = F.concat(F.array(value(name, F.lit(None)), *[value(k, F.col(c)) for k, c in spreads.items()]), *[bad(k, prefix) for k, prefix in failed.items()])
    rows = df.select(F.explode(items).alias("x")).groupBy("x.of", "x.value").count().collect()  # as many rows as there are statuses and checks
    out: dict = {name: 0, **{k: {} for k in [*spreads, *failed]}}
    for r in sorted(rows, key=lambda r: (r["value"] is not None, r["value"] or "")):
        if r["of"] == name:
            out[name] = r["count"]
        else:
            out[r["of"]][str(r["value"]) if r["of"] in spreads else r["value"]] = r["count"]
    return out


def summary(tables: dict[str, DataFrame], export_ready: bool = False) -> dict:
    """Counts of the tables, their distributions and failed checks, and whether a release is ready; one small aggregate for each table.

    tables: generated, rejected, verified, repaired, finalized, assessed; those that are not there count as empty.
    """
    some = dict(tables)
    if "latest" not in some and "verified" in some:
        some["latest"] = first_with_rows(*[some[n] for n in ("finalized", "repaired", "verified") if n in some])
    spreads = {name: column for name, (of, column) in SPREADS.items() if of in some and column in some[of].columns}
    failed = {name: (of, prefix) for name, (of, prefix) in {"static_rejection_reasons": ("rejected", ""), "final_blockers": ("finalized", "final_")}.items() if of in some}
    said: dict = {}
    for n, df in some.items():
        said |= _counts(df, n, {k: c for k, c in spreads.items() if SPREADS[k][0] == n}, {k: prefix for k, (of, prefix) in failed.items() if of == n})
    out: dict = {n: said[n] for n in tables}
    for name in spreads:
        out[name] = said[name]
    for name in ("static_rejection_reasons", "final_blockers"):
        out[name] = said.get(name, {})
    out["release_ready"], out["blockers"] = release(sum(out["final_blockers"].values()), out.get("assessed", 0), export_ready)
    return out


def markdown(run: str, found: dict) -> str:
    """The summary for people: one line a count, then a list for each distribution."""
    plain = [f"- {k.replace('_', ' ')}: **{v}**" for k, v in found.items() if not isinstance(v, dict | list)]
    parts = [f"# Run {run}", "\n".join(plain)]
    for k, v in found.items():
        if isinstance(v, dict):
            parts += [f"## {k.replace('_', ' ')}", "\n".join(f"- `{n}`: {c}" for n, c in v.items()) or "- none"]
        elif isinstance(v, list):
            parts += [f"## {k.replace('_', ' ')}", "\n".join(f"- `{n}`" for n in v) or "- none"]
    return "\n\n".join(parts) + "\n"


def write_report(run: str, found: dict, path: str) -> None:
    """PATH.json and PATH.md, each put in place whole."""
    from pathlib import Path

    from evigrain.sources.files import write_json

    write_json(f"{path}.json", found)
    Path(f"{path}.md").write_text(markdown(run, found), encoding="utf-8")
