"""What may be read at all: schemes, forbidden markers and folders, licenses."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

from evigrain.config import Security


def url_problem(url: Column, conf: Security) -> Column:
    """Why an address may not be used, or null."""
    scheme = F.lower(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    marks = F.array(*[F.lit(m.lower()) for m in conf.forbidden_source_substrings]).cast("array<string>")
    return F.when(~scheme.isin(*[s.lower() for s in conf.allowed_download_schemes]), "scheme_not_allowed").when(F.exists(marks, lambda m: F.contains(F.lower(url), m)), "forbidden_source")


def checked_url(url: Column, conf: Security) -> Column:
    """The address, or a failed job."""
    why = url_problem(url, conf)
    return F.when(why.isNotNull(), F.raise_error(F.concat(why, F.lit(": "), url)).cast("string")).otherwise(url)


def check_path(path: str | Path, roots: list[str | Path]) -> Path:
    """The resolved path, unless it lies in a forbidden folder."""
    real = Path(path).resolve()
    for root in roots:
        top = Path(root).resolve()
        if real == top or top in real.parents:
            raise PermissionError(f"{real} is inside {top}, which must not be read")
    return real


def license_problem(lic: Column) -> Column:
    """Why a license record is inconsistent: an approval needs an id, evidence and notes."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    return F.when((lic["status"] == "approved") & (blank(lic["license_id"]) | blank(lic["evidence_url"]) | blank(lic["review_notes"])), "approval_without_evidence")
