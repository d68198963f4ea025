"""Deterministic identifiers from SHA-256 prefixes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

NUL = "\0"


def digest(*parts: Column | str, length: int = 64) -> Column:
    """First hex digits of the SHA-256 of parts joined by NUL."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.substring(F.sha2(F.concat_ws(NUL, *cols).cast("binary"), 256), 1, length)


def hash_int(col: Column) -> Column:
    """Integer of the first eight hex digits of a text's SHA-256."""
    return F.conv(F.substring(F.sha2(col.cast("binary"), 256), 1, 8), 16, 10).cast("long")


def candidate_id(source_id: Column, url: Column) -> Column:
    return F.concat(F.lit("candidate_"), digest(source_id, url, length=20))


def document_id(content: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(content.cast("binary"), 256))


def document_key(doc_id: Column) -> Column:
    """What follows the first colon, or all where there is none."""
    return F.regexp_replace(doc_id, "^[^:]*:", "")


def view_id(doc_id: Column, pages: Column, full: Column) -> Column:
    listed = F.array_join(pages.cast("array<string>"), ",")
    return F.when(full, F.concat(doc_id, F.lit(":full"))).otherwise(F.concat(doc_id, F.lit(":bounded-"), digest(doc_id, listed, length=16)))


def package_id(view: Column, profile: Column, dpi: Column) -> Column:
    return F.concat(F.lit("input_"), digest(view, profile, F.coalesce(dpi.cast("string"), F.lit("None")), length=20))


def sample_id(doc_id: Column, index: Column, prompt_version: Column, prefix: str = "task_") -> Column:
    return F.concat(F.lit(prefix), digest(doc_id, index, prompt_version, length=20))


def split_of(doc_id: Column) -> Column:
    """train, validation or internal_holdout by document: 90, 5 and 5 of 100 buckets."""
    bucket = F.pmod(hash_int(doc_id), F.lit(100))
    return F.when(bucket < 90, "train").when(bucket < 95, "validation").otherwise("internal_holdout")


def safe_file_name(col: Column) -> Column:
    return F.regexp_replace(col, "[^A-Za-z0-9_.-]+", "_")
