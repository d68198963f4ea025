"""Connectors for what Spark does not do itself: fetching, parsing pages, asking models. Each takes an injected function.

The functions run on executors, a partition at a time; tests and offline runs inject deterministic ones.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evigrain.functions import ids

MAGIC = b"%PDF-"


class TooLarge(ValueError):
    """A download over the size limit."""


def checked_download(chunks: Iterator[bytes], limit: int) -> tuple[bytes, str]:
    """(content, sha256) of a streamed download; the limit holds while it streams, and the content must be a PDF."""
    digest, parts, size = hashlib.sha256(), [], 0
    for c in chunks:
        size += len(c)
        if size > limit:
            raise TooLarge(f"more than {limit} bytes")
        digest.update(c)
        parts.append(c)
    content = b"".join(parts)
    if not content.startswith(MAGIC):
        raise ValueError("not a PDF")
    return content, digest.hexdigest()


def fetch(df: DataFrame, fetcher: Callable[[str], Iterator[bytes]], limit: int) -> DataFrame:
    """df (candidate_id, url) with content, sha256 and error; a failed download is a row with its error."""

    def run(parts):
        for pdf in parts:
            rows = []
            for url in pdf["url"]:
                try:
                    rows.append((*checked_download(fetcher(url), limit), None))
                except Exception as e:  # the reason is data
                    rows.append((None, None, f"{type(e).__name__}: {e}"))
            yield pdf[["candidate_id", "url"]].assign(content=[r[0] for r in rows], sha256=[r[1] for r in rows], error=[r[2] for r in rows])

    return df.select("candidate_id", "url").mapInPandas(run, "candidate_id string, url string, content binary, sha256 string, error string")


def ingested(downloads: DataFrame) -> DataFrame:
    """Document rows of the downloads that came through; equal contents share a document_id and keep their rows."""
    ok = downloads.where("error is null")
    return ok.select("candidate_id", F.col("url").alias("source_url"), ids.document_id(F.col("content")).alias("document_id"), F.octet_length("content").cast("long").alias("size_bytes"), "sha256")


PAGE = "struct<page_number:int,width_points:double,height_points:double,extracted_text:string,native_text:string,blocks:array<struct<block_id:string,kind:string,bbox:struct<x0:double,y0:double,x1:double,y1:double>,text:string,reading_order:int>>>"


def parse(files: DataFrame, parser: Callable[[bytes], list[dict]]) -> DataFrame:
    """files (document_id, content) with pages, by a parser that returns dictionaries shaped like PAGE."""

    def run(parts):
        for pdf in parts:
            yield pd.DataFrame({"document_id": pdf["document_id"], "pages": [json.dumps(parser(c)) for c in pdf["content"]]})

    raw = files.select("document_id", "content").mapInPandas(run, "document_id string, pages string")
    out = raw.select("document_id", F.from_json("pages", f"array<{PAGE}>", {"mode": "FAILFAST"}).alias("pages"))
    return out.withColumn("page_count", F.size("pages"))


def strict_schema(schema: dict) -> dict:
    """A JSON schema in which every property is required and no other is allowed, at every level."""
    out = {k: strict_schema(v) if isinstance(v, dict) else [strict_schema(x) if isinstance(x, dict) else x for x in v] if isinstance(v, list) else v for k, v in schema.items()}
    if isinstance(out.get("properties"), dict):
        out |= {"required": list(out["properties"]), "additionalProperties": False}
    out.pop("default", None)
    return out


def ask(df: DataFrame, client: Callable[[str], dict], attempts: int = 1) -> DataFrame:
    """df (request_id, prompt) with response (JSON), finish_reason, attempts and error.

    client returns {"text", "finish_reason"?, "status"?}. An empty text or an exception is tried again; what stays wrong is data. A
    response with status incomplete and no finish reason counts as cut short.
    """

    def run(parts):
        for pdf in parts:
            rows = []
            for prompt in pdf["prompt"]:
                row = (None, None, 0, "no attempt")
                for n in range(1, attempts + 1):
                    try:
                        got = client(prompt)
                        reason = got.get("finish_reason") or {"completed": "stop", "incomplete": "length"}.get(got.get("status", ""))
                        row = (got.get("text") or None, reason, n, None if got.get("text") else "empty response")
                    except Exception as e:
                        row = (None, None, n, f"{type(e).__name__}: {e}")
                    if row[3] is None:
                        break
                rows.append(row)
            cols = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pd.DataFrame({"request_id": pdf["request_id"], "response": cols[0], "finish_reason": cols[1], "attempts": cols[2], "error": cols[3]})

    return df.select("request_id", "prompt").mapInPandas(run, "request_id string, response string, finish_reason string, attempts int, error string")
