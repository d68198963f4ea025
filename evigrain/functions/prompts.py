"""Texts that models read, and keys and versions made of them, as columns."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

from evigrain.config import Generation
from evigrain.functions import ids


def filled(template: str, fields: dict[str, Column]) -> Column:
    """The template with each {field} replaced and double braces made single, as a column; a field without a value is an error."""
    import string

    parts = []
    for literal, name, _, _ in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(fields[name])
    return F.concat(*parts) if parts else F.lit("")


def prompt_version(base: str, template: str, conf: Generation) -> str:
    """The base name, a digest of the template and one of the generation policy."""
    policy = ":".join(str(x) for x in (conf.target_difficulty, conf.candidates_per_document, conf.batches_per_document, conf.hard_min_evidence_nodes, conf.hard_min_evidence_pages, conf.hard_min_dependent_operations))
    short = lambda t, n: hashlib.sha256(t.encode()).hexdigest()[:n]
    return f"{base}+sha256:{short(template, 12)}+policy:{short(policy, 8)}"


def cache_key(run_id: str, sample_id: Column, step: str, scope: str | None = None, pages: Column | None = None, crops: bool = False) -> Column:
    """What a service may cache a request by: run, sample and step; for audits also what is shown."""
    parts = [F.lit(run_id), F.lit("verify"), sample_id, F.lit(step)]
    if scope is not None:
        parts += [F.lit(scope), F.array_join(pages.cast("array<string>"), ","), F.lit(f"crops={crops}")]
    return F.concat_ws(":", *parts)


def crop_file_name(index: Column, node_id: Column, page: Column, about: Column) -> Column:
    """A file name that sorts by index and names node, page and a digest of what is shown."""
    digest = F.substring(F.sha2(F.to_json(about).cast("binary"), 256), 1, 12)
    return F.concat(F.lpad(index.cast("string"), 3, "0"), F.lit("_"), ids.safe_file_name(node_id), F.lit("_page_"), F.lpad(page.cast("string"), 4, "0"), F.lit("_"), digest, F.lit(".png"))


def hard_target(conf: Generation) -> str:
    """What a hard task has to have, for the prompt; nothing for other targets."""
    if conf.target_difficulty != "hard":
        return ""
    rules = [
        f"at least {conf.hard_min_evidence_nodes} decisive evidence nodes on at least {conf.hard_min_evidence_pages} pages",
        f"one connected chain of at least {conf.hard_min_dependent_operations} dependent operations, two of them more than a lookup",
        "a professional decision in several stages before the final answer",
        "a near-match, exception, threshold, footnote or scope trap to rule out",
        "two Tier 2 axes and two Tier 3 axes where the document allows",
        "no node or operation that only fills up a count",
    ]
    return "\nEvery candidate must be hard:\n" + "".join(f"- {r}\n" for r in rules)


def prior_line(sample_id: Column, kind: Column, nodes: Column, operations: Column, prompt: Column) -> Column:
    """One earlier candidate in a line: type, sorted pages, operations and question."""
    pages = F.array_sort(F.array_distinct(F.transform(nodes, lambda n: n["page"])))
    verbs = F.transform(operations, lambda o: F.concat(F.lit("'"), o["op"], F.lit("'")))
    listed = lambda c: F.concat(F.lit("["), F.array_join(c.cast("array<string>"), ", "), F.lit("]"))
    return F.concat(F.lit("- "), sample_id, F.lit(": type="), kind, F.lit("; pages="), listed(pages), F.lit("; operations="), listed(verbs), F.lit("; question="), prompt)


def prior_summary(lines: Column) -> Column:
    # fixed value: the text for a document's first batch
    return F.when(F.size(lines) == 0, "None; this is the first batch for the document.").otherwise(F.array_join(lines, "\n"))


def repair_request(raw: str, error: Exception, count: int) -> str:
    """Asks for a draft's structure to be mended, not its content."""
    return (
        f"The draft below breaks the schema ({type(error).__name__}: {error}). Return the whole JSON batch again with exactly {count} candidates. "
        "Mend ids, references, the order and reachability of operations, required fields and the count only; keep question, evidence, answer and difficulty. Give no explanation.\n\n"
        f"{raw}\n"
    )


def blind_payload(prompt: Column, document_id: Column) -> Column:
    """What a blind solver learns of a task: the question and the document, no answer, evidence or claims."""
    return F.to_json(F.struct(prompt.alias("prompt"), document_id.alias("document_id")))


def audit_payload(prompt: Column, gold_answer: Column, graph: Column, claims: Column, derivations: Column) -> Column:
    """What an auditor sees beside the document: the question, the gold answer and all that it rests on."""
    return F.to_json(F.struct(prompt.alias("prompt"), gold_answer.alias("gold_answer"), graph.alias("evidence_graph"), claims.alias("claims"), derivations.alias("derivations")), {"ignoreNullFields": "false"})


def judge_payload(prompt: Column, gold_answer: Column, rubric: Column) -> Column:
    return F.to_json(F.struct(prompt.alias("prompt"), gold_answer.alias("gold_answer"), rubric.alias("rubric")), {"ignoreNullFields": "false"})
