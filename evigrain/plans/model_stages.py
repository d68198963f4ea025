"""Stages that ask models, through injected clients: generate with structure repair, verify blind and audited, judge.

A client is called with a prompt and returns {"text", "finish_reason"?, "status"?}. What it answers is data: a service error or a
broken answer is a row with its reason, never a lost row. Requests are rows; Arrow batches of them go to workers.
"""

from __future__ import annotations

import json
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evigrain.config import Config
from evigrain.functions import ids, prompts
from evigrain.operators import gates, select
from evigrain.operators.asserted import asserted_join, numbered
from evigrain.sources.connectors import ask

Client = Callable[[str], dict]


def schedule(documents: DataFrame, conf: Config) -> DataFrame:
    """(document_id, batch, candidate, required_type): the mix of types spread over all documents in the order of their ids.

    The mix repeats after as many places as the weights need to come out even to a thousandth, so its table stays small.
    """
    per = conf.generation.candidates_per_document * conf.generation.batches_per_document
    n = documents.count() * per
    cycle = select.type_schedule(conf.generation.primary_evidence_type_weights, min(n, 1000))
    rows = documents.select("document_id").withColumn("_all", F.lit(0))
    rows = numbered(rows, "_all", ["document_id"], "_d", 0) if n <= 1_000_000 else rows.withColumn("_d", F.pmod(ids.hash_int(F.col("document_id")), F.lit(1_000_000)))
    rows = rows.select("document_id", "_d", F.explode(F.sequence(F.lit(0), F.lit(per - 1))).alias("_k"))
    place = F.pmod(F.col("_d").cast("long") * per + F.col("_k"), F.lit(max(1, len(cycle)))).cast("int")
    size = conf.generation.candidates_per_document
    return rows.select("document_id", F.floor(F.col("_k") / size).cast("int").alias("batch"), F.pmod("_k", F.lit(size)).alias("candidate"), F.get(F.array(*[F.lit(t) for t in cycle]), place).alias("required_type"))


def generate(packages: DataFrame, documents: DataFrame, conf: Config, template: str, client: Client, validate: Callable[[dict], None], base: str = "v1") -> DataFrame:
    """(request_id, document_id, batch, draft, attempts, error): drafts of each batch of each document, mended if their structure is broken.

    documents without a package fail the job. template has {candidate_count}. validate raises on a broken batch; then the model is asked
    to mend it, max_structure_repair_attempts times; what stays broken has an error and no draft.
    """
    version = prompts.prompt_version(base, template, conf.generation)
    plan = schedule(documents, conf).groupBy("document_id", "batch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("candidate", "required_type"))), lambda x: x["required_type"]), ", ").alias("types"))
    rows = asserted_join(plan, packages.select("document_id", "document_text"), "document_id", "input package")
    head = F.lit(template.format(candidate_count=conf.generation.candidates_per_document) + prompts.hard_target(conf.generation) + "\nTYPES: ")
    rows = rows.select(ids.digest("document_id", F.col("document_id"), F.col("batch"), F.lit(version), length=20).alias("request_id"), "document_id", "batch", F.concat(head, "types", F.lit("\n\n"), "document_text").alias("prompt"))
    times, count = conf.generation.max_structure_repair_attempts, conf.generation.candidates_per_document

    def one(prompt: str) -> tuple[str | None, int, str | None]:
        raw, request = "", prompt
        for n in range(times + 1):
            try:
                raw = client(request).get("text") or ""
                draft = json.loads(raw)
                validate(draft)
                return json.dumps(draft, sort_keys=True), n + 1, None
            except Exception as e:  # the model's or the service's fault: mended, or data
                why = f"{type(e).__name__}: {e}"
                request = prompt + "\n\n" + prompts.repair_request(raw, e, count)
        return None, times + 1, why

    def run(parts):
        for pdf in parts:
            got = [one(p) for p in pdf["prompt"]]
            yield pdf[["request_id", "document_id", "batch"]].assign(draft=[g[0] for g in got], attempts=[g[1] for g in got], error=[g[2] for g in got])

    return rows.mapInPandas(run, "request_id string, document_id string, batch int, draft string, attempts int, error string")


def _asked(df: DataFrame, client: Client, attempts: int, prefix: str) -> DataFrame:
    """df (sample_id, prompt column `_prompt`) with the answer, its finish reason, attempts and error."""
    got = ask(df.select(F.col("sample_id").alias("request_id"), F.col("_prompt").alias("prompt")), client, attempts)
    got = got.select(F.col("request_id").alias("_r"), *[F.col(c).alias(f"{prefix}_{c}") for c in ("response", "finish_reason", "attempts", "error")])
    return df.drop("_prompt").join(got, F.col("sample_id") == F.col("_r"), "left").drop("_r")


AUDIT = "gold_answer_supported boolean, needs_human_review boolean, disputed_claims array<string>"


def model_verify(records: DataFrame, packages: DataFrame, conf: Config, solver: Client, auditor: Client, independent: Column | None = None) -> DataFrame:
    """records with a blind reconstruction, an audit and independent_verifier_status.

    The solver sees the question and the document alone; an answer that is cut short, too short or lacks labelled parts is asked
    for again. The auditor sees the gold answer and what it rests on. Where generator and verifier are of one family
    (`independent` false) the status is needs_review, whatever was answered. Records without a package fail the job.
    """
    v = conf.verification
    df = asserted_join(records, packages.select("document_id", "document_text"), "document_id", "input package")
    df = df.withColumn("_prompt", F.concat(prompts.blind_payload(F.col("prompt"), F.col("document_id")), F.lit("\n\n"), "document_text"))

    def patient(prompt: str) -> dict:
        answer: dict = {}
        for _ in range(max(1, v.max_reconstruction_attempts)):
            answer = solver(prompt)
            if len((answer.get("text") or "").strip()) >= v.minimum_reconstructed_answer_chars and answer.get("finish_reason", "stop") == "stop":
                break
        return answer

    df = _asked(df, patient, 1, "reconstruction")
    wrong = gates.reconstruction_errors(F.col("prompt"), F.coalesce("reconstruction_response", F.lit("")), F.col("reconstruction_finish_reason"), v)
    df = df.withColumn("reconstruction_problems", wrong)
    audit = prompts.audit_payload(F.col("prompt"), F.col("gold_answer"), F.col("graph"), F.col("claims"), F.col("derivations"))
    df = df.withColumn("_prompt", F.concat(audit, F.lit("\n\n"), F.coalesce("reconstruction_response", F.lit("")), F.lit("\n\n"), "document_text"))
    df = _asked(df, auditor, 1, "audit").withColumn("audit", F.from_json("audit_response", AUDIT))
    aligned = ~F.exists("alignments", lambda a: a["status"].isin("misaligned", "missing_page")) if "alignments" in df.columns else F.lit(True)
    whole = F.col("reconstruction_error").isNull() & (F.size("reconstruction_problems") == 0)
    audited = F.col("audit_error").isNull() & F.col("audit.gold_answer_supported").isNotNull() & (F.coalesce("audit_finish_reason", F.lit("stop")) == "stop")
    status = gates.verifier_status(whole, audited, F.coalesce("audit.needs_human_review", F.lit(False)), aligned, F.coalesce("audit.gold_answer_supported", F.lit(False)), F.coalesce("audit.disputed_claims", F.array().cast("array<string>")))
    alone = F.lit(True) if independent is None else independent
    return df.withColumn("independent_verifier_status", F.when(alone, status).otherwise("needs_review")).drop("document_text")


JUDGMENT = "solver_answer_correct boolean, failure_class string"


def judge(records: DataFrame, client: Client) -> DataFrame:
    """records (reconstruction_response beside a final-passed candidate) with solver_correct, failure_attribution and judge_error, as the judged gate reads them."""
    df = records.withColumn("_prompt", F.concat(prompts.judge_payload(F.col("prompt"), F.col("gold_answer"), F.col("rubric")), F.lit("\n\n"), F.coalesce("reconstruction_response", F.lit(""))))
    df = _asked(df, client, 1, "judge_call").withColumn("_j", F.from_json("judge_call_response", JUDGMENT))
    missing = F.when(F.col("reconstruction_response").isNull(), "no reconstruction").when(F.col("judge_call_error").isNotNull(), F.col("judge_call_error")).when(F.col("_j.solver_answer_correct").isNull(), "unreadable judgment")
    return df.select("*", F.col("_j.solver_answer_correct").alias("solver_correct"), F.col("_j.failure_class").alias("failure_attribution"), missing.alias("judge_error")).drop("_j")


def answers_of(pdf: pd.DataFrame) -> Client:
    """A client that answers from a table (prompt, text): for runs that were recorded."""
    known = dict(zip(pdf["prompt"], pdf["text"], strict=True))
    return lambda prompt: {"text": known.get(prompt), "finish_reason": "stop"}
