"""Commands over folders of records: python -m evigrain.cli COMMAND --config FILE ..."""

from __future__ import annotations

import argparse
import dataclasses
import importlib
import json

from evigrain.config import load_config
from evigrain.operators import asserted
from evigrain.sources.manifest import stage_run


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()


def validate_config(args) -> dict:
    return dataclasses.asdict(load_config(args.config))


def _transform(args, change, inputs: list[str]) -> dict:
    """Read Parquet inputs, change them, write args.output; the counts go to the manifest."""
    if args.output in inputs:
        raise SystemExit("a stage writes a new table, it does not replace its input")
    spark, conf = _session(), load_config(args.config)
    with stage_run(args.command, args.logs, inputs, [args.output]) as m:
        out = change(*[spark.read.parquet(p) for p in inputs], conf)
        if isinstance(out, tuple):  # kept and rejected rows, each in a table of its own
            out, rejected = out
            rejected.write.mode("overwrite" if args.overwrite else "errorifexists").parquet(f"{args.output}-rejected")
            m["counts"]["rejected"] = spark.read.parquet(f"{args.output}-rejected").count()
        if args.document_id:
            out = asserted.selected(out, args.document_id)
        if args.limit is not None:
            out = out.orderBy([c for c in ("document_id", "sample_id") if c in out.columns] or out.columns[:1]).limit(args.limit)
        out.write.mode("overwrite" if args.overwrite else "errorifexists").parquet(args.output)
        m["counts"]["rows"] = spark.read.parquet(args.output).count()
    return m["counts"]


def _plugin(spec: str):
    """What module:function returns; a renderer or a model's client is not part of this package."""
    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)()


def _asked(args, change) -> dict:
    from pathlib import Path

    text = Path(args.template).read_text(encoding="utf-8") if args.template else ""
    return _transform(args, lambda r, p, c: change(r, p, c, text, _plugin(args.plugin)), [args.records, args.packages])


def commands() -> dict:
    from evigrain.operators import gates, select
    from evigrain.plans import model_stages, stages
    from evigrain.sources import connectors

    return {
        "discover": lambda a: _transform(a, lambda s, c: stages.discover(s, c), [a.records]),
        "ingest": lambda a: _transform(a, lambda r, c: connectors.ingested(connectors.fetch(stages.admitted(r), _plugin(a.plugin), c.security.max_pdf_bytes)), [a.records]),
        "parse": lambda a: _transform(a, lambda r, c: connectors.parse(r, _plugin(a.plugin)), [a.records]),
        "generate": lambda a: _asked(a, lambda d, p, c, t, m: model_stages.generate(p, d, c, t, m[0], m[1])),
        "model-verify": lambda a: _asked(a, lambda r, p, c, t, m: model_stages.model_verify(r, p, c, m[0], m[1])),
        "build-input": lambda a: _transform(a, lambda p, c: stages.packages(stages.views(p), c, a.profile or c.target_input.profile), [a.records]),
        "static-verify": lambda a: _transform(a, lambda r, c: gates.static_verify(r, c), [a.records]),
        "deduplicate": lambda a: _transform(a, lambda r, c: select.select_diverse(gates.difficulty(r), c.deduplication), [a.records]),
        "suggest-repairs": lambda a: _transform(a, lambda r, c: gates.repair_suggestions(gates.alignment(r, c.verification), c.verification), [a.records]),
        "apply-bbox-repairs": lambda a: _transform(a, lambda r, c: gates.apply_repairs(r), [a.records]),
        "finalize": lambda a: _transform(a, lambda r, c: gates.finalize(gates.apply_rubric_overrides(r), c), [a.records]),
        "difficulty-gate": lambda a: _transform(a, lambda r, c: gates.difficulty_gate(r, a.mode == "judged"), [a.records]),
        "export": lambda a: _transform(a, lambda r, p, c: stages.export(r, p, c, a.allow_predicted_difficulty), [a.records, a.packages]),
        "report": lambda a: _transform(a, lambda r, c: stages.blockers(r), [a.records]),
        "review-pack": lambda a: _transform(a, lambda r, c: stages.review_markdown(r), [a.records]),
    }


def parser(names: list[str]) -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="evigrain")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ["validate-config", *names]:
        s = sub.add_parser(name)
        s.add_argument("--config", required=True)
        if name != "validate-config":
            for flag in ("--records", "--output"):
                s.add_argument(flag, required=True)
            s.add_argument("--packages", required=name in ("export", "generate", "model-verify"))
            s.add_argument("--logs", default="logs")
            s.add_argument("--profile", choices=["multimodal", "text_only"])
            s.add_argument("--mode", choices=["predicted", "judged"], default="predicted")
            s.add_argument("--overwrite", action="store_true")
            s.add_argument("--limit", type=int)
            s.add_argument("--document-id", action="append")
            s.add_argument("--plugin", help="module:function that makes the fetcher, parser or client", required=name in ("ingest", "parse", "generate", "model-verify"))
            s.add_argument("--template", help="prompt file with {candidate_count}", required=name == "generate")
            s.add_argument("--allow-predicted-difficulty", action="store_true")
    return p


def main(argv: list[str] | None = None) -> None:
    known = commands()
    args = parser(list(known)).parse_args(argv)
    print(json.dumps(validate_config(args) if args.command == "validate-config" else known[args.command](args), indent=2, sort_keys=True))


if __name__ == "__main__":
    main()
