"""Stages from sources to export on small tables."""

import json

import pytest
from pyspark.sql import functions as F
from test_gates import frame, row

from evigrain import cli
from evigrain.config import Config, ContextBudget
from evigrain.operators import gates
from evigrain.plans import stages

PAGES = "document_id string, page_count int, pages array<struct<page_number:int,extracted_text:string,width_points:double,height_points:double>>"


def parsed(spark):
    return spark.createDataFrame([("sha256:abc", 2, [(2, " two ", 612.0, 792.0), (1, "one", 612.0, 792.0)]), ("sha256:def", 1, [(1, "", 612.0, 792.0)])], PAGES)


def test_discover_first_wins_and_guards(spark):
    rows = [("s", "https://x/1", 1), ("t", "https://x/1", 0), ("s", "https://x/2", 2)]
    out = stages.discover(spark.createDataFrame(rows, "source_id string, url string, ordinal int"), Config()).collect()
    assert sorted((r["source_id"], r["url"]) for r in out) == [("s", "https://x/2"), ("t", "https://x/1")] and all(len(r["candidate_id"]) == 30 for r in out)
    with pytest.raises(Exception, match="scheme_not_allowed"):
        stages.discover(spark.createDataFrame([("s", "ftp://x", 1)], "source_id string, url string, ordinal int"), Config()).collect()


def test_packages(spark):
    got = {r["document_id"]: r for r in stages.packages(stages.views(parsed(spark)), Config(), "multimodal").collect()}
    a = got["sha256:abc"]
    assert a["document_text"] == "[Page 1]\none\n[End Page 1]\n\n[Page 2]\ntwo\n[End Page 2]" and a["page_image_dpi"] == 150 and a["document_view_id"] == "sha256:abc:full"
    assert a["token_accounting"]["page_image_tokens"] == 5049 and got["sha256:def"]["text_empty_page_numbers"] == [1]
    bounded = {r["document_id"]: r for r in stages.packages(stages.views(parsed(spark), {"abc": ["2"]}), Config(), "text_only").collect()}["sha256:abc"]
    assert bounded["page_numbers"] == [2] and ":bounded-" in bounded["document_view_id"] and bounded["page_image_dpi"] is None
    tight = Config(context_budget=ContextBudget(model_context_tokens=12_400, minimum_output_and_safety_reserve_tokens=1000))
    assert {r["page_image_dpi"] for r in stages.packages(stages.views(parsed(spark)), tight, "multimodal").collect()} == {120, 150}
    with pytest.raises(Exception, match="does not fit"):
        stages.packages(stages.views(parsed(spark)), Config(context_budget=ContextBudget(model_context_tokens=6000, minimum_output_and_safety_reserve_tokens=10)), "text_only").collect()


def assessed(spark):
    df = gates.features(gates.static_verify(frame(spark, row(document_id="sha256:abc", document_view_id="sha256:abc:full")).withColumn("gold_answer", F.lit("90"))))
    for k, v in {"final_validation_status": "passed", "eligible_for_difficulty": True, "human_review_status": "approved"}.items():
        df = df.withColumn(k, F.lit(v))
    return gates.difficulty_gate(df).withColumn("admitted_as_hard", F.lit(True))


def test_export_keeps_audit_data_apart(spark):
    inputs = stages.packages(stages.views(parsed(spark)), Config(), "multimodal")
    strict, gone = stages.export(assessed(spark), inputs, Config())
    assert strict.count() == 0 and gone.first()["reasons"] == ["difficulty_not_verified"]
    pilot, gone = stages.export(assessed(spark), inputs, Config(), allow_predicted=True)
    r = pilot.first()
    assert gone.count() == 0 and [m["role"] for m in r["messages"]] == ["user", "assistant"] and "rubric" not in json.dumps([m["content"] for m in r["messages"]])
    assert {x["split"]: x["records"] for x in stages.split_counts(pilot).collect()} == {s: int(s == r["split"]) for s in stages.SPLITS}
    other = inputs.withColumn("document_view_id", F.lit("x"))
    assert stages.export(assessed(spark), other, Config(), True)[1].first()["reasons"] == ["input_package_mismatch"]


def test_reports_and_reviews(spark):
    df = gates.static_verify(frame(spark, row(page_count=1), row(sample_id="s2")))
    assert [(r["stage"], r["rows"]) for r in stages.funnel({"all": df, "passed": df.where("static_checks_passed")}).orderBy("place").collect()] == [("all", 2), ("passed", 1)]
    assert stages.blockers(df).first()["check"] == "evidence_pages_in_range"
    page = stages.review_markdown(df).where("sample_id = 's1'").first()["markdown"]
    assert "| e1 | 1 | base_value | 0.1000, 0.1000, 0.4000, 0.2000 | c1 | revenue 100 |" in page and "- [ ] evidence_pages_in_range" in page
    assert [r["sample_id"] for r in stages.decision_templates(df, df.where("sample_id = 's1'")).collect()] == ["s2"]


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "c.yaml").write_text("{}")
    frame(spark).write.parquet(str(tmp_path / "in"))
    cli.main(["static-verify", "--config", str(tmp_path / "c.yaml"), "--records", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--logs", str(tmp_path / "logs")])
    assert json.loads(capsys.readouterr().out) == {"rows": 1} and len(list((tmp_path / "logs").glob("static-verify-*.json"))) == 1
    cli.main(["validate-config", "--config", str(tmp_path / "c.yaml")])
    assert "context_budget" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        cli.main(["static-verify", "--config", str(tmp_path / "c.yaml"), "--records", "x", "--output", "x"])
