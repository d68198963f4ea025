"""Asserted joins, model stages, reports, manifests and settings."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from evigrain import config
from evigrain.operators import asserted, select
from evigrain.plans import model_stages, report
from evigrain.sources import files


def test_a_missing_mate_fails_the_job(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, x string")
    assert {r["k"]: r["y"] for r in asserted.asserted_join(left, spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "k int, y int"), "k", "mate").collect()} == {1: 5, 2: 6}
    with pytest.raises(PySparkException, match="missing mate: 2"):
        asserted.asserted_join(left, spark.createDataFrame([(1, 5)], "k int, y int"), "k", "mate").select("k").collect()
    with pytest.raises(PySparkException, match="pages and images"):
        spark.range(1).select(asserted.zipped(F.array(F.lit(1)), F.array(F.lit(1), F.lit(2)), ("a", "b"), "pages and images")).collect()


def test_selectors_and_limits(spark):
    d = spark.createDataFrame([("sha256:aa",), ("sha256:bb",), ("sha256:cc",)], "document_id string")
    assert sorted(r[0] for r in asserted.selected(d, ["aa", "sha256:cc"]).collect()) == ["sha256:aa", "sha256:cc"]
    with pytest.raises(ValueError, match="no document"):
        asserted.selected(d, ["zz"])
    done = d.limit(1)
    assert [r[0] for r in asserted.pending(d, done, "document_id", 1).collect()] == sorted({"sha256:aa", "sha256:bb", "sha256:cc"} - {r[0] for r in done.collect()})[:1]
    assert asserted.first_with_rows(d.where("false"), d, d.where("false")).count() == 3


@pytest.mark.parametrize(
    ("weights", "total", "want"),
    [({"a": 0.5, "b": 0.5}, 4, "abab"), ({"a": 0.6, "b": 0.4}, 5, "ababa"), ({"a": 0.7, "b": 0.2, "c": 0.1}, 10, "aabaacaaba"), ({"a": 1.0}, 3, "aaa"), ({"a": 0.34, "b": 0.33, "c": 0.33}, 1, "a"), ({"a": 0.1, "b": 0.9}, 0, "")],
)
def test_listed_schedules(weights, total, want):
    assert "".join(select.type_schedule(weights, total)) == want


def test_broken_drafts_are_mended_or_kept_as_errors(spark):
    docs = spark.createDataFrame([("sha256:1",), ("sha256:2",)], "document_id string")
    packages = spark.createDataFrame([("sha256:1", "good"), ("sha256:2", "hopeless")], "document_id string, document_text string")

    def client(prompt):
        if "hopeless" in prompt:
            return {"text": "no json"}
        return {"text": json.dumps({"candidates": [1, 2, 3]} if "breaks the schema" in prompt else {"candidates": [1]})}

    def validate(draft):
        if len(draft["candidates"]) != 3:
            raise ValueError("three candidates")

    got = {r["document_id"]: r for r in model_stages.generate(packages, docs, config.Config(), "Make {candidate_count}.", client, validate).collect()}
    assert json.loads(got["sha256:1"]["draft"]) == {"candidates": [1, 2, 3]} and got["sha256:1"]["attempts"] == 2
    assert got["sha256:2"]["draft"] is None and got["sha256:2"]["error"].startswith("JSONDecodeError")
    with pytest.raises(PySparkException, match="missing input package"):
        model_stages.generate(packages.limit(1), docs, config.Config(), "{candidate_count}", client, validate).collect()


def test_verification_and_judgment(spark):
    rows = [(i, "d", f"Question {i}?", "gold secret", 1, ["c"], ["x"], ["r"]) for i in ("fine", "cut", "down", "doubt", "human")]
    rec = spark.createDataFrame(rows, "sample_id string, document_id string, prompt string, gold_answer string, graph int, claims array<string>, derivations array<string>, rubric array<string>")
    pack = spark.createDataFrame([("d", "the text")], "document_id string, document_text string")

    def solver(prompt):
        assert "gold" not in prompt and "the text" in prompt
        if "down" in prompt:
            raise OSError("no service")
        return {"text": "word " * 80, "finish_reason": "length" if "cut" in prompt else "stop"}

    def auditor(prompt):
        return {"text": json.dumps({"gold_answer_supported": True, "needs_human_review": "human" in prompt, "disputed_claims": ["c"] if "doubt" in prompt else []}), "finish_reason": "stop"}

    out = model_stages.model_verify(rec, pack, config.Config(), solver, auditor)
    assert {r["sample_id"]: r["independent_verifier_status"] for r in out.collect()} == {"fine": "passed", "cut": "needs_review", "down": "needs_review", "doubt": "failed", "human": "needs_review"}
    alike = model_stages.model_verify(rec, pack, config.Config(), solver, auditor, F.lit(False))
    assert {r["independent_verifier_status"] for r in alike.collect()} == {"needs_review"}
    judged = {r["sample_id"]: (r["solver_correct"], r["failure_attribution"], r["judge_error"]) for r in model_stages.judge(out, lambda p: {"text": '{"solver_answer_correct": false, "failure_class": "genuine_reasoning_failure"}' if "fine" in p else "?"}).collect()}
    assert judged["fine"] == (False, "genuine_reasoning_failure", None)
    assert judged["down"][2] == "no reconstruction" and judged["doubt"][2] == "unreadable judgment"


def test_summary_and_its_files(spark, tmp_path):
    c = "array<struct<check:string,passed:boolean,details:string>>"
    fin = spark.createDataFrame([("s", "passed", [("final_x", False, "no"), ("y", True, None)])], f"sample_id string, final_validation_status string, checks {c}")
    found = report.summary({"generated": spark.range(3), "verified": fin, "finalized": fin})
    assert found["final_blockers"] == {"final_x": 1} and found["final_statuses"] == {"passed": 1} and found["generated"] == 3
    assert not found["release_ready"] and found["blockers"] == ["final_validation_incomplete", "no_difficulty_assessments", "export_not_release_ready"]
    assert report.release(0, 2, True) == (True, [])
    report.write_report("r", found, str(tmp_path / "report"))
    assert json.loads((tmp_path / "report.json").read_text())["final_blockers"] == {"final_x": 1}
    assert "- `final_x`: 1" in (tmp_path / "report.md").read_text()


def test_summary_works_a_table_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def status(i):
        seen.add(1)
        return None if i == 3 else f"s{i % 2}"

    c = "array<struct<check:string,passed:boolean,details:string>>"
    rows = [(i, "p", [("final_x", i % 2 == 0, ""), ("final_y", None, "")] if i else None) for i in range(8)]
    fin = spark.createDataFrame(rows, f"i int, human_review_status string, checks {c}").withColumn("final_validation_status", status("i"))
    found = report.summary({"finalized": fin})
    assert seen.value == 8
    assert found["finalized"] == 8 and found["final_statuses"] == {"None": 1, "s0": 4, "s1": 3} and found["human_review_statuses"] == {"p": 8} and found["final_blockers"] == {"final_x": 4}
    assert report.summary({"finalized": fin.where("false")})["final_blockers"] == {}


def test_manifests_packages_decisions_and_splits(spark, tmp_path):
    (tmp_path / "m.yaml").write_text("source_id: s\ndocuments:\n- {source_url: 'https://a.example/x.pdf', title: T, license_status: approved, license_id: CC0}\n")
    r = files.read_manifest(spark, tmp_path / "m.yaml").first()
    assert (r["source_id"], r["title"], r["license"]["status"], r["ordinal"]) == ("s", "T", "approved", 0)
    (tmp_path / "bad.yaml").write_text("source_id: s\ndocuments: [{title: T}]\n")
    with pytest.raises(ValueError, match="no source_url"):
        files.read_manifest(spark, tmp_path / "bad.yaml")
    with pytest.raises(FileNotFoundError):
        files.read_packages(spark, str(tmp_path), "text_only", "document_id string")
    (tmp_path / "review").mkdir()
    (tmp_path / "review" / "s1.json").write_text('{"sample_id": "s1", "decision": "approved"}')
    assert files.read_decisions(spark, f"{tmp_path}/review/*.json", "sample_id string, decision string").first()["decision"] == "approved"
    (tmp_path / "review" / "s2.json").write_text('{"sample_id": "s9", "decision": "approved"}')
    with pytest.raises(PySparkException, match="another sample"):
        files.read_decisions(spark, f"{tmp_path}/review/*.json", "sample_id string, decision string").collect()
    files.write_splits(spark.createDataFrame([(1, "train")], "x int, split string"), str(tmp_path / "out"), "split", ["train", "validation"])
    assert (tmp_path / "out" / "split=validation").is_dir() and spark.read.json(str(tmp_path / "out")).count() == 1


def test_settings_are_held_to_their_ranges(tmp_path):
    made = config.load_config({"run_id": "r1", "source_manifest": "m.yaml", "models": {"verifier_long_context": {"model": "long"}, "judge": {"model": "j"}}})
    assert made.run_id == "r1" and made.models.verifier_long_context.model == "long" and made.models.judge.model == "j"
    for section, name, value in (("verification", "audit_bbox_repair_max_blocks", -3), ("parse", "dpi", 10), ("deduplication", "bbox_match_iou", 1.5)):
        with pytest.raises(config.ConfigError):
            config.load_config({section: {name: value}})
    (tmp_path / "env").write_text("GOOD=1\nno value here\n")
    with pytest.raises(config.ConfigError, match="line 2"):
        config.load_env(tmp_path / "env")


def test_claims_need_one_ground_and_no_circle(spark):
    from evigrain.functions import graph

    kind = "array<struct<claim_id:string,supported_by:array<string>>>"
    cases = [("mixed", [("a", ["e1", "b"]), ("b", ["e9"])], ["b"], []), ("circle", [("a", ["e1", "b"]), ("b", ["a"]), ("c", ["b"])], [], ["a", "b", "c"]), ("self", [("a", ["a"])], ["a"], ["a"]), ("chain", [("a", ["b"]), ("b", ["c"]), ("c", ["e1"])], [], []), ("none", [], [], [])]
    df = spark.createDataFrame([(n, c) for n, c, _, _ in cases], f"name string, claims {kind}")
    got = {r["name"]: (sorted(r["u"]), sorted(r["k"])) for r in df.select("name", graph.ungrounded_claims(F.col("claims"), F.array(F.lit("e1"))).alias("u"), graph.circular_claims(F.col("claims")).alias("k")).collect()}
    assert got == {n: (u, k) for n, _, u, k in cases}
