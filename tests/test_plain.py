"""Settings, schedules, arithmetic, guards, files and connectors."""

import pytest
from pyspark.sql import functions as F

from evigrain import config
from evigrain.functions import text
from evigrain.operators import select
from evigrain.sources import connectors, files, guards, manifest


def test_settings_inherit_and_check(tmp_path):
    (tmp_path / "base.yaml").write_text("security: {max_pdf_bytes: 5}\ntarget_input: {page_image_dpi: 120}\n")
    (tmp_path / "own.yaml").write_text("extends: base.yaml\ntarget_input: {minimum_page_image_dpi: 96}\n")
    c = config.load_config(tmp_path / "own.yaml")
    assert (c.security.max_pdf_bytes, c.target_input.page_image_dpi, c.target_input.minimum_page_image_dpi) == (5, 120, 96)
    (tmp_path / "a.yaml").write_text("extends: b.yaml")
    (tmp_path / "b.yaml").write_text("extends: a.yaml")
    for bad in (tmp_path / "a.yaml", {"nonsense": 1}, {"target_input": {"minimum_page_image_dpi": 300}}, {"generation": {"primary_evidence_type_weights": {"x": 0.5}}}, {"context_budget": {"maximum_input_utilization": 0.1}}):
        with pytest.raises(config.ConfigError):
            config.load_config(bad)


def test_env_file_keeps_what_is_set(tmp_path, monkeypatch):
    monkeypatch.setenv("EVI_A", "old")
    monkeypatch.delenv("EVI_B", raising=False)
    (tmp_path / "env").write_text("# note\nEVI_A=new\nexport EVI_B='two'\n")
    assert config.load_env(tmp_path / "env") == {"EVI_B": "two"}
    assert config.load_env(tmp_path / "env", override=True)["EVI_A"] == "new"


def test_routing():
    small, large = config.Model("s", context_window_tokens=262_144, max_output_tokens=16_384), config.Model("l", context_window_tokens=524_288, max_output_tokens=16_384)
    assert [m and m.model for m in (config.route([small, large], n) for n in (96_827, 287_184, 520_000))] == ["s", "l", None]


def test_schedule():
    w = {"visual": 0.40, "layout": 0.45, "text": 0.15}
    got = select.type_schedule(w, 20)
    assert [got.count(k) for k in w] == [8, 9, 3] and not any(len(set(got[i : i + 4])) == 1 for i in range(17))
    assert sorted(select.type_schedule(w, 3)) == ["layout", "text", "visual"] and select.type_schedule(w, 0) == []


@pytest.mark.parametrize("source,value", [("100 - 10", 90), ("2^3 × 1.5", 12), ("-(1 + 2) ÷ 4", -0.75), ("1/0", None), ("x", None), ("a=1", None), ("", None), (None, None), ("(-8)^0.5", None), ("9^9^9", None), ("__import__('os')", None)])
def test_arithmetic(source, value):
    assert select.arithmetic(source) == value


def test_ranges(spark):
    assert select.parse_ranges(["1-3", 5, "2"], 6) == [1, 2, 3, 5]
    for bad in (["4-2"], ["0"], ["7"], ["x"]):
        with pytest.raises(ValueError):
            select.parse_ranges(bad, 6)
    df = spark.createDataFrame([("d", p) for p in (1, 2, 3, 5, 7, 8, 8)], "d string, p int")
    assert [(r["start"], r["end"]) for r in select.page_ranges(df, "d", "p").orderBy("range_no").collect()] == [(1, 3), (5, 5), (7, 8)]


def test_numbers_and_labels(spark):
    df = spark.createDataFrame([("a12 b-5 1,200.5 +3 (A) (b) (B)",)], "t string")
    r = df.select(text.numbers_in(F.col("t")).alias("n"), text.labels_in(F.col("t")).alias("l")).first()
    assert r["n"] == [2.0, 5.0, 1200.5, 3.0] and r["l"] == ["A", "B", "b"]


def test_guards(spark, tmp_path):
    s = config.Security(forbidden_source_substrings=["Bad.org/Set"])
    df = spark.createDataFrame([("https://ok.org/a",), ("http://ok.org",), ("https://x/bad.ORG/set",)], "u string")
    assert [r[0] for r in df.select(guards.url_problem(F.col("u"), s)).collect()] == [None, "scheme_not_allowed", "forbidden_source"]
    (tmp_path / "no" / "in").mkdir(parents=True)
    with pytest.raises(PermissionError):
        guards.check_path(tmp_path / "no" / "in" / "x", [tmp_path / "no"])
    assert guards.check_path(tmp_path / "nope", [tmp_path / "no"]).name == "nope"


def test_files(spark, tmp_path):
    assert files.read_jsonl(spark, str(tmp_path / "none"), "a int").count() == 0
    files.write_jsonl(spark.createDataFrame([(1, None), (2, "é")], "b int, a string"), str(tmp_path / "t"))
    assert sorted(x for p in (tmp_path / "t").glob("part*") for x in p.read_text().splitlines()) == ['{"a":"é","b":2}', '{"a":null,"b":1}']
    for n, v in (("1.json", 1), ("2.json", 2)):
        files.write_json(tmp_path / "f" / n, {"k": "x", "v": v})
    got = files.read_json_folder(spark, str(tmp_path / "f" / "*.json"), "k string, v int", "k").collect()
    assert [(r["k"], r["v"]) for r in got] == [("x", 2)]
    (tmp_path / "bad.jsonl").write_text("{}\nnot json\n")
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "bad.jsonl"), "a int").collect()


def test_manifest(tmp_path):
    import json

    with manifest.stage_run("good", tmp_path) as m:
        m["counts"]["rows"] = 3
    with pytest.raises(RuntimeError), manifest.stage_run("bad", tmp_path):
        raise RuntimeError("no")
    got = {p.name.split("-")[0]: json.loads(p.read_text()) for p in tmp_path.glob("*.json")}
    assert got["good"]["status"] == "completed" and got["good"]["counts"] == {"rows": 3} and got["bad"]["status"] == "failed" and got["bad"]["errors"][0]["message"] == "no"


def _fetch(url):
    if "missing" in url:
        raise OSError("gone")
    return iter([b"%PDF-", b"x" * (100 if "big" in url else 3)])


def _client(prompt):
    return {"text": "" if prompt == "empty" else f"re: {prompt}", "status": "incomplete" if prompt == "cut" else "completed"}


def test_connectors(spark):
    df = spark.createDataFrame([("a", "https://x/1"), ("b", "https://x/1"), ("c", "https://x/big"), ("d", "https://x/missing")], "candidate_id string, url string")
    got = connectors.fetch(df, _fetch, 50)
    assert {r["candidate_id"]: r["error"] and r["error"].split(":")[0] for r in got.collect()} == {"a": None, "b": None, "c": "TooLarge", "d": "OSError"}
    docs = connectors.ingested(got).collect()
    assert len(docs) == 2 and len({r["document_id"] for r in docs}) == 1
    asked = connectors.ask(spark.createDataFrame([("1", "hi"), ("2", "empty"), ("3", "cut")], "request_id string, prompt string"), _client, 2)
    assert {r["request_id"]: (r["response"], r["finish_reason"], r["attempts"], r["error"]) for r in asked.collect()} == {"1": ("re: hi", "stop", 1, None), "2": (None, "stop", 2, "empty response"), "3": ("re: cut", "length", 1, None)}


def test_strict_schema():
    s = connectors.strict_schema({"type": "object", "properties": {"a": {"type": "object", "properties": {"b": {"type": "string", "default": "x"}}}, "c": {"type": "array", "items": {"type": "object", "properties": {"d": {}}}}}})
    assert s["required"] == ["a", "c"] and s["additionalProperties"] is False and s["properties"]["a"]["required"] == ["b"] and s["properties"]["c"]["items"]["additionalProperties"] is False
    assert "default" not in s["properties"]["a"]["properties"]["b"]
