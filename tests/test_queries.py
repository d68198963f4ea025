"""Registered queries against the same question in SQL, on the smallest tables."""

import pytest

from evigrain.plans.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    import duckdb

    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return c


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple("None" if v is None or v != v else repr(float(v)) if isinstance(v, float) else str(v) for v in r) for r in df.itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    got, want = QUERIES[name](spark, DATA).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_queries_without_sql(spark):
    from tokenizers import Tokenizer

    P = pytest.importorskip("public_tokenizers")
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()}
    got = {r["doc_id"]: r["n_tokens"] for r in QUERIES["exact_text_tokens"](spark, DATA).collect()}
    assert got == {i: len(t.encode(x, add_special_tokens=False).ids) for i, x in texts.items()}


def _meet(a, b):
    """Intersection over union of two boxes."""
    sides = [min(a[f"{x}1"], b[f"{x}1"]) - max(a[f"{x}0"], b[f"{x}0"]) for x in "xy"]
    both = sides[0] * sides[1] if min(sides) > 0 else 0.0
    size = lambda r: (r["x1"] - r["x0"]) * (r["y1"] - r["y0"])
    return both / (size(a) + size(b) - both) if both else 0.0


def _matched(left, right, least):
    """Greedy matches in the order of left, the best right region first."""
    used = set()
    for n in left:
        rank = sorted((-_meet(n["bbox"], m["bbox"]), j) for j, m in enumerate(right) if j not in used and m["page"] == n["page"])
        if rank and -rank[0][0] >= max(least, 1e-300):
            used.add(rank[0][1])
    return len(used)


def _share(left, right, least):
    n = _matched(left, right, least)
    return n / (len(left) + len(right) - n) if left or right else 1.0


def test_region_match_equals_a_plain_loop(spark):
    from evigrain.plans import derived

    got = {r["sample_id"]: r["region_jaccard"] for r in QUERIES["greedy_region_match"](spark, DATA).collect()}
    for r in derived.candidates(spark, DATA, False).select("sample_id", "graph.nodes").collect():
        left = [n.asDict(recursive=True) for n in r["nodes"]]
        right = [n | {"bbox": n["bbox"] | {"x0": n["bbox"]["x0"] + 0.1, "x1": n["bbox"]["x1"] + 0.1}} for n in left]
        assert got[r["sample_id"]] == pytest.approx(_share(left, right, 0.30))


def test_selection_equals_a_plain_loop(spark):
    import re

    from evigrain.config import Deduplication
    from evigrain.operators import gates
    from evigrain.plans import derived

    conf, index = Deduplication(), lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    got = {r["sample_id"]: (r["status"], r["matched_sample_id"], r["reasons"]) for r in QUERIES["dedup_selected"](spark, DATA).collect()}
    c = gates.difficulty(gates.features(derived.candidates(spark, DATA, False)))
    groups = {}
    for r in c.select("sample_id", "doc_id", "prompt", "primary_evidence_type", "structural_score", "graph").collect():
        groups.setdefault(r["doc_id"] % 97, []).append(r.asDict(recursive=True))
    want = {}
    for rows in groups.values():
        todo, chosen = {r["sample_id"]: r for r in rows}, []
        while todo:
            types = [k["primary_evidence_type"] for k in chosen]
            if len(chosen) == conf.max_tasks_per_document:
                want |= {i: ("rejected_document_cap", None, ["max_tasks_per_document"]) for i in todo}
                break
            now = todo.pop(min(todo, key=lambda i: (todo[i]["primary_evidence_type"] in types, -todo[i]["structural_score"], i)))
            for k in chosen:
                a, b = now["graph"], k["graph"]
                tests = {
                    "evidence_region_overlap": round(_share(a["nodes"], b["nodes"], conf.bbox_match_iou), 4) >= conf.max_evidence_region_jaccard,
                    "prompt_rephrase": round(index(*({*re.findall("[a-z0-9]+", x["prompt"].lower())} for x in (now, k))), 4) >= conf.max_prompt_token_jaccard,
                    "same_pages_and_reasoning_path": round(index(*({n["page"] for n in g["nodes"]} for g in (a, b))), 4) >= conf.max_evidence_page_jaccard
                    and round(index(*({o["op"] for o in g["operations"]} for g in (a, b))), 4) >= conf.max_page_operation_jaccard,
                }
                if any(tests.values()):
                    want[now["sample_id"]] = ("rejected_duplicate", k["sample_id"], [n for n, t in tests.items() if t])
                    break
            else:
                chosen.append(now)
                want[now["sample_id"]] = ("selected", None, [])
    assert got == want
