from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from callmill import common
from callmill.operators import assemble, contracts, engines, evaluate, evidence, grouping, ingest, layout, report, scoring, taxonomy
from callmill.sources import files
from callmill.streaming import intake


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_ingest(spark):
    sources = spark.createDataFrame([(1, "77", "F", "T", "https://x.example/a.pdf?utm_a=1"), (2, " ", "A & B", "Q1: go", "https://x.example/a"), (3, None, None, None, None)], "list_row bigint, id string, firm string, title string, source_link string")
    assert rows_of(ingest.target_sources(sources).select("list_row", "source_id", "source_type")) == [(1, "77", "pdf"), (2, "2-a-b-q1-go", "html"), (3, "3", "html")]
    pilot = spark.createDataFrame([("Abc Co", "Out look", "https://x.example/p"), ("Abc Co", "Other", "l"), ("Def", "X", "https://x.example/q.pdf?z")], "firm string, source string, link string")
    local = spark.createDataFrame([("abcco", "outlook", "/1.pdf"), ("ABC CO", "else", "/0.pdf")], "firm string, title string, path string")
    assert rows_of(ingest.pilot_sources(pilot, local).select("source", "local_path", "source_type")) == [("Other", "/0.pdf", "pdf"), ("Out look", "/1.pdf", "pdf"), ("X", None, "pdf")]
    pages = spark.createDataFrame([("s", 2, "b"), ("s", 1, "a"), ("s", 3, None)], "source_id string, page_no int, text string")
    assert rows_of(ingest.page_text(pages)) == [("s", "a\n\nb\n\n", 3)]
    snaps = spark.createDataFrame([("p", 11, "x"), ("z", 0, "x"), ("h", None, "y" * 16_001), ("e", None, ""), ("n", None, None)], "source_id string, page_count int, snapshot_text string")
    made = {s: [r[2] for r in rows_of(ingest.make_chunks(snaps)) if r[0] == s] for s in "pzhen"}
    assert made == {"p": ["p1-5", "p6-10", "p11-11"], "z": [], "h": ["char:0-8000", "char:8000-16000", "char:16000-16001"], "e": ["char:0-0"], "n": ["char:0-0"]}
    quality = snaps.select("source_id", ingest.read_quality(F.col("snapshot_text"), F.col("page_count")).alias("q"))
    assert dict(rows_of(quality)) == {"p": False, "z": False, "h": True, "e": False, "n": False}
    many = spark.createDataFrame([(i,) for i in range(45)], "k int")
    assert sorted(r.batch_no for r in ingest.batches(many, "k").collect()) == [0] * 20 + [1] * 20 + [2] * 5
    assert ingest.batches(many.limit(0), "k").count() == 0


def test_numbered(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(7)
    assert all(r.k == r.idx for r in common.numbered(df, "k").collect())


@pytest.mark.parametrize(
    ("quote", "wanted"),
    [
        ("alpha beta gamma delta", None), ("alpha beta gamma delta ... epsilon zeta theta iota", None), ("epsilon zeta theta iota ... alpha beta gamma delta", "out_of_order"), ("beta alpha", "not_found"), ("alpha beta gamma delta ... one two", "span_too_short"),
        ("a ... b ... c ... d", "too_many_spans"), (" ... ", "empty"), ("", "empty"), ("alpha beta gamma delta ... missing words here now", "not_found"), (None, "empty"),
    ],
)
def test_verbatim(spark, quote, wanted):
    text = "alpha beta gamma delta, then epsilon zeta theta iota."
    df = spark.createDataFrame([(quote, text)], "q string, t string")
    assert evidence.with_spans(df, evidence.spans_of(F.col("q"))).select(evidence.verbatim(F.col("t")).alias("r")).first().r == wanted


def test_evidence_check(spark):
    sources = spark.createDataFrame([("s", "Rates fell and copper rose sharply", [3]), ("blank", " ", []), ("none", None, None)], "source_id string, snapshot_text string, scrambled_pages array<int>")
    ready = evidence.prepared(sources, "snapshot_text")
    rows = [(1, "s", "copper rose", "prose", "p.1"), (2, "s", "rose copper", "prose", "p.1"), (3, "s", "rose copper", "prose", "p.3"), (4, "s", "copper sharply", "table", "p.1"), (5, "s", "copper sharply", "table", "p. 1 - table 2"), (6, "s", "zinc lead", "visual", "chart 1"),
            (7, "blank", "copper", "prose", "p.1"), (8, "none", "copper", "prose", None), (9, "unknown", "copper", "prose", "p.1"), (10, "s", None, None, None), (11, None, "x", "prose", "p.1")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "k int, source_id string, evidence_quote string, evidence_kind string, locator string, norm_text string")
    found = {r.k: (r.ev_reason, r.degraded) for r in evidence.check(df, ready, "k").collect()}
    assert found == {1: (None, False), 2: ("quote_not_found", False), 3: (None, True), 4: ("visual_locator_missing", False), 5: (None, False), 6: ("evidence_check_failed", False),
                     7: ("evidence_check_failed", False), 8: ("evidence_check_failed", False), 9: ("evidence_check_failed", False), 10: ("quote_not_found", False), 11: ("evidence_check_failed", False)}
    assert evidence.check(df.limit(0), ready, "k").count() == 0


BASE = {"call_language": "explicit_stance", "evidence_kind": "prose", "taxonomy_match": "exact", "conflict": False, "well_read": True, "degraded": False, "basis": "stated", "call_view": "O", "supports_view": "pass", "forward_looking": "pass", "asset_match": "pass", "evidence_strength": "decisive"}


@pytest.mark.parametrize(
    ("change", "score", "band", "flag"),
    [
        ({}, 96, "High", "none"), ({"call_language": "implied"}, 82, "High", "none"), ({"call_language": "implied", "taxonomy_match": "semantic"}, 72, "Medium", "review"),
        ({"call_language": "implied", "taxonomy_match": "semantic", "well_read": False}, 62, "Medium", "review"), ({"evidence_strength": "adequate"}, 92, "High", "none"), ({"evidence_strength": "thin"}, 74, "Medium", "review"),
        ({"asset_match": "unclear"}, 74, "Medium", "review"), ({"supports_view": None, "forward_looking": None, "asset_match": None}, 74, "Medium", "review"), ({"basis": "inferred"}, 74, "Medium", "review"), ({"degraded": True}, 74, "Medium", "review"),
        ({"call_language": "explicit_dial"}, 96, "High", "none"), ({"call_language": "explicit_dial", "evidence_kind": "visual"}, 100, "High", "none"), ({"conflict": True}, 86, "High", "review"), ({"call_view": "UNCERTAIN"}, 96, "High", "review"), ({"evidence_strength": ""}, 96, "High", "none"),
        ({"call_language": None, "taxonomy_match": None, "conflict": None, "well_read": None, "degraded": None, "basis": None, "call_view": None}, 50, "Medium", "review"),
    ],
)
def test_score(spark, change, score, band, flag):
    x = BASE | change
    schema = ", ".join(f"{k} {'boolean' if k in ('conflict', 'well_read', 'degraded') else 'string'}" for k in x)
    r = scoring.score(spark.createDataFrame([tuple(x.values())], schema)).first()
    assert (r.confidence, r.band, r.review_flag) == (score, band, flag)


def test_gates(spark):
    rows = [(1, True, None, 25.0, "bp", "forecast_delta", "pass"), (2, True, None, -24.0, "bp", "forecast_delta", "pass"), (3, True, None, 0.86, "pct", "forecast_delta", "fail"), (4, False, "x", 1.0, "bp", "forecast_delta", "fail"), (5, True, "quote_not_found", 1.0, "bp", "forecast_delta", "fail"), (6, True, None, None, None, "stated", "fail"), (7, None, None, None, None, None, None)]
    df = spark.createDataFrame([(*r, None, None) for r in rows], "k int, known boolean, ev string, d double, u string, b string, supports_view string, forward_looking string, asset_match string")
    reason = scoring.hard_failure(F.col("known"), F.lit("exact"), F.col("ev"), F.col("d"), F.col("u"), F.col("b"), True)
    assert dict(rows_of(df.select("k", reason.alias("r")))) == {1: None, 2: "delta_below_materiality", 3: "delta_below_materiality", 4: "taxonomy_no_match", 5: "quote_not_found", 6: "checker_sign_mismatch", 7: "taxonomy_no_match"}


def test_same_view_and_arbitration(spark):
    calls = spark.createDataFrame([(1, "g", "l", "O", 80.0, "s1"), (2, "g", "l", "O", 90.0, "s2"), (3, "g", "l", "U", 90.0, "s2"), (4, "g", "m", "O", 70.0, "s1"), (5, "g", "m", "O", 70.0, "s1"), (6, "g", "m", "O", 60.0, "s3"), (7, None, "m", "O", None, None)], "idx int, grp string, leaf string, call_view string, score double, source string")
    keys = ["grp", "leaf"]
    routed = assemble.route_same_view(calls, keys, "score", "idx")
    assert {r.idx: r.reason for r in routed.collect()} == {1: "duplicate_same_view", 2: None, 3: "duplicate_same_view", 4: None, 5: "duplicate_same_view", 6: "duplicate_same_view", 7: None}
    assert {(r.grp, r.leaf): r.conflict for r in assemble.view_conflicts(calls, keys).collect()} == {("g", "l"): True, ("g", "m"): False, (None, "m"): False}
    for decision, wanted in (((("g", "l", 2, "x"),), {1: "arbitrated_out", 2: "arbitrated_out", 3: None}), ((("g", "l", 9, "x"),), dict.fromkeys((1, 2, 3), "unresolved_conflict")), ((), dict.fromkeys((1, 2, 3), "unresolved_conflict"))):
        d = spark.createDataFrame(list(decision), "grp string, leaf string, winning_index int, reasoning string")
        assert {r.idx: r.reason for r in assemble.arbitrate(calls, keys, d, "idx").collect()} == wanted
    noted = assemble.corroboration(calls.withColumn("title", F.concat(F.lit("T"), "idx")), keys, "score", "idx", "source", "title", "source")
    assert {r.winner_idx: r.corroboration for r in noted.collect()} == {2: "T1 (s1)", 4: "T6 (s3)", 7: ""}
    assert assemble.route_same_view(calls.limit(0), keys, "score", "idx").count() == 0


def test_cross_leaf(spark):
    rows = [(1, "s", "O", ["gold rallies", "now"], "Gold Bullion", 5), (2, "s", "O", ["now", "gold  rallies"], "Silver Bullion", 3), (3, "s", "U", ["gold rallies", "now"], "Silver Bullion", 3), (4, "s", "O", ["nothing named"], "Oil", 9), (5, "s", "O", ["nothing named"], "Gas", 2), (6, "s", "O", ["nothing named"], "None", None), (7, None, None, None, None, None)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "idx int, source string, call_view string, spans array<string>, leaf string, leaf_no int, _n int")
    found = assemble.cross_leaf_duplicates(df.drop("_n"), "source", "call_view", "spans", "leaf", "leaf_no", "idx")
    assert {r.idx: r.reason for r in found.collect()} == {1: None, 2: "duplicate_cross_leaf", 3: None, 4: "duplicate_cross_leaf", 5: None, 6: "duplicate_cross_leaf", 7: None}


def test_memory(spark):
    blocks = spark.createDataFrame([("a", 0, 0, "a0;", "A"), ("a", 0, 1, "a1;", "A"), ("b", 1, 0, "b0;", "B"), ("b", 1, 1, "b1;", "B"), ("d", 3, 0, "d0;", "D"), ("c", 2, 0, "c0;", None)], "source_id string, source_ord int, chunk_ord int, block string, head string")
    assert {(r.source_id, r.chunk_ord): r.memory for r in assemble.rolling_memory(blocks, ["source_id"], "chunk_ord", "block", "head").collect()} == {("a", 0): "A", ("a", 1): "Aa0;", ("b", 0): "B", ("b", 1): "Bb0;", ("c", 0): "", ("d", 0): "D"}
    groups = spark.createDataFrame([("a", "g"), ("b", "g"), ("d", "g")], "source_id string, group_id string")
    found = assemble.companion_memory(blocks, groups, "source_ord", "chunk_ord", "block", "head", "<new>")
    whole_a = "Aa0;a1;"
    whole_b = "B<new>" + whole_a + "\nb0;b1;"
    assert {(r.source_id, r.chunk_ord): r.memory for r in found.collect()} == {("a", 0): "A", ("a", 1): "Aa0;", ("b", 0): "B<new>" + whole_a + "\n", ("b", 1): "B<new>" + whole_a + "\nb0;", ("d", 0): "D<new>" + whole_b + "\n", ("c", 0): ""}
    none, one = F.lit(None).cast("string"), F.array(F.struct(F.lit("Gold").alias("leaf"), F.lit("O").alias("call_view"), F.lit("p.1").alias("locator")))
    x = spark.range(1).select(engines.memory_block(F.lit("p1-5"), F.lit("s."), one, none).alias("x"), engines.memory_block(F.lit("p1-5"), none, one, F.lit("engine_error")).alias("y"), engines.memory_header(F.lit("F"), F.lit("T"), F.lit("s")).alias("z")).first()
    assert (x.x, x.y, x.z) == ("\n## Chunk p1-5\nSummary: s.\nCandidates: Gold=O[p.1]\n", "\n## Chunk p1-5\nSummary: (engine_error; chunk skipped)\nCandidates: none\n", "# F — T  (s)\n")


def test_analyze_in_order(spark):
    """Each chunk is read with what came before it, a companion with all of the document before it, and a failure stops nothing."""

    def engine(prompt: str) -> str:
        if "boom" in prompt:
            raise RuntimeError("down")
        return "no json" if "stubborn" in prompt else json.dumps({"summary": f"seen {prompt.count('## Chunk')}", "candidates": [{"sub_asset_class": "Gold", "view": "O", "locator": "p.1"}] if "call" in prompt.split("CONTENT:")[1].split("##")[0] else []})

    rows = [("g", 1, "s1", "F", "T", 0, "c0", "call"), ("g", 1, "s1", "F", "T", 1, "c1", "boom"), ("g", 1, "s1", "F", "T", 2, "c2", "stubborn"), ("g", 2, "s2", "F", "U", 0, "c0", "nothing"), ("s3", 3, "s3", None, None, 0, "c0", "call")]
    chunks = spark.createDataFrame(rows, "group_key string, source_ord int, source_id string, firm string, title string, chunk_ord int, chunk_id string, content string")
    validate = lambda a: None if a.startswith("{") else "not JSON"
    found = {(r.source_id, r.chunk_ord): r for r in engines.analyze(chunks, "{{rules}}\nMEMORY:{{memory}}CONTENT:{{chunk_content}}", engine, validate, {"rules": "R"}).collect()}
    head = "# F — T  (s1)\n"
    told = "\n## Chunk c0\nSummary: seen 0\nCandidates: Gold=O[p.1]\n"
    failed = "\n## Chunk c1\nSummary: (engine_error; chunk skipped)\nCandidates: none\n"
    assert found["s1", 0].memory == head and found["s1", 1].memory == head + told and found["s1", 2].memory == head + told + failed
    assert (found["s1", 1].reason_code, found["s1", 1].attempt, found["s1", 2].reason_code, found["s1", 2].attempt) == ("engine_error", 1, "json_parse_error", 3)
    assert found["s2", 0].memory.startswith("# F — U  (s2)\n" + engines.COMPANION + head + told) and found["s3", 0].memory == "#  —   (s3)\n"
    assert engines.analyze(chunks.limit(0), "", engine, validate).count() == 0


def test_recorded_responses(spark):
    good = {"source_id": "s", "chunk_id": "p1-5", "sub_asset_class": "Gold", "taxonomy_match": "exact", "view": "O", "call_language": "implied", "evidence_kind": "prose", "evidence_quote": "q", "locator": "p.1", "reasoning": "r"}
    rows = [("s", "p1-5", json.dumps({"candidates": [good, good | {"view": "U"}], "summary": "x"})), ("s", "p6-9", json.dumps({"candidates": [good, good | {"view": "?"}, {}]})), ("t", "p1-5", "no"), ("u", "p1-5", json.dumps({"candidates": []}))]
    kept, lost = engines.responses_to_candidates(spark.createDataFrame(rows, "source_id string, chunk_id string, response string"), ["source_id", "chunk_id"], "response")
    assert sorted((r.response_source_id, r.response_chunk_id, r.item_no, r.call_view) for r in kept.collect()) == [("s", "p1-5", 0, "O"), ("s", "p1-5", 1, "U")]
    before = "invalid LLM JSON after repair attempts: "
    assert rows_of(lost.select("source_id", "chunk_id", "reason_code", "message")) == [("s", "p6-9", "json_parse_error", before + "view must be one of O, N, U, UNCERTAIN"), ("t", "p1-5", "json_parse_error", before + "LLM response must be a JSON object")]
    ok = {"index": 0, "supports_view": "pass", "forward_looking": "pass", "asset_match": "pass"}
    calls = spark.createDataFrame([("a", 10), ("a", 30), ("a", 20), ("b", 40), ("c", 50), ("d", 60)], "source_id string, cand_idx bigint")
    said = [("a", json.dumps({"verdicts": [ok, ok | {"index": 2, "note": "n"}, ok | {"index": 9}, ok | {"supports_view": "fail"}]}), None), ("b", json.dumps({"verdicts": [ok | {"asset_match": "no"}]}), None), ("c", None, "engine_error: down")]
    verdicts, failed = engines.checked_verdicts(calls, spark.createDataFrame(said, "source_id string, response string, error string"), error="error")
    assert rows_of(verdicts.select("cand_idx", "supports_view", "note")) == [(10, "fail", ""), (30, "pass", "n")]
    assert rows_of(failed) == [("b", "checker", "checker_error", "asset_match must be one of pass, unclear, fail"), ("c", "checker", "checker_error", "engine_error: down")]
    conflicts = spark.createDataFrame([("g", "l"), ("g", "l"), (None, "l")], "group_key string, sub_asset_class string")
    told = spark.createDataFrame([("g", "l", '{"winning_index": 1, "reasoning": "newer"}', None), (None, "l", "x", None), ("z", "l", None, "down")], "group_key string, sub_asset_class string, response string, error string")
    assert rows_of(engines.decided(conflicts, ["group_key", "sub_asset_class"], told, error="error")) == [("g", "l", 1, "newer"), (None, "l", None, "arbiter error: arbiter response must be a JSON object")]


def test_recorded_responses_in_parts(spark, monkeypatch):
    """Observations don't carry their response's text, and one bad part makes the whole response fail with the first message."""
    written = []
    monkeypatch.setattr(engines, "stored", lambda df, name: written.append(df.columns) or common.stored(df, name))
    good = {"source_id": "s", "chunk_id": "p1-5", "sub_asset_class": "Gold", "taxonomy_match": "exact", "view": "O", "call_language": "implied", "evidence_kind": "prose", "evidence_quote": "q", "locator": "p.1", "reasoning": "r"}
    said = lambda *found: json.dumps({"candidates": found})
    rows = [("a", 1, said(good, good)), ("a", 0, said(good)), ("b", 2, said(good | {"view": "?"})), ("b", 1, said(good, good | {"locator": ""})), ("c", 0, said(good)), ("c", 1, "no"), ("d", 0, said()), (None, 0, said(good, {})), (None, 1, said(good))]
    kept, lost = engines.responses_to_candidates(spark.createDataFrame([("s", *r) for r in rows], "source_id string, chunk_id string, part int, response string"), ["source_id", "chunk_id"], "response", "part")
    assert sorted((r.response_chunk_id, r.part, r.item_no) for r in kept.collect()) == [("a", 0, 0), ("a", 1, 0), ("a", 1, 1)]
    before = "invalid LLM JSON after repair attempts: "
    found = {r.chunk_id: r.message.removeprefix(before) for r in lost.collect()}
    assert lost.count() == 3 and (found["b"], found["c"]) == ("locator must be a non-empty string", "LLM response must be a JSON object") and found[None].startswith("candidate missing required fields")
    assert written and not any({"_answer", "item"} & {*columns} for columns in written)


GOOD = {"source_id": "s", "sub_asset_class": "Gold", "taxonomy_match": "exact", "view": "O", "call_language": "explicit", "evidence_kind": "prose", "evidence_quote": ["a", "b ... c"], "locator": "p.1", "reasoning": "r", "conflict": False, "chunk_id": "p1-1"}


@pytest.mark.parametrize(
    ("text", "error"),
    [
        (json.dumps(GOOD), ""), ("```json\n" + json.dumps(GOOD) + "\n```", ""), (json.dumps(GOOD | {"evidence_quote": "one"}), ""), (json.dumps({k: v for k, v in GOOD.items() if k != "view"}), "missing_fields"), (json.dumps(GOOD | {"view": "X"}), "view"),
        (json.dumps(GOOD | {"call_language": "loud"}), "call_language"), (json.dumps(GOOD | {"basis": "guessed"}), "basis"), (json.dumps(GOOD | {"basis": "forecast_delta"}), "delta_fields"), (json.dumps(GOOD | {"basis": "forecast_delta", "delta_value": "30", "delta_unit": "bp"}), "delta_value"),
        (json.dumps(GOOD | {"basis": "forecast_delta", "delta_value": True, "delta_unit": "bp"}), "delta_value"), (json.dumps(GOOD | {"basis": "forecast_delta", "delta_value": 30, "delta_unit": "percent"}), "delta_unit"), (json.dumps(GOOD | {"basis": "forecast_delta", "delta_value": -0.5, "delta_unit": "pct"}), ""),
        (json.dumps(GOOD | {"conflict": 1}), "conflict"), (json.dumps(GOOD | {"evidence_quote": []}), "evidence_quote"), (json.dumps(GOOD | {"evidence_quote": ["a", " "]}), "evidence_quote"), (json.dumps(GOOD | {"locator": " "}), "locator"), ("[1]", "not_an_object"), ("{", "not_an_object"), ("", "not_an_object"), (None, "not_an_object"),
    ],
)
def test_candidate_contract(spark, text, error):
    r = contracts.candidates(spark.createDataFrame([(text, "x")], "j string, view string"), "j").first()
    assert (r.errors[0] if r.errors else "") == error
    if text == json.dumps(GOOD):
        assert r.call_language == "explicit_stance" and r.evidence_spans == ["a", "b ... c"] and r.basis == "stated" and r.delta_value is None


def test_verdicts_and_attempts(spark):
    ok = {"index": 0, "supports_view": "pass", "forward_looking": "pass", "asset_match": "fail"}
    texts = [ok, ok | {"index": True}, ok | {"index": 1.5}, ok | {"index": -1}, ok | {"asset_match": "no"}, ok | {"evidence_strength": "strong"}, ok | {"evidence_strength": "thin", "note": "n"}]
    found = contracts.verdicts(spark.createDataFrame([(i, json.dumps(t)) for i, t in enumerate(texts)], "i int, j string"), "j")
    assert [len(r.errors) for r in found.orderBy("i").collect()] == [0, 1, 1, 1, 1, 1, 0]
    envelope = spark.createDataFrame([("r", 1, json.dumps({"verdicts": [ok, ok | {"asset_match": 3}]})), ("r", 2, json.dumps({"verdicts": [ok, ok | {"index": 5}, ok | {"supports_view": "fail"}]})), ("q", 1, "no json")], "source string, attempt int, j string")
    checked = contracts.verdicts(contracts.items(envelope, "j", "verdicts"), "item")
    assert rows_of(contracts.first_valid_attempt(checked, ["source"], "attempt")) == [("r", 2)]
    counts = spark.createDataFrame([("r", 3)], "source string, n int")
    last = contracts.last_verdicts(checked.where("attempt = 2"), counts, "source", "item_no").collect()
    assert [(r.cand_idx, r.supports_view) for r in last] == [(0, "fail")]
    back = spark.createDataFrame([(json.dumps(GOOD | {"evidence_quote": "one"}),)], "j string")
    text = contracts.candidates(back, "j").select(contracts.to_json().alias("x")).first().x
    assert json.loads(text)["evidence_quote"] == "one" and "delta_value" not in json.loads(text)


def test_engine(spark):
    def engine(prompt: str) -> str:
        if "boom" in prompt:
            raise RuntimeError("no engine")
        return "{}" if "did not satisfy" in prompt or "easy" in prompt else "x"

    validate = lambda a: None if a == "{}" else "no object"
    prompts = spark.createDataFrame([("a", "easy"), ("b", "hard"), ("c", "boom")], "k string, p string")
    tried = common.stored(engines.run_engine(prompts, ["k"], "p", engine, validate), "tried")
    assert rows_of(engines.accepted(tried, ["k"])) == [("a", "{}", 1), ("b", "{}", 2)]
    assert rows_of(engines.exhausted(tried, ["k"])) == [("c", "engine_error", "engine_error: no engine")]
    never = engines.run_engine(prompts.where("k = 'b'"), ["k"], "p", lambda p: "x", validate)
    assert never.count() == 3 and rows_of(engines.exhausted(never, ["k"]))[0][1] == "json_parse_error"
    allowed = {"one": engines.Rule(("one", "run"), ("low",), model="m", model_flags=("-m", "{}"), effort_flags=("-c", "effort={}")), "two": engines.Rule(("two",), ("low", "high"), needs_model=True)}
    assert engines.Settings("one", effort="low").checked(allowed).repairs == 2
    assert engines.Settings("one", effort="low").argv(allowed, "p") == ["one", "run", "-m", "m", "-c", "effort=low", "p"] and engines.Settings("two", "x").argv(allowed, "p") == ["two", "--model", "x", "p"]
    assert engines.compose_prompt("base \n", '{"b": 1, "a": "é"}') == 'base\n\n## Machine-readable inputs\n{\n  "a": "é",\n  "b": 1\n}\n'
    assert json.loads(engines.repair_prompt("base", '{"a": 1}', "prev", "why").split("JSON.\n\n")[1]) == {"original_inputs": {"a": 1}, "previous_response": "prev", "validation_error": "why"}
    for bad in (engines.Settings("three"), engines.Settings("one", effort="x"), engines.Settings("one", model="q"), engines.Settings("two")):
        with pytest.raises(ValueError):
            bad.checked(allowed)
    batch = engines.check_batches(spark.createDataFrame([("s", 4, "x"), ("s", 2, "y")], "s string, idx int, v string"), "s", "idx", "v").first()
    assert [(b["index"], b["v"]) for b in json.loads(batch.batch)] == [(0, "y"), (1, "x")]


def test_grouping(spark):
    plan = [(["a", "b", "x"], "n1"), (["b", "c"], "n2"), (["c", "d"], "n3"), (["e", "e"], "n4")]
    groups, warnings = grouping.resolve_groups(plan, set("abcd"), ["who?"])
    assert groups == [{"group_id": "group-1", "source_ids": ["a", "b"], "note": "n1"}, {"group_id": "group-2", "source_ids": ["c", "d"], "note": "n3"}]
    assert warnings == [
        "unmatched note: who?", "dropped unknown source ids ['x'] from note: n1", "source(s) ['b'] already grouped; dropped from note: n2", "note did not resolve to two run sources; ignored: n2",
        "dropped unknown source ids ['e', 'e'] from note: n4", "note did not resolve to two run sources; ignored: n4",
    ]
    df = spark.createDataFrame([("a", "z"), ("q", "z")], "source_id string, group_id string")
    assert rows_of(grouping.with_groups(df, grouping.group_map(groups)).select("source_id", "group_id")) == [("a", "group-1"), ("q", "q")]
    said = lambda text, error=None: grouping.resolved(spark.createDataFrame([(text, error)], "t string, e string"), "t", set("ab"), "e")
    assert said('{"groups": [{"source_ids": ["a", "b"], "note": "n"}], "unmatched_notes": ["u"]}') == ([{"group_id": "group-1", "source_ids": ["a", "b"], "note": "n"}], ["unmatched note: u"])
    assert said("x") == ([], ["group-notes resolution failed; run proceeds ungrouped: group resolver response must be a JSON object"]) and said(None, "down")[1][0].endswith("down")


def test_snapshots(spark):
    sources = spark.createDataFrame([("f", "pdf"), ("h", "html"), ("v", "html"), ("w", "html"), ("e", "pdf")], "source_id string, source_type string")
    pages = spark.createDataFrame([("f", 2, "two", True), ("f", 1, "one", False)], "source_id string, page_no int, text string, scrambled boolean")
    heavy = "<img>" * 6
    html = spark.createDataFrame([("h", "<p>x</p>", "x"), ("v", heavy, "few"), ("w", heavy, "kept")], "source_id string, html string, text string")
    prints = files.paged(spark.createDataFrame([("v", "http://v"), ("z", "bad")], "source_id string, u string"), "u", lambda u: ["p1", "p2"] if "v" in u else 1 / 0)
    assert rows_of(prints.select("source_id", "page_no", "text", "read_error")) == [("v", 1, "p1", None), ("v", 2, "p2", None), ("z", None, None, "division by zero")]
    got = {r.source_id: r for r in ingest.snapshots(sources, pages, html, prints.where("page_no is not null").withColumn("scrambled", F.lit(False))).collect()}
    assert (got["f"].snapshot_text, got["f"].page_count, got["f"].scrambled_pages, got["f"].visual_markup) == ("one\n\ntwo", 2, [2], None)
    assert (got["h"].snapshot_text, got["h"].page_count, got["h"].visual_heavy) == ("x", None, False) and (got["v"].snapshot_text, got["v"].page_count, got["v"].printed_pdf) == ("p1\n\np2", 2, True)
    assert (got["w"].snapshot_text, got["w"].printed_pdf, got["w"].visual_heavy) == ("kept", False, True) and (got["e"].snapshot_text, got["e"].page_count) == ("", 0)
    told = spark.createDataFrame([("char:1-3", "char:1-3", "abcd", "/f", "http://x", False, False), ("p1-5", "p.1-5", "abcd", "/f", "http://x", False, True)], "c string, l string, t string, p string, u string, paged boolean, printed boolean")
    said = [r.x for r in told.select(ingest.chunk_content(*[F.col(c) for c in ("c", "l", "t", "p", "u", "paged", "printed")]).alias("x")).collect()]
    assert "(locator char:1-3, from http://x)" in said[0] and said[0].endswith("-----\nbc\n-----") and said[1].startswith("This chunk is pages 1-5 of the PDF file at:\n`/f`\n\n(This PDF is a print-to-PDF capture")


def test_layout(spark):
    one = [("one", 50.0, 500.0, 100.0 + 20 * i) for i in range(30)]
    two = [("two", x0, x1, 100.0 + 20 * i) for i in range(30) for x0, x1 in ((50.0, 250.0), (330.0, 530.0))]
    few = [("few", 50.0, 100.0, 100.0 + i) for i in range(10)] + [("none", None, None, None)]
    words = spark.createDataFrame([(*r, r[3] and r[3] + 10, 595.0, 842.0) for r in one + two + few], "page_id string, x0 double, x1 double, top double, bottom double, page_width double, page_height double")
    assert dict(rows_of(layout.scrambled_pages(words))) == {"one": False, "two": True, "few": False, "none": False}
    assert layout.scrambled_pages(words.limit(0)).count() == 0


def test_taxonomy_and_reports(spark, tmp_path):
    t = spark.createDataFrame([(1, "Gold", "Metals", "Alt", "G"), (2, "Oil", "Fuel", "Alt", "G"), (3, "Yen", "FX", "Cur", "C")], "leaf_no int, sub_asset_class string, asset_class_category string, asset_class string, canva_groupings string")
    assert taxonomy.integrity(t, 3).first().sound and not taxonomy.integrity(t).first().sound and not taxonomy.integrity(t.union(t.limit(1)), 4).first().sound
    assert "".join(r.block + "\n" for r in taxonomy.outline(t).orderBy("leaf_no").collect()) == "## Alt\n### Metals\n- Gold\n### Fuel\n- Oil\n## Cur\n### FX\n- Yen\n"
    rows = spark.createDataFrame([("Gold", "x"), ("gold", "x"), (None, "x")], "label string, asset_class string")
    assert rows_of(taxonomy.lookup(rows, t, "label").select("label", "asset_class")) == [("Gold", "Alt"), ("gold", None), (None, None)]
    assert rows_of(taxonomy.unknown_labels(rows, t, "label")) == [("gold", 1)]
    assert report.reconciliation(rows, rows.limit(1), rows.limit(1)).first().status == "review"
    counts = report.reconciliation(rows, rows.limit(1), rows.limit(2))
    kept = spark.createDataFrame([("stated", "thin"), ("", ""), (None, None)], "basis string, checker_strength string")
    failed = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), ("b",)], "reason_code string")
    done = spark.createDataFrame([("s2", "pdf", 3, 1, 4, False, True, [2, 3], 2), ("s1", "html", None, 2, 0, True, False, [], 1), ("s0", "pdf", 0, 0, 0, False, False, None, 3)], "source_id string, source_type string, page_count int, chunk_count int, candidates int, visual_heavy boolean, printed_pdf boolean, scrambled_pages array<int>, source_ord int")
    text = report.manifest(counts, failed, kept, failed.where("reason_code = 'a'"), {"engine": "x", "none": None}, done, {"notes_path": "n.txt", "groups": [{"group_id": "group-1", "source_ids": ["a", "b"], "note": "w"}], "warnings": ["v"]})
    assert text.split("\n") == [
        "# Run Manifest", "", "## Run configuration", "- engine: x", "", "## Grouping", "- group notes: n.txt", "- group-1: a, b — note: w", "- warning: v", "",
        "## Candidate reconciliation", "- candidates: 3", "- kept: 1", "- failed: 2", "- count check: pass", "- chunk failures (no candidate): 1", "",
        "## Call basis (kept rows)", "- stated: 3", "", "## Checker strength (kept rows)", "- (none): 2", "- thin: 1", "", "## Failure reasons", "- a: 2", "- b: 2", "- c: 2", "",
        "## Sources processed", "- s1 (html, 2 chunks): 0 candidates emitted [visual_heavy]", "- s2 (pdf, 3p / 1 chunks): 4 candidates emitted [printed-to-pdf] [scrambled pages: p.2, p.3]", "- s0 (pdf, 0 chunks): 0 candidates emitted", "",
    ]
    assert "## " not in report.manifest(counts, failed.limit(0), kept.limit(0)).split("## Candidate reconciliation")[1]
    said = spark.range(1).select(report.commentary(F.lit("R."), F.lit("q"), F.lit("p.1"), F.lit(""), F.lit(False), F.lit("Capped."), F.lit(None), F.lit("unclear"), F.lit("why"), F.lit("won")).alias("x")).first().x
    assert said == "R. Evidence: q. Locator: p.1. Capped. Checker: unconfirmed (why). Arbiter: won"
    calls = spark.createDataFrame([("f", "O"), ("g", "U"), ("h", "UNCERTAIN")], "firm string, call_view string")
    truth = spark.createDataFrame([("f", "U"), ("g", "U"), ("i", "O")], "firm string, call_view string")
    assert tuple(evaluate.agreement(calls, truth, ["firm"]).first()) == (2, 1, 1, 1, 1, 0)


def test_review_page(spark):
    rows = spark.createDataFrame([(2, "a <b>", "review"), (1, None, None)], "k int, v string, review_flag string")
    page = report.review_page(rows, ["k", "v"], "k", title="R & D")
    assert "<h1>R &amp; D</h1>" in page and page.index("<td>1</td><td></td>") < page.index('<tr class="review"><td>2</td><td>a &lt;b&gt;</td></tr>')
    with pytest.raises(ValueError):
        report.review_page(rows, ["k"], most=1)


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿Id,Title,\n1,"two\nlines ""q""",\n,,x\n', encoding="utf-8")
    read = files.read_csv(spark, str(tmp_path / "a.csv"))
    assert [tuple(r) for r in read.collect()] == [("1", 'two\nlines "q"', ""), ("", "", "x")]
    (tmp_path / "t.csv").write_text("Number,Sub-Asset Class,Asset Class Category,Asset Class,Canva Groupings\n1,Gold,M,A,G\nx,Oil,M,A,G\n2,,M,A,G\n")
    good, bad = files.read_taxonomy(spark, str(tmp_path / "t.csv"))
    assert good.count() == 1 and sorted(r.bad[0] for r in bad.collect()) == ["leaf_no", "sub_asset_class"]
    with pytest.raises(ValueError):
        files.read_taxonomy(spark, str(tmp_path / "a.csv"))
    df = spark.createDataFrame([(2, "b"), (1, 'a "x"')], "k int, v string")
    files.write_csv(df, str(tmp_path / "out"), ["v", "k"], "k")
    assert next((tmp_path / "out").glob("*.csv")).read_text() == 'v,k\n"a ""x""",1\nb,2\n'
    files.write_csv(df.limit(0), str(tmp_path / "none"), ["v", "k"])
    assert next((tmp_path / "none").glob("*.csv")).read_text().strip() == "v,k"

    kept = spark.createDataFrame([tuple("x" * (i + 1) for i in range(len(files.OUTPUT_COLUMNS)))], ", ".join(f"{c} string" for c in files.OUTPUT_COLUMNS))
    files.write_output(kept, str(tmp_path / "kept"), "sub_asset_class")
    assert next((tmp_path / "kept").glob("*.csv")).read_text().split("\n")[0] == "Firm,Date,Source,URL,Sub-Asset Class,Asset Class Category,Canva Groupings,Asset Class,View,Full Commentary,confidence,band,review_flag,basis,checker_strength"

    def fetcher(url):
        if "bad" in url:
            raise OSError("404")
        return "<p>Hi &amp; <b>you</b></p><script>x</script>"

    got = files.fetch(spark.createDataFrame([("ok",), ("bad",)], "u string"), "u", fetcher)
    assert rows_of(got.select("u", files.html_text(F.col("page")).alias("t"), "fetch_error")) == [("bad", None, "404"), ("ok", "Hi & you\n", None)]
    (tmp_path / "n.txt").write_text("one\ntwo")
    assert files.read_notes(spark, str(tmp_path / "n.txt")).first().value == "one\ntwo"


def test_stream(spark, tmp_path):
    schema = spark.createDataFrame([], "k bigint, loaded_at timestamp, code string").schema
    for n, rows in enumerate([[(1, datetime(2026, 1, 1), "a"), (2, datetime(2026, 1, 1), None)], [(1, datetime(2026, 1, 2), "a"), (None, datetime(2026, 1, 2), "b"), (3, datetime(2026, 1, 2), "a")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = intake.first_deliveries(intake.deliveries(spark, str(tmp_path / "in"), schema), "k")
        intake.keep_table(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    kept = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.k for r in kept.collect()) == [1, 2, 3]
    assert rows_of(intake.windowed_counts(kept, "code").select("code", "n")) == [("(none)", 1), ("a", 1), ("a", 1)]


def test_salted_lookup(spark, monkeypatch):
    monkeypatch.setattr(common, "small", lambda df, limit=0, most_bytes=0: False)
    rows = spark.createDataFrame([(i, "hot" if i % 3 else None) for i in range(90)], "i int, k string")
    look = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, v int")
    found = common.salted_lookup(rows, look, "k", F.col("i"), 4)
    assert found.count() == 90 and found.where("v = 1").count() == 60
