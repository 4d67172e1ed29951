"""Rules that are easily misread, each with the values that it must give."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.sql import functions as F

from callmill import common
from callmill.operators import assemble, contracts, evidence, layout, scoring

GOOD = {"source_id": "s", "chunk_id": "p1-5", "sub_asset_class": "Gold", "taxonomy_match": "exact", "view": "O", "call_language": "implied", "evidence_kind": "prose", "evidence_quote": "q", "locator": "p.1", "reasoning": "r"}
VERDICT = {"index": 0, "supports_view": "pass", "forward_looking": "pass", "asset_match": "pass"}


@pytest.mark.parametrize(
    ("change", "error", "message"),
    [
        ({}, [], None), ({"basis": None}, [], None), ({"conflict": None}, ["conflict"], "conflict must be a boolean"), ({"chunk_id": " "}, ["chunk_id"], "chunk_id must be a non-empty string"),
        ({"source_id": ...}, ["missing_fields", "source_id"], "candidate missing required fields: source_id"), ({"source_id": ..., "view": ...}, ["missing_fields", "source_id", "view"], "candidate missing required fields: source_id, view"),
        ({"locator": None}, ["locator"], "locator must be a non-empty string"), ({"view": "X"}, ["view"], "view must be one of O, N, U, UNCERTAIN"), ({"view": ""}, ["view"], "view must be a non-empty string"),
        ({"basis": "guessed", "view": "X"}, ["basis", "view"], "basis must be one of stated, forecast_delta, inferred"), ({"basis": "forecast_delta", "delta_value": 1}, ["delta_fields", "delta_unit"], "forecast_delta candidate requires delta_unit"),
        ({"basis": "forecast_delta", "delta_value": True, "delta_unit": "bp"}, ["delta_value"], "delta_value must be a number"), ({"basis": "forecast_delta", "delta_value": 1, "delta_unit": "percent"}, ["delta_unit"], "delta_unit must be one of bp, pct"),
        ({"evidence_quote": []}, ["evidence_quote"], "evidence_quote must not be an empty list"), ({"evidence_quote": ["a", 1]}, ["evidence_quote"], "evidence_quote spans must each be a non-empty string"), ({"evidence_quote": 5}, ["evidence_quote"], "evidence_quote must be a string or a list of strings"),
        ({"evidence_quote": ["a", " "]}, ["evidence_quote"], "evidence_quote spans must each be a non-empty string"), ({"call_language": "loud"}, ["call_language"], "call_language must be one of explicit_dial, explicit_stance, directional, implied, none"),
    ],
)
def test_candidate(spark, change, error, message):
    given = {k: v for k, v in (GOOD | change).items() if v is not ...}
    r = contracts.candidates(spark.createDataFrame([(json.dumps(given),)], "j string"), "j").first()
    assert (r.errors, r.message) == (error, message)
    if not error:
        assert r.basis == "stated" and r.conflict is False and r.sub_asset_raw == "" and r.evidence_spans == ["q"]


def test_candidate_round_trip(spark):
    for given in (GOOD | {"sub_asset_raw": "g"}, GOOD | {"sub_asset_raw": "", "evidence_quote": ["a", "b"], "conflict": True, "basis": "forecast_delta", "delta_value": 2.5, "delta_unit": "pct"}):
        x = contracts.candidates(spark.createDataFrame([(json.dumps(given),)], "j string"), "j").select(contracts.to_json().alias("x")).first().x
        assert json.loads(x) == {"basis": "stated", "conflict": False} | given


@pytest.mark.parametrize(("change", "errors", "strength"), [({}, [], ""), ({"evidence_strength": None}, [], ""), ({"evidence_strength": ""}, ["evidence_strength"], ""), ({"evidence_strength": "thin"}, [], "thin"), ({"evidence_strength": 1}, ["evidence_strength"], None)])
def test_verdict(spark, change, errors, strength):
    r = contracts.verdicts(spark.createDataFrame([(json.dumps(VERDICT | change),)], "j string"), "j").first()
    assert r.errors == errors and r.evidence_strength == strength and r.note == ""


def test_envelopes(spark):
    said = lambda *texts: spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, j string")
    found = contracts.arbitration(said('{"winning_index": 1, "reasoning": "r"}', '{"reasoning": "r"}', '{"winning_index": null, "reasoning": " "}', '{"winning_index": true, "reasoning": "r"}', "[]"), "j").orderBy("i").collect()
    assert [(r.winning_index, r.error is None) for r in found] == [(1, True), (None, True), (None, False), (None, False), (None, False)]
    found = contracts.group_plan(said('{"groups": [{"source_ids": ["a", "b"], "note": "n"}], "unmatched_notes": ["x"]}', '{"groups": [{"source_ids": ["a"]}]}', '{"groups": []}', '{"groups": 1}', '{"groups": [], "unmatched_notes": [1]}'), "j").orderBy("i").collect()
    assert [r.error is None for r in found] == [True, False, True, False, False]
    assert found[0].groups[0].source_ids == ["a", "b"] and found[0].unmatched_notes == ["x"] and found[2].unmatched_notes == []
    found = contracts.list_response(said('{"candidates": [], "summary": "s"}', '{"candidates": {}}', "x", '{"candidates": [], "summary": 1}'), "j", "candidates").orderBy("i").collect()
    assert [r.envelope_error for r in found] == [None, "response must include a candidates list", "response must be a JSON object", "response summary must be a string"] and found[0].summary == "s"


@pytest.mark.parametrize(
    ("text", "quote", "kind", "chunk", "reason", "message"),
    [
        ("We stay conﬁdent on copper", "confident on copper", "prose", "p1-1", None, None), ("We stay confident on copper", "conﬁdent on copper", "prose", "p1-1", None, None),
        ("We stay confident", "We stay confident", "prose", "p9-9", "evidence_check_failed", "snapshot text is empty"), ("alpha beta gamma delta, epsilon zeta eta theta", "alpha beta gamma delta ...  ... epsilon zeta eta theta", "prose", "p1-1", "quote_not_found", "a prose quote span is too short to verify"),
        ("they were there", "were was the", "table", "p1-1", "evidence_check_failed", "table/visual evidence is empty"), ("they has it", "has were", "table", "p1-1", None, None),
        ("one two", "two one", "prose", "p1-1", "quote_not_found", "prose quote was not found"),
    ],
)
def test_evidence(spark, text, quote, kind, chunk, reason, message):
    sources = evidence.prepared(spark.createDataFrame([("s", text, [])], "source_id string, snapshot_text string, scrambled_pages array<int>"), "snapshot_text")
    rows = spark.createDataFrame([(1, "s", chunk, quote, kind, "p.1 - table")], "k int, source_id string, chunk_id string, evidence_quote string, evidence_kind string, locator string")
    r = evidence.check(rows, sources, "k", spark.createDataFrame([("s", "p1-1"), (None, "p9-9")], "source_id string, chunk_id string")).first()
    assert (r.ev_reason, r.ev_message) == (reason, message)


def test_label_matched_to_none(spark):
    df = spark.createDataFrame([("none",), ("exact",), (None,)], "m string")
    found = df.select(scoring.hard_failure(F.lit(True), F.col("m"), F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit("bp"), F.lit("stated"), False).alias("r")).collect()
    assert [r.r for r in found] == ["taxonomy_no_match", None, None]


def test_leaf_named_after_normalising(spark):
    """A hyphen inside a word joins it: "high-yield" names neither "high" nor a short "AI"."""
    rows = spark.createDataFrame([(1, "s", "O", ["high-yield spreads"], "High Yield Debt", 5), (2, "s", "O", ["high-yield spreads"], "Oil", 9), (3, "s", "U", ["AI-related stocks"], "AI", 1), (4, "s", "U", ["AI-related stocks"], "Stocks", 2)], "idx int, source string, call_view string, spans array<string>, leaf string, leaf_no int")
    found = {r.idx: (r.reason, r.message) for r in assemble.cross_leaf_duplicates(rows, "source", "call_view", "spans", "leaf", "leaf_no", "idx").collect()}
    about = "same source, view, and evidence as kept leaf '{}'; this leaf is not named in the shared evidence (cross-leaf fan-out)"
    assert found == {1: (None, None), 2: ("duplicate_cross_leaf", about.format("High Yield Debt")), 3: ("duplicate_cross_leaf", about.format("Stocks")), 4: (None, None)}


def scrambled(words, w, h):
    """The detector word by word."""
    body = [x for x in words if 0.10 * h < x[2] < 0.92 * h]
    if len(body) < 20 or w <= 0:
        return False
    y0, y1 = min(x[2] for x in body), max(x[3] for x in body)
    if y1 <= y0:
        return False
    for b in range(30, 70):
        x = (b + 0.5) / 100 * w
        left, right = sum(q[1] < x for q in body), sum(q[0] > x for q in body)
        rows = {min(39, int((q[2] - y0) / (y1 - y0) * 40)) for q in body if not q[1] < x and not q[0] > x}
        if left >= 15 and right >= 15 and len(rows) / 40 <= 0.12:
            return True
    return False


def test_scrambled_against_brute_force(spark):
    r = random.Random(7)
    pages = {}
    for n in range(60):
        gap, count = r.choice((0, 20, 60)), r.choice((15, 40, 90))
        pages[f"p{n}"] = [(x, x + r.choice((30, 90, 150)), y, y + r.choice((5, 60))) for _ in range(count) for x, y in [(r.choice((40, 300 + gap)) + r.random() * 80, r.random() * 842)]]
    df = spark.createDataFrame([(p, *map(float, q), 595.0, 842.0) for p, qs in pages.items() for q in qs], "page_id string, x0 double, x1 double, top double, bottom double, page_width double, page_height double")
    found = {x.page_id: x.scrambled for x in layout.scrambled_pages(df).collect()}
    assert found == {p: scrambled(q, 595.0, 842.0) for p, q in pages.items()} and 0 < sum(found.values()) < 60


def test_group_index_over_blocks(spark):
    rows = spark.range(500).select((F.col("id") % 3).alias("g"), (F.col("id") * 7 % 500).alias("i")).withColumn("g", F.when(F.col("g") > 0, F.col("g")))
    plain = {(x.g, x.i): x.group_idx for x in assemble.group_index(rows, ["g"], "i").collect()}
    assert plain == {(x.g, x.i): x.group_idx for x in assemble.group_index(rows, ["g"], "i", 20).collect()} and len(plain) == 500
    assert sorted(n for (g, _), n in plain.items() if g is None) == list(range(167))


def test_storage(spark):
    before = common.stored(spark.range(3), "kept")
    assert before.count() == 3 and spark.conf.get(common.CLEANUP) is not None
    assert common.small(spark.range(10)) and not common.small(spark.range(10), 9)
    wide = spark.range(3).select(F.repeat(F.lit("x"), 1000).alias("t"))
    assert common.small(wide) and not common.small(wide, most_bytes=2000)
    assert common.release(spark) >= 1
