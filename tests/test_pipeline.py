"""The whole way from candidates to rows, on small tables."""

from __future__ import annotations

import pytest
from callmill.operators import pipeline

TEXT = "EM equities are favored in the outlook. We are long gold and copper for the year. " + "Context. " * 30
LEAVES = [(1, "Gold", "Metals", "Alternatives", "G"), (2, "Copper", "Metals", "Alternatives", "G"), (3, "Emerging Equities", "Shares", "Equities", "E"), (4, "Japan Equities", "Shares", "Equities", "E")]
BASE = {
    "source_id": "s1", "chunk_id": "p1-5", "sub_asset_raw": "raw", "sub_asset_class": "Emerging Equities", "taxonomy_match": "exact", "call_view": "O", "call_language": "explicit_stance", "evidence_kind": "prose",
    "evidence_spans": ["EM equities are favored"], "locator": "p.1", "reasoning": "Why.", "conflict": False, "basis": "stated", "delta_value": None, "delta_unit": None,
}
PASS = {"supports_view": "pass", "forward_looking": "pass", "asset_match": "pass", "evidence_strength": "decisive", "note": ""}


@pytest.fixture(scope="module")
def run(spark):
    def go(*changes, verdicts=None, decisions=None, groups=None):
        kinds = "cand_idx bigint, " + ", ".join(f"{k} " + {"evidence_spans": "array<string>", "conflict": "boolean", "delta_value": "double"}.get(k, "string") for k in BASE) + ", firm string, norm_text string"
        rows = spark.createDataFrame([(i, *(BASE | c).values(), "clash", "clash") for i, c in enumerate(changes)], kinds)
        leaves = spark.createDataFrame(LEAVES, "leaf_no int, sub_asset_class string, asset_class_category string, asset_class string, canva_groupings string")
        snapshots = spark.createDataFrame([("s1", TEXT, 1, [2]), ("s2", TEXT, None, None), ("lost", TEXT, 1, None)], "source_id string, snapshot_text string, page_count int, scrambled_pages array<int>")
        chunks = spark.createDataFrame([("s1", "p1-5"), ("s2", "p1-5"), ("lost", "p1-5")], "source_id string, chunk_id string")
        sources = spark.createDataFrame([("s1", 1, "Firm A", "1/1/2026", "Outlook", "http://a"), ("s2", 2, "Firm B", "2/1/2026", "Review", "http://b")], "source_id string, source_ord int, firm string, out_date string, source string, url string")
        given = None if verdicts is None else spark.createDataFrame([(i, *(PASS | v).values()) for i, v in verdicts.items()], "cand_idx bigint, " + ", ".join(f"{k} string" for k in PASS))
        told = None if decisions is None else spark.createDataFrame(decisions, "group_key string, sub_asset_class string, winning_index int, reasoning string")
        together = None if groups is None else spark.createDataFrame(groups, "source_id string, group_id string")
        judged = pipeline.judge(rows, leaves, pipeline.prepared_sources(snapshots), chunks, given, together)
        done = pipeline.assembled(judged, sources, told, together)
        output = {r.cand_idx: r for r in done.output.collect()}
        failures = {r.cand_idx: r for r in done.failures.collect()}
        assert len(output) + len(failures) == len(changes) and not set(output) & set(failures)
        return output, failures

    return go


def test_gates_and_messages(run):
    kept, failed = run(
        {}, {"sub_asset_class": "No Leaf"}, {"taxonomy_match": "none"}, {"evidence_spans": ["never said"]}, {"chunk_id": "p9-9"}, {"source_id": "unknown"}, {"source_id": "lost", "sub_asset_class": "Gold"},
        {"basis": "forecast_delta", "delta_value": -12.5, "delta_unit": "bp", "sub_asset_class": "Copper"}, {"basis": "forecast_delta", "delta_value": 30.0, "delta_unit": "bp", "sub_asset_class": "Japan Equities"}, {"evidence_kind": "table"},
    )
    assert {i: r.reason_code for i, r in failed.items()} == {1: "taxonomy_no_match", 2: "taxonomy_no_match", 3: "quote_not_found", 4: "evidence_check_failed", 5: "evidence_check_failed", 6: "source_metadata_missing", 7: "delta_below_materiality", 9: "visual_locator_missing"} and set(kept) == {0, 8}
    assert failed[1].message == "taxonomy_no_match" and failed[3].message == "prose quote was not found" and failed[4].message == "snapshot text is empty"
    assert failed[7].message == "forecast delta 12.5bp is below the 25bp materiality floor (provisional, pending client confirmation)"
    assert (kept[0].confidence, kept[0].band, kept[0].review_flag, kept[0].checker_strength, kept[0].firm, kept[0].asset_class) == (96, "High", "none", "", "Firm A", "Equities")
    assert kept[0].full_commentary == "Why. Evidence: EM equities are favored. Locator: p.1."
    assert failed[3].evidence_quote == "never said"


def test_basis_and_scrambled(run):
    kept, _ = run({"basis": "forecast_delta", "delta_value": 30.0, "delta_unit": "bp"}, {"sub_asset_class": "Gold", "locator": "p.2", "evidence_spans": ["gold copper long"], "basis": "inferred"}, {"call_language": "explicit_dial", "sub_asset_class": "Copper", "evidence_spans": ["We are long gold and copper"]})
    assert kept[0].confidence == 74 and "(30bp move)" in kept[0].full_commentary and kept[0].review_flag == "review"
    assert kept[1].confidence == 74 and "degraded to key-token overlap (confidence capped, review required). Basis: inferred" in kept[1].full_commentary
    assert kept[2].confidence == 96 and kept[2].full_commentary.endswith("prose evidence scored as explicit_stance.")


def test_checker(run):
    leaves = ["Gold", "Copper", "Emerging Equities", "Japan Equities"]
    spans = [["long gold"], ["gold and copper"], ["EM equities are favored"], ["favored in the outlook"]]
    changes = [{"sub_asset_class": leaf, "evidence_spans": s} for leaf, s in zip(leaves, spans)]
    kept, failed = run(*changes, verdicts={0: {"evidence_strength": "adequate"}, 1: {"asset_match": "unclear", "note": "metal?"}, 2: {"supports_view": "fail", "asset_match": "fail", "note": "no call"}})
    assert (kept[0].confidence, kept[0].checker_strength) == (92, "adequate")
    assert kept[1].confidence == 74 and kept[1].full_commentary.endswith(" Checker: unconfirmed (metal?).")
    assert kept[3].confidence == 74 and kept[3].full_commentary.endswith(" Checker: not run.")
    assert (failed[2].reason_code, failed[2].message, failed[2].checker_strength) == ("checker_sign_mismatch", "no call", "decisive")
    kept, _ = run({}, verdicts={0: {"evidence_strength": ""}})
    assert kept[0].confidence == 96 and kept[0].checker_strength == "decisive" and "legacy all-pass treated as decisive." in kept[0].full_commentary
    kept, _ = run({}, verdicts={0: {"evidence_strength": "thin"}})
    assert kept[0].confidence == 74 and kept[0].review_flag == "review" and "supports the view only just" in kept[0].full_commentary


def test_conflicts(run):
    kept, failed = run({}, {"call_view": "U"})
    assert not kept and {r.message for r in failed.values()} == {"multiple views survived validation for the same source/group and leaf"} and {r.reason_code for r in failed.values()} == {"unresolved_conflict"}
    kept, failed = run({}, {"call_view": "U"}, decisions=[("s1", "Emerging Equities", None, "cannot tell")])
    assert not kept and failed[0].message.endswith("; arbiter: cannot tell")
    kept, failed = run({}, {"call_view": "U"}, decisions=[("s1", "Emerging Equities", 1, "newer")])
    assert kept[1].review_flag == "review" and kept[1].full_commentary.endswith(" Arbiter: newer") and (failed[0].reason_code, failed[0].message) == ("arbitrated_out", "newer")


def test_companions(run):
    kept, failed = run({}, {"source_id": "s2", "call_language": "explicit_dial", "locator": "p.3"}, {"locator": "p.9"}, groups=[("s1", "group-1"), ("s2", "group-1")])
    assert set(kept) == {0} and {r.message for r in failed.values()} == {"same view already kept from p.1"}
    assert kept[0].source == "Outlook | Review" and kept[0].out_date == "1/1/2026 | 2/1/2026" and kept[0].firm == "Firm A"
    assert kept[0].full_commentary == "Why. Evidence: EM equities are favored. Locator: p.1 (Outlook). Corroborated by companion source: Review (p.3)."
    kept, _ = run({}, groups=[("s1", "group-1")])
    assert kept[0].source == "Outlook" and "(Outlook)" not in kept[0].full_commentary


def test_cross_leaf(run):
    same = {"evidence_spans": ["We are long gold and copper"]}
    kept, failed = run(same | {"sub_asset_class": "Gold"}, same | {"sub_asset_class": "Japan Equities"}, same | {"sub_asset_class": "Copper"})
    assert set(kept) == {0, 2} and "kept leaf 'Gold', 'Copper';" in failed[1].message
    same = {"evidence_spans": ["favored in the outlook"]}
    kept, failed = run(same | {"sub_asset_class": "Japan Equities"}, same | {"sub_asset_class": "Gold"})
    assert set(kept) == {1} and "kept leaf 'Gold';" in failed[0].message


def test_nothing(run, spark):
    kept, failed = run({"sub_asset_class": None, "evidence_spans": None, "locator": None, "reasoning": None, "call_view": None, "taxonomy_match": None, "basis": None, "evidence_kind": None, "call_language": None, "source_id": None})
    assert failed[0].reason_code == "taxonomy_no_match" and failed[0].locator == ""
