"""Score, band and flag of a call, and the ordered gates before it, as plain column arithmetic.

The points and caps are parameters of the data's owner and stand together here. A null attribute earns no points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmill.functions.text import format_number

# Points, caps, floors and bands.
LANGUAGE = {"explicit_dial": 30, "explicit_stance": 26, "directional": 19, "implied": 12, "none": 0}
EVIDENCE, EXACT, SEMANTIC, CALM, CONFLICTING, WELL_READ, ADEQUATE_LESS, CAP = 25, 20, 10, 15, 5, 10, 4, 74
HIGH, MEDIUM = 75, 50
FLOORS = {"bp": 25.0, "pct": 2.0}
QUESTIONS = {"supports_view": "checker_sign_mismatch", "forward_looking": "checker_not_forward_looking", "asset_match": "checker_asset_mismatch"}


def below_materiality(delta: Column, unit: Column) -> Column:
    """The size of a change is under its unit's floor; its sign doesn't matter, none is 0."""
    return F.abs(F.coalesce(delta, F.lit(0.0))) < F.when(unit == "bp", FLOORS["bp"]).otherwise(FLOORS["pct"])


def failed_question() -> Column:
    """The first question that the checker failed, in their fixed order."""
    return F.coalesce(*[F.when(F.col(q) == "fail", code) for q, code in QUESTIONS.items()])


def hard_failure(known_leaf: Column, match: Column, evidence: Column, delta: Column, unit: Column, basis: Column, checked: bool) -> Column:
    """The first gate that stops a call: label (no leaf, or matched to none), evidence, materiality, checker; null where none does."""
    return F.coalesce(
        F.when(~F.coalesce(known_leaf, F.lit(False)) | F.coalesce(match == "none", F.lit(False)), "taxonomy_no_match"), evidence,
        F.when((basis == "forecast_delta") & below_materiality(delta, unit), "delta_below_materiality"), failed_question() if checked else F.lit(None).cast("string"),
    )


def band(score: Column) -> Column:
    return F.when(score >= HIGH, "High").when(score >= MEDIUM, "Medium").otherwise("Low")


def score(df: DataFrame, checked: bool = True) -> DataFrame:
    """Adds confidence, band, review_flag, checker_status, checker_strength, checker_note, cap_reason and call_language_note.

    Reads call_language, evidence_kind, taxonomy_match, conflict, well_read, degraded, basis, call_view and, where
    checked, the three answers and evidence_strength; note, delta_value and delta_unit where they are there. A row
    without a verdict is missing its check, which is capped: has_verdict says which, else a row without any answer.
    """
    dialled = F.coalesce((F.col("call_language") == "explicit_dial") & (F.col("evidence_kind") == "prose"), F.lit(False))
    language = F.when(dialled, "explicit_stance").otherwise(F.col("call_language"))
    points = F.lit(0)
    for name, n in LANGUAGE.items():
        points = F.when(language == name, n).otherwise(points)
    base = points + EVIDENCE + F.when(F.col("taxonomy_match") == "exact", EXACT).otherwise(SEMANTIC)
    base = base + F.when(F.coalesce("conflict", F.lit(False)), CONFLICTING).otherwise(CALM) + F.when(F.coalesce("well_read", F.lit(False)), WELL_READ).otherwise(0)
    given, legacy = F.lit(""), F.lit(False)
    if checked:
        answers = [F.col(q) for q in QUESTIONS]
        missing = ~F.coalesce("has_verdict", F.lit(False)) if "has_verdict" in df.columns else answers[0].isNull() & answers[1].isNull() & answers[2].isNull()
        passed = (answers[0] == "pass") & (answers[1] == "pass") & (answers[2] == "pass")
        status = F.when(missing, "missing").when(F.coalesce(passed, F.lit(False)), "confirmed").otherwise("unclear")
        given = F.coalesce("evidence_strength", F.lit(""))
        legacy = given == ""
    else:
        status = F.lit("off")
    note = F.coalesce("note", F.lit("")) if "note" in df.columns else F.lit("")
    confirmed = status == "confirmed"
    strength = F.when(confirmed, F.when(legacy, "decisive").otherwise(given)).when(status == "unclear", given).otherwise("")
    thin = confirmed & (strength == "thin")
    # What is said of the checker, of a cap and of a downgraded dial.
    checker_note = (
        F.when(status == "missing", "no checker verdict for this candidate").when(status == "unclear", note)
        .when(confirmed & legacy, "checker verdict missing evidence_strength; legacy all-pass treated as decisive").when(thin, "checker evidence_strength is thin; confidence capped below High and review required").otherwise("")
    )
    size = F.abs(F.coalesce("delta_value", F.lit(0.0))) if "delta_value" in df.columns else F.lit(0.0)
    unit = F.coalesce("delta_unit", F.lit("")) if "delta_unit" in df.columns else F.lit("")
    by_basis = (
        F.when(F.col("basis") == "forecast_delta", F.concat(F.lit("Basis: forecast_delta — a house forecast endpoint ("), format_number(size), unit, F.lit(" move) is treated as a provisional view (delta-as-view pending client confirmation); confidence capped below High and review required.")))
        .when(F.col("basis") == "inferred", "Basis: inferred — single-step analyst inference from macro/thematic prose; segregated one band below stated calls, review required.").otherwise("")
    )
    by_strength = F.when(thin, "Checker: evidence_strength thin — quoted evidence supports the view only just; confidence capped below High and review required.").otherwise("")
    cap_reason = F.trim(F.concat_ws(" ", by_basis, by_strength))
    total = base - F.when(confirmed & (strength == "adequate"), ADEQUATE_LESS).otherwise(0)
    capped = F.coalesce("degraded", F.lit(False)) | F.coalesce(F.col("basis").isin("forecast_delta", "inferred"), F.lit(False)) | status.isin("missing", "unclear") | thin
    x = df.withColumns({"_status": status, "_strength": strength, "_note": checker_note, "_cap": cap_reason, "_capped": capped, "confidence": F.when(capped, F.least(total, F.lit(CAP))).otherwise(total).cast("int")})
    doubt = (F.col("confidence") < HIGH) | F.coalesce("conflict", F.lit(False)) | (F.col("call_view") == "UNCERTAIN")
    flag = F.when(F.col("confidence") < MEDIUM, "strong_review").when(F.coalesce(doubt, F.lit(True)) | F.col("_capped"), "review").otherwise("none")
    said = F.when(dialled, "Call language: explicit_dial is accepted only for table/visual evidence; prose evidence scored as explicit_stance.").otherwise("")
    x = x.withColumn("band", band(F.col("confidence"))).withColumn("review_flag", flag).withColumn("call_language_note", said).drop("_capped", "checker_status", "checker_strength", "checker_note", "cap_reason")
    return x.withColumnsRenamed({"_status": "checker_status", "_strength": "checker_strength", "_note": "checker_note", "_cap": "cap_reason"})
