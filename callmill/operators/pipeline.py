"""From checked observations to reviewable rows: gates and score, groups, decisions, duplicates, display, commentary.

Every step is a table of few columns keyed by the candidate's place (cand_idx); texts are joined in once, at the end.
Groups and leaves are never gathered: winners come from aggregates, and only conflicting groups are numbered.

Defined results: null fields count as empty texts; a candidate of an unknown source, or of an unknown chunk, fails with a
reason of its own; equal candidates are duplicates of the first; no candidates give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmill.common import broadcast_if_small, join_same, once, stored
from callmill.functions.text import format_number
from callmill.operators import assemble, evidence, ingest, report, scoring, taxonomy

GROUP = ["group_key", "sub_asset_class"]
#: What a failed candidate is reported with.
SHOWN = ("source_id", "chunk_id", "sub_asset_raw", "sub_asset_class", "call_view", "taxonomy_match", "evidence_kind", "evidence_quote", "locator", "reasoning", "basis")


@dataclass(frozen=True)
class Assembled:
    """output: the kept rows with cand_idx and row_ord; failures: with phase (0 gates, 1 groups, 2 leaves) and cand_idx."""

    output: DataFrame
    failures: DataFrame


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def prepared_sources(snapshots: DataFrame) -> DataFrame:
    """snapshots(source_id, snapshot_text, page_count, scrambled_pages) with what the gates read of each."""
    ready = evidence.prepared(snapshots, "snapshot_text")
    read = F.coalesce(ingest.read_quality(F.col("snapshot_text"), F.col("page_count")), F.lit(False))
    return ready.withColumn("well_read", read).drop("snapshot_text")


def judge(candidates: DataFrame, leaves: DataFrame, sources: DataFrame, chunks: DataFrame, verdicts: DataFrame | None = None, groups: DataFrame | None = None) -> DataFrame:
    """candidates with reason and message (null where a call passes all gates), its score and notes, and its group; stored.

    sources as prepared_sources gives them; verdicts(cand_idx, three answers, evidence_strength, note), None where no
    checker is in play; groups(source_id, group_id), None where no sources belong together.
    """
    x = candidates.withColumn("evidence_quote", evidence.quote_of(F.col("evidence_spans")))
    x = evidence.check(x, sources, "cand_idx", chunks, F.col("evidence_spans"))
    quality = sources.select("source_id", F.col("well_read"))
    x = x.drop("well_read").join(broadcast_if_small(quality), "source_id", "left")
    # a candidate of an unknown chunk has failed already, so the quality is that of a text that was read
    x = taxonomy.lookup(x, leaves, "sub_asset_class")
    if verdicts is not None:
        given = once(verdicts.select("cand_idx", *scoring.QUESTIONS, "evidence_strength", "note"), "cand_idx").withColumn("has_verdict", F.lit(True))
        x = x.drop(*scoring.QUESTIONS, "evidence_strength", "note", "has_verdict").join(given, "cand_idx", "left")
    x = scoring.score(x, verdicts is not None)
    checked = verdicts is not None
    reason = scoring.hard_failure(F.col("leaf_no").isNotNull(), F.col("taxonomy_match"), F.col("ev_reason"), F.col("delta_value"), F.col("delta_unit"), F.col("basis"), checked)
    x = x.withColumn("reason", reason)
    size, unit = F.abs(F.coalesce("delta_value", F.lit(0.0))), _text("delta_unit")
    floor = F.when(F.col("delta_unit") == "bp", scoring.FLOORS["bp"]).otherwise(scoring.FLOORS["pct"])
    small = F.concat(F.lit("forecast delta "), format_number(size), unit, F.lit(" is below the "), format_number(floor), unit, F.lit(" materiality floor (provisional, pending client confirmation)"))
    said = F.when(F.col("reason") == "delta_below_materiality", small).when(F.col("reason") == F.col("ev_reason"), F.col("ev_message"))
    if checked:
        said = F.when(F.col("reason").isin(*scoring.QUESTIONS.values()), F.nullif(F.col("note"), F.lit(""))).otherwise(said)
    x = x.withColumn("message", F.coalesce(F.when(F.col("reason").isNotNull(), said), "reason"))
    strength = _text("evidence_strength") if checked else F.lit("")
    x = x.withColumn("given_strength", strength)
    x = x.drop("group_id").join(broadcast_if_small(groups.select("source_id", "group_id")), "source_id", "left") if groups is not None else x.withColumn("group_id", F.lit(None).cast("string"))
    return stored(x.withColumn("group_key", F.coalesce("group_id", "source_id")), "judged")


def conflicting(judged: DataFrame) -> DataFrame:
    """The calls in conflict with their place in the group, as an arbiter sees them: without their scores."""
    kept = judged.where("reason is null")
    conflicts = assemble.view_conflicts(kept, GROUP).where("conflict").select(*GROUP)
    fields = ("cand_idx", "source_id", *GROUP, "call_view", "call_language", "evidence_kind", "evidence_quote", "locator", "reasoning", "given_strength")
    return assemble.group_index(join_same(kept.select(*fields), conflicts, GROUP), GROUP, "cand_idx")


def _routed(judged: DataFrame, decisions: DataFrame | None, titles: DataFrame) -> DataFrame:
    """cand_idx, group_ord, reason, message, arbiter_note, corroboration of the calls that passed the gates."""
    spark = judged.sparkSession
    kept = judged.where("reason is null").select("cand_idx", *GROUP, "call_view", "confidence", "source_id", "locator")
    groups = kept.groupBy(*GROUP).agg(F.min("cand_idx").alias("group_ord"), (F.min("call_view") != F.max("call_view")).alias("conflict"))
    placed = stored(join_same(kept, groups, GROUP), "placed")
    none = F.lit("")
    if decisions is None:
        decisions = spark.createDataFrame([], "group_key string, sub_asset_class string, winning_index int, reasoning string")
    decided = assemble.arbitrate(placed.where("conflict"), GROUP, decisions, "cand_idx")
    why = F.coalesce("reasoning", none)
    open_message = F.concat(F.lit("multiple views survived validation for the same source/group and leaf"), F.when(why != "", F.concat(F.lit("; arbiter: "), why)).otherwise(none))
    message = F.when(F.col("reason") == "unresolved_conflict", open_message).when(F.col("reason") == "arbitrated_out", why)
    apart = decided.select("cand_idx", "group_ord", "reason", message.alias("message"), F.when(F.col("reason").isNull(), why).otherwise(none).alias("arbiter_note"), none.alias("corroboration"))
    agreeing = placed.where("not conflict").join(broadcast_if_small(titles), "source_id", "left")
    routed = assemble.route_same_view(agreeing, GROUP, "confidence", "cand_idx")
    winners = routed.where("reason is null").select(F.col("cand_idx").alias("winner_idx"), F.col("locator").alias("_kept_at"))
    noted = assemble.corroboration(agreeing, GROUP, "confidence", "cand_idx", "source_id", "title", "locator").where("corroboration <> ''").select(F.col("winner_idx").alias("cand_idx"), F.concat(F.lit("Corroborated by companion source: "), "corroboration", F.lit(".")).alias("corroboration"))
    same = routed.join(winners, "winner_idx").join(noted, "cand_idx", "left")
    same = same.select("cand_idx", "group_ord", "reason", F.when(F.col("reason").isNotNull(), F.concat(F.lit("same view already kept from "), _text("_kept_at"))).alias("message"), none.alias("arbiter_note"), F.coalesce("corroboration", none).alias("corroboration"))
    return stored(apart.unionByName(same), "routed")


def displayed(sources: DataFrame, groups: DataFrame | None) -> DataFrame:
    """source_id with the identity its rows show: its own, or that of its group where that has two or more members.

    sources(source_id, source_ord, firm, out_date, source, url), unique by source. A group's members are few by contract.
    """
    own = sources.select("source_id", "source_ord", *[_text(c).alias(c) for c in ("firm", "out_date", "source", "url")])
    if groups is None:
        return own.select("source_id", F.col("source_id").alias("shown_id"), "firm", "out_date", "source", "url", F.lit(1).alias("members"), F.lit("").alias("own_title"))
    member = own.join(broadcast_if_small(groups.select("source_id", "group_id")), "source_id", "left")
    listed = F.array_sort(F.collect_list(F.struct("source_ord", "firm", "out_date", "source", "url")))
    many = member.where("group_id is not null").groupBy("group_id").agg(listed.alias("_m")).where(F.size("_m") > 1)
    joined = lambda f: F.array_join(F.transform("_m", lambda m: m[f]), " | ")
    whole = many.select("group_id", F.size("_m").alias("_n"), F.col("_m")[0]["firm"].alias("_firm"), joined("out_date").alias("_date"), joined("source").alias("_source"), joined("url").alias("_url"))
    x = member.join(whole, "group_id", "left")
    grouped = F.col("_n").isNotNull()
    pick = lambda a, b: F.when(grouped, F.col(a)).otherwise(F.col(b))
    return x.select(
        "source_id", pick("group_id", "source_id").alias("shown_id"), pick("_firm", "firm").alias("firm"), pick("_date", "out_date").alias("out_date"), F.when(grouped, F.col("_source")).otherwise(F.col("source")).alias("source"),
        pick("_url", "url").alias("url"), F.coalesce("_n", F.lit(1)).alias("members"), F.when(grouped, F.col("source")).otherwise("").alias("own_title"),
    )


def assembled(judged: DataFrame, sources: DataFrame, decisions: DataFrame | None = None, groups: DataFrame | None = None) -> Assembled:
    """What is kept and what fails, of the judged candidates; every candidate is in one of both."""
    routed = _routed(judged, decisions, sources.select("source_id", F.col("source").alias("title")))
    shown = displayed(sources, groups)
    winners = routed.where("reason is null").join(judged.select("cand_idx", "source_id", "call_view", "evidence_spans", "sub_asset_class", "leaf_no"), "cand_idx")
    known = shown.select("source_id", F.lit(True).alias("_known"))
    placed = stored(winners.drop("reason", "message").join(broadcast_if_small(known), "source_id", "left"), "winners")
    lost = placed.where("_known is null").select("cand_idx", "group_ord", F.lit("source_metadata_missing").alias("reason"), F.lit("source metadata was not available for this candidate").alias("message"))
    parted = stored(assemble.cross_leaf_duplicates(placed.where("_known").drop("_known"), "source_id", "call_view", "evidence_spans", "sub_asset_class", "leaf_no", "group_ord"), "parted")
    narrow = ("cand_idx", "group_ord", "reason", "message")
    failed = (
        judged.where("reason is not null").select(F.lit(0).alias("phase"), F.col("cand_idx").alias("group_ord"), "cand_idx", "reason", "message", F.col("given_strength").alias("checker_strength"))
        .unionByName(routed.where("reason is not null").select(F.lit(1).alias("phase"), *narrow, F.lit("").alias("checker_strength")))
        .unionByName(lost.select(F.lit(1).alias("phase"), *narrow, F.lit("").alias("checker_strength")))
        .unionByName(parted.where("reason is not null").select(F.lit(2).alias("phase"), *narrow, F.lit("").alias("checker_strength")))
    )
    failures = failed.withColumnRenamed("reason", "reason_code").join(judged.select("cand_idx", *[_text(c).alias(c) for c in SHOWN]), "cand_idx")
    survivors = parted.where("reason is null").select("cand_idx", "group_ord", "arbiter_note", "corroboration")
    rows = judged.drop("firm", "out_date", "source", "url", "members", "own_title", "shown_id", "group_ord", "arbiter_note", "corroboration").join(survivors, "cand_idx").join(broadcast_if_small(shown), "source_id")
    where = F.when(F.col("members") > 1, F.concat(_text("locator"), F.lit(" ("), "own_title", F.lit(")"))).otherwise(_text("locator"))
    flag = F.when((F.col("arbiter_note") != "") & (F.col("review_flag") == "none"), "review").otherwise(F.col("review_flag"))
    commentary = report.commentary(
        _text("reasoning"), F.col("evidence_quote"), where, F.col("corroboration"), F.col("degraded"), F.col("cap_reason"), F.col("call_language_note"), F.col("checker_status"), F.col("checker_note"), F.col("arbiter_note")
    )
    output = rows.select(
        "cand_idx", F.col("group_ord").alias("row_ord"), "firm", "out_date", "source", "url", "sub_asset_class", "asset_class_category", "canva_groupings", "asset_class", "call_view", commentary.alias("full_commentary"),
        "confidence", "band", flag.alias("review_flag"), F.coalesce("basis", F.lit("stated")).alias("basis"), "checker_strength",
    )
    return Assembled(output, failures)
