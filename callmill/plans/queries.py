"""The core's queries over the tables, each a function of (spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.common import once, read, stored
from callmill.functions import text as T
from callmill.operators import assemble, contracts, engines, evaluate, evidence, ingest, instants, layout, pipeline, report, scoring, taxonomy

LANGUAGES = ("explicit_dial", "explicit_stance", "directional", "implied", "none")
#: Ids of calls that one part of a recorded reading covers.
PART_IDS = 1000


def _targets(spark, d):
    return once(read(spark, d, "target_list").drop("loaded_at"), "list_row")


def _snapshots(spark, d, *columns):
    return once(read(spark, d, "snapshots").select("source_id", *columns).where("source_id is not null"), "source_id")


def _chunks(spark, d):
    return once(read(spark, d, "chunks").drop("loaded_at", "fetched_at"), "source_id", "chunk_id")


def _failures(spark, d, *columns):
    return once(read(spark, d, "failures").select("failure_id", *columns), "failure_id")


def _calls(spark, d, *columns):
    return once(read(spark, d, "output_calls").select("call_id", *columns), "call_id")


def source_urls(spark: SparkSession, d: str) -> DataFrame:
    return ingest.target_sources(_targets(spark, d)).select("list_row", "source_id", "resolved_url", "source_type")


def firm_keys(spark, d):
    rows = _targets(spark, d)
    return rows.groupBy(T.lookup_key(F.col("firm")).alias("firm_key")).agg(F.count("*").alias("n"))


def visual_pages(spark, d):
    rows = _snapshots(spark, d, "visual_markup")
    return rows.select("source_id", F.coalesce(T.visual_heavy(F.col("visual_markup")), F.lit(False)).alias("visual_heavy"))


def made_chunks(spark, d):
    return ingest.make_chunks(_snapshots(spark, d, "page_count", "snapshot_text"))


def chunk_lengths(spark, d):
    texts = _snapshots(spark, d, "snapshot_text")
    sliced = _chunks(spark, d).join(texts, "source_id").withColumn("t", ingest.chunk_slice(F.col("snapshot_text"), F.col("chunk_id")))
    return sliced.select("source_id", "chunk_id", F.length("t").alias("n_chars"), F.md5("t").alias("digest"))


def source_batches(spark, d):
    return ingest.batches(_targets(spark, d).select("list_row"), "list_row")


def read_quality(spark, d):
    rows = _snapshots(spark, d, "snapshot_text", "page_count")
    return rows.select("source_id", F.coalesce(ingest.read_quality(F.col("snapshot_text"), F.col("page_count")), F.lit(False)).alias("well_read"))


def normalized_quotes(spark, d):
    return _failures(spark, d, "evidence_quote").select("failure_id", T.normalize_quote(F.col("evidence_quote")).alias("quote"))


def nfkc_texts(spark, d):
    """Snapshot texts normalised: they hold characters that composition changes."""
    rows = _snapshots(spark, d, "snapshot_text")
    return rows.select("source_id", F.md5(T.normalize_quote(F.coalesce("snapshot_text", F.lit("")))).alias("digest"))


def quote_tokens(spark, d):
    tokens = T.meaningful_tokens(F.col("evidence_quote"))
    return _failures(spark, d, "evidence_quote").select("failure_id", F.size(tokens).alias("n"), F.array_join(tokens, " ").alias("tokens"))


def verbatim_evidence(spark, d):
    sources = evidence.prepared(_snapshots(spark, d, "snapshot_text", "scrambled_pages"), "snapshot_text").select("source_id", "norm_text")
    rows = _failures(spark, d, "source_id", "evidence_quote")
    ready = evidence.with_spans(rows, evidence.spans_of(F.col("evidence_quote")))
    joined = evidence.salted_lookup(ready, sources, "source_id", F.col("failure_id"), salts=1, broadcast_rows=0)
    reason = evidence.verbatim(F.coalesce("norm_text", F.lit("")))
    return joined.select("failure_id", F.coalesce(reason, F.lit("found")).alias("result"))


def evidence_check(spark, d):
    sources = evidence.prepared(_snapshots(spark, d, "snapshot_text", "scrambled_pages"), "snapshot_text")
    rows = _failures(spark, d, "source_id", "chunk_id", "evidence_quote", "evidence_kind", "locator")
    found = evidence.check(rows, sources, "failure_id", _chunks(spark, d))
    return found.select("failure_id", "ev_passed", F.coalesce("ev_reason", F.lit("")).alias("ev_reason"), F.coalesce("ev_message", F.lit("")).alias("ev_message"), "degraded")


def locator_parse(spark, d):
    rows = _failures(spark, d, "locator")
    return rows.select("failure_id", T.cited_page(F.col("locator")).alias("page"), T.visual_locator(F.col("locator")).alias("specific"))


def taxonomy_lookup(spark, d):
    found = taxonomy.lookup(_failures(spark, d, "sub_asset_class"), read(spark, d, "taxonomy"), "sub_asset_class")
    return found.select("failure_id", "leaf_no", "asset_class_category", "asset_class", "canva_groupings")


def unknown_labels(spark, d):
    return taxonomy.unknown_labels(_failures(spark, d, "sub_asset_class"), read(spark, d, "taxonomy"), "sub_asset_class")


def taxonomy_integrity(spark, d):
    return taxonomy.integrity(read(spark, d, "taxonomy"))


def taxonomy_outline(spark, d):
    return taxonomy.outline(read(spark, d, "taxonomy"))


def failure_reason_counts(spark, d):
    rows = _failures(spark, d, "reason_code", "chunk_id")
    return report.failure_counts(rows.where("coalesce(chunk_id, '') <> 'checker'"), rows.where("chunk_id = 'checker'"))


def basis_counts(spark, d):
    return report.labelled_counts(_calls(spark, d, "basis"), "basis", "stated")


def strength_counts(spark, d):
    return report.labelled_counts(_calls(spark, d, "checker_strength"), "checker_strength", "(none)")


def reconciliation(spark, d):
    routed = assemble.route_same_view(_calls(spark, d, "firm", "sub_asset_class", "call_view", "confidence"), ["firm", "sub_asset_class", "call_view"], "confidence", "call_id")
    return report.reconciliation(routed, routed.where("reason is null"), routed.where("reason is not null"))


def source_summary(spark, d):
    sources = _snapshots(spark, d, "page_count", "visual_heavy", "printed_pdf", "scrambled_pages")
    return report.source_summary(sources, _chunks(spark, d), _failures(spark, d, "source_id"))


def view_conflicts(spark, d):
    x = assemble.view_conflicts(_calls(spark, d, "firm", "sub_asset_class", "call_view"), ["firm", "sub_asset_class"])
    return x.select("firm", "sub_asset_class", F.array_join("views", ",").alias("views"), "members", "conflict")


def same_view_dedup(spark, d):
    keys = ["firm", "sub_asset_class", "call_view"]
    x = assemble.route_same_view(_calls(spark, d, *keys, "confidence"), keys, "confidence", "call_id")
    return x.select("call_id", "winner_idx", F.coalesce("reason", F.lit("")).alias("reason"))


def arbitration(spark, d):
    """Decisions for the check: a group's first decisive member, none where it has none."""
    keys = ["firm", "sub_asset_class"]
    rows = _calls(spark, d, *keys, "call_view", "checker_strength")
    placed = assemble.group_index(rows, keys, "call_id")
    decisions = placed.groupBy(*keys).agg(F.min(F.when(F.col("checker_strength") == "decisive", F.col("group_idx"))).alias("winning_index"), F.lit("first decisive").alias("reasoning"))
    x = assemble.arbitrate(rows, keys, decisions, "call_id")
    return x.select("call_id", "group_idx", F.coalesce("reason", F.lit("")).alias("reason"))


def corroboration(spark, d):
    keys = ["sub_asset_class", "call_view", "out_date"]
    rows = _calls(spark, d, *keys, "confidence", "firm", "source", "band")
    x = assemble.corroboration(rows, keys, "confidence", "call_id", "firm", "source", "band")
    return x.select("winner_idx", "corroboration")


def cross_leaf_dedup(spark, d):
    rows = taxonomy.lookup(_failures(spark, d, "source_id", "call_view", "evidence_quote", "sub_asset_class"), read(spark, d, "taxonomy"), "sub_asset_class")
    rows = rows.withColumn("spans", evidence.spans_of(F.coalesce("evidence_quote", F.lit(""))))
    x = assemble.cross_leaf_duplicates(rows, "source_id", "call_view", "spans", "sub_asset_class", "leaf_no", "failure_id")
    return x.select("failure_id", F.coalesce("reason", F.lit("")).alias("reason"), F.coalesce("message", F.lit("")).alias("message"))


def _memory_blocks(spark, d):
    """What each chunk leaves: the failures of it as its calls, its locator as its summary; a chunk with a failed reading is skipped."""
    calls = _failures(spark, d, "source_id", "chunk_id", "sub_asset_class", "call_view", "locator", "reason_code")
    listed = F.array_sort(F.collect_list(F.struct("failure_id", F.col("sub_asset_class").alias("leaf"), "call_view", "locator")))
    lost = F.min(F.when(F.col("reason_code").isin("json_parse_error", "engine_error"), F.col("reason_code")))
    left = calls.groupBy("source_id", "chunk_id").agg(listed.alias("ledger"), lost.alias("lost"))
    rows = _chunks(spark, d).join(left, ["source_id", "chunk_id"], "left")
    block = engines.memory_block(F.col("chunk_id"), F.col("locator"), F.coalesce("ledger", F.array().cast("array<struct<failure_id:bigint,leaf:string,call_view:string,locator:string>>")), F.col("lost"))
    sources, groups = _source_infos(spark, d)
    headed = rows.withColumn("block", block).join(sources, "source_id", "left")
    return headed.select("source_id", "source_ord", "chunk_ord", "chunk_id", "block", engines.memory_header(F.col("firm"), F.col("source"), F.col("source_id")).alias("head")), groups


def rolling_memory(spark, d):
    blocks, _ = _memory_blocks(spark, d)
    return assemble.rolling_memory(blocks, ["source_id"], "chunk_ord", "block", "head").select("source_id", "chunk_id", F.length("memory").alias("n_chars"), F.md5("memory").alias("digest"))


def companion_memory(spark, d):
    blocks, groups = _memory_blocks(spark, d)
    found = assemble.companion_memory(blocks, groups, "source_ord", "chunk_ord", "block", "head", engines.COMPANION)
    return found.select("source_id", "chunk_id", "group_key", F.length("memory").alias("n_chars"), F.md5("memory").alias("digest"))


def prompt_contents(spark, d):
    """What a reader is told of each chunk."""
    texts = _snapshots(spark, d, "snapshot_text", "source_type", "printed_pdf", "resolved_url", "snapshot_text_path")
    said = ingest.chunk_content(F.col("chunk_id"), F.coalesce("locator", F.lit("")), F.col("snapshot_text"), F.col("snapshot_text_path"), F.col("resolved_url"), F.col("source_type") == "pdf", F.col("printed_pdf"))
    return _chunks(spark, d).join(texts, "source_id").select("source_id", "chunk_id", F.md5(said).alias("digest"))


def _answers():
    answer = lambda code, doubt="": F.when(F.col("reason_code") == code, "fail").when(F.col("reason_code") == doubt, "unclear").otherwise("pass")
    return answer("checker_sign_mismatch", "unresolved_conflict").alias("supports_view"), answer("checker_not_forward_looking").alias("forward_looking"), answer("checker_asset_mismatch").alias("asset_match")


def _checked(spark, d):
    """Recorded answers of a checker, one for each source; that of a source with a checker_error is no JSON."""
    rows = _failures(spark, d, "source_id", "reason_code", "checker_strength", "message").withColumnRenamed("failure_id", "cand_idx")
    placed = assemble.group_index(rows, ["source_id"], "cand_idx")
    one = F.struct(F.col("group_idx").alias("index"), *_answers(), F.nullif("checker_strength", F.lit("")).alias("evidence_strength"), F.col("message").alias("note"))
    said = placed.groupBy("source_id").agg(F.collect_list(one).alias("verdicts"), F.max(F.col("reason_code") == "checker_error").alias("lost"))
    responses = said.select("source_id", F.when(F.coalesce("lost", F.lit(False)), "no answer").otherwise(F.to_json(F.struct("verdicts"))).alias("response"))
    return engines.checked_verdicts(rows.where("source_id is not null"), responses.where("source_id is not null"))


def checker_verdicts(spark, d):
    return _checked(spark, d)[0]


def checker_failures(spark, d):
    return _checked(spark, d)[1]


def response_outcomes(spark, d):
    """Recorded readings of chunks, parsed by contract: how many calls each gives, or why it fails as a whole.

    A reading is recorded in parts of PART_IDS ids, in their order, so that none is wider than that, however much a chunk gives.
    """
    fields = ("source_id", "chunk_id", "sub_asset_raw", "sub_asset_class", "taxonomy_match", "call_view", "evidence_kind", "evidence_quote", "locator", "reasoning", "basis")
    rows = _failures(spark, d, *fields).where("source_id is not null and chunk_id is not null")
    one = F.struct("failure_id", *[F.col(f).alias("view" if f == "call_view" else f) for f in fields if f != "basis"], F.lit("implied").alias("call_language"), F.when(F.col("basis") != "forecast_delta", F.col("basis")).alias("basis"))
    said = rows.groupBy("source_id", "chunk_id", F.floor(F.col("failure_id") / PART_IDS).alias("part")).agg(F.to_json(F.struct(F.array_sort(F.collect_list(one)).alias("candidates"))).alias("response"))
    kept, lost = engines.responses_to_candidates(said, ["source_id", "chunk_id"], "response", "part")
    good = kept.groupBy(F.col("response_source_id").alias("source_id"), F.col("response_chunk_id").alias("chunk_id")).agg(F.count("*").alias("n")).withColumn("message", F.lit(""))
    return good.unionByName(lost.select("source_id", "chunk_id", F.lit(0).cast("bigint").alias("n"), "message"))


def quote_quality(spark, d):
    return evaluate.quotes(evidence_check(spark, d), "ev_passed")


def leaf_matches(spark, d):
    """Calls that were inferred against those that were stated."""
    rows = _calls(spark, d, "firm", "sub_asset_class", "basis")
    return evaluate.leaf_matches(rows.where("basis = 'inferred'"), rows.where("basis = 'stated'"), "firm", "sub_asset_class")


def displayed_chunks(spark, d):
    return assemble.display_sources(_chunks(spark, d), "source_id", "chunk_ord", "chunk_id", "locator")


def contract_candidates(spark, d):
    rows = _failures(spark, d, "source_id", "sub_asset_raw", "sub_asset_class", "taxonomy_match", "call_view", "evidence_kind", "evidence_quote", "locator", "reasoning", "chunk_id", "basis")
    spoken = F.element_at(F.array(*[F.lit(x) for x in (*LANGUAGES, "explicit", "loud")]), (F.col("failure_id") % 7 + 1).cast("int"))
    delta = F.when(F.col("failure_id") % 3 == 0, F.lit("30")).otherwise(F.lit(None))
    ids = ("source_id", "chunk_id")
    body = F.struct(*ids, "sub_asset_raw", "sub_asset_class", "taxonomy_match", F.col("call_view").alias("view"), spoken.alias("call_language"), "evidence_kind", "evidence_quote", "locator", "reasoning", (F.col("call_view") == "UNCERTAIN").alias("conflict"), "basis", (F.col("failure_id") % 60).alias("delta_value"), F.lit("bp").alias("delta_unit"))
    # every fifth is a forecast whose delta is a text or missing, and says nothing of a conflict
    odd = F.struct(*ids, *[F.col("b")[f] for f in ("sub_asset_class", "taxonomy_match", "view", "call_language", "evidence_kind", "evidence_quote", "locator", "reasoning")], F.lit("forecast_delta").alias("basis"), delta.alias("delta_value"), F.lit("bp").alias("delta_unit"))
    made = rows.withColumn("b", body).select("failure_id", F.when(F.col("failure_id") % 5 == 0, F.to_json(odd)).otherwise(F.to_json("b")).alias("json"))
    x = contracts.candidates(made, "json")
    return x.select("failure_id", F.coalesce(F.try_element_at("errors", F.lit(1)), F.lit("")).alias("error"), F.size("errors").alias("n_errors"), F.coalesce("message", F.lit("")).alias("message"))


def contract_verdicts(spark, d):
    """Events as verdicts; the strength is that of an event's kind, at times null and at times not given."""
    rows = read(spark, d, "events").select("event_id", "event_type", "props")
    k = F.get_json_object("props", "$.k").try_cast("int")
    answer = lambda n: F.element_at(F.array(*[F.lit(x) for x in ("pass", "unclear", "fail", "maybe")]), (k % n + 1).cast("int"))
    body = F.to_json(F.struct((k - 3).alias("index"), answer(4).alias("supports_view"), answer(3).alias("forward_looking"), answer(2).alias("asset_match"), F.when(k % 5 > 1, F.col("event_type")).alias("evidence_strength")))
    made = rows.select("event_id", F.when(k % 5 == 1, F.regexp_replace(body, r"\}$", ',"evidence_strength":null}')).otherwise(body).alias("json"))
    x = contracts.verdicts(made, "json")
    return x.select("event_id", F.coalesce(F.try_element_at("errors", F.lit(1)), F.lit("")).alias("error"), F.coalesce("message", F.lit("")).alias("message"))


def _observed(spark, d):
    rows = taxonomy.lookup(_failures(spark, d, "sub_asset_class", "taxonomy_match", "call_view", "evidence_kind", "basis", "checker_strength"), read(spark, d, "taxonomy"), "sub_asset_class")
    n = F.col("failure_id")
    pick = lambda values, k: F.element_at(F.array(*[F.lit(v) for v in values]), (k % len(values) + 1).cast("int"))
    checked = F.col("checker_strength").isNotNull()
    return rows.withColumns(
        {
            "call_language": pick(LANGUAGES, n), "conflict": F.col("call_view") == "UNCERTAIN", "well_read": n % 4 != 0, "degraded": n % 11 == 0, "evidence_strength": F.col("checker_strength"),
            "supports_view": F.when(checked, pick(("pass", "pass", "unclear", "fail"), n)), "forward_looking": F.when(checked, pick(("pass", "pass", "pass", "pass", "fail"), n)), "asset_match": F.when(checked, F.lit("pass")),
            "delta": (n % 60).cast("double") - 30, "unit": F.when(n % 2 == 0, "bp").otherwise("pct"),
        }
    )


def call_scores(spark, d):
    return scoring.score(_observed(spark, d)).select("failure_id", "confidence", "band", "review_flag", "checker_status")


def hard_failures(spark, d):
    reason = scoring.hard_failure(F.col("leaf_no").isNotNull(), F.col("taxonomy_match"), F.when(F.col("degraded"), "quote_not_found"), F.col("delta"), F.col("unit"), F.col("basis"), True)
    return _observed(spark, d).select("failure_id", F.coalesce(reason, F.lit("")).alias("reason"))


def band_counts(spark, d):
    rows = _calls(spark, d, "confidence", "band", "review_flag").withColumn("scored_band", scoring.band(F.col("confidence")))
    return rows.groupBy("scored_band", "band", "review_flag").agg(F.count("*").alias("n"))


def scrambled_pages(spark, d):
    """Line items as word boxes, pages of ten orders: odd pages in one column, even ones in two."""
    items = read(spark, d, "lineitem").select((F.floor(F.col("l_orderkey") / 10)).cast("bigint").alias("page_id"), "l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("q"))
    rn = F.row_number().over(layout_window()) - 1
    boxed = items.withColumn("rn", rn).withColumn("xr", (F.col("q") * 7) % 45)
    two, even = F.col("page_id") % 2 == 0, F.col("rn") % 2 == 0
    x0 = F.when(two, F.when(even, F.col("xr") * 0.9).otherwise(F.col("xr") * 0.8 + 60)).otherwise(F.col("xr"))
    words = boxed.withColumn("x0", x0).withColumn("x1", F.col("x0") + F.when(two, 3.0).otherwise(50.0)).withColumn("top", 15.0 * F.col("rn"))
    words = words.withColumn("bottom", F.col("top") + 12.0 + F.col("xr") % 5).withColumn("page_width", F.lit(100.0)).withColumn("page_height", F.lit(700.0))
    return layout.scrambled_pages(words)


def layout_window():
    from pyspark.sql import Window

    return Window.partitionBy("page_id").orderBy("l_orderkey", "l_linenumber")


def eval_agreement(spark, d):
    keys = ["firm", "sub_asset_class"]
    rows = _calls(spark, d, *keys, "call_view")
    first = rows.where("call_id % 2 = 0").groupBy(*keys).agg(F.min_by("call_view", "call_id").alias("call_view"))
    last = rows.where("call_id % 2 = 1").groupBy(*keys).agg(F.min_by("call_view", "call_id").alias("call_view"))
    return evaluate.agreement(first, last, keys)


def one_hot_views(spark, d):
    return _calls(spark, d, "call_view").select("call_id", *evaluate.one_hot(F.col("call_view")))


def conflict_ledger(spark, d):
    rows = _calls(spark, d, "firm", "sub_asset_class", "call_view").withColumn("leaf", F.concat_ws("|", "firm", "sub_asset_class"))
    return evaluate.conflict_ledger(rows, "leaf", "call_view", "call_id")


def all_failures(spark, d):
    rows = _failures(spark, d, "reason_code", "chunk_id")
    both = report.all_failures(rows.where("coalesce(chunk_id, '') <> 'checker'"), rows.where("chunk_id = 'checker'").drop("reason_code"), "failure_id")
    return both.select("phase", "failure_id", F.coalesce("reason_code", F.lit("")).alias("reason_code"))


def _candidates(spark, d):
    """Failures as candidates: language by the kind of evidence, deltas read from the quote."""
    columns = ("source_id", "chunk_id", "sub_asset_raw", "sub_asset_class", "call_view", "taxonomy_match", "evidence_kind", "evidence_quote", "locator", "reasoning", "basis")
    rows = _failures(spark, d, *columns)
    kind, inferred = F.col("evidence_kind"), F.coalesce(F.col("basis") == "inferred", F.lit(False))
    spoken = F.when(kind == "table", "explicit_dial").when(kind == "visual", "directional").when((kind == "prose") & inferred, "implied").when(kind == "prose", "explicit_stance").otherwise("none")
    points = F.nullif(F.regexp_extract(F.coalesce("evidence_quote", F.lit("")), r"(\d{1,4}) basis points", 1), F.lit("")).cast("double")
    percent = F.nullif(F.regexp_extract(F.coalesce("evidence_quote", F.lit("")), r"(\d{1,3}\.\d{1,2})%", 1), F.lit("")).cast("double")
    made = rows.withColumnRenamed("failure_id", "cand_idx").withColumn("evidence_spans", F.coalesce(F.split("evidence_quote", r" \.\.\. "), F.array().cast("array<string>")))
    made = made.withColumn("delta_value", F.coalesce(points, percent)).withColumn("delta_unit", F.when(points.isNotNull(), "bp").otherwise("pct"))
    return made.withColumn("call_language", spoken).withColumn("conflict", F.col("call_view") == "UNCERTAIN").drop("evidence_quote")


def _source_infos(spark, d):
    """The target list's sources; neighbours in it are companions."""
    found = ingest.target_sources(_targets(spark, d)).select("source_id", F.col("list_row").alias("source_ord"), "firm", F.col("published_at").alias("out_date"), F.col("title").alias("source"), F.col("resolved_url").alias("url"))
    rest = F.struct("source_ord", "firm", "out_date", "source", "url")
    sources = stored(found.groupBy("source_id").agg(F.min_by(rest, "source_ord").alias("s")).select("source_id", "s.*"), "source_infos")
    return sources, sources.select("source_id", F.concat(F.lit("pair-"), F.floor(F.col("source_ord") / 2).cast("string")).alias("group_id"))


def _assembled(spark, d):
    verdicts = _failures(spark, d, "reason_code", "checker_strength", "message").where("checker_strength is not null")
    verdicts = verdicts.select(F.col("failure_id").alias("cand_idx"), *_answers(), F.col("checker_strength").alias("evidence_strength"), F.col("message").alias("note"))
    sources, groups = _source_infos(spark, d)
    texts = pipeline.prepared_sources(_snapshots(spark, d, "snapshot_text", "page_count", "scrambled_pages"))
    judged = pipeline.judge(_candidates(spark, d), read(spark, d, "taxonomy"), texts, _chunks(spark, d), verdicts, groups)
    decisive = F.min(F.when(F.col("given_strength") == "decisive", F.col("group_idx")))
    decisions = pipeline.conflicting(judged).groupBy(*pipeline.GROUP).agg(decisive.alias("winning_index"), F.lit("first decisive").alias("reasoning"))
    return pipeline.assembled(judged, sources, decisions, groups)


def assembled_rows(spark, d):
    """The flagship, end to end: gates, score, groups, decisions, duplicates, display and commentary of the kept rows."""
    return _assembled(spark, d).output


def assembled_failures(spark, d):
    return _assembled(spark, d).failures.drop("group_ord", "evidence_quote", "reasoning")


def assembled_counts(spark, d):
    """Reconciliation of a whole run, by real steps: what is kept and what fails under each reason add up to the candidates."""
    done = _assembled(spark, d)
    kept = done.output.agg(F.lit("kept").alias("label"), F.count("*").alias("n"))
    failed = report.failure_counts(done.failures).withColumnRenamed("reason_code", "label")
    every = _failures(spark, d).agg(F.lit("candidates").alias("label"), F.count("*").alias("n"))
    return kept.unionByName(failed).unionByName(every)


NAMES = (
    "source_urls firm_keys visual_pages made_chunks chunk_lengths source_batches read_quality normalized_quotes nfkc_texts quote_tokens verbatim_evidence evidence_check locator_parse "
    "taxonomy_lookup unknown_labels taxonomy_integrity taxonomy_outline failure_reason_counts basis_counts strength_counts reconciliation source_summary view_conflicts same_view_dedup arbitration "
    "corroboration cross_leaf_dedup rolling_memory companion_memory prompt_contents checker_verdicts checker_failures response_outcomes quote_quality leaf_matches displayed_chunks contract_candidates contract_verdicts call_scores hard_failures band_counts assembled_rows assembled_failures assembled_counts scrambled_pages eval_agreement one_hot_views conflict_ledger all_failures"
).split()
QUERIES = {name: globals()[name] for name in NAMES} | {"p5_found": instants.p5_found}
