"""Evidence checks: is a quote in its source, in order, or do its key tokens occur there?

Normalised text and tokens are made once for each source, then joined to its quotes in a shuffle, whose hot partitions
adaptive execution splits. Defined results: a null or blank text fails with evidence_check_failed; null quotes have no spans
and are not found; repeated rows are checked as often as they occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmill.common import salted_lookup, stored
from callmill.functions.text import cited_page, nfkc_all, normalize_composed, normalize_quote, tokens_of, visual_locator

SPAN_MARK, MOST_SPANS, LEAST_SPAN_TOKENS, LEAST_OVERLAP = " ... ", 3, 4, 2


def spans_of(quote: Column) -> Column:
    return F.split(quote, r" \.\.\. ")


def quote_of(spans: Column) -> Column:
    return F.array_join(spans, SPAN_MARK)


def prepared(sources: DataFrame, text: str) -> DataFrame:
    """sources with norm_text and token_set, stored: the costly part, once for each source."""
    kept = F.coalesce(F.col(text), F.lit(""))
    # by texts, not by bytes: the work is in the expressions. By a hash, as a shuffle by the key itself may be one that exists and is coalesced
    spark = sources.sparkSession
    sources = sources.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), F.xxhash64("source_id"))
    return stored(sources.withColumn("norm_text", normalize_quote(kept)).withColumn("token_set", F.array_distinct(tokens_of(F.col("norm_text")))), "sources")


def with_spans(df: DataFrame, spans: Column) -> DataFrame:
    """Adds _spans, the normalised spans that are not empty, _thin: whether any span as given has too few meaningful tokens,
    and _tokens, those of the quote that the spans make.

    Columns of their own, so that the normalisation runs once for each row however often the check reads it.
    """
    x = df.withColumn("_all", F.transform(nfkc_all(spans), normalize_composed))
    x = x.withColumn("_spans", F.filter("_all", lambda s: F.coalesce(s, F.lit("")) != ""))
    x = x.withColumn("_thin", F.exists("_all", lambda s: F.size(tokens_of(s)) < LEAST_SPAN_TOKENS))
    return x.withColumn("_tokens", tokens_of(normalize_composed(F.array_join("_all", SPAN_MARK)))).drop("_all")


def _in_order(n: int) -> Column:
    """A pattern of the first n spans one after the other: each taken where it first occurs, without going back."""
    one = lambda i: F.concat(F.lit(r"(?>.*?\Q"), F.replace(F.coalesce(F.try_element_at("_spans", F.lit(i)), F.lit("")), F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E)"))
    return F.concat(F.lit("(?s)^"), *[one(i + 1) for i in range(n)])


def verbatim(norm_text: Column) -> Column:
    """Reason why _spans are not in the text one after the other, or null where they are.

    A single span, the usual case, is a plain search of bytes; only several ones need the pattern.
    """
    at = lambda i: F.coalesce(F.try_element_at("_spans", F.lit(i)), F.lit(""))
    count, has = F.size("_spans"), lambda x: F.contains(norm_text, x)
    missing = lambda x: F.when(has(x), "out_of_order").otherwise("not_found")
    return (
        F.when(F.coalesce(count, F.lit(0)) <= 0, "empty")
        .when(count > MOST_SPANS, "too_many_spans")
        .when((count > 1) & F.col("_thin"), "span_too_short")
        .when(~has(at(1)), "not_found")
        .when((count > 1) & ~(has(at(2)) & F.regexp_like(norm_text, _in_order(2))), missing(at(2)))
        .when((count > 2) & ~(has(at(3)) & F.regexp_like(norm_text, _in_order(3))), missing(at(3)))
    )


def tokens_overlap(quote_tokens: Column, token_set: Column) -> Column:
    """At least two of the quote's different tokens, or all where it has fewer, occur; never for a quote without tokens."""
    own = F.array_distinct(quote_tokens)
    return (F.size(own) > 0) & (F.size(F.array_intersect(own, token_set)) >= F.least(F.lit(LEAST_OVERLAP), F.size(own)))


def check(rows: DataFrame, sources: DataFrame, by: str, chunks: DataFrame | None = None, spans: Column | None = None) -> DataFrame:
    """rows(source_id, evidence_quote, evidence_kind, locator) with ev_passed, ev_reason, ev_message and degraded.

    sources(source_id, norm_text, token_set, scrambled_pages) is unique by source. Prose must be verbatim; on a page
    that reads scrambled its key tokens must occur; tables and pictures need a specific locator and key tokens. With
    chunks(source_id, chunk_id), a row (chunk_id) of no known chunk has no text. spans: the quote's spans where a column
    holds them, else the quote is parted at its marks.
    """
    side = sources.select("source_id", "norm_text", "token_set", "scrambled_pages")
    ready = with_spans(rows.drop("norm_text", "token_set", "scrambled_pages"), spans_of(F.col("evidence_quote")) if spans is None else spans)
    known = F.lit(True)
    if chunks is not None:
        # matched on a hash of both, so that a hot source's rows are spread by their chunks
        there = chunks.select("source_id", "chunk_id").where("source_id is not null and chunk_id is not null").distinct().withColumn("_there", F.lit(True))
        ready, known = ready.join(there, ["source_id", "chunk_id"], "left"), F.coalesce("_there", F.lit(False))
    x = salted_lookup(ready.withColumn("_known", known), side, "source_id", F.col(by), salts=1, broadcast_rows=0)
    tokens = F.col("_tokens")
    overlap = tokens_overlap(tokens, F.coalesce("token_set", F.array().cast("array<string>")))
    prose, page = F.coalesce(F.col("evidence_kind"), F.lit("prose")) == "prose", cited_page(F.col("locator"))
    degraded = prose & F.coalesce(F.array_contains(F.coalesce("scrambled_pages", F.array().cast("array<int>")), page), F.lit(False))
    blank = ~F.col("_known") | (F.coalesce("norm_text", F.lit("")) == "")
    x = x.withColumn("_found", F.when(~blank & prose & ~degraded, verbatim(F.col("norm_text"))))
    # Codes and messages of the failures, in the order of the checks.
    code = (
        F.when(blank, "evidence_check_failed")
        .when(degraded, F.when(~overlap, "quote_not_found"))
        .when(prose, F.when(F.col("_found").isNotNull(), "quote_not_found"))
        .when(~visual_locator(F.col("locator")), "visual_locator_missing")
        .when((F.size(tokens) == 0) | ~overlap, "evidence_check_failed")
    )
    message = (
        F.when(blank, "snapshot text is empty")
        .when(degraded, F.when(~overlap, F.concat(F.lit("page p."), page.cast("string"), F.lit(" flagged scrambled (two-column interleave); prose verbatim check degraded to key-token overlap, which also failed"))))
        .when(
            prose,
            F.when(F.col("_found") == "empty", "prose quote is empty")
            .when(F.col("_found") == "too_many_spans", f"prose quote has more than {MOST_SPANS} spans")
            .when(F.col("_found") == "span_too_short", "a prose quote span is too short to verify")
            .when(F.col("_found") == "out_of_order", "prose quote spans are out of document order")
            .when(F.col("_found") == "not_found", "prose quote was not found"),
        )
        .when(~visual_locator(F.col("locator")), "table/visual evidence needs page plus table, figure, grid, caption, or heading")
        .when(F.size(tokens) == 0, "table/visual evidence is empty")
        .when(~overlap, "table/visual evidence tokens were not found in snapshot text")
    )
    out = x.withColumn("ev_reason", code).withColumn("ev_message", message).withColumn("ev_passed", F.col("ev_reason").isNull()).withColumn("degraded", degraded & ~blank)
    return out.drop("norm_text", "token_set", "scrambled_pages", "_spans", "_thin", "_tokens", "_known", "_there", "_found")
