"""Counts that reconcile a run, and their Markdown."""

from __future__ import annotations

import html

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reconciliation(candidates: DataFrame, kept: DataFrame, failed: DataFrame) -> DataFrame:
    """One row: whether every candidate is either kept or failed."""
    counts = [df.agg(F.count("*").alias(n)) for df, n in ((candidates, "candidates"), (kept, "kept"), (failed, "failed"))]
    one = counts[0].crossJoin(counts[1]).crossJoin(counts[2])  # three single rows
    return one.withColumn("status", F.when(F.col("candidates") == F.col("kept") + F.col("failed"), "pass").otherwise("review"))


def labelled_counts(rows: DataFrame, column: str, blank: str) -> DataFrame:
    """label, n: rows by the column, with a name for blank and null."""
    return rows.groupBy(F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(blank)).alias("label")).agg(F.count("*").alias("n"))


def failure_counts(*failures: DataFrame) -> DataFrame:
    """reason_code, n over assembly and chunk failures alike."""
    every = failures[0].select("reason_code")
    for df in failures[1:]:
        every = every.unionByName(df.select("reason_code"))
    return every.groupBy("reason_code").agg(F.count("*").alias("n"))


def all_failures(assembly: DataFrame, chunk: DataFrame, *order: str) -> DataFrame:
    """Assembly failures, then chunk failures: `phase` and the order's columns say where a row stands in the file."""
    both = assembly.withColumn("phase", F.lit(0)).unionByName(chunk.withColumn("phase", F.lit(1)), allowMissingColumns=True)
    return both.select("phase", *order, *[c for c in both.columns if c not in ("phase", *order)])


def source_summary(sources: DataFrame, chunks: DataFrame, candidates: DataFrame) -> DataFrame:
    """source_id, candidates, chunk_count, page_count, pages_text, flags; sources without any are kept with 0."""
    n = candidates.groupBy("source_id").agg(F.count("*").alias("candidates"))
    k = chunks.groupBy("source_id").agg(F.count("*").alias("chunk_count"))
    x = sources.select("source_id", "page_count", "visual_heavy", "printed_pdf", "scrambled_pages").join(n, "source_id", "left").join(k, "source_id", "left")
    x = x.fillna(0, ["candidates", "chunk_count"])
    count = F.concat(F.col("chunk_count").cast("string"), F.lit(" chunks"))
    tags = F.array_compact(F.array(F.when(F.col("visual_heavy"), "visual"), F.when(F.col("printed_pdf"), "printed"), F.when(F.size(F.coalesce("scrambled_pages", F.array().cast("array<int>"))) > 0, "scrambled")))
    paged = F.coalesce(F.col("page_count"), F.lit(0)) > 0
    return x.select("source_id", "candidates", "chunk_count", "page_count", F.when(paged, F.concat(F.col("page_count").cast("string"), F.lit("p / "), count)).otherwise(count).alias("pages_text"), F.array_join(tags, ", ").alias("flags"))


# Fixed value: what a call says whose quote was only checked by its tokens.
DEGRADED = "Evidence check: cited page detected as scrambled two-column text; verbatim quote match degraded to key-token overlap (confidence capped, review required)."


def commentary(reasoning, quote, locator, corroboration, degraded, cap, language, status, note, arbiter):
    """The clauses of a kept row's commentary, in order; an empty clause is left out."""
    some = lambda x: F.when(F.coalesce(x, F.lit("")) != "", x)
    text = lambda x: F.coalesce(x, F.lit(""))
    head = F.concat(text(reasoning), F.lit(" Evidence: "), text(quote), F.lit(". Locator: "), text(locator), F.lit("."))
    unclear = F.concat(F.lit("Checker: unconfirmed"), F.coalesce(F.concat(F.lit(" ("), some(note), F.lit(")")), F.lit("")), F.lit("."))
    checker = F.when(status == "unclear", unclear).when(status == "missing", "Checker: not run.").when(status == "confirmed", F.concat(F.lit("Checker: "), some(note), F.lit(".")))
    parts = (head, some(corroboration), F.when(degraded, DEGRADED), some(cap), some(language), checker, F.concat(F.lit("Arbiter: "), some(arbiter)))
    return F.array_join(F.array_compact(F.array(*parts)), " ")


def manifest(
    counts: DataFrame, failures: DataFrame, kept: DataFrame, chunk_failures: DataFrame | None = None, settings: dict[str, object] | None = None, sources: DataFrame | None = None,
    grouping: dict | None = None, most: int = 10_000,
) -> str:
    """Markdown of a run: settings that are set, grouping, reconciliation, basis and strength of kept rows, reasons, sources.

    counts has one row (candidates, kept, failed, status); what reaches the driver are labels with their numbers, and the
    sources(source_id, source_type, page_count, chunk_count, candidates, visual_heavy, printed_pdf, scrambled_pages,
    source_ord), a list that more than `most` refuses. Sections without lines are left out.
    """

    def few(df: DataFrame) -> list:
        rows = df.take(most + 1)
        if len(rows) > most:
            raise ValueError(f"a section of more than {most} lines")
        return rows

    one = counts.first()
    lost = chunk_failures.count() if chunk_failures is not None else 0
    every = (failures,) if chunk_failures is None else (failures, chunk_failures)
    said: list[tuple[str, list[str]]] = []
    if settings:
        said.append(("Run configuration", [f"- {k}: {v}" for k, v in settings.items() if v is not None]))
    if grouping:
        lines = [f"- group notes: {grouping.get('notes_path')}"]
        lines += [f"- {g['group_id']}: {', '.join(g['source_ids'])}" + (f" — note: {g['note']}" if g.get("note") else "") for g in grouping.get("groups", [])]
        said.append(("Grouping", lines + [f"- warning: {w}" for w in grouping.get("warnings", [])]))
    said.append(("Candidate reconciliation", [f"- candidates: {one.candidates}", f"- kept: {one.kept}", f"- failed: {one.failed}", f"- count check: {one.status}", f"- chunk failures (no candidate): {lost}"]))
    said.append(("Call basis (kept rows)", [f"- {r.label}: {r.n}" for r in few(labelled_counts(kept, "basis", "stated").orderBy("label"))]))
    said.append(("Checker strength (kept rows)", [f"- {r.label}: {r.n}" for r in few(labelled_counts(kept, "checker_strength", "(none)").orderBy("label"))]))
    said.append(("Failure reasons", [f"- {r.reason_code}: {r.n}" for r in few(failure_counts(*every).orderBy(F.desc("n"), "reason_code"))]))
    lines = []
    for r in few(sources.orderBy("source_ord")) if sources is not None else ():
        tags = (" [visual_heavy]" if r.visual_heavy else "") + (" [printed-to-pdf]" if r.printed_pdf else "")
        tags += f" [scrambled pages: {', '.join(f'p.{n}' for n in r.scrambled_pages)}]" if r.scrambled_pages else ""
        size = (f"{r.page_count}p / " if r.page_count else "") + f"{r.chunk_count} chunks"
        lines.append(f"- {r.source_id} ({r.source_type}, {size}): {r.candidates} candidates emitted{tags}")
    said.append(("Sources processed", lines))
    return "\n".join(["# Run Manifest", "", *[x for title, lines in said if lines for x in (f"## {title}", *lines, "")]])


def review_page(rows: DataFrame, columns: list[str], *order: str, title: str = "Review", most: int = 5_000) -> str:
    """A page for reviewers: the rows as a table, those that need review marked. It is read by people, so more than `most` rows are refused."""
    given = (rows.orderBy(*order) if order else rows).select(*columns, F.coalesce("review_flag", F.lit("none")).alias("_flag")).take(most + 1)
    if len(given) > most:
        raise ValueError(f"a page of more than {most} rows")
    cell = lambda v: html.escape("" if v is None else str(v))
    body = "".join(f'<tr class="{cell(r[-1])}">' + "".join(f"<td>{cell(v)}</td>" for v in r[:-1]) + "</tr>\n" for r in given)
    style = "table{border-collapse:collapse}td,th{border:1px solid #999;padding:4px;vertical-align:top}.review{background:#fff3cd}.strong_review{background:#f8d7da}"
    head = "".join(f"<th>{cell(c)}</th>" for c in columns)
    return f'<!DOCTYPE html>\n<html><head><meta charset="utf-8"><title>{cell(title)}</title><style>{style}</style></head><body>\n<h1>{cell(title)}</h1>\n<table><tr>{head}</tr>\n{body}</table></body></html>\n'
