"""Source lists, snapshots and chunks.

Defined results: a source without id gets one of its row, firm and title; empty texts give one empty chunk, no pages
give none; re-delivered rows count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from callmill.common import numbered
from callmill.functions.text import lookup_key, markup_counts, slugify, strip, visual_heavy
from callmill.functions.urls import resolve_url, source_type

PAGES_A_CHUNK, CHARS_A_CHUNK, SOURCES_A_RUN = 5, 8000, 20


def target_sources(rows: DataFrame) -> DataFrame:
    """Target list rows with source_id, resolved_url and source_type."""
    made = slugify(F.concat_ws(" ", F.col("list_row").cast("string"), "firm", "title"))
    known = F.nullif(strip(F.col("id")), F.lit(""))
    resolved = rows.withColumn("resolved_url", resolve_url(F.col("source_link")))
    return resolved.withColumn("source_id", F.coalesce(known, made)).withColumn("source_type", source_type(F.col("resolved_url")))


def pilot_sources(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Pilot rows (firm, source, link) with their local file: by firm and title, else by firm alone. files(firm, title, path)."""
    keyed = rows.withColumn("_f", lookup_key(F.col("firm"))).withColumn("_t", lookup_key(F.col("source")))
    side = files.select(lookup_key(F.col("firm")).alias("_f"), lookup_key(F.col("title")).alias("_t"), "path")
    exact = side.groupBy("_f", "_t").agg(F.min("path").alias("_exact"))
    loose = side.groupBy("_f").agg(F.min("path").alias("_loose"))
    found = keyed.join(exact, ["_f", "_t"], "left").join(loose, "_f", "left").withColumn("local_path", F.coalesce("_exact", "_loose"))
    typed = found.withColumn("source_type", F.when(F.col("local_path").isNotNull(), "pdf").otherwise(source_type(F.col("link"))))
    return typed.withColumn("source_id", slugify(F.concat_ws(" ", "firm", "source"))).withColumn("resolved_url", resolve_url(F.col("link"))).drop("_f", "_t", "_exact", "_loose")


def page_text(pages: DataFrame) -> DataFrame:
    """pages(source_id, page_no, text) -> source_id, snapshot_text, page_count: pages in order, a blank line between."""
    ordered = F.array_sort(F.collect_list(F.struct("page_no", F.coalesce("text", F.lit("")).alias("text"))))
    return pages.groupBy("source_id").agg(F.array_join(F.transform(ordered, lambda p: p["text"]), "\n\n").alias("snapshot_text"), F.count("*").cast("int").alias("page_count"))


def snapshot_flags(pages: DataFrame, html: str) -> DataFrame:
    """Adds visual_markup and visual_heavy, which chooses between the page's text and a print of it."""
    marked = pages.withColumn("visual_markup", markup_counts(F.col(html)))
    return marked.withColumn("visual_heavy", F.coalesce(visual_heavy(F.col("visual_markup")), F.lit(False)))


def page_ranges(n: Column, size: int = PAGES_A_CHUNK) -> Column:
    starts = F.when(n >= 1, F.sequence(F.lit(1), n, F.lit(size))).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda a: F.struct(a.alias("a"), F.least(a + (size - 1), n).alias("b")))


def char_ranges(n: Column, size: int = CHARS_A_CHUNK) -> Column:
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(size))
    return F.transform(starts, lambda a: F.struct(a.alias("a"), F.least(a + size, n).alias("b")))


def make_chunks(snapshots: DataFrame) -> DataFrame:
    """source_id, chunk_ord, chunk_id, locator: pages where a page count is known, else characters."""
    length = F.length(F.coalesce("snapshot_text", F.lit("")))
    paged = F.col("page_count").isNotNull()
    ranged = snapshots.select("source_id", paged.alias("paged"), F.posexplode(F.when(paged, page_ranges(F.col("page_count"))).otherwise(char_ranges(length))).alias("chunk_ord", "r"))
    name = lambda page, char: F.concat(F.when(F.col("paged"), page).otherwise(char), F.col("r.a").cast("string"), F.lit("-"), F.col("r.b").cast("string"))
    return ranged.select("source_id", F.col("chunk_ord").cast("int").alias("chunk_ord"), name("p", "char:").alias("chunk_id"), name("p.", "char:").alias("locator"))


def char_slice(text: Column, chunk_id: Column) -> Column:
    """The part of the text that char:{a}-{b} names; the whole text for any other id."""
    pattern = r"^char:(\d{1,9})-(\d{1,9})$"
    a, b = (F.regexp_extract(chunk_id, pattern, i).try_cast("int") for i in (1, 2))
    return F.when(chunk_id.rlike(pattern), F.substring(text, a + 1, F.greatest(b - a, F.lit(0)))).otherwise(text)


def chunk_slice(text: Column, chunk_id: Column) -> Column:
    """The part of the text that the id names: characters, or pages between form feeds, which stay between pages."""
    pattern = r"^p(\d{1,9})-(\d{1,9})$"
    a, b = (F.regexp_extract(chunk_id, pattern, i).try_cast("int") for i in (1, 2))
    pages = F.slice(F.split(text, "\f"), F.greatest(a, F.lit(1)), F.greatest(b - a + 1, F.lit(0)))
    return F.when(chunk_id.rlike(pattern), F.array_join(pages, "\f")).otherwise(char_slice(text, chunk_id))


def read_quality(text: Column, page_count: Column, chars_a_page: int = 200, chars: int = 1000) -> Column:
    """Enough text was read: per page where pages are known, else altogether."""
    n = F.length(strip(F.coalesce(text, F.lit(""))))
    return F.when(page_count.isNull(), n >= chars).otherwise((page_count > 0) & (n >= chars_a_page * page_count))


def batches(sources: DataFrame, order: str, size: int = SOURCES_A_RUN) -> DataFrame:
    """batch_no of each source in its list's order."""
    return numbered(sources, order, name="_i").withColumn("batch_no", F.floor(F.col("_i") / size).cast("int")).drop("_i")


def chunk_content(chunk_id: Column, locator: Column, text: Column, path: Column, url: Column, paged: Column, printed: Column) -> Column:
    """What a reader is told of a chunk: the pages of a file, with a note where it is a print of a page, or the text itself."""
    # The wording.
    text_of = lambda x: F.coalesce(x, F.lit(""))
    note = F.when(printed, F.concat(F.lit("(This PDF is a print-to-PDF capture of the web page at "), text_of(url), F.lit("; use its page numbers as locators.)\n\n"))).otherwise("")
    of_pages = F.concat(
        F.lit("This chunk is pages "), F.replace(locator, F.lit("p."), F.lit("")), F.lit(" of the PDF file at:\n`"), text_of(path), F.lit("`\n\n"), note,
        F.lit("Open and read those pages as rendered pages — view them so you see tables, positioning/view grids, arrows, and dial gauges as printed, not only the extracted text. Cite what you actually see on the page."),
    )
    of_text = F.concat(
        F.lit("This chunk is the extracted text below (locator "), locator, F.lit(", from "), text_of(url), F.lit(").\nIf the text references a chart, figure, or infographic you cannot see, say so in your summary rather than guessing its contents.\n\n-----\n"),
        text_of(char_slice(text, chunk_id)), F.lit("\n-----"),
    )
    return F.when(F.coalesce(paged, F.lit(False)) | F.coalesce(printed, F.lit(False)), of_pages).otherwise(of_text)


def snapshots(sources: DataFrame, pages: DataFrame, html: DataFrame, printed: DataFrame | None = None) -> DataFrame:
    """source_id, source_type, snapshot_text, page_count, visual_markup, visual_heavy, printed_pdf, scrambled_pages of each source.

    sources(source_id, source_type); pages(source_id, page_no, text, scrambled) of files; html(source_id, html, text) of
    pages; printed(source_id, page_no, text, scrambled) of prints. A file is its pages; a page is its text, or its print
    where it is heavy with pictures and there is one. Only what is read as pages has a page count.
    """
    flagged = snapshot_flags(html.select("source_id", "html", "text"), "html").select("source_id", "text", "visual_markup", "visual_heavy")
    torn = lambda p: p.groupBy("source_id").agg(F.array_sort(F.collect_list(F.when(F.coalesce("scrambled", F.lit(False)), F.col("page_no")))).alias("scrambled_pages"))
    paged = page_text(pages).join(torn(pages), "source_id")
    x = sources.select("source_id", "source_type").join(flagged, "source_id", "left").join(paged.withColumnsRenamed({"snapshot_text": "_file", "page_count": "_file_n", "scrambled_pages": "_file_s"}), "source_id", "left")
    if printed is None:
        x = x.withColumn("_print", F.lit(None).cast("string")).withColumn("_print_n", F.lit(None).cast("int")).withColumn("_print_s", F.lit(None).cast("array<int>"))
    else:
        x = x.join(page_text(printed).join(torn(printed), "source_id").withColumnsRenamed({"snapshot_text": "_print", "page_count": "_print_n", "scrambled_pages": "_print_s"}), "source_id", "left")
    file = F.col("source_type") == "pdf"
    as_print = ~file & F.coalesce("visual_heavy", F.lit(False)) & F.col("_print").isNotNull()
    none = F.array().cast("array<int>")
    return x.select(
        "source_id", "source_type", F.when(file, F.coalesce("_file", F.lit(""))).when(as_print, F.col("_print")).otherwise(F.coalesce("text", F.lit(""))).alias("snapshot_text"),
        F.when(file, F.coalesce("_file_n", F.lit(0))).when(as_print, F.col("_print_n")).cast("int").alias("page_count"), F.when(~file, F.col("visual_markup")).alias("visual_markup"),
        (~file & F.coalesce("visual_heavy", F.lit(False))).alias("visual_heavy"), as_print.alias("printed_pdf"), F.when(file, F.coalesce("_file_s", none)).when(as_print, F.coalesce("_print_s", none)).otherwise(none).alias("scrambled_pages"),
    )
