"""CSV, text and table sources and sinks.

CSV is read as text, header first, quoted fields with line breaks allowed; an absent field is an empty text. A kept
file has its header even without rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

# The columns of the two result files.
OUTPUT_COLUMNS = "firm out_date source url sub_asset_class asset_class_category canva_groupings asset_class call_view full_commentary confidence band review_flag basis checker_strength".split()
FAILURE_COLUMNS = "reason_code message source_id chunk_id sub_asset_raw sub_asset_class call_view taxonomy_match evidence_kind evidence_quote locator reasoning basis checker_strength".split()


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(path).na.fill("")


def read_taxonomy(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(taxonomy, errors): rows whose number is no integer or which lack a field are errors, with their line."""
    raw = read_csv(spark, path)
    wanted = {"Number": "leaf_no", "Sub-Asset Class": "sub_asset_class", "Asset Class Category": "asset_class_category", "Asset Class": "asset_class", "Canva Groupings": "canva_groupings"}
    lacking = [c for c in wanted if c not in raw.columns]
    if lacking:
        raise ValueError(f"the taxonomy lacks {', '.join(lacking)}")
    x = raw.select(*[F.col(f"`{c}`").alias(n) for c, n in wanted.items()])
    blank = F.array_compact(F.array(F.when(F.col("leaf_no").try_cast("int").isNull(), F.lit("leaf_no")), *[F.when(F.col(n) == "", F.lit(n)) for n in list(wanted.values())[1:]]))
    x = x.withColumn("bad", blank)
    return x.where(F.size("bad") == 0).drop("bad").withColumn("leaf_no", F.col("leaf_no").cast("int")), x.where(F.size("bad") > 0)


def read_notes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def fetch(urls: DataFrame, url: str, fetcher: Callable[[str], str]) -> DataFrame:
    """urls with page and fetch_error: an injected fetcher runs beside the data; what it raises becomes the error."""
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in urls.schema), "page string", "fetch_error string"])

    def one(address: str) -> tuple[str | None, str | None]:
        try:
            return fetcher(address), None
        except Exception as e:  # noqa: BLE001
            return None, str(e)[:300]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            got = [one(a) for a in batch[url]]
            yield batch.assign(page=[g[0] for g in got], fetch_error=[g[1] for g in got])

    return urls.mapInPandas(run, schema)


def paged(items: DataFrame, item: str, reader: Callable[[object], list[str]]) -> DataFrame:
    """items with page_no (from 1), text and read_error: an injected reader gives the page texts of a file's bytes or of an address to print.

    What it raises becomes the error of one row without page.
    """
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema if f.name != item or not isinstance(f.dataType, BinaryType)), "page_no int, text string, read_error string"])
    kept = [f.name for f in items.schema if f.name != item or not isinstance(f.dataType, BinaryType)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for own, value in zip(batch[kept].itertuples(index=False), batch[item]):
                try:
                    rows += [(*own, n, t, None) for n, t in enumerate(reader(value), 1)]
                except Exception as e:  # noqa: BLE001
                    rows.append((*own, None, None, str(e)[:300]))
            out = pd.DataFrame(rows, columns=[*kept, "page_no", "text", "read_error"])
            yield out.astype({"page_no": "Int32"})

    return items.mapInPandas(run, schema)


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """path, content of the files below a folder, for a reader of theirs (paged)."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def html_text(html):
    """Text of a page by pattern: scripts, styles and tags fall away, blocks end lines. A fallback, no main-content extraction."""
    x = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>", "")
    x = F.regexp_replace(x, r"(?i)<(?:br|/p|/div|/li|/tr|/h[1-6])\b[^>]*>", "\n")
    x = F.regexp_replace(x, r"(?s)<[^>]*>", "")
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(name), F.lit(char))
    return x


def write_csv(df: DataFrame, path: str, columns: list[str], *order: str, single: bool = True) -> None:
    """The columns in their order; rows sorted by `order`. A single file suits a report; large results keep their partitions."""
    chosen = df.orderBy(*[F.col(f"`{o}`") for o in order]) if order else df
    chosen = chosen.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    (chosen.coalesce(1) if single else chosen).write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


# The workbook's headings of the result files' columns.
HEADINGS = {
    "firm": "Firm", "out_date": "Date", "source": "Source", "url": "URL", "sub_asset_class": "Sub-Asset Class", "asset_class_category": "Asset Class Category", "canva_groupings": "Canva Groupings",
    "asset_class": "Asset Class", "call_view": "View", "full_commentary": "Full Commentary",
}


def write_output(rows: DataFrame, path: str, *order: str, single: bool = True) -> None:
    """Kept rows under the workbook's headings."""
    write_csv(rows.withColumnsRenamed(HEADINGS), path, [HEADINGS.get(c, c) for c in OUTPUT_COLUMNS], *[HEADINGS.get(c, c) for c in order], single=single)


def write_failures(rows: DataFrame, path: str, *order: str, single: bool = True) -> None:
    """Failures with their view under its short heading."""
    write_csv(rows.withColumnRenamed("call_view", "view"), path, ["view" if c == "call_view" else c for c in FAILURE_COLUMNS], *order, single=single)


def write_table(df: DataFrame, path: str, *partition_by: str) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
