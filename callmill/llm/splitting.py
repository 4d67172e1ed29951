"""Splitting oversized items at natural boundaries (problem 2).

A hierarchy of separators, strongest first: section (form feed), paragraph (blank line), line, sentence mark, word
(space), and at last any character. A piece is packed as full as the strongest separator in its window allows and
the next one begins `overlap` characters before its end.

Defined results: null texts and texts within the limit give no pieces; an item without any boundary is cut at the
limit. Repeated rows of a key give their pieces once. Empty tables give none. Offsets are code points.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.common import read
from callmill.llm.common import map_texts

LIMIT, LEAST, OVERLAP = 4000, 2000, 200

#: Each level as a pattern that ends where a piece may end; look-ahead may see what follows.
LEVELS = (r"\f", r"\n\n", r"\n", r"[.!?](?=\s)|[。！？]", r" ")


_PAGES, _CHARS = re.compile(r"p(\d{1,9})-(\d{1,9})\Z", re.A), re.compile(r"char:(\d{1,9})-(\d{1,9})\Z", re.A)


def _last_end(pattern: re.Pattern, text: str, first: int, last: int) -> int:
    """The last end within first..last of a match of the one or two character pattern, or -1."""
    found = -1
    # a match may begin before the window and overlap another, so it is searched again from each match's second character
    at = pattern.search(text, max(0, first - 2))
    while at and at.end() <= last:
        if at.end() >= first:
            found = at.end()
        at = pattern.search(text, at.start() + 1)
    return found


def cut(text: str, limit: int = LIMIT, least: int = LEAST, overlap: int = OVERLAP, levels: tuple[str, ...] = LEVELS) -> Iterator[tuple[int, int]]:
    """(start, end) of the pieces of a text longer than the limit."""
    if not 0 <= overlap < least <= limit:
        raise ValueError("0 <= overlap < least <= limit")
    patterns, start = [re.compile(x) for x in levels], 0
    while len(text) - start > limit:
        ends = (_last_end(p, text, start + least, start + limit) for p in patterns)
        end = next((e for e in ends if e >= 0), start + limit)
        yield start, end
        start = end - overlap
    yield start, len(text)


def chunk_text(text: Column, chunk_id: Column) -> Column:
    """The text that a chunk id names: p{a}-{b} are pages, char:{a}-{b} is a range of characters; else null."""
    number = lambda pattern, group: F.regexp_extract(chunk_id, pattern, group).try_cast("int")
    pages, chars = r"^p(\d{1,9})-(\d{1,9})$", r"^char:(\d{1,9})-(\d{1,9})$"
    a, b, c, d = number(pages, 1), number(pages, 2), number(chars, 1), number(chars, 2)
    by_page = F.array_join(F.slice(F.split(text, "\f"), F.greatest(a, F.lit(1)), F.greatest(b - F.greatest(a, F.lit(1)) + 1, F.lit(0))), "\f")
    return F.when(chunk_id.rlike(pages), by_page).when(chunk_id.rlike(chars), F.substring(text, c + 1, F.greatest(d - c, F.lit(0))))


def chunk_of(text: str, pages: list[str], chunk_id: str) -> str | None:
    """The same of a text at hand, with its pages."""
    by_page, by_char = _PAGES.match(chunk_id), _CHARS.match(chunk_id)
    if by_page:
        first, last = max(1, int(by_page[1])), int(by_page[2])
        return "\f".join(pages[first - 1 : max(first - 1, last)])
    if by_char:
        return text[int(by_char[1]) : max(int(by_char[1]), int(by_char[2]))]
    return None


def split_items(df: DataFrame, keys: list[str], text: str, limit: int = LIMIT, least: int = LEAST, overlap: int = OVERLAP) -> DataFrame:
    """keys with piece_no, char_start, char_end for each piece of each text longer than the limit."""
    long = df.where(F.length(text) > limit).select(*keys, F.col(text).alias("_text"))
    schema = pa.schema([pa.field(k, pa.string()) for k in keys] + [pa.field(n, pa.int32()) for n in ("piece_no", "char_start", "char_end")])

    def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = list(zip(*[batch.column(k).to_pylist() for k in keys]))
        rows = [(*k, i, *ends) for k, t in zip(own, batch.column("_text").to_pylist()) for i, ends in enumerate(cut(t, limit, least, overlap))]
        return pa.record_batch([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    names = ", ".join(f"`{k}` string" for k in keys)
    return map_texts(long, "_text", f"{names}, piece_no int, char_start int, char_end int", pieces)


def split_chunks(chunks: DataFrame, texts: DataFrame, limit: int = LIMIT, least: int = LEAST, overlap: int = OVERLAP, together: int = 500) -> DataFrame:
    """source_id, chunk_id, piece_no, char_start, char_end of the pieces of the long chunks(source_id, chunk_id) of texts(source_id, snapshot_text).

    A source's chunks are taken from its text in one go, `together` of them at most, so that the text is neither sent
    nor divided into pages for each, and no list of chunks grows with the source.
    """
    many = chunks.groupBy("source_id").agg(F.ceil(F.count("*") / together).cast("int").alias("_n"))
    grouped = chunks.join(many, "source_id").groupBy("source_id", F.pmod(F.xxhash64("chunk_id"), F.col("_n")).alias("_part")).agg(F.collect_list("chunk_id").alias("_ids"))
    sided = grouped.join(texts.select("source_id", F.col("snapshot_text").alias("_text")), "source_id").select("source_id", "_ids", "_text")
    schema = pa.schema([("source_id", pa.string()), ("chunk_id", pa.string()), ("piece_no", pa.int32()), ("char_start", pa.int32()), ("char_end", pa.int32())])

    def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for source, ids, text in zip(*(batch.column(c).to_pylist() for c in ("source_id", "_ids", "_text"))):
            pages = text.split("\f")
            for chunk in ids:
                own = chunk_of(text, pages, chunk)
                if own is not None and len(own) > limit:
                    rows += [(source, chunk, i, *ends) for i, ends in enumerate(cut(own, limit, least, overlap))]
        return pa.record_batch([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)

    return map_texts(sided, "_text", "source_id string, chunk_id string, piece_no int, char_start int, char_end int", pieces)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every chunk longer than 4,000 characters."""
    chunks = read(spark, sf_dir, "chunks").where("source_id is not null and chunk_id is not null").select("source_id", "chunk_id").distinct()
    texts = read(spark, sf_dir, "snapshots").where("source_id is not null and length(snapshot_text) > 4000").select("source_id", "snapshot_text").dropDuplicates(["source_id"])
    return split_chunks(chunks, texts)


#: The same in SQL: the rule of TESTDATA.md step by step. A window is searched from its end.
P2_SQL = r"""
WITH RECURSIVE c AS (SELECT DISTINCT source_id, chunk_id FROM chunks WHERE source_id IS NOT NULL AND chunk_id IS NOT NULL),
t AS (SELECT DISTINCT ON (source_id) source_id, snapshot_text AS x FROM snapshots WHERE source_id IS NOT NULL AND length(snapshot_text) > 4000),
n AS (SELECT *, TRY_CAST(regexp_extract(chunk_id, '^(?:p|char:)(\d{1,9})-', 1) AS INT) AS a, TRY_CAST(regexp_extract(chunk_id, '-(\d{1,9})$', 1) AS INT) AS b FROM c JOIN t USING (source_id)),
k AS (SELECT source_id, chunk_id, CASE WHEN regexp_full_match(chunk_id, 'p\d{1,9}-\d{1,9}') THEN array_to_string(string_split(x, chr(12))[greatest(a, 1):b], chr(12)) WHEN regexp_full_match(chunk_id, 'char:\d{1,9}-\d{1,9}') THEN substr(x, a + 1, b - a) END AS x FROM n),
step AS (
  SELECT source_id, chunk_id, x, 0 AS piece_no, 0 AS s, 0 AS e FROM k WHERE length(x) > 4000
  UNION ALL
  SELECT source_id, chunk_id, x, piece_no + 1, CASE WHEN piece_no = 0 THEN 0 ELSE e - 200 END,
    CASE WHEN length(x) - CASE WHEN piece_no = 0 THEN 0 ELSE e - 200 END <= 4000 THEN length(x) ELSE CASE WHEN piece_no = 0 THEN 0 ELSE e - 200 END + 4000 - (
      SELECT CASE WHEN strpos(one, chr(12)) > 0 THEN strpos(one, chr(12)) - 1 WHEN strpos(two, chr(10) || chr(10)) > 0 THEN strpos(two, chr(10) || chr(10)) - 1 WHEN strpos(one, chr(10)) > 0 THEN strpos(one, chr(10)) - 1
        WHEN least(m, w) < 9999 THEN least(m, w) WHEN strpos(one, ' ') > 0 THEN strpos(one, ' ') - 1 ELSE 0 END
      FROM (SELECT one, two, CASE WHEN regexp_matches(more, '[\t-\r\x{1c}-\x20\x{85}\p{Z}][.!?]') THEN length(regexp_extract(more, '(?s)^(.*?)[\t-\r\x{1c}-\x20\x{85}\p{Z}][.!?]', 1)) ELSE 9999 END AS m,
              CASE WHEN regexp_matches(one, '[。！？]') THEN length(regexp_extract(one, '(?s)^(.*?)[。！？]', 1)) ELSE 9999 END AS w
            FROM (SELECT reverse(substr(x, f + 2000, 2001)) AS one, reverse(substr(x, f + 1999, 2002)) AS two, reverse(substr(x, f + 2000, 2002)) AS more FROM (SELECT CASE WHEN piece_no = 0 THEN 0 ELSE e - 200 END AS f)))) END
  FROM step WHERE piece_no = 0 OR e < length(x))
SELECT source_id, chunk_id, CAST(piece_no - 1 AS INT) AS piece_no, CAST(s AS INT) AS char_start, CAST(e AS INT) AS char_end FROM step WHERE piece_no > 0""".replace("\\\\", "\\")
