"""Detector of pages whose columns a reader would mix up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Share of the page's height that holds its body, and of its width where a gutter may lie.
BODY, GUTTER = (0.10, 0.92), (0.30, 0.70)
BINS, ROWS, LEAST_WORDS, LEAST_A_SIDE, MOST_CROSSED = 100, 40, 20, 15, 0.12


def scrambled_pages(words: DataFrame) -> DataFrame:
    """words(page_id, x0, x1, top, bottom, page_width, page_height) -> page_id, scrambled.

    For each place where a gutter may be: words left and right of it, and the rows that words straddling it take. A word
    is left of all places from one on and right of all up to one, so a page needs counts by place only, and the places it
    straddles are bits, joined row by row before the shuffle.
    Pages with too few words, or without width or height, are never flagged; words with null boxes are left out.
    """
    low, high = int(GUTTER[0] * BINS), int(GUTTER[1] * BINS)
    height = F.col("page_height")
    sound = words.where("x0 is not null and x1 is not null and top is not null and bottom is not null and page_width is not null and page_height is not null")
    body = sound.where((F.col("top") > BODY[0] * height) & (F.col("top") < BODY[1] * height))
    span = body.groupBy("page_id").agg(F.count("*").alias("n"), F.min("top").alias("y0"), F.max("bottom").alias("y1"), F.max("page_width").alias("w"))
    usable = span.where((F.col("n") >= LEAST_WORDS) & (F.col("w") > 0) & (F.col("y1") > F.col("y0")))
    places = F.array(*[F.lit((b + 0.5) / BINS) for b in range(low, high)])
    # how many places lie at or left of a word's end, and left of its beginning
    ends = F.size(F.filter(places, lambda p: p * F.col("w") <= F.col("x1")))
    begins = F.size(F.filter(places, lambda p: p * F.col("w") < F.col("x0")))
    row = F.least(F.lit(ROWS - 1), F.floor((F.col("top") - F.col("y0")) / (F.col("y1") - F.col("y0")) * ROWS))
    placed = body.join(usable, "page_id").select("page_id", row.alias("row"), ends.alias("e"), begins.alias("b"))
    bits = F.expr("shiftleft(1L, e) - shiftleft(1L, b)")
    rows = placed.groupBy("page_id", "row").agg(F.bit_or(F.when(F.col("e") > F.col("b"), bits).otherwise(F.lit(0).cast("bigint"))).alias("crossed"))
    crossed = rows.groupBy("page_id").agg(F.array(*[F.sum(F.expr(f"shiftright(crossed, {i}) & 1")) for i in range(high - low)]).alias("crossed"))
    sided = placed.groupBy("page_id", "e", "b").agg(F.count("*").alias("n")).groupBy("page_id").agg(F.collect_list(F.struct("e", "b", "n")).alias("words"))
    total = lambda keep: F.aggregate(F.filter("words", keep), F.lit(0).cast("bigint"), lambda s, w: s + w["n"])
    hit = F.exists(
        F.sequence(F.lit(0), F.lit(high - low - 1)),
        lambda i: (total(lambda w: w["e"] <= i) >= LEAST_A_SIDE) & (total(lambda w: w["b"] > i) >= LEAST_A_SIDE) & (F.get("crossed", i) / F.lit(ROWS) <= MOST_CROSSED),
    )
    flagged = sided.join(crossed, "page_id").select("page_id", hit.alias("scrambled"))
    return words.select("page_id").distinct().join(flagged, "page_id", "left").select("page_id", F.coalesce("scrambled", F.lit(False)).alias("scrambled"))
