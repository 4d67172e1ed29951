"""Filling fixed-capacity containers with items (problem 8).

Vector best-fit: a container has capacities of tokens, documents and attention cost (the sum of squared lengths).
Items come largest first; among all open containers that can take an item under every constraint, the one is chosen
whose weighted norm of what stays free is least. An item that no empty container could take, by its tokens or by its
attention cost, is divided into parts of the greatest length that one can; no other item is.

Items are dealt at random to packing groups of at most about GROUP items, each packed by itself in one task: the
number of groups follows the data, and only the last containers of a group are poorly filled (about one in thousands).

Defined results: null and empty texts are items of size 0 and get a container; equal ids are packed as often as they
occur; an empty table gives no rows; capacities below 1 are an error. The result has one row for each document, or for
each part of a divided one.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callmill.common import read, stored
from callmill.llm.encoding import encode_texts

CAPACITY = 2048
#: Documents and attention cost that a container may hold, and the weights of the three free shares in the norm.
MOST_DOCUMENTS, MOST_ATTENTION, WEIGHTS = 256, CAPACITY * CAPACITY, (1.0, 0.02, 0.02)
GROUP = 30_000


def longest_part(capacity: int = CAPACITY, most_attention: int = MOST_ATTENTION) -> int:
    """Tokens that an empty container takes of one item."""
    return min(capacity, math.isqrt(most_attention))


def best_fit(sizes: np.ndarray, capacity: int = CAPACITY, most_documents: int = MOST_DOCUMENTS, most_attention: int = MOST_ATTENTION, weights=WEIGHTS) -> np.ndarray:
    """The container number of each size. Sizes must not exceed longest_part.

    Open containers stand in arrays and are scored all at once; one that can't take the smallest item any more is closed.
    """
    if min(capacity, most_documents, most_attention) < 1:
        raise ValueError("a container must be able to hold one token of one document")
    if len(sizes) and int(sizes.max()) > longest_part(capacity, most_attention):
        raise ValueError("an item that no container can take must be divided first")
    chosen = np.empty(len(sizes), np.int64)
    least, opened, n = int(sizes.min()) if len(sizes) else 0, 0, 0
    number, free, docs, cost = (np.zeros(len(sizes), t) for t in (np.int64, np.float64, np.float64, np.float64))
    of_docs = np.zeros(len(sizes))
    by_tokens, by_cost = weights[0] / capacity**2, weights[2] / most_attention**2
    for i in np.argsort(-sizes, kind="stable"):
        s = float(sizes[i])
        left, spare = free[:n] - s, most_attention - s * s - cost[:n]
        score = np.where((left >= 0) & (spare >= 0), by_tokens * left * left + by_cost * spare * spare + of_docs[:n], np.inf)
        at = int(np.argmin(score)) if n else -1
        if at < 0 or score[at] == np.inf:
            at, n = n, n + 1
            number[at], free[at], docs[at], cost[at] = opened, capacity, 0, 0
            opened += 1
        free[at] -= s
        docs[at] += 1
        cost[at] += s * s
        of_docs[at] = weights[1] * (1 - (docs[at] + 1) / most_documents) ** 2
        chosen[i] = number[at]
        if docs[at] >= most_documents or free[at] < least or cost[at] + least * least > most_attention:
            n -= 1
            for x in (number, free, docs, cost, of_docs):
                x[at] = x[n]
    return chosen


def pack(items: DataFrame, key: str, size: str, capacity: int = CAPACITY, most_documents: int = MOST_DOCUMENTS, most_attention: int = MOST_ATTENTION, weights=WEIGHTS, group: int = GROUP) -> DataFrame:
    """items(key, size) -> key, part_no, token_start, token_end, container_id."""
    longest = longest_part(capacity, most_attention)
    if longest < 1 or most_documents < 1:
        raise ValueError("a container must be able to hold one token of one document")
    items = stored(items.select(F.col(key).cast("bigint").alias(key), F.coalesce(F.col(size), F.lit(0)).cast("int").alias("_n")), "sizes")
    full = longest == capacity
    parts_made = F.lit(1) if full else (F.col("_n") / longest).cast("int") + 1
    groups = max(1, -(-items.agg(F.coalesce(F.sum(parts_made), F.lit(0))).first()[0] // group))
    parts = items.withColumn("_whole", (F.col("_n") / longest).cast("int")).withColumn("_rest", F.col("_n") % longest)
    # a part's identity is its document and number; the document's own hash names the container
    whole = parts.where("_whole > 0").withColumn("part_no", F.explode(F.sequence(F.lit(0), F.col("_whole") - 1)))
    whole = whole.select(key, "part_no", (F.col("part_no") * longest).alias("token_start"), ((F.col("part_no") + 1) * longest).alias("token_end"))
    rest = parts.where("_rest > 0 or _n = 0").select(key, F.col("_whole").alias("part_no"), (F.col("_whole") * longest).alias("token_start"), F.col("_n").alias("token_end"))
    # a part that fills a container needs no packing; one that only uses up its attention leaves tokens to others
    packed = (rest if full else rest.unionByName(whole)).withColumn("_group", F.pmod(F.xxhash64(key, "part_no", F.monotonically_increasing_id()), F.lit(groups)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([key, "part_no"], kind="stable")
        chosen = best_fit((pdf.token_end - pdf.token_start).to_numpy(), capacity, most_documents, most_attention, weights)
        return pdf.assign(container_id=[f"g{g}-{b}" for g, b in zip(pdf._group, chosen)]).drop(columns="_group")

    # by groups, not by bytes: the work is in the packing
    packed = packed.repartition(groups, "_group").groupBy("_group").applyInPandas(run, f"`{key}` bigint, part_no int, token_start int, token_end int, container_id string")
    return packed.unionByName(whole.withColumn("container_id", F.concat(F.lit("w"), F.monotonically_increasing_id()))) if full else packed


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in containers of 2,048 tokens of byte_bpe_50k."""
    sizes = encode_texts(read(spark, sf_dir, "documents"), "doc_id", "text", count_only=True)
    return pack(sizes, "doc_id", "n_tokens")


def p8_limited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same where documents and attention bind: at most 6 documents and a cost of 1,440,000 (1,200 tokens of one document) in a container."""
    sizes = encode_texts(read(spark, sf_dir, "documents"), "doc_id", "text", count_only=True)
    return pack(sizes, "doc_id", "n_tokens", most_documents=6, most_attention=1200 * 1200)
