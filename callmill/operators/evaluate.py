"""Comparison of calls with a ground truth, and presentation columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def agreement(calls: DataFrame, truth: DataFrame, keys: list[str], view: str = "call_view") -> DataFrame:
    """One row: matched, agreeing, opposite, missed and extra keys. Both sides are unique by key; null keys match nothing."""
    a, b = calls.select(*keys, F.col(view).alias("_a")), truth.select(*keys, F.col(view).alias("_b"))
    x = a.withColumn("_in_a", F.lit(1)).join(b.withColumn("_in_b", F.lit(1)), keys, "full")
    both = F.col("_in_a").isNotNull() & F.col("_in_b").isNotNull()
    opposite = both & (F.concat_ws("", "_a", "_b").isin("OU", "UO"))
    count = lambda c, name: F.coalesce(F.sum(c.cast("int")), F.lit(0)).cast("bigint").alias(name)
    return x.agg(
        count(both, "matched"), count(both & (F.col("_a") == F.col("_b")), "agreeing"), count(opposite, "opposite"), count(F.col("_in_a").isNull(), "missed"), count(F.col("_in_b").isNull(), "extra"),
        count(both & (F.col("_a") == "UNCERTAIN"), "abstained"),
    )


def quotes(calls: DataFrame, passed: str) -> DataFrame:
    """One row: calls, those with a quote that the check has judged, and those whose quote is in its source."""
    return calls.agg(F.count("*").alias("calls"), F.count(passed).alias("judged"), F.coalesce(F.sum(F.col(passed).cast("int")), F.lit(0)).cast("bigint").alias("verbatim"))


def leaf_matches(calls: DataFrame, truth: DataFrame, firm: str, leaf: str) -> DataFrame:
    """firm, truth_leaves, found: of each firm's leaves in the truth, how many the calls name. Null firms and leaves match nothing."""
    named = calls.select(firm, leaf).where(F.col(leaf).isNotNull()).distinct().withColumn("_named", F.lit(1))
    return truth.select(firm, leaf).distinct().join(named, [firm, leaf], "left").groupBy(firm).agg(F.count(leaf).alias("truth_leaves"), F.count("_named").alias("found"))


def one_hot(view: Column) -> list[Column]:
    return [F.coalesce((view == v).cast("int"), F.lit(0)).alias(n) for v, n in (("U", "uw"), ("N", "n"), ("O", "ow"))]


def conflict_ledger(calls: DataFrame, leaf: str, view: str, idx: str) -> DataFrame:
    """leaf, ledger of its views in order, status: CONFLICT where they differ."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(idx), F.coalesce(view, F.lit("")).alias("v"))))
    x = calls.groupBy(leaf).agg(F.array_join(F.transform(listed, lambda c: c["v"]), ",").alias("ledger"), F.countDistinct(view).alias("_n"))
    return x.withColumn("status", F.when(F.col("_n") > 1, "CONFLICT").otherwise("OK")).drop("_n")
