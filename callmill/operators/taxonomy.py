"""The locked taxonomy: integrity, lookup and outline.

Nulls never match a leaf. An empty taxonomy is reported as such, and looks up nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callmill.common import broadcast_if_small

COLUMNS = ("leaf_no", "sub_asset_class", "asset_class_category", "asset_class", "canva_groupings")
LEAVES = 396


def integrity(taxonomy: DataFrame, expected: int | None = LEAVES) -> DataFrame:
    """One row: leaves, different numbers and labels, blank fields, and whether all is as it must be."""
    blank = F.greatest(*[F.when(F.col(c).isNull() | (F.col(c).cast("string") == ""), 1).otherwise(0) for c in COLUMNS])
    found = taxonomy.agg(
        F.count("*").alias("leaves"), F.countDistinct("leaf_no").alias("numbers"), F.countDistinct("sub_asset_class").alias("labels"), F.coalesce(F.sum(blank), F.lit(0)).cast("bigint").alias("blank_rows")
    )
    sound = (F.col("numbers") == F.col("leaves")) & (F.col("labels") == F.col("leaves")) & (F.col("blank_rows") == 0)
    return found.withColumn("sound", sound & (F.col("leaves") == expected) if expected else sound)


def lookup(rows: DataFrame, taxonomy: DataFrame, label: str) -> DataFrame:
    """rows with the taxonomy's fields where the label is a leaf exactly, else nulls. Clashing names are taken from the taxonomy."""
    fields = [c for c in COLUMNS if c != "sub_asset_class"]
    side = taxonomy.select(F.col("sub_asset_class").alias("_leaf"), *[F.col(c) for c in fields])
    return rows.drop(*fields).join(broadcast_if_small(side), F.col(label) == F.col("_leaf"), "left").drop("_leaf")


def unknown_labels(rows: DataFrame, taxonomy: DataFrame, label: str) -> DataFrame:
    """Labels that are no leaf, with their number of rows."""
    counts = rows.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label")).agg(F.count("*").alias("n"))
    return counts.join(broadcast_if_small(taxonomy.select(F.col("sub_asset_class").alias("label"))), "label", "left_anti")


def outline(taxonomy: DataFrame) -> DataFrame:
    """leaf_no, block: the outline's lines in order, with a heading where class or category changes.

    The window has no partition: a taxonomy is a dimension of a few hundred rows, and more is refused.
    """
    if taxonomy.limit(100_001).count() > 100_000:
        raise ValueError("an outline is made of a taxonomy, not of data")
    by = Window.orderBy("leaf_no")
    prior_class, prior_category = F.lag("asset_class").over(by), F.lag("asset_class_category").over(by)
    new_class = prior_class.isNull() | (prior_class != F.col("asset_class"))
    new_category = new_class | (prior_category != F.col("asset_class_category"))
    heads = F.concat(F.when(new_class, F.concat(F.lit("## "), "asset_class", F.lit("\n"))).otherwise(F.lit("")), F.when(new_category, F.concat(F.lit("### "), "asset_class_category", F.lit("\n"))).otherwise(F.lit("")))
    return taxonomy.select("leaf_no", F.concat(heads, F.lit("- "), "sub_asset_class").alias("block"))
