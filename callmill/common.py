"""Session, storage and join helpers that every operator shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DatetimeType, NumericType, StringType

#: Rows up to which a table may be broadcast; larger ones are shuffled.
BROADCAST_ROWS = 100_000
#: Bytes of its values up to which a table may be broadcast.
BROADCAST_BYTES = 16_000_000
#: Spark's setting by which a finished write drops its shuffle files.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset, a local session gets a new one and a cluster an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="callmill-"))
        found = spark.sparkContext.getCheckpointDir()
    return found.rstrip("/")


#: Folders that stored() has written in this process and release() has not removed.
_WRITTEN: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read again: cuts lineage and survives lost executors.

    The shuffle files of the write go with it, since nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    _WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Removes what stored() has written in this process; for a caller that has read all results made of it. Gives the number of folders."""
    done = 0
    while _WRITTEN:
        where = spark._jvm.org.apache.hadoop.fs.Path(_WRITTEN.pop())
        done += bool(where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True))
    return done


def small(df: DataFrame, limit: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> bool:
    """True where df has at most limit rows and its texts and arrays at most most_bytes; reads no more than limit + 1 rows."""
    wide = [F.octet_length(F.to_json(F.struct(c))) if not isinstance(t, (StringType, BinaryType)) else F.octet_length(c) for c, t in ((f.name, f.dataType) for f in df.schema) if not isinstance(t, (NumericType, BooleanType, DatetimeType))]
    size = sum((F.coalesce(w, F.lit(0)).cast("bigint") for w in wide), F.lit(16 * len(df.columns)).cast("bigint"))
    found = df.limit(limit + 1).select(size.alias("_size")).agg(F.count("*").alias("n"), F.coalesce(F.sum("_size"), F.lit(0)).alias("b")).first()
    return found.n <= limit and found.b <= most_bytes


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    return F.broadcast(df) if small(df, limit) else df


def once(df: DataFrame, *keys: str) -> DataFrame:
    """One row for each key. Re-delivered rows have equal contents, so any of them serves; null keys are kept apart by value."""
    return df.dropDuplicates(list(keys))


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """left with right's other columns where the keys are equal or both null."""
    side = right.withColumnsRenamed({k: f"_same_{k}" for k in keys})
    match = [F.col(k).eqNullSafe(F.col(f"_same_{k}")) for k in keys]
    return left.join(side, match, how).drop(*[f"_same_{k}" for k in keys])


def salted_lookup(rows: DataFrame, lookup: DataFrame, key: str, by: Column, salts: int = 16, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Left join to a lookup that is unique by key; rows of a hot key are spread over salts by their own value `by`.

    A lookup of at most broadcast_rows rows is broadcast, which suits short values only: pass 0 where it holds texts.
    The lookup is repeated `salts` times; with salts of 1 it isn't, and adaptive execution splits hot partitions.
    """
    if broadcast_rows and small(lookup, broadcast_rows):
        return rows.join(F.broadcast(lookup), key, "left")
    if salts == 1:
        return rows.join(lookup, key, "left")
    left = rows.withColumn("_salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    right = lookup.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
    return left.join(right, [key, "_salt"], "left").drop("_salt")


def numbered(df: DataFrame, *order: str, name: str = "idx") -> DataFrame:
    """df with its rows' places, from 0, in the order of the columns: ranges are numbered apart and shifted by what lies before.

    Rows that tie in all columns are numbered in any order. Only the ranges' sizes are gathered.
    """
    ranged = stored(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_size"))
    before = sizes.withColumn("_before", F.sum("_size").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)))
    local = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    placed = ranged.withColumn("_local", local).join(F.broadcast(before.select("_range", "_before")), "_range")
    return placed.withColumn(name, (F.col("_local") + F.coalesce("_before", F.lit(0))).cast("bigint")).drop("_range", "_local", "_before")
