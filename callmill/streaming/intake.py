"""Continuous intake of delivered rows: late and repeated deliveries, windows, and incremental tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def deliveries(spark: SparkSession, path: str, schema: StructType, files_at_once: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(path)


def first_deliveries(stream: DataFrame, key: str, at: str = "loaded_at", late: str = "7 days") -> DataFrame:
    """Each key once, its first delivery; state is kept as long as a repeat may come. Null keys are dropped as no delivery."""
    return stream.where(F.col(key).isNotNull()).withWatermark(at, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, by: str, at: str = "loaded_at", every: str = "1 day", late: str = "7 days") -> DataFrame:
    """Rows by window and label; null labels count as (none)."""
    kept = stream if stream.isStreaming is False else stream.withWatermark(at, late)
    return kept.groupBy(F.window(at, every), F.coalesce(by, F.lit("(none)")).alias(by)).agg(F.count("*").alias("n")).select(F.col("window.start").alias("day"), by, "n")


def keep_table(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends to a parquet table until all that is there is read."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
