"""Counts over growing folders: an addition to the batch operators, with the same results once all files are seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_parquet(spark: SparkSession, path: str, schema: str, files: int = 10) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def read_counts(stream: DataFrame, *keys: str) -> DataFrame:
    """Running number of rows for each key combination (complete or update mode)."""
    return stream.groupBy(*keys).agg(F.count("*").alias("reads"))


def windowed_counts(stream: DataFrame, ts: str, length: str, late: str, *keys: str) -> DataFrame:
    """(start, keys, n): rows in each time window; rows later than `late` are left out and closed windows forgotten."""
    w = F.window(ts, length)
    return stream.withWatermark(ts, late).groupBy(w.alias("_w"), *keys).agg(F.count("*").alias("n")).select(F.col("_w.start").alias("start"), *keys, "n")


def to_memory(df: DataFrame, name: str, mode: str = "complete") -> StreamingQuery:
    return df.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
