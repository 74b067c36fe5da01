"""File sources, batch and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns of the click CSV table, read as text: trimming on read would also strip the
# leading space that the second field keeps.
CLICK_FIELDS = ("user_name", "url", "ts")


def text_lines(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    return (spark.readStream if streaming else spark.read).text(path)


def click_csv(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """(user_name, url, ts BIGINT) rows; ``ts`` may have blanks around it."""
    raw = T.StructType([T.StructField(name, T.StringType()) for name in CLICK_FIELDS])
    reader = spark.readStream if streaming else spark.read
    return reader.schema(raw).csv(path).withColumn("ts", F.trim("ts").try_cast("bigint"))


def with_event_time(df: DataFrame, ms: str = "ts", delay: str | None = None) -> DataFrame:
    """Add ``et``, the event time cut to seconds, and optionally its watermark."""
    timed = df.withColumn("et", F.timestamp_seconds(F.expr(f"`{ms}` div 1000")))
    return timed.withWatermark("et", delay) if delay else timed


def parquet_stream(spark: SparkSession, path: str, schema: T.StructType | str,
                   files_per_batch: int | None = None) -> DataFrame:
    """An unbounded stream over parquet files, replayable from the start."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
