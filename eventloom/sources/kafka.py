"""Message-topic source and sink.  The connector jar must be on the cluster's class path."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter


def source_options(servers: str, topic: str, group: str | None = None, start: str = "latest") -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": start}
    if group:
        options["kafka.group.id"] = group
    return options


def read_topic(spark: SparkSession, servers: str, topic: str, group: str | None = None) -> DataFrame:
    return decode(spark.readStream.format("kafka").options(**source_options(servers, topic, group)).load())


def decode(records: DataFrame) -> DataFrame:
    """Binary key and value to text."""
    return records.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"))


def as_records(df: DataFrame, key: Column, value: Column) -> DataFrame:
    return df.select(key.cast("string").alias("key"), value.cast("string").alias("value"))


def write_topic(records: DataFrame, servers: str, topic: str, checkpoint: str) -> DataStreamWriter:
    return (records.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("topic", topic).option("checkpointLocation", checkpoint))
