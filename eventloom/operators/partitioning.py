"""Redistribution of rows that the user asks for."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.session import BYTES_PER_PARTITION, input_bytes


def partitions_for(df: DataFrame) -> int:
    """As many partitions as a shuffle has at least, and one per 128 MB of the input."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-input_bytes(df) // BYTES_PER_PARTITION))


def per_partition(df: DataFrame, **measures: Column) -> DataFrame:
    """One row for each partition that holds rows: its number, its size and ``measures``."""
    return df.groupBy(F.spark_partition_id().alias("partition")).agg(
        F.count(F.lit(1)).alias("n"), *[m.alias(name) for name, m in measures.items()])


def by_key(df: DataFrame, n: int, *keys: str) -> DataFrame:
    return df.repartition(n, *keys)


def scattered(df: DataFrame, n: int, seed_column: str) -> DataFrame:
    """Pseudo-random spread.  A hash of a row column, not ``rand``: a task that runs again
    after an executor is lost must send every row to the same place."""
    return df.repartition(n, F.xxhash64(F.lit("spread"), F.col(seed_column)))


def round_robin(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n)


def rescaled(df: DataFrame, n: int) -> DataFrame:
    """Merge neighbouring partitions without a shuffle."""
    return df.coalesce(n)


def replicated(df: DataFrame, n: int) -> DataFrame:
    """Every row once for each of ``n`` receivers."""
    return df.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))


def custom(df: DataFrame, n: int, partition_id: Column) -> DataFrame:
    """Rows go to exactly the partition that ``partition_id`` names."""
    return df.repartitionById(n, partition_id.cast("int"))


def total_order(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """One global sequence over many partitions: partition i holds only rows before those
    of partition i + 1.  It stands in for sending every row to a single task."""
    return df.repartitionByRange(n, *columns).sortWithinPartitions(*columns)
