"""Rows in the form that external stores take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, key: str, value: str, *version: str) -> DataFrame:
    """Last write per key wins, with map-side aggregation."""
    newest = F.max(F.struct(*version, value)).alias("_v")
    return df.groupBy(key).agg(newest).select(key, *[F.col("_v")[c].alias(c) for c in (value, *version)])


def index_documents(df: DataFrame, index: str, key: str, value: str) -> DataFrame:
    """One document ``{key: value}`` per row for a document index."""
    doc = F.to_json(F.create_map(F.col(key).cast("string"), F.col(value)))
    return df.select(F.lit(index).alias("index_name"), doc.alias("doc"))


def cell_puts(df: DataFrame, row_key: Column, family: str, qualifier: Column, value: str) -> DataFrame:
    """One put per cell of a wide-column store; repeated puts of a cell are one put."""
    return df.select(row_key.cast("string").alias("row_key"), F.lit(family).alias("family"),
                     qualifier.alias("qualifier"), F.lit(value).alias("cell")).distinct()


def positional(df: DataFrame, *columns: str) -> DataFrame:
    """Columns in the order of the target table: the sink inserts by position."""
    return df.select(*columns)
