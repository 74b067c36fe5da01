"""Helpers that the operators share: tables, stored intermediates, ranks and components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.session import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table with the schema that its files have."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: lineage ends here, nothing is
    computed twice, and a lost executor costs no more than its tasks."""
    path = work_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, group: str, order: list[Column], bucket: str, rank: str) -> DataFrame:
    """Add ``rank``: the 0-based place of each row in its group, by (bucket, order).

    A group of any size is spread over its buckets: rows are numbered inside (group, bucket),
    and the counts of the earlier buckets are added.  ``group`` must not be null.
    """
    offset, size = free_names(df, "offset_", "size_")
    counts = df.groupBy(group, bucket).agg(F.count("*").alias(size))
    before = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(group, bucket, F.coalesce(F.sum(size).over(before), F.lit(0)).alias(offset))
    inside = Window.partitionBy(group, bucket).orderBy(*order)
    return (df.join(starts, [group, bucket])
            .withColumn(rank, F.col(offset) + F.row_number().over(inside) - 1).drop(offset))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Cut a stream of batches, sorted by ``keys``, into one table for each key."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        rows = list(zip(*cols))
        start = 0
        for i, row in enumerate(rows):
            if row != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, row
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component) of an undirected graph given as ``a``, ``b``; component is the
    smallest node that can be reached.

    Contraction: every node is replaced by the neighbour (or itself) that comes first in a
    pseudo-random order, until no edge is left.  That takes a logarithmic number of rounds
    whatever the shape; each round is written, and nothing but a yes or no comes to the
    driver.  Loops and repeated edges are allowed.
    """
    spark = edges.sparkSession
    first = F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("id"))
    own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("id"))
    live = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                  .where("a < b").distinct(), f"{label}-edges")
    steps: list[DataFrame] = []
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = stored(both.groupBy("a").agg(F.min(first).alias("n"))
                    .select(F.col("a").alias("node"), F.least("n", own)["id"].alias("up")), f"{label}-up")
        steps.append(up)
        left = up.select(F.col("node").alias("a"), F.col("up").alias("x"))
        right = up.select(F.col("node").alias("b"), F.col("up").alias("y"))
        live = stored(live.join(left, "a").join(right, "b")
                      .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                      .where("a < b").distinct(), f"{label}-edges")
    if not steps:
        return spark.createDataFrame([], "node BIGINT, component BIGINT")
    names = steps[0]
    for step in steps[1:]:
        later = step.select(F.col("node").alias("up"), F.col("up").alias("later"))
        names = (names.join(later, "up", "left")
                 .select("node", F.coalesce("later", "up").alias("up")))
    least = names.groupBy("up").agg(F.min("node").alias("component"))
    return names.join(least, "up").select("node", "component")
