"""Writers for batch frames and streams.

A writer that changes a store is idempotent by micro-batch id: a batch that runs again after
a failure replaces what its first run wrote.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from eventloom.sinks import shaping


def rolling_text(lines: DataFrame, path: str, checkpoint: str, *, every: str = "5 minutes",
                 max_records: int = 10_000_000) -> DataStreamWriter:
    """Text files that roll by time (one set per trigger) and by size (rows per file)."""
    return (lines.writeStream.format("text").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).option("maxRecordsPerFile", max_records)
            .trigger(processingTime=every))


def rolled(lines: DataFrame, max_bytes: int, column: str = "value") -> DataFrame:
    """Add ``roll``: the lines of a task in order, cut where ``max_bytes`` are reached.

    A running sum of the bytes of each line and its end, batch by batch and without a shuffle,
    says which file of its task a line goes to, so no file is longer than the bound and one line.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = 0
        for batch in batches:
            sizes = pc.add(pc.fill_null(pc.binary_length(batch.column(0)), 0).cast(pa.int64()), 1)
            starts = pc.add(pc.subtract(pc.cumulative_sum(sizes), sizes), before)
            before += pc.sum(sizes).as_py() or 0
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.divide(starts, max_bytes)], [column, "roll"])

    return lines.select(column).mapInArrow(run, f"{column} string, roll bigint")


def rolling_files(lines: DataFrame, path: str, checkpoint: str, *, every: str = "5 minutes",
                  max_bytes: int = 1 << 30) -> DataStreamWriter:
    """Text files that roll by bytes and by time.  A micro-batch finishes its files, so none is
    open for longer than ``every``, be the stream idle or busy; one that runs again after a
    failure replaces what its first run wrote."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (rolled(batch, max_bytes).write.mode("overwrite").partitionBy("roll").text(f"{path}/batch_id={batch_id}"))

    return (lines.writeStream.option("checkpointLocation", checkpoint).trigger(processingTime=every).foreachBatch(write))


def write_text(lines: DataFrame, path: str, max_records: int = 10_000_000) -> None:
    lines.write.option("maxRecordsPerFile", max_records).text(path)


def write_csv(df: DataFrame, path: str, *columns: str) -> None:
    """CSV by position: the columns in the order of the target table, whatever their names.

    Blanks around a value are data and stay.
    """
    (shaping.positional(df, *columns).write.option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))


def console(df: DataFrame, label: str, checkpoint: str) -> DataStreamWriter:
    """Rows on the driver's console, each with a label; for looking at a stream."""
    return (df.select(F.lit(label).alias("label"), *df.columns).writeStream.format("console")
            .option("checkpointLocation", checkpoint).queryName(label))


def jdbc_append(df: DataFrame, url: str, table: str, checkpoint: str, *, batch_size: int = 1_000,
                connections: int = 16, **properties: str) -> DataStreamWriter:
    """Append micro-batches to a database table over at most ``connections`` connections.

    The insert is at least once: the table should have a key, or ``batch_id`` as a column.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.repartition(connections).write.mode("append").format("jdbc")
         .options(url=url, dbtable=table, batchsize=batch_size, **properties).save())

    return df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def with_client(df: DataFrame, open_client: Callable[[], Any], put: Callable[[Any, Iterable[Any]], None],
                close: Callable[[Any], None]) -> None:
    """Send each partition through a client of its own, opened and closed on the executor."""
    def send(rows: Iterator[Any]) -> None:
        client = open_client()
        try:
            put(client, rows)
        finally:
            close(client)

    df.foreachPartition(send)


def document_bulks(docs: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Documents as JSON lines, one folder per index and micro-batch, ready for bulk load."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.select("index_name", F.col("doc").alias("value")).write.mode("overwrite")
         .partitionBy("index_name").text(f"{path}/batch_id={batch_id}"))

    return docs.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


@dataclass(frozen=True)
class KeyedTable:
    """A table where the last write per key wins.

    Each micro-batch adds its newest row per key to a log, so a write costs as much as the
    batch, not as the table.  Reading takes the newest row per key of the last snapshot and
    the log after it; :meth:`compact` writes a new snapshot aside and then publishes where it
    is, in one file, so a reader sees all of it or none.
    """

    root: str
    key: str
    value: str
    version: tuple[str, ...]

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        (shaping.latest_per_key(batch, self.key, self.value, *self.version)
         .write.mode("overwrite").parquet(f"{self.root}/log/batch_id={batch_id}"))

    def writer(self, stream: DataFrame, checkpoint: str) -> DataStreamWriter:
        return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(self.write_batch)

    def _parts(self, spark: SparkSession) -> tuple[DataFrame, int]:
        columns = [self.key, self.value, *self.version]
        log = spark.read.parquet(f"{self.root}/log")
        try:
            last = spark.read.schema("upto long, folder string").parquet(f"{self.root}/published").agg(
                F.max(F.struct("upto", "folder"))).first()[0]
        except AnalysisException:
            last = None
        if last is None:
            return log.select(*columns), -1
        snapshot = spark.read.parquet(f"{self.root}/snapshots/{last['folder']}")
        newer = log.where(F.col("batch_id") > last["upto"]).select(*columns)
        return snapshot.select(*columns).unionByName(newer), last["upto"]

    def latest(self, spark: SparkSession) -> DataFrame:
        return shaping.latest_per_key(self._parts(spark)[0], self.key, self.value, *self.version)

    def compact(self, spark: SparkSession) -> None:
        done = spark.read.parquet(f"{self.root}/log").agg(F.max("batch_id")).first()[0]
        if done > self._parts(spark)[1]:
            folder = uuid.uuid4().hex
            self.latest(spark).write.parquet(f"{self.root}/snapshots/{folder}")
            (spark.createDataFrame([(done, folder)], "upto long, folder string").coalesce(1)
             .write.mode("append").parquet(f"{self.root}/published"))
