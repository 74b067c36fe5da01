"""Start streams over stored events, run them to the end of the input, read what they wrote."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from eventloom.session import stream_session, work_dir
from eventloom.sources.files import parquet_stream
from eventloom.sources.tables import EVENTS_SCHEMA, as_clicks


def click_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The click log as a stream.  Without ``files_per_batch`` the first micro-batch takes
    all files that are there, so the order of the files does not matter."""
    return as_clicks(parquet_stream(spark, path, EVENTS_SCHEMA, files_per_batch))


def events_path(sf_dir: str) -> str:
    """The stored events, be they one file or a folder: a file stream takes a single file
    only as a glob, and this one matches nothing else."""
    return f"{sf_dir}/events.parque[t]"


def finish(writer: DataStreamWriter) -> None:
    """Process everything available, then the trailing batch that fires what is due."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()


def append_to_table(df: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
    """Exactly-once file sink for results that never change."""
    return (df.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).option("path", out))


def batches_to_table(df: DataFrame, out: str, checkpoint: str, mode: str,
                     shape: Callable[[DataFrame], DataFrame] = lambda b: b,
                     step: Callable[[DataFrame, int, str], DataFrame] | None = None) -> DataStreamWriter:
    """Write each micro-batch to its own folder; a repeated batch overwrites itself.

    A ``step`` also gets the number of the micro-batch and a folder for what it keeps.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        rows = step(batch, batch_id, f"{checkpoint}-kept") if step else shape(batch)
        rows.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    return (df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write))


ROWS_PER_SLICE = 20_000_000
# Up to here a table that gets a closing row is copied into one file.
ROWS_PER_FILE = 1_000_000
# How far the closing row lies past the newest event; longer than any window, gap or wait.
CLOSING_AFTER = timedelta(days=3650)


def _in_order(spark: SparkSession, folder: str) -> bool:
    """Give the files of a folder, by name, rising modification times, the order in which a
    file stream takes them; false where the store cannot."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = sorted((f.getPath().getName(), f.getPath(), f.getModificationTime()) for f in fs.listStatus(path)
                   if f.getPath().getName().startswith("part-"))
    first = max((t for _, _, t in found), default=0) // 1000 * 1000 - 1000 * len(found)
    for i, (_, file, _) in enumerate(found):
        fs.setTimes(file, first + 1000 * i, -1)
    return all(fs.getFileStatus(file).getModificationTime() == first + 1000 * i for i, (_, file, _) in enumerate(found))


def _laid_out(stored: DataFrame, folder: str, slices: int, order: str | Column, closing: DataFrame | None) -> bool:
    """One file for each slice of the rows, in ``order``, and one for the closing row, as a
    stream can take them one by one; false where the store cannot keep their order."""
    spark = stored.sparkSession
    cut = stored.repartitionByRange(slices, order) if slices > 1 else stored.coalesce(1)
    cut.write.parquet(folder)
    if not _in_order(spark, folder):
        return False
    if closing is not None:
        closing.coalesce(1).write.mode("append").parquet(folder)  # newer than all others
    return True


def _slices(stored: DataFrame, folder: str, slices: int, order: str | Column) -> list[DataFrame]:
    """Consecutive slices of the rows, in ``order``, stored by one job, in which all cores of the
    cluster write at each slice."""
    spark = stored.sparkSession
    files = spark.sparkContext.defaultParallelism
    (stored.repartitionByRange(slices * files, order)
     .withColumn("slice", F.floor(F.spark_partition_id() / files).cast("int"))
     .write.partitionBy("slice").parquet(folder))
    found = spark.read.parquet(folder).select("slice").distinct().collect()
    return [spark.read.schema(stored.schema).parquet(f"{folder}/slice={i}") for i in sorted(r[0] for r in found)]


def replay(spark: SparkSession, job: Callable[[DataFrame], DataFrame], path: str, *,
           files_per_batch: int | None = None, rows_per_slice: int = ROWS_PER_SLICE, order: str | Column = "ts",
           mode: str = "append", closing: str | None = None, shape: Callable[[DataFrame], DataFrame] | None = None,
           step: Callable[[DataFrame, int, str], DataFrame] | None = None, restarts: bool = False) -> DataFrame:
    """Run ``job`` over the click stream at ``path`` and return what it emitted.

    A keyed processor sees all rows that a micro-batch has for a key at once, so the size of
    a micro-batch bounds its memory whatever the key skew.  With ``files_per_batch`` the
    stored files must be in time order and are taken that many at a time.  Otherwise a table
    above ``rows_per_slice`` rows is first laid out, by one job, as a file for each slice of about
    that size, and one stream takes them one by one; a smaller one is one micro-batch.
    Slices follow ``order``: ``ts`` for event-time jobs, so that no row is late, and
    ``event_id`` for arrival jobs, so that rows come in the order in which they arrived.
    With ``restarts``, or where the store cannot keep the order of files, slices are added one
    after the other, and the stream is started anew for each and goes on from its checkpoint.

    The input is finite, so with ``closing`` a row of that kind, far past the newest event,
    follows in a micro-batch of its own.  It lifts the watermark past every window, session,
    timer and wait; its own window or wait never ends, so it leaves no row in the result.
    The kind must pass the job's filters.  Not for jobs that emit rows as they come or tick
    for ever: they have nothing that closes.

    With ``shape``, ``step`` or another mode than append the result has ``batch_id``.
    """
    session = stream_session(spark)
    appends = mode == "append" and shape is None and step is None
    folder = work_dir(spark, "replay")
    out, checkpoint, end = f"{folder}/out", f"{folder}/checkpoint", f"{folder}/closing"

    def start(source: str, files: int | None, more: str | None = None) -> DataFrame:
        stream = click_stream(session, source, files)
        if more is not None:
            stream = stream.unionByName(click_stream(session, more))
        result = job(stream)
        if appends:
            finish(append_to_table(result, out, checkpoint))
        else:
            finish(batches_to_table(result, out, checkpoint, mode, shape or (lambda b: b), step))
        return result

    stored = spark.read.schema(EVENTS_SCHEMA).parquet(path)
    rows, newest = stored.agg(F.count("*"), F.max("ts")).first()
    last = None
    if closing is not None and newest is not None:
        last = spark.createDataFrame([(-1, newest + CLOSING_AFTER, -1, closing, None, None)], EVENTS_SCHEMA)
    slices = 1 if files_per_batch else max(1, -(-rows // rows_per_slice))
    copied = not files_per_batch and not restarts and (slices > 1 or (last is not None and rows <= ROWS_PER_FILE))
    if copied and _laid_out(stored, f"{folder}/source", slices, order, last):
        result = start(f"{folder}/source", 1)
    else:
        more = end if last is not None else None
        if more is not None:
            spark.createDataFrame([], EVENTS_SCHEMA).write.parquet(end)
        if slices == 1:
            source, result = path, start(path, files_per_batch, more)
        else:
            source = f"{folder}/grown"
            for part in _slices(stored, f"{folder}/stage", slices, order):
                part.write.mode("append").parquet(source)
                result = start(source, None, more)
        if last is not None:
            last.write.mode("append").parquet(end)
            result = start(source, files_per_batch, more)
    if appends:
        return spark.read.schema(result.schema).parquet(out)
    return spark.read.parquet(out)


def replay_log(spark: SparkSession, log: DataFrame, ms: str, step: Callable[[DataFrame, int, str], DataFrame], *,
               closing: dict[str, object], rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Run ``step`` over the micro-batches of a log that is not stored yet, in the order of its
    time ``ms``, and return what it emitted, with ``batch_id``.

    The log is stored once and laid out as in :func:`replay`, but with a file for each core
    of the cluster in a slice.  A row ``closing``, far past the newest one, follows at the end;
    what it opens itself never comes out.
    """
    session = stream_session(spark)
    folder = work_dir(spark, "replay")
    log.write.parquet(f"{folder}/stored")
    stored = spark.read.schema(log.schema).parquet(f"{folder}/stored")
    rows, newest = stored.agg(F.count("*"), F.max(ms)).first()
    if newest is None:  # nothing to take in order
        return step(stored, 0, f"{folder}/checkpoint-kept").withColumn("batch_id", F.lit(0))
    row = {**closing, ms: newest + CLOSING_AFTER // timedelta(milliseconds=1)}
    last = spark.createDataFrame([tuple(row[c] for c in log.columns)], log.schema)
    slices = max(1, -(-rows // rows_per_slice))
    files = spark.sparkContext.defaultParallelism

    def start(source: str, most: int | None) -> None:
        stream = parquet_stream(session, source, log.schema, most)
        finish(batches_to_table(stream, f"{folder}/out", f"{folder}/checkpoint", "append", step=step))

    if _laid_out(stored, f"{folder}/source", slices * files, ms, last):
        start(f"{folder}/source", files)
    else:
        for part in [*_slices(stored, f"{folder}/stage", slices, ms), last]:
            part.write.mode("append").parquet(f"{folder}/grown")
            start(f"{folder}/grown", None)
    return spark.read.parquet(f"{folder}/out")


def write_slices(events: DataFrame, folder: str, order: str, n: int) -> None:
    """Cut stored events into ``n`` consecutive slices, one file each, oldest file first.

    For tests: the bounds come from equal steps of ``order``.
    """
    lo, hi = events.agg(F.min(order), F.max(order)).first()
    step = (hi - lo) // n + 1
    for i in range(n):
        part = events.where((F.col(order) >= lo + i * step) & (F.col(order) < lo + (i + 1) * step))
        part.coalesce(1).write.mode("append").parquet(folder)
