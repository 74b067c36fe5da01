"""Sinks that commit, roll and compact, and streams that fail inside a micro-batch."""

import os
from dataclasses import dataclass
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventloom.operators import aggregates, windows
from eventloom.session import stream_session
from eventloom.sinks import committed, writers
from eventloom.sources.tables import EVENTS_SCHEMA, as_clicks
from eventloom.streaming import jobs, kept, processors
from eventloom.streaming.replay import batches_to_table, click_stream, finish, replay
from tests.fixtures import SHIFT, rows

HOUR = 3_600_000


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """400 events, nine in ten of one user, with gaps."""
    data, ms = [], SHIFT
    for i in range(400):
        ms += 7 * HOUR if i % 40 == 0 else (i * 7919) % 900_000
        data.append((i, ms, i % 7 if i % 10 == 0 else 99, "click" if i % 2 else "view", 1.0))
    df = spark.createDataFrame(data, "event_id long, ms long, user_id long, event_type string, value double").select(
        "event_id", F.timestamp_millis("ms").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value",
        F.lit("{}").alias("props"))
    path = str(tmp_path_factory.mktemp("events") / "events")
    df.write.parquet(path)
    return path, as_clicks(spark.read.schema(EVENTS_SCHEMA).parquet(path)).cache()


@dataclass
class FailsOnce(committed.JsonFolder):
    """A store one of whose tasks breaks off in the middle of its rows, the first time."""

    root: str
    marker: str

    def stage(self, rows):
        def some():
            for i, row in enumerate(rows):
                if i == 5 and not os.path.exists(self.marker):
                    Path(self.marker).touch()
                    raise OSError("lost")
                yield row
        return super().stage(some())


def test_a_failed_task_leaves_no_half_write(spark, stored, tmp_path):
    store = FailsOnce(str(tmp_path / "store"), str(tmp_path / "marker"))
    session = stream_session(spark)

    def go():
        cells = click_stream(session, stored[0]).repartition(4).select("seq", "user_id", "url")
        finish(committed.writer(cells, store, str(tmp_path / "checkpoint")))

    schema = "seq long, user_id long, url string"
    with pytest.raises(PySparkException):
        go()
    assert store.read(spark, schema).count() == 0 and os.path.exists(store.marker)
    go()
    assert rows(store.read(spark, schema), "seq", "user_id", "url") == rows(stored[1], "seq", "user_id", "url")
    store.sweep(3600)
    assert store.read(spark, schema).count() == 400
    store.sweep(0)  # what other tasks had staged before the failure
    staged = sorted(p.stem for p in (tmp_path / "store" / "rows").glob("*.json"))
    assert staged == sorted(store.published()) and len(staged) == 4
    store.publish(0, staged)  # a micro-batch that is published again replaces itself
    assert store.read(spark, schema).count() == 400


def test_files_roll_by_bytes(spark, tmp_path):
    lines = spark.range(3000, numPartitions=3).select(
        F.when(F.col("id") % 100 == 7, F.repeat(F.lit("é"), 700)).when(F.col("id") % 50 == 3, "")
        .otherwise(F.concat(F.lit("line "), F.col("id"))).alias("value"))
    lines.write.parquet(str(tmp_path / "in"))
    stream = stream_session(spark).readStream.schema("value string").parquet(str(tmp_path / "in"))
    finish(writers.rolling_files(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"), max_bytes=2000))
    sizes = [p.stat().st_size for p in (tmp_path / "out").rglob("part-*")]
    assert len(sizes) > 20 and max(sizes) <= 2000 + 1401
    assert sum(s >= 2000 - 1401 for s in sizes) >= len(sizes) - 8  # all but the last of each task are full
    assert rows(spark.read.text(str(tmp_path / "out")), "value") == rows(lines, "value")


def test_a_snapshot_appears_at_once(spark, tmp_path):
    table = writers.KeyedTable(str(tmp_path / "t"), "k", "v", ("ver",))
    schema = "k long, v string, ver long"
    table.write_batch(spark.createDataFrame([(1, "a", 1), (2, "b", 1)], schema), 0)
    table.compact(spark)
    table.write_batch(spark.createDataFrame([(1, "c", 2)], schema), 1)
    want = [(1, "c", 2), (2, "b", 1)]
    assert rows(table.latest(spark), "k", "v", "ver") == want
    # A snapshot that is written but not published is not seen.
    spark.createDataFrame([(7, "x", 9)], schema).write.parquet(str(tmp_path / "t/snapshots/half"))
    assert rows(table.latest(spark), "k", "v", "ver") == want
    table.compact(spark)
    table.compact(spark)
    assert rows(table.latest(spark), "k", "v", "ver") == want


def test_a_stream_that_fails_inside_a_micro_batch(spark, stored, tmp_path):
    """The second micro-batch fails after it has written half of its output and used its state."""
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    events = spark.read.schema(EVENTS_SCHEMA).parquet(stored[0])
    session, failed = stream_session(spark), []

    def step(batch, batch_id, folder):
        if batch_id == 1 and not failed:
            failed.append(batch.count())
            batch.limit(3).write.parquet(f"{out}/batch_id=1")
            raise RuntimeError("lost")
        return batch

    def go():
        counted = jobs.stateful(click_stream(session, source).select("seq", "user_id"), "user_id", processors.RunningCount())
        finish(batches_to_table(counted, out, checkpoint, "append", step=step))

    for lo, hi in ((0, 150), (150, 300), (300, 400)):
        events.where((F.col("event_id") >= lo) & (F.col("event_id") < hi)).coalesce(1).write.mode("append").parquet(source)
        try:
            go()
        except PySparkException:
            assert lo == 150 and failed == [150]
            go()
    want = aggregates.running_count(stored[1].select("seq", "user_id"), ["user_id"])
    assert failed and rows(spark.read.parquet(out), "seq", "user_id", "cnt") == rows(want, "seq", "user_id", "cnt")


@pytest.mark.parametrize("batches", [1, 5])
def test_streamed_sessions_of_a_hot_key(spark, stored, batches):
    out = replay(spark, lambda s: s.select("seq", "user_id", "ts_ms"), stored[0], rows_per_slice=-(-400 // batches),
                 closing="click", step=kept.sessions("user_id", 2 * HOUR))
    want = windows.sessions(stored[1], ["user_id"], 2 * HOUR)
    columns = ("user_id", "window_start", "window_end", "cnt")
    assert rows(out, *columns) == rows(want, *columns)


@pytest.mark.parametrize("bound", [5, 4_000_000])
def test_partial_sessions_merge_to_whole_ones(stored, bound):
    """Rows dealt to parts by their number: parts of a session overlap, touch and enclose each other."""
    parts = None
    for i in range(5):
        own = windows.sessions(stored[1].where(F.col("seq") % 5 == i), ["user_id"], HOUR)
        parts = own if parts is None else parts.unionByName(own)
    columns = ("user_id", "window_start", "window_end", "cnt")
    out = windows.merged_sessions(parts, ["user_id"], rows_per_chunk=bound)
    assert rows(out, *columns) == rows(windows.sessions(stored[1], ["user_id"], HOUR), *columns)
