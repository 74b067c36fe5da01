"""Sinks and file sources: write the whole result, read it back, compare."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions import scalar
from eventloom.operators import elementwise
from eventloom.plans.catalog import ORACLES, query
from eventloom.session import stream_session, work_dir
from eventloom.sinks import committed, shaping, writers
from eventloom.sources import files
from eventloom.sources.tables import clicks, table
from eventloom.streaming.replay import click_stream, events_path, finish


def _event_text():
    return scalar.event_text(F.col("user_id").cast("string"), F.col("url"), F.col("ts_ms"))


@query("sink_text", f"SELECT line FROM ({ORACLES['event_string']})", "")
def sink_text(spark, sf):
    """Event text through the rolling text sink of a stream."""
    folder = work_dir(spark, "text")
    lines = click_stream(stream_session(spark), events_path(sf)).select(_event_text().alias("value"))
    finish(writers.rolling_text(lines, f"{folder}/out", f"{folder}/checkpoint", max_records=1_000_000))
    return spark.read.text(f"{folder}/out").withColumnRenamed("value", "line")


@query("sink_rolling_files", f"SELECT line FROM ({ORACLES['event_string']})", "")
def sink_rolling_files(spark, sf):
    """Event text through the sink that rolls by bytes."""
    folder = work_dir(spark, "rolling")
    lines = click_stream(stream_session(spark), events_path(sf)).select(_event_text().alias("value"))
    finish(writers.rolling_files(lines, f"{folder}/out", f"{folder}/checkpoint"))
    return spark.read.text(f"{folder}/out").select(F.col("value").alias("line"))


@query("sink_cells", ORACLES["cell_puts"], "")
def sink_cells(spark, sf):
    """Cells of a wide-column store through a sink with a commit protocol; the last batch of a cell counts."""
    folder = work_dir(spark, "cells")
    cells = click_stream(stream_session(spark), events_path(sf)).select(
        F.col("user_id").cast("string").alias("row_key"), F.lit("info").alias("family"), F.col("url").alias("qualifier"),
        F.lit("1").alias("cell"))
    store = committed.JsonFolder(f"{folder}/store")
    finish(committed.writer(cells, store, f"{folder}/checkpoint"))
    return store.read(spark, "row_key string, family string, qualifier string, cell string").distinct()


@query("sink_csv", "SELECT user_id AS url, url AS user_name FROM clicks")
def sink_csv(spark, sf):
    """A positional insert of (user_id, url) into a table declared (url, user_name)."""
    folder = work_dir(spark, "csv")
    writers.write_csv(clicks(spark, sf), folder, "user_id", "url")
    return spark.read.schema("url bigint, user_name string").csv(folder)


@query("source_text", ORACLES["word_count"], "")
def source_text(spark, sf):
    """Word count over the lines of text files, into which all documents were written."""
    folder = work_dir(spark, "lines")
    writers.write_text(table(spark, sf, "documents").where("text IS NOT NULL").select(F.col("text").alias("value")), folder)
    return elementwise.tokens(files.text_lines(spark, folder), "value").groupBy("word").agg(F.sum("one").alias("cnt"))


@query("source_csv", "SELECT CAST(user_id AS VARCHAR) AS user_name, url, ts_ms AS ts FROM clicks")
def source_csv(spark, sf):
    """The click log as a CSV table of (user_name, url, ts), read by its declared fields."""
    folder = work_dir(spark, "clicks")
    writers.write_csv(clicks(spark, sf), folder, "user_id", "url", "ts_ms")
    return files.click_csv(spark, folder)


@query("sink_keyed_table", ORACLES["upsert_latest"], "")
def sink_keyed_table(spark, sf):
    folder = work_dir(spark, "keyed")
    table = writers.KeyedTable(f"{folder}/table", "user_id", "url", ("ts_ms", "seq"))
    stream = click_stream(stream_session(spark), events_path(sf)).select("user_id", "url", "ts_ms", "seq")
    finish(table.writer(stream, f"{folder}/checkpoint"))
    table.compact(spark)
    return table.latest(spark).drop("ts_ms")


@query("sink_documents", ORACLES["index_docs"], "")
def sink_documents(spark, sf):
    folder = work_dir(spark, "docs")
    stream = click_stream(stream_session(spark), events_path(sf))
    docs = shaping.index_documents(stream, "clicks", "user_id", "url")
    finish(writers.document_bulks(docs, f"{folder}/out", f"{folder}/checkpoint"))
    return spark.read.text(f"{folder}/out").select("index_name", F.col("value").alias("doc"))
