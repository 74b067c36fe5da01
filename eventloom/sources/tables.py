"""The event model over the given tables.

A click is (seq, user_id, url, ts, ts_ms, value): ``seq`` is the arrival order, ``ts`` the
event time as TIMESTAMP and ``ts_ms`` the same instant as epoch milliseconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.session import size_shuffles

# Declared, not inferred: reading a schema from the files costs a job per table.
SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
                "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
                "l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "pages": "page_id BIGINT, url STRING, html STRING",
}
EVENTS_SCHEMA = SCHEMAS["events"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
    size_shuffles(spark, df)
    return df


def as_clicks(events: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.col("event_id").alias("seq"), "user_id", F.col("event_type").alias("url"),
        ts.alias("ts"), F.unix_millis(ts).alias("ts_ms"), "value")


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_clicks(table(spark, sf_dir, "events"))


def with_arrival(df: DataFrame) -> DataFrame:
    """A disordered arrival number for the lateness operators (ties keep ``seq`` order)."""
    return df.withColumn("arrival", F.col("seq") + F.pmod(F.col("seq") * 17, F.lit(41)))
