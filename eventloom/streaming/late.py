"""Lateness over a stream without loss: on time, firing again, and a complete side output.

The engine's own watermark drops what lies behind it.  These steps keep a watermark of their
own instead, the highest time among the rows that arrived so far, and run per micro-batch
(:func:`eventloom.streaming.replay.replay` with ``step``).  They decide row by row in arrival
order, as the batch operators do, so the result does not depend on how input was batched; the
micro-batches must follow the arrival order.

A step reads what micro-batch ``n - 1`` left in the shared folder and writes its own ``n``,
so one that runs again after a failure gives the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators import lateness
from eventloom.operators.ordered import running

Step = Callable[[DataFrame, int, str], DataFrame]


def _newest(batch: DataFrame, batch_id: int, folder: str) -> tuple[int | None, int | None]:
    """The highest time before this micro-batch and with it; one number each."""
    spark, path = batch.sparkSession, f"{folder}/newest"
    earlier = None
    if batch_id:
        earlier = spark.read.schema("ms long").parquet(f"{path}/{batch_id - 1}").first()[0]
    now = batch.agg(F.greatest(F.max("ts_ms"), F.lit(earlier).cast("bigint"))).first()[0]
    spark.createDataFrame([(now,)], "ms long").write.mode("overwrite").parquet(f"{path}/{batch_id}")
    return earlier, now


def split(size_ms: int, bound_ms: int, lateness_ms: int) -> Step:
    """Every row with its window and ``tag``: ``on_time``, ``refire`` or ``late``."""
    def step(batch: DataFrame, batch_id: int, folder: str) -> DataFrame:
        earlier, _ = _newest(batch, batch_id, folder)
        return lateness.classify(batch, size_ms, bound_ms, lateness_ms, earlier_ms=earlier)
    return step


def firings(key: str, size_ms: int, bound_ms: int, lateness_ms: int) -> Step:
    """Every result of every window: the count when the watermark passes its end (``firing``
    0), then the raised count for each row that comes within the allowed lateness.

    What is kept is one row per key and window that may still get rows.
    """
    group = [key, "window_start", "window_end"]
    schema = f"{key} string, window_start long, window_end long, n_on_time long, n_refire long"

    def step(batch: DataFrame, batch_id: int, folder: str) -> DataFrame:
        spark, path = batch.sparkSession, f"{folder}/windows"
        earlier, now = _newest(batch, batch_id, folder)
        rows = (lateness.classify(batch, size_ms, bound_ms, lateness_ms, earlier_ms=earlier)
                .where("tag <> 'late'").select(*group, *lateness.ARRIVAL, "tag"))
        old = spark.createDataFrame([], schema)
        if earlier is not None:
            old = (spark.read.schema(schema).parquet(f"{path}/{batch_id - 1}")
                   .where(F.col("window_end") + lateness_ms > earlier - bound_ms))
        new = rows.groupBy(*group).agg(F.count_if(F.col("tag") == "on_time").alias("n_on_time"),
                                       F.count_if(F.col("tag") == "refire").alias("n_refire"))
        (old.unionByName(new).groupBy(*group)
         .agg(F.sum("n_on_time").alias("n_on_time"), F.sum("n_refire").alias("n_refire"))
         .write.mode("overwrite").parquet(f"{path}/{batch_id}"))

        counted = running(rows, group, lateness.ARRIVAL, {
            "_cnt": ("count", F.lit(1)), "_firing": ("count", F.when(F.col("tag") == "refire", 1))})
        known = old.select(*[F.col(c).alias("_o_" + c) for c in group], "n_on_time", "n_refire")
        same_window = F.lit(True)
        for c in group:
            same_window = same_window & F.col(c).eqNullSafe(F.col("_o_" + c))
        again = counted.where("tag = 'refire'").join(known, same_window, "left").select(
            *group, (F.col("_firing") + F.coalesce("n_refire", F.lit(0))).alias("firing"),
            (F.col("_cnt") + F.coalesce(F.col("n_on_time") + F.col("n_refire"), F.lit(0))).alias("cnt"))
        closes = (F.col("window_end") > F.lit(earlier) - bound_ms) if earlier is not None else F.lit(True)
        passed = F.col("window_end") <= F.lit(now).cast("bigint") - bound_ms
        first = (spark.read.schema(schema).parquet(f"{path}/{batch_id}").where(closes & passed & (F.col("n_on_time") > 0))
                 .select(*group, F.lit(0).cast("bigint").alias("firing"), F.col("n_on_time").alias("cnt")))
        return first.unionByName(again)
    return step
