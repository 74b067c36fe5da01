"""Watermarks and late rows, decided row by row over the arrival order.

The engine moves its watermark once per micro-batch, so which rows it treats as late depends
on the batch layout.  These operators give the layout-free answer, and
:mod:`eventloom.streaming.late` gives it for streams.  Ties in ``arrival`` keep ``seq`` order.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.operators.ordered import ROWS_PER_CHUNK, chunk_rows, running, uncut

ARRIVAL = ("arrival", "seq")


def watermark_trace(df: DataFrame, bound_ms: int, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """The watermark after each row: highest time so far - bound - 1 ms."""
    out = running(df, [], ARRIVAL, {"_max": ("max", F.col("ts_ms"))}, rows_per_chunk=rows_per_chunk)
    return out.withColumn("watermark", F.col("_max") - bound_ms - 1).drop("_max")


def classify(df: DataFrame, size_ms: int, bound_ms: int, lateness_ms: int,
             rows_per_chunk: int = ROWS_PER_CHUNK, earlier_ms: int | None = None) -> DataFrame:
    """Tag rows of tumbling windows as ``on_time``, ``refire`` (the window already fired but
    is kept for the allowed lateness) or ``late`` (goes to the side output).

    ``earlier_ms`` is the highest time among rows that arrived before those of ``df``.
    """
    seen = running(df, [], ARRIVAL, {"_max": ("max", F.col("ts_ms"))}, inclusive=False,
                   rows_per_chunk=rows_per_chunk)
    start = F.col("ts_ms") - F.pmod(F.col("ts_ms"), F.lit(size_ms))
    passed = F.greatest("_max", F.lit(earlier_ms).cast("bigint")) - bound_ms
    tag = (F.when(F.col("window_end") + lateness_ms <= passed, "late")
           .when(F.col("window_end") <= passed, "refire").otherwise("on_time"))
    return (seen.withColumn("window_start", start)
            .withColumn("window_end", F.col("window_start") + size_ms)
            .withColumn("tag", tag).drop("_max"))


def window_firings(df: DataFrame, key: str, size_ms: int, bound_ms: int, lateness_ms: int,
                   rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Every result a window emits: the count when the watermark passes its end, then the
    raised count for each row that comes within the allowed lateness.

    ``firing`` numbers the results of a window from 0 (the first, on time) upwards.
    """
    kept = classify(df, size_ms, bound_ms, lateness_ms, rows_per_chunk).where("tag <> 'late'")
    group = [key, "window_start", "window_end"]
    on_time = (kept.where("tag = 'on_time'").groupBy(*group)
               .agg(F.count(F.lit(1)).alias("cnt"), F.lit(0).cast("bigint").alias("firing")))
    refire = F.when(F.col("tag") == "refire", 1)
    counted = running(kept.select(*group, *ARRIVAL, "tag"), group, ARRIVAL,
                      {"cnt": ("count", F.lit(1)), "firing": ("count", refire)},
                      rows_per_chunk=rows_per_chunk)
    late = counted.where("tag = 'refire'").select(*group, "cnt", "firing")
    return on_time.unionByName(late).select(*group, "firing", "cnt")


@dataclass(frozen=True)
class InputsSoFar:
    """What the rows before those of a frame left: how many there were, the newest time and the
    last place of each input (null: none yet), and the watermark."""

    rows: int
    newest: tuple[int | None, ...]
    last: tuple[int | None, ...]
    watermark: int | None

    @classmethod
    def none(cls, inputs: int) -> InputsSoFar:
        return cls(0, (None,) * inputs, (None,) * inputs, None)


def union_watermark(df: DataFrame, inputs: int, bound_ms: int, idle_rows: int, before: InputsSoFar | None = None,
                    rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """The watermark of a union of ``inputs`` streams after each row, in arrival order.

    Column ``source`` numbers the inputs from 0.  Each has a watermark of its own, its highest
    time so far - bound - 1 ms, and the union has the lowest of them.  An input without a row
    among the last ``idle_rows`` rows of the union is idle and holds nothing back, nor does one
    that has not begun by then; before that an input without rows holds the watermark back
    (null).  The watermark never falls, also when an idle input comes back behind it.
    """
    before = before or InputsSoFar.none(inputs)
    own = [F.col("source") == i for i in range(inputs)]

    def since(name: str, known: int | None):
        return F.greatest(F.col(name), F.lit(known).cast("bigint"))

    rows = chunk_rows(df, [], ARRIVAL, rows_per_chunk)
    placed = running(rows, [], ARRIVAL, {"_row": ("count", F.lit(1))}).withColumn("_row", F.col("_row") + before.rows)
    seen = running(placed, [], ARRIVAL, {
        **{f"_newest{i}": ("max", F.when(own[i], F.col("ts_ms"))) for i in range(inputs)},
        **{f"_last{i}": ("max", F.when(own[i], F.col("_row"))) for i in range(inputs)}})
    least, blocked = F.lit(None).cast("bigint"), F.lit(False)
    for i in range(inputs):
        active = F.col("_row") - F.coalesce(since(f"_last{i}", before.last[i]), F.lit(0)) < idle_rows
        newest = since(f"_newest{i}", before.newest[i])
        least = F.least(least, F.when(active, newest))
        blocked = blocked | (active & newest.isNull())
    own_mark = seen.withColumn("_own", F.when(~blocked, least - bound_ms - 1))
    marked = running(own_mark, [], ARRIVAL, {"_mark": ("max", F.col("_own"))})
    return (uncut(marked).withColumn("watermark", since("_mark", before.watermark))
            .select(*df.columns, "watermark"))
