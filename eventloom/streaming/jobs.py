"""Streaming jobs over the click log: each takes a stream and returns a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from eventloom.operators import aggregates, joins, ranking, windows


def watermarked(stream: DataFrame, delay_ms: int = 0, ts: str = "ts") -> DataFrame:
    return stream.withWatermark(ts, windows.duration(delay_ms))


def stateful(stream: DataFrame, key: str | list[str], processor: StatefulProcessor, *, delay_ms: int | None = None,
             time_mode: str | None = None) -> DataFrame:
    """Run a processor per key: event-time mode with ``delay_ms``, else as ``time_mode`` says."""
    if delay_ms is not None:
        stream, time_mode = watermarked(stream, delay_ms), "EventTime"
    return stream.groupBy(key).transformWithStateInPandas(
        processor, outputStructType=processor.OUT, outputMode="Append", timeMode=time_mode or "None")


def _panes(stream: DataFrame, key: str, pane_ms: int, delay_ms: int) -> DataFrame:
    """Row counts per (pane, key), with ``pane_ts`` as event time for a second aggregate."""
    counted = (watermarked(stream, delay_ms).groupBy(windows.tumbling(pane_ms), key)
               .agg(F.count(F.lit(1)).alias("n")))
    return counted.select(key, "n", F.window_time("window").alias("pane_ts"))


def tumbling_counts(stream: DataFrame, key: str, size_ms: int, delay_ms: int = 0) -> DataFrame:
    grouped = watermarked(stream, delay_ms).groupBy(windows.tumbling(size_ms), key)
    return windows.window_bounds(grouped.agg(F.count(F.lit(1)).alias("cnt")))


def sliding_counts(stream: DataFrame, key: str, size_ms: int, slide_ms: int, delay_ms: int = 0) -> DataFrame:
    """Each row is counted once, in its pane of one slide; the windows add up panes."""
    if size_ms % slide_ms:
        raise ValueError("the size must be a multiple of the slide")
    panes = _panes(stream, key, slide_ms, delay_ms)
    grouped = panes.groupBy(windows.sliding(size_ms, slide_ms, "pane_ts"), key)
    return windows.window_bounds(grouped.agg(F.sum("n").alias("cnt")))


def session_counts(stream: DataFrame, key: str, gap_ms: int, delay_ms: int = 0) -> DataFrame:
    grouped = watermarked(stream, delay_ms).groupBy(
        F.session_window("ts", windows.duration(gap_ms)).alias("window"), key)
    return windows.window_bounds(grouped.agg(F.count(F.lit(1)).alias("cnt")))


def cumulating_counts(stream: DataFrame, key: str, size_ms: int, step_ms: int, delay_ms: int = 0) -> DataFrame:
    """All ends of an enclosing window come out together, when it closes.

    Each row is counted once, in its pane of one step; only the counts go to several ends.
    """
    if size_ms % step_ms:
        raise ValueError("the size must be a multiple of the step")
    assigned = (
        _panes(stream, key, step_ms, delay_ms).withColumn("window", windows.tumbling(size_ms, "pane_ts"))
        .withColumn("_end", F.explode(windows.cumulate_ends(
            F.unix_millis(F.col("window.start")), F.unix_millis("pane_ts"), size_ms, step_ms))))
    grouped = assigned.groupBy("window", "_end", key).agg(F.sum("n").alias("cnt"))
    return (windows.window_bounds(grouped).drop("window_end").withColumnRenamed("_end", "window_end"))


def unique_visitors(stream: DataFrame, size_ms: int, delay_ms: int = 0) -> DataFrame:
    return aggregates.unique_visitors(watermarked(stream, delay_ms), size_ms)


def rank_closed_windows(n: int, key: str):
    """Top-N of the windows that closed in a micro-batch.

    In append mode all counts of a window leave in the same micro-batch, so ranking the
    micro-batch is exact and uses the batch top-N with its early group limit.
    """
    def shape(batch: DataFrame) -> DataFrame:
        return ranking.top_n(batch, ["window_start", "window_end"], "cnt", key, n)
    return shape


def window_join(left: DataFrame, right: DataFrame, key: str, size_ms: int, delay_ms: int = 0) -> DataFrame:
    """Stream-stream join on (key, tumbling window)."""
    lw = watermarked(left, delay_ms, "left_ts").withColumn("window", windows.tumbling(size_ms, "left_ts"))
    rw = watermarked(right, delay_ms, "right_ts").withColumn("window", windows.tumbling(size_ms, "right_ts"))
    return windows.window_bounds(lw.join(rw, [key, "window"]))


def interval_join(left: DataFrame, right: DataFrame, key: str, lower_ms: int, upper_ms: int,
                  delay_ms: int = 0, how: str = "inner") -> DataFrame:
    """Stream-stream join with ``right_ts`` in [left + lower, left + upper].

    The range condition and both watermarks bound the join state.  As in the batch form, the
    time slot is part of the join key, so a hot key is spread over slots: one side lies in one
    slot and the other looks into at most two.  The side in one slot comes out alone exactly if
    it has no partner, so a full outer join is a left outer join, in which the right rows look
    into slots, and the right rows that come out alone of a join the other way round.
    """
    l = watermarked(left, delay_ms, "left_ts").withColumnRenamed(key, "_left_key")
    r = watermarked(right, delay_ms, "right_ts").withColumnRenamed(key, "_right_key")
    width = max(upper_ms - lower_ms, 1)
    l_ms, r_ms = F.unix_millis("left_ts"), F.unix_millis("right_ts")
    cond = F.expr(f"""_left_key = _right_key AND _left_slot = _right_slot
        AND right_ts >= left_ts + INTERVAL {lower_ms} MILLISECONDS
        AND right_ts <= left_ts + INTERVAL {upper_ms} MILLISECONDS""")

    def joined(ls, rs, kind: str) -> DataFrame:
        sides = l.withColumn("_left_slot", ls), r.withColumn("_right_slot", rs)
        return (sides[0].join(sides[1], cond, kind).withColumn(key, F.coalesce("_left_key", "_right_key"))
                .drop("_left_key", "_right_key", "_left_slot", "_right_slot"))

    def slot(ms):
        return joins.time_slot(ms, width)

    if how == "inner" or how == "right_outer":
        return joined(F.explode(F.sequence(slot(l_ms + lower_ms), slot(l_ms + upper_ms))), slot(r_ms), how)
    met = joined(slot(l_ms + lower_ms), F.explode(F.sequence(slot(r_ms - width), slot(r_ms))), "left_outer")
    if how == "left_outer":
        return met
    if how != "full_outer":
        raise ValueError("how is inner, left_outer, right_outer or full_outer")
    alone = interval_join(left, right, key, lower_ms, upper_ms, delay_ms, "right_outer").where("left_ts is null")
    return met.unionByName(alone)


def reconcile(app: DataFrame, third: DataFrame, key: str, app_wait_ms: int, third_wait_ms: int,
              delay_ms: int = 0) -> DataFrame:
    """Match two payment logs; a row whose wait is over comes out alone, as an alert.

    Inputs are (key, left_ts) and (key, right_ts).
    """
    joined = interval_join(app, third, key, -third_wait_ms, app_wait_ms, delay_ms, "full_outer")
    status = (F.when(F.col("right_ts").isNull(), "third_missing")
              .when(F.col("left_ts").isNull(), "app_missing").otherwise("matched"))
    return joined.select(key, F.unix_millis("left_ts").alias("app_ms"),
                         F.unix_millis("right_ts").alias("third_ms"), status.alias("status"))


def sum_of_closed(*group: str):
    """Add up the partial counts of salted keys: all parts of a window close in the same
    micro-batch, so its rows are all there are."""
    def shape(batch: DataFrame) -> DataFrame:
        return batch.groupBy(*group).agg(F.sum("cnt").alias("cnt"))
    return shape


def window_cogroup(left: DataFrame, right: DataFrame, key: str, size_ms: int, delay_ms: int = 0) -> DataFrame:
    both = (left.select(key, "ts", "ts_ms", F.lit(True).alias("_left"))
            .unionByName(right.select(key, "ts", "ts_ms", F.lit(False).alias("_left"))))
    ms_l, ms_r = F.when(F.col("_left"), F.col("ts_ms")), F.when(~F.col("_left"), F.col("ts_ms"))
    grouped = watermarked(both, delay_ms).groupBy(windows.tumbling(size_ms), key).agg(
        F.count(ms_l).alias("n_left"), F.count(ms_r).alias("n_right"),
        F.min(ms_l).alias("first_left"), F.max(ms_l).alias("last_left"),
        F.min(ms_r).alias("first_right"), F.max(ms_r).alias("last_right"))
    return windows.window_bounds(grouped)
