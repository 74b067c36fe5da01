"""Keyed, running and windowed aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.operators import windows
from eventloom.operators.ordered import ROWS_PER_CHUNK, running


def running_count(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("seq",),
                  rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Count of the key so far, one row per input row."""
    return running(df, keys, order, {"cnt": ("count", F.lit(1))}, rows_per_chunk=rows_per_chunk)


def running_leader(df: DataFrame, key: str, seq: str = "seq",
                   rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """After each row, the key with the highest count so far; a tie goes to the newer row.

    ``seq`` is a dense sequence number: the second pass is one sequence over all keys.
    """
    counted = running_count(df.select(seq, key), [key], [seq], rows_per_chunk)
    best = running(counted, [], [seq], {"_best": ("max", F.struct("cnt", seq, key))},
                   rows_per_chunk=rows_per_chunk)
    return best.select(seq, F.col("_best")[key].alias("leader"), F.col("_best")["cnt"].alias("leader_cnt"))


def running_max(df: DataFrame, key: str, value: str, frozen: str, seq: str = "seq",
                rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Running maximum of one field; ``frozen`` keeps the value of the key's first row."""
    out = running(df, [key], [seq], {"max_" + value: ("max", F.col(value)),
                                     "_first": ("min", F.struct(seq, frozen))},
                  rows_per_chunk=rows_per_chunk)
    return out.select(seq, key, F.col("_first")[frozen].alias("first_" + frozen), "max_" + value)


def running_max_row(df: DataFrame, key: str, value: str, carried: str, seq: str = "seq",
                    rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Running row with the maximum of ``value``; a tie keeps the row seen first."""
    rank = F.struct(F.col(value), (-F.col(seq)).alias("_age"), F.col(carried))
    out = running(df, [key], [seq], {"_top": ("max", rank)}, rows_per_chunk=rows_per_chunk)
    return out.select(seq, key, F.col("_top")[carried].alias("top_" + carried),
                      F.col("_top")[value].alias("top_" + value))


def max_row(df: DataFrame, key: str, value: str, *carried: str, seq: str = "seq") -> DataFrame:
    """The final row with the maximum of ``value`` per key (first seen on a tie)."""
    top = F.max(F.struct(F.col(value), (-F.col(seq)).alias("_age"), *carried)).alias("_top")
    return df.groupBy(key).agg(top).select(key, *[F.col("_top")[c].alias(c) for c in (value, *carried)])


def unique_visitors(df: DataFrame, size_ms: int, user: str = "user_id") -> DataFrame:
    """Exact distinct users per tumbling window.

    Two grouped steps, (window, user) and then window: a set of users is never held in one
    row, and the same plan runs on a stream.
    """
    per_user = df.groupBy(windows.tumbling(size_ms), user).agg(F.count(F.lit(1)).alias("pv"))
    return windows.window_bounds(
        per_user.groupBy("window").agg(F.count(F.lit(1)).alias("uv"), F.sum("pv").alias("pv")))


def approx_unique_visitors(df: DataFrame, size_ms: int, user: str = "user_id", rsd: float = 0.01) -> DataFrame:
    """Distinct users per tumbling window from a sketch of fixed size."""
    return windows.window_bounds(
        df.groupBy(windows.tumbling(size_ms)).agg(F.approx_count_distinct(user, rsd).alias("uv")))


def views_per_visitor(df: DataFrame, size_ms: int, slide_ms: int, user: str = "user_id") -> DataFrame:
    """Page views per unique visitor over sliding windows of the whole stream."""
    return (windows.sliding_distinct(df, user, size_ms, slide_ms)
            .withColumn("pv_uv", F.round(F.col("pv") / F.col("uv"), 6)))


def every_nth_average(df: DataFrame, key: str, value: str, n: int, seq: str = "seq",
                      rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Integer average over each run of ``n`` rows of a key; an unfinished run emits nothing."""
    numbered = running_count(df.select(seq, key, value), [key], [seq], rows_per_chunk)
    return (
        numbered.withColumn("group_no", F.expr(f"(cnt - 1) div {n}"))
        .groupBy(key, "group_no")
        .agg(F.count(F.lit(1)).alias("_n"), F.expr(f"sum(`{value}`) div {n}").alias("avg_" + value))
        .where(F.col("_n") == n).drop("_n")
    )


def state_profile(df: DataFrame, user: str = "user_id", seq: str = "seq") -> DataFrame:
    """Per user what five kinds of keyed state hold after the last row: list length, map
    entry, accumulator text, and a reduced row (first url, newest time)."""
    return (
        df.groupBy(user)
        .agg(F.count(F.lit(1)).alias("list_size"),
             F.min_by("url", seq).alias("reduced_url"), F.max_by("ts_ms", seq).alias("reduced_ts"))
        .select(user, "list_size", F.col("list_size").alias("map_count"), "reduced_url", "reduced_ts",
                F.concat(F.lit("count: "), F.col("list_size")).alias("agg_text"))
    )


def count_changelog(df: DataFrame, key: str, seq: str = "seq",
                    rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """The change stream of a grouped count: +I for a new key, then -U old / +U new."""
    def change(op: str, cnt: Column) -> Column:
        return F.struct(F.lit(op).alias("op"), cnt.alias("cnt"))

    cnt = F.col("cnt")
    changes = F.when(cnt == 1, F.array(change("+I", cnt))).otherwise(
        F.array(change("-U", cnt - 1), change("+U", cnt)))
    return (running_count(df.select(seq, key), [key], [seq], rows_per_chunk)
            .select(seq, key, F.explode(changes).alias("_c"))
            .select(seq, key, "_c.op", "_c.cnt"))


def buffered_batches(df: DataFrame, shard: str, size: int, payload: str, seq: str = "seq",
                     rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Full buffers of ``size`` rows per shard, in arrival order; a part-filled one waits.

    Each output row is one flush; its list never holds more than ``size`` rows.
    """
    numbered = running_count(df.select(seq, shard, payload), [shard], [seq], rows_per_chunk)
    return (
        numbered.withColumn("batch_no", F.expr(f"(cnt - 1) div {size}"))
        .groupBy(shard, "batch_no")
        .agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct(seq, payload))).alias("rows"))
        .where(F.col("n") == size)
    )


def periodic_counts(df: DataFrame, key: str, period_ms: int, order: Sequence[str] = ("ts_ms", "seq"),
                    rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Cumulative count per key at first + k * period, for every tick up to the newest event.

    Rows are counted per tick first; a tick without rows repeats the count before it.
    """
    ms = order[0]
    newest = df.agg(F.max(ms)).scalar()
    dated = running(df.select(key, *order), [key], order, {"_first": ("min", F.col(ms))},
                    rows_per_chunk=rows_per_chunk)
    tick = F.greatest(F.lit(1), F.expr(f"(`{ms}` - _first + {period_ms - 1}) div {period_ms}"))
    per_tick = dated.groupBy(key, "_first", tick.alias("_tick")).agg(F.count(F.lit(1)).alias("_n"))
    # A key has at most time span / period ticks, however many rows it has.
    ticks = Window.partitionBy(key).orderBy("_tick")
    return (
        per_tick.withColumns({
            "pv": F.sum("_n").over(ticks.rowsBetween(Window.unboundedPreceding, 0)),
            "_next": F.lead("_tick", 1).over(ticks),
            "_newest": newest})
        .withColumn("_last", F.expr(f"(_newest - _first) div {period_ms}"))
        .where(F.col("_tick") <= F.col("_last"))
        .withColumn("_t", F.explode(F.sequence(F.col("_tick"), F.least(F.col("_next") - 1, F.col("_last")))))
        .select(key, (F.col("_first") + F.col("_t") * period_ms).alias("tick_ms"), "pv")
    )
