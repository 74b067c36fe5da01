"""Event-time windows.  Bounds come out as epoch ms: ``window_start``, ``window_end``.

``tumble``, ``hop`` and ``cumulate`` assign rows to windows and work on batch and streaming
frames.  The batch-only operators below them cut the shuffled volume first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.ordered import ROWS_PER_CHUNK, chunk_rows, neighbourhood, running, uncut


def duration(ms: int) -> str:
    return f"{ms} milliseconds"


def window_bounds(df: DataFrame, window: str = "window") -> DataFrame:
    """Replace a window struct by its bounds in epoch ms."""
    rest = [c for c in df.columns if c != window]
    return df.select(F.unix_millis(F.col(window)["start"]).alias("window_start"),
                     F.unix_millis(F.col(window)["end"]).alias("window_end"), *rest)


def tumbling(size_ms: int, ts: str = "ts") -> Column:
    return F.window(F.col(ts), duration(size_ms)).alias("window")


def sliding(size_ms: int, slide_ms: int, ts: str = "ts") -> Column:
    return F.window(F.col(ts), duration(size_ms), duration(slide_ms)).alias("window")


def tumble(df: DataFrame, size_ms: int, ts: str = "ts") -> DataFrame:
    """The rows with the bounds of their tumbling window."""
    return window_bounds(df.withColumn("window", tumbling(size_ms, ts)))


def hop(df: DataFrame, size_ms: int, slide_ms: int, ts: str = "ts") -> DataFrame:
    """The rows once per sliding window they fall in."""
    return window_bounds(df.withColumn("window", sliding(size_ms, slide_ms, ts)))


def cumulate_ends(start_ms: Column, ts_ms: Column, size_ms: int, step_ms: int) -> Column:
    """Ends of the growing windows that hold ``ts_ms``: multiples of the step after the row,
    up to the end of the enclosing window."""
    first = start_ms + F.floor((ts_ms - start_ms) / step_ms).cast("bigint") * step_ms + step_ms
    return F.sequence(first, start_ms + size_ms, F.lit(step_ms).cast("bigint"))


def cumulate(df: DataFrame, size_ms: int, step_ms: int, ts: str = "ts") -> DataFrame:
    """The rows once per cumulating window: windows share a start and grow by the step."""
    rest = df.columns
    enclosed = tumble(df, size_ms, ts)
    ends = cumulate_ends(F.col("window_start"), F.unix_millis(F.col(ts)), size_ms, step_ms)
    return (enclosed.drop("window_end").withColumn("window_end", F.explode(ends))
            .select("window_start", "window_end", *rest))


def pane_counts(df: DataFrame, keys: Sequence[str], pane_ms: int, ts_ms: str = "ts_ms") -> DataFrame:
    """Row counts per (pane, keys), the shared input of overlapping windows."""
    start = F.col(ts_ms) - F.pmod(F.col(ts_ms), F.lit(pane_ms))
    return (df.groupBy(start.alias("pane"), *keys).agg(F.count(F.lit(1)).alias("n")))


def windows_of_pane(size_ms: int, slide_ms: int) -> Column:
    """Starts of the sliding windows that cover a pane of one slide."""
    return F.sequence(F.col("pane") - (size_ms - slide_ms), F.col("pane"),
                      F.lit(slide_ms).cast("bigint"))


def sliding_counts(df: DataFrame, keys: Sequence[str], size_ms: int, slide_ms: int,
                   ts_ms: str = "ts_ms") -> DataFrame:
    """Counts per sliding window and key.

    Rows are counted once per pane and only the counts are copied to the size / slide
    windows above it, instead of copying every row that often.
    """
    if size_ms % slide_ms:
        raise ValueError("the size must be a multiple of the slide")
    return (
        pane_counts(df, keys, slide_ms, ts_ms)
        .withColumn("window_start", F.explode(windows_of_pane(size_ms, slide_ms)))
        .groupBy("window_start", *keys).agg(F.sum("n").alias("cnt"))
        .select("window_start", (F.col("window_start") + size_ms).alias("window_end"), *keys, "cnt")
    )


def sliding_distinct(df: DataFrame, key: str, size_ms: int, slide_ms: int, ts_ms: str = "ts_ms",
                     rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Rows (``pv``) and distinct keys (``uv``) of every sliding window that is not empty, exact.

    A row is never copied to its windows.  A key that comes in pane p and came last in pane q is
    new to the windows that begin after q and still hold p, which is one range of windows; each
    range adds one where it begins and takes it away where it ends, and a running sum over these
    changes, two or three numbers for each pane, gives the counts.  So the work does not depend
    on how many windows a row is in.
    """
    if size_ms % slide_ms:
        raise ValueError("the size must be a multiple of the slide")
    panes = size_ms // slide_ms
    number = F.floor(F.col("pane") / slide_ms).cast("bigint")
    visits = pane_counts(df, [key], slide_ms, ts_ms).select(key, number.alias("_p"), "n")
    seen = neighbourhood(visits, [key], ["_p"], 1, lambda w: {"_q": F.lag("_p", 1).over(w)}, rows_per_chunk=rows_per_chunk)
    first, after = F.col("_p") - (panes - 1), F.col("_p") + 1
    none = F.lit(0).cast("bigint")

    def change(at: Column, users: Column, rows: Column) -> Column:
        return F.struct(at.alias("w"), users.alias("u"), rows.alias("n"))

    one = F.lit(1).cast("bigint")
    changes = F.array(change(F.greatest(first, F.col("_q") + 1), one, none), change(first, none, F.col("n")),
                      change(after, -one, -F.col("n")))
    steps = seen.select(F.explode(changes).alias("c")).groupBy(F.col("c.w").alias("w")).agg(
        F.sum("c.u").alias("u"), F.sum("c.n").alias("n"))
    # One row for each pane at which a count changes; in between the counts hold.
    line = chunk_rows(steps, [], ["w"], rows_per_chunk)
    summed = running(line, [], ["w"], {"uv": ("sum", F.col("u")), "pv": ("sum", F.col("n"))})
    held = running(summed, [], ["w"], {"until": ("min", F.col("w"))}, inclusive=False, reverse=True)
    start = F.col("at") * slide_ms
    return (uncut(held).where("uv > 0").withColumn("at", F.explode(F.sequence(F.col("w"), F.col("until") - 1)))
            .select(start.alias("window_start"), (start + size_ms).alias("window_end"), "pv", "uv"))


def cumulating_counts(df: DataFrame, keys: Sequence[str], size_ms: int, step_ms: int,
                      ts_ms: str = "ts_ms") -> DataFrame:
    """Counts per cumulating window and key, from one count per step."""
    if size_ms % step_ms:
        raise ValueError("the size must be a multiple of the step")
    start = F.col("pane") - F.pmod(F.col("pane"), F.lit(size_ms))
    ends = F.sequence(F.col("pane") + step_ms, F.col("window_start") + size_ms,
                      F.lit(step_ms).cast("bigint"))
    return (
        pane_counts(df, keys, step_ms, ts_ms)
        .withColumn("window_start", start)
        .withColumn("window_end", F.explode(ends))
        .groupBy("window_start", "window_end", *keys).agg(F.sum("n").alias("cnt"))
    )


def sessions(df: DataFrame, keys: Sequence[str], gap_ms: int, order: Sequence[str] = ("ts_ms", "seq"),
             rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Session windows: a row at most ``gap_ms`` after the previous one joins its session.

    The end is the last row plus the gap.  Streams use ``F.session_window``; in a batch that
    function sorts each key in one task, so here sessions are numbered per stretch of a key
    and then counted with map-side aggregation.
    """
    ms = order[0]
    rows = chunk_rows(df.select(*keys, *order), keys, order, rows_per_chunk)
    starts = neighbourhood(
        rows, keys, order, 1,
        lambda w: {"_new": F.when(F.col(ms) - F.lag(ms, 1).over(w) <= gap_ms, 0).otherwise(1)})
    numbered = running(starts, keys, order, {"_session": ("sum", F.col("_new").cast("bigint"))})
    return (
        numbered.groupBy(*keys, "_session")
        .agg(F.min(ms).alias("window_start"), (F.max(ms) + gap_ms).alias("window_end"),
             F.count(F.lit(1)).alias("cnt"))
        .drop("_session")
    )


def merged_sessions(parts: DataFrame, keys: Sequence[str], rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Sessions from partial ones of the same gap (keys, window_start, window_end, cnt), in any
    order: those that touch or overlap are one."""
    order = ["window_start", "window_end"]
    rows = chunk_rows(parts, keys, order, rows_per_chunk)
    seen = running(rows, keys, order, {"_upto": ("max", F.col("window_end"))}, inclusive=False)
    opens = F.col("_upto").isNull() | (F.col("window_start") > F.col("_upto"))
    numbered = running(seen.withColumn("_new", opens.cast("bigint")), keys, order, {"_session": ("sum", F.col("_new"))})
    return (numbered.groupBy(*keys, "_session")
            .agg(F.min("window_start").alias("window_start"), F.max("window_end").alias("window_end"),
                 F.sum("cnt").alias("cnt")).drop("_session"))


def count_windows(df: DataFrame, keys: Sequence[str], size: int, slide: int, value: str,
                  order: Sequence[str] = ("seq",), rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Count windows: at every ``slide``-th row of a key, reduce its last ``size`` rows."""
    rows = chunk_rows(df, keys, order, rows_per_chunk)
    framed = neighbourhood(
        rows, keys, order, size - 1,
        lambda w: {"cnt": F.count(F.lit(1)).over(w.rowsBetween(1 - size, 0)),
                   "max_value": F.max(value).over(w.rowsBetween(1 - size, 0))})
    numbered = running(framed, keys, order, {"row_no": ("count", F.lit(1))})
    return uncut(numbered.where(F.col("row_no") % slide == 0))


def over_average(df: DataFrame, keys: Sequence[str], value: str, preceding: int,
                 order: Sequence[str] = ("ts_ms", "seq"), rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Integer average of ``value`` over the current and the ``preceding`` rows of the key."""
    def average(w):
        frame = w.rowsBetween(-preceding, 0)
        return {"_sum": F.sum(value).over(frame), "_n": F.count(value).over(frame)}

    return (neighbourhood(df, keys, order, preceding, average, rows_per_chunk=rows_per_chunk)
            .withColumn("avg_" + value, F.expr("_sum div _n")).drop("_sum", "_n"))
