"""State entries that live for a time after their last touch, in event time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators.ordered import ROWS_PER_CHUNK, chunk_rows, running, uncut

ORDER = ("ts_ms", "seq")
REFRESH = ("write", "read_write")


def living_counts(df: DataFrame, keys: Sequence[str], writes: Column, ttl_ms: int, *, refresh: str = "read_write",
                  order: Sequence[str] = ORDER, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Add ``value``: what a counter holds after each row, if every write adds one, every other
    row reads it, and the counter is gone ``ttl_ms`` after it was last touched.

    With ``refresh="write"`` only writes are touches; with ``read_write`` reads of a counter that
    is there are too.  A read never makes one: of two reads after a long gap both find nothing.
    Each life is a run of touches without such a gap, so a life is counted like a session.
    """
    if refresh not in REFRESH:
        raise ValueError(f"refresh is one of {REFRESH}")
    ms, keys = order[0], list(keys)
    touch = F.lit(True) if refresh == "read_write" else F.col("_writes")
    rows = chunk_rows(df.withColumn("_writes", F.coalesce(writes, F.lit(False))), keys, order, rows_per_chunk)
    seen = running(rows, keys, order, {"_last": ("max", F.when(touch, F.col(ms)))}, inclusive=False)
    over = F.col("_last").isNull() | (F.col(ms) - F.col("_last") >= ttl_ms)
    lives = running(seen.withColumn("_over", over), keys, order,
                    {"_life": ("sum", F.when(touch & F.col("_over"), 1).otherwise(0).cast("bigint"))})
    own = uncut(lives).withColumn("_read_late", ~F.col("_writes") & F.col("_over"))
    counted = running(own, [*keys, "_life"], order, {"value": ("count", F.when(F.col("_writes"), 1))},
                      rows_per_chunk=rows_per_chunk)
    value = F.when(F.col("_read_late"), 0).otherwise(F.col("value")).cast("bigint")
    return counted.select(*df.columns, value.alias("value"))
