"""Top-N reports and ranks.  Equal counts rank by the key, ascending."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.operators import windows
from eventloom.operators.ordered import ROWS_PER_CHUNK, chunk_rows, uncut


def top_n(df: DataFrame, partition: Sequence[str], value: str, tie: str, n: int) -> DataFrame:
    """The ``n`` highest rows per group as ``row_num`` 1..n.

    ``row_number() <= n`` gives Spark a group limit before the shuffle, so a task passes on
    at most n rows of a group.
    """
    w = Window.partitionBy(*partition).orderBy(F.col(value).desc(), F.col(tie).asc())
    return df.withColumn("row_num", F.row_number().over(w)).where(F.col("row_num") <= n)


def top_n_overall(df: DataFrame, value: str, tie: str, n: int) -> DataFrame:
    """The ``n`` highest rows of the whole table: per-task heads, merged once."""
    head = df.orderBy(F.col(value).desc(), F.col(tie).asc()).limit(n)
    w = Window.orderBy(F.col(value).desc(), F.col(tie).asc())
    return head.withColumn("row_num", F.row_number().over(w))


def window_top_n(df: DataFrame, key: str, size_ms: int, n: int, slide_ms: int | None = None) -> DataFrame:
    """The ``n`` most frequent keys of every tumbling or sliding window."""
    counts = windows.sliding_counts(df, [key], size_ms, slide_ms or size_ms)
    return top_n(counts, ["window_start", "window_end"], "cnt", key, n)


def ranked_counts(df: DataFrame, key: str, size_ms: int, slide_ms: int) -> DataFrame:
    """All keys of each sliding window in descending count order, as ``rnk``.

    ``rnk`` is 1 + the number of keys with a higher count, so equal counts share a rank.
    A window may hold any number of keys; its *distinct counts* are at most about the square
    root of twice its rows, so only that histogram is ordered and then joined back.
    """
    bounds = ["window_start", "window_end"]
    counts = windows.sliding_counts(df, [key], size_ms, slide_ms)
    histogram = counts.groupBy("window_start", "cnt").agg(F.count(F.lit(1)).alias("_keys"))
    above = (Window.partitionBy("window_start").orderBy(F.col("cnt").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    ranks = histogram.select("window_start", "cnt",
                             (F.coalesce(F.sum("_keys").over(above), F.lit(0)) + 1).alias("rnk"))
    return counts.join(ranks, ["window_start", "cnt"]).select(*bounds, key, "cnt", "rnk")


def top_two(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """The two highest values per group, repeats kept, as (value, rank)."""
    w = Window.partitionBy(*group).orderBy(F.col(value).desc())
    return (df.select(*group, value, F.row_number().over(w).alias("rank"))
            .where(F.col("rank") <= 2))


# A head is what leads: at most n (count, key), the highest first; equal counts by key.
Head = list[tuple[int, int]]


def _raised(head: Head, key: int, cnt: int, n: int) -> Head:
    """The head after a key's count has risen."""
    return sorted([*[h for h in head if h[1] != key], (cnt, key)], key=lambda h: (-h[0], h[1]))[:n]


def _head_changes(n: int, start: Head):
    """Pass over rows in order and report how each one changes the head.

    A row whose count is below the last of a full head cannot change it, as counts only rise,
    so all but the rows of leading keys are left out at once.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = start
        for batch in batches:
            seqs, keys, counts = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("seq", "key", "cnt"))
            begins = batch.column("opens").to_numpy(zero_copy_only=False)
            heads = batch.column("head")
            edges = [*np.flatnonzero(begins).tolist(), len(seqs)]
            out = []
            for a, b in zip([0, *edges], edges):
                if a < len(seqs) and begins[a]:
                    given = heads[a].as_py()
                    head = start if given is None else [(h["cnt"], h["key"]) for h in given]
                least = head[-1][0] if len(head) == n else 0
                for i in (np.flatnonzero(counts[a:b] >= least) + a).tolist():
                    new = _raised(head, int(keys[i]), int(counts[i]), n)
                    for rank in range(len(new)):
                        was = head[rank] if rank < len(head) else None
                        if was != new[rank]:
                            if was:
                                out.append((int(seqs[i]), rank + 1, "-U", was[1], was[0]))
                            out.append((int(seqs[i]), rank + 1, "+U" if was else "+I", new[rank][1], new[rank][0]))
                    head = new
            columns = list(zip(*out)) if out else [()] * 5
            types = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                             ["seq", "row_num", "op", "key", "cnt"])
    return run


def _heads_before(n: int, start: Head):
    """Of stretches in order, each with its own head: the head of all that came before."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = start
        for batch in batches:
            before = []
            for own in batch.column("own").to_pylist():
                before.append([{"cnt": c, "key": k} for c, k in head])
                for h in own:
                    if all(h["cnt"] > c for c, k in head if k == h["key"]):
                        head = _raised(head, h["key"], h["cnt"], n)
            kind = pa.list_(pa.struct([("cnt", pa.int64()), ("key", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("first"), pa.array(before, kind)], ["first", "head"])
    return run


def own_heads(counted: DataFrame, group: Sequence[str], key: str, n: int) -> DataFrame:
    """The ``n`` keys with the highest counts of each group of rows."""
    most = counted.groupBy(*group, key).agg(F.max("cnt").alias("cnt"))
    return top_n(most, group, "cnt", key, n) if group else top_n_overall(most, "cnt", key, n)


def top_n_changes(counted: DataFrame, key: str, n: int, *, start: Head = (), seq: str = "seq",
                  rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """The changelog of a top-N over counts that rise: (seq, row_num, op, key, cnt).

    ``counted`` has the count of a row's key, a number, after it (:func:`aggregates.running_count`);
    rows without a key have no rank.  After
    each row the ranks that changed come out: ``+I`` for a rank that is filled, ``-U`` and ``+U``
    for one that changes.  ``start`` is the head before the first row.

    The rows are one sequence, cut into stretches; the head before a stretch follows from the
    heads of the stretches themselves, at most n rows each, so all stretches run in parallel.
    """
    start = list(start)
    known = counted.where(F.col(key).isNotNull())
    rows = chunk_rows(known.select(F.col(seq).alias("seq"), F.col(key).cast("bigint").alias("key"), "cnt"),
                      [], ["seq"], rows_per_chunk)
    out = "seq bigint, row_num bigint, op string, key bigint, cnt bigint"
    kind = "array<struct<cnt:bigint,key:bigint>>"
    if dict(rows.dtypes)["_chunk"] == "int":  # a single stretch
        line = rows.select("seq", "key", "cnt", F.lit(False).alias("opens"), F.lit(None).cast(kind).alias("head"))
        whole = line.repartition(1).sortWithinPartitions("seq")
        return whole.mapInArrow(_head_changes(n, start), out).withColumnRenamed("key", key)
    own = own_heads(rows, ["_chunk"], "key", n).groupBy("_chunk").agg(F.sort_array(F.collect_list(F.struct(
        F.col("row_num"), "cnt", "key"))).alias("own"))
    firsts = rows.groupBy("_chunk").agg(F.min("seq").alias("first"))
    # One row for each stretch, in order and in one task.
    w = Window.orderBy("_chunk")
    line = firsts.join(own, "_chunk").withColumn("_n", F.row_number().over(w)).select("first", "own")
    before = line.mapInArrow(_heads_before(n, start), f"first bigint, head {kind}")
    opened = (rows.join(F.broadcast(before), F.col("seq") == F.col("first"), "left")
              .repartition("_chunk").sortWithinPartitions("_chunk", "seq"))
    changes = uncut(opened).select("seq", "key", "cnt", F.col("first").isNotNull().alias("opens"), "head").mapInArrow(
        _head_changes(n, start), out)
    return changes.withColumnRenamed("key", key)
