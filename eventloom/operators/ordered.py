"""Per-key ordered computations that stay parallel when one key holds most rows.

A plain ``OVER (PARTITION BY key ORDER BY t)`` sorts each key in a single task.  Here a
key above ``rows_per_chunk`` rows is cut into consecutive stretches of its order column.
Windows run per (key, stretch), and what one stretch must know of the others travels in a
small table: running totals (:func:`running`) or the few rows next to a cut
(:func:`neighbourhood`).  Keys below the bound keep one stretch and cost one shuffle, the
same as the plain window.

Two tables are broadcast.  Both are bounded by the row count N: at most
N / rows_per_chunk cut keys, and at most twice that many stretches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from eventloom.session import work_dir

ROWS_PER_CHUNK = 4_000_000

Measures = dict[str, tuple[str, Column]]

# name -> (aggregate of rows, aggregate that merges partial results)
_AGGREGATES = {
    "count": (F.count, F.sum),
    "sum": (F.sum, F.sum),
    "max": (F.max, F.max),
    "min": (F.min, F.min),
}


def _combine(fn: str, local: Column, carry: Column) -> Column:
    if fn in ("count", "sum"):
        return F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))
    return (F.greatest if fn == "max" else F.least)(local, carry)


def _same_key(keys: Sequence[str], prefix: str) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(prefix + k))
    return cond


def _oversized(df: DataFrame, group: Sequence[str], column: str, rows_per_chunk: int,
               which: str = "true") -> DataFrame:
    """Groups above the bound, with the step that cuts their range of ``column`` evenly."""
    return (
        df.groupBy(*group)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(column).alias("_lo"), F.max(column).alias("_hi"))
        .where((F.col("_n") > rows_per_chunk) & F.expr(which))
        .select(*[F.col(k).alias("_h_" + k) for k in group], "_lo",
                F.expr(f"(_hi - _lo) div ((_n + {rows_per_chunk - 1}) div {rows_per_chunk}) + 1")
                .alias("_width"))
    )


def _written(small: DataFrame) -> DataFrame | None:
    """The table, stored in the shared folder and computed once; None if it is empty."""
    spark = small.sparkSession
    path = work_dir(spark, "cut")
    small.write.parquet(path)
    stored = spark.read.schema(small.schema).parquet(path)
    return None if stored.isEmpty() else stored


def _piece(column: str) -> Column:
    return F.coalesce(F.expr(f"(`{column}` - _lo) div _width"), F.lit(0))


def chunk_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Add ``_chunk`` (stretch, rising with ``order``) and ``_cut`` (is the key cut).

    The order columns are integers.  A large key is cut evenly by the first one; a piece that
    is still too large, because the key is busier at some times than at others, is cut again
    over its own narrower range, and pieces of a single instant by the second order column.
    Where the order columns are unique, no stretch is above the bound in the end.  Without keys the whole table is one sequence, cut in the
    same way as a large key.

    The keys are counted before the plan is built (one pass over the key and order columns,
    aggregated map-side): without a large key the result is the plain window.  The cuts are
    small tables in the shared folder, so later steps read them instead of counting again.

    A frame that already has stretches keeps them, so several steps over the same keys and
    order share one cut (:func:`uncut` drops it at the end).
    """
    if "_chunk" in df.columns:
        return df
    keys = list(keys)
    large = _oversized(df, keys, order[0], rows_per_chunk)
    whole = None if keys else large.first()
    large = _written(large) if keys else None
    if large is None and whole is None:
        return df.withColumns({"_chunk": F.lit(0), "_cut": F.lit(False)})
    if whole is not None:
        bounds = {"_lo": F.lit(whole["_lo"]), "_width": F.lit(whole["_width"])}
        rows = df.withColumns(bounds)
    else:
        rows = df.join(F.broadcast(large), _same_key(keys, "_h_"), "left")
    rows = (rows.withColumns({"_c0": _piece(order[0]), "_cut": F.col("_lo").isNotNull()})
            .drop("_lo", "_width", *["_h_" + k for k in keys]))
    pieces = ["_c0"]
    for column in order[:2]:
        # Each round at least halves the range of a piece, so this ends; a piece that is then
        # still too large holds a single value of the column, and only the next one parts it.
        while True:
            group = [*keys, *pieces]
            dense = _written(_oversized(rows.where("_cut"), group, column, rows_per_chunk, "_hi > _lo"))
            if dense is None:
                break
            name = f"_c{len(pieces)}"
            rows = (rows.join(F.broadcast(dense), _same_key(group, "_h_"), "left")
                    .withColumn(name, _piece(column))
                    .drop("_lo", "_width", *["_h_" + k for k in group]))
            pieces.append(name)
    return rows.withColumn("_chunk", F.struct(*pieces)).drop(*pieces)


def uncut(df: DataFrame) -> DataFrame:
    return df.drop("_chunk", "_cut")


def _directed(order: Sequence[str], reverse: bool) -> list[Column]:
    return [F.col(c).desc() if reverse else F.col(c).asc() for c in order]


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], measures: Measures, *,
            inclusive: bool = True, reverse: bool = False,
            rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Running aggregates per key: one output row per input row.

    ``measures`` maps an output name to (``count|sum|max|min``, expression).
    ``inclusive=False`` leaves out the current row; ``reverse=True`` runs over the
    following rows instead of the preceding ones.
    """
    keys = list(keys)
    rows = chunk_rows(df, keys, order, rows_per_chunk)
    frame = (
        Window.partitionBy(*keys, "_chunk").orderBy(*_directed(order, reverse))
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    local = rows.withColumns(
        {"_l_" + name: _AGGREGATES[fn][0](value).over(frame) for name, (fn, value) in measures.items()})

    totals = rows.where("_cut").groupBy(*keys, "_chunk").agg(
        *[_AGGREGATES[fn][0](value).alias("_t_" + name) for name, (fn, value) in measures.items()])
    before = (
        Window.partitionBy(*(keys or [F.lit(0)])).orderBy(*_directed(["_chunk"], reverse))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carry = totals.select(
        *[F.col(k).alias("_h_" + k) for k in keys], F.col("_chunk").alias("_h_chunk"),
        *[_AGGREGATES[fn][1]("_t_" + name).over(before).alias("_p_" + name)
          for name, (fn, _) in measures.items()])

    joined = local.join(F.broadcast(carry),
                        (F.col("_chunk") == F.col("_h_chunk")) & _same_key(keys, "_h_"), "left")
    # `df` may come with its stretches; then they stay for the next step.
    return joined.select(
        *[F.col(c) for c in df.columns],
        *[_combine(fn, F.col("_l_" + name), F.col("_p_" + name)).alias(name)
          for name, (fn, _) in measures.items()])


def neighbourhood(df: DataFrame, keys: Sequence[str], order: Sequence[str], before: int,
                  build: Callable[[WindowSpec], dict[str, Column]], *,
                  rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Window expressions that look back at most ``before`` rows of the same key.

    ``build`` gets the ordered window and returns the new columns (``lag``, or an
    aggregate over ``rowsBetween(-before, 0)``).  Each stretch of a cut key also gets
    copies of the ``before`` rows that precede it.
    """
    keys = list(keys)
    rows = chunk_rows(df, keys, order, rows_per_chunk)
    per_chunk = Window.partitionBy(*keys, "_chunk")
    tail = (
        rows.where("_cut")
        .withColumn("_from_end", F.row_number().over(per_chunk.orderBy(*_directed(order, True))))
        .where(F.col("_from_end") <= before)
    )
    # The next `before` tail rows name every later stretch that is close enough.
    ahead = (Window.partitionBy(*keys).orderBy(F.col("_chunk"), *_directed(order, False))
             .rowsBetween(1, before))
    copies = (
        tail.withColumn("_to", F.array_remove(F.array_distinct(F.collect_list("_chunk").over(ahead)),
                                              F.col("_chunk")))
        .withColumn("_chunk", F.explode("_to"))
        .select(*rows.columns, F.lit(True).alias("_copy"))
    )
    seen = rows.select(*rows.columns, F.lit(False).alias("_copy")).unionByName(copies)
    ordered = per_chunk.orderBy(*_directed(order, False))
    kept = seen.withColumns(build(ordered)).where("not _copy").drop("_copy")
    return kept if "_chunk" in df.columns else uncut(kept)
