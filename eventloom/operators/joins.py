"""Joins of two event streams.

The equi-key always carries a time part where the semantics give one, which spreads a hot
key over many shuffle partitions; AQE splits what is still skewed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.operators import windows
from eventloom.operators.ordered import ROWS_PER_CHUNK, neighbourhood, running

MAX_RULES = 100_000


def window_join(left: DataFrame, right: DataFrame, key: str, size_ms: int) -> DataFrame:
    """All pairs with equal ``key`` in the same tumbling window (columns must not clash)."""
    lw = left.withColumn("window", windows.tumbling(size_ms, "left_ts"))
    rw = right.withColumn("window", windows.tumbling(size_ms, "right_ts"))
    return windows.window_bounds(lw.join(rw, [key, "window"]))


def window_cogroup(left: DataFrame, right: DataFrame, key: str, size_ms: int, ms: str) -> DataFrame:
    """Per (key, window) both sides together, also when one side is empty.

    Each side is reduced to count, first and last time with map-side aggregation; no list
    of a whole group is built.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return windows.tumble(df, size_ms).select(key, "window_start", "window_end", F.lit(name).alias("_side"), ms)

    both = side(left, "left").unionByName(side(right, "right"))

    def of(name: str) -> Column:
        return F.when(F.col("_side") == name, F.col(ms))

    return both.groupBy(key, "window_start", "window_end").agg(
        F.count(of("left")).alias("n_left"), F.count(of("right")).alias("n_right"),
        F.min(of("left")).alias("first_left"), F.max(of("left")).alias("last_left"),
        F.min(of("right")).alias("first_right"), F.max(of("right")).alias("last_right"))


def window_cogroup_rows(left: DataFrame, right: DataFrame, key: str, size_ms: int, ms: str) -> DataFrame:
    """The members of the co-groups, one row each, with the sizes of both sides."""
    sizes = window_cogroup(left, right, key, size_ms, ms).select(
        key, "window_start", "window_end", "n_left", "n_right")
    members = (
        windows.tumble(left, size_ms).select(key, "window_start", F.lit("left").alias("side"), ms)
        .unionByName(windows.tumble(right, size_ms).select(key, "window_start", F.lit("right").alias("side"), ms)))
    return members.join(sizes, [key, "window_start"])


def time_slot(ms: Column, width: int) -> Column:
    return F.floor((ms - F.pmod(ms, F.lit(width))) / width).cast("bigint")


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ms: str, right_ms: str,
                  lower_ms: int, upper_ms: int, how: str = "inner") -> DataFrame:
    """Pairs with equal key and ``right`` in [left + lower, left + upper], both ends in; with
    ``how="full_outer"`` also the rows of both sides that have no partner.

    Time is cut into slots as wide as the interval.  A right row lies in one slot and a left
    row looks into at most two, so each pair is found once and (key, slot) is the join key,
    which spreads a hot key over its time.  A right row without a partner comes out of its one
    slot; a left row is without one if it comes out alone of every slot that it looked into,
    which is counted over these rows only.
    """
    width = max(upper_ms - lower_ms, 1)
    l_ms, r_ms = F.col(left_ms), F.col(right_ms)
    slots = F.sequence(time_slot(l_ms + lower_ms, width), time_slot(l_ms + upper_ms, width))
    in_time = r_ms.between(l_ms + lower_ms, l_ms + upper_ms)
    if how == "inner":
        probes = left.withColumn("_slot", F.explode(slots))
        hits = right.withColumn("_slot", time_slot(r_ms, width))
        return probes.join(hits, [key, "_slot"]).where(in_time).drop("_slot")
    if how != "full_outer":
        raise ValueError("how is inner or full_outer")
    # A row without a time has no slot, and one without a key or a time has no partner.
    probes = (left.withColumn("_slots", F.when(l_ms.isNotNull(), slots).otherwise(F.array(F.lit(None).cast("bigint"))))
              .withColumn("_slot", F.explode("_slots")).withColumn("_looked", F.size("_slots")).drop("_slots")
              .withColumnRenamed(key, "_left_key").withColumnRenamed("_slot", "_left_slot"))
    hits = (right.withColumn("_right_slot", time_slot(r_ms, width)).withColumnRenamed(key, "_right_key")
            .withColumn("_is_right", F.lit(True)))
    joined = probes.join(hits, (F.col("_left_key") == F.col("_right_key"))
                         & (F.col("_left_slot") == F.col("_right_slot")) & in_time, "full_outer")
    others_l, others_r = ([c for c in side.columns if c != key] for side in (left, right))
    met = joined.where("_is_right").select(F.coalesce("_left_key", "_right_key").alias(key), *others_l, *others_r)
    left_alone = (joined.where("_is_right is null").groupBy("_left_key", *others_l, "_looked")
                  .agg(F.count(F.lit(1)).alias("_alone"), F.count_distinct(F.coalesce("_left_slot", F.lit(0))).alias("_slots"))
                  .where("_slots = _looked")
                  .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.expr("cast(_alone div _looked as int)")))))
    nothing = [F.lit(None).cast(t).alias(c) for c, t in right.dtypes if c != key]
    return met.unionByName(left_alone.select(F.col("_left_key").alias(key), *others_l, *nothing))


def reconcile(app: DataFrame, third: DataFrame, key: str, app_wait_ms: int, third_wait_ms: int,
              keep: Sequence[str] = ()) -> DataFrame:
    """Match two payment logs by order; a row left alone after its wait becomes an alert.

    Inputs are (key, app_ms) and (key, third_ms), with any number of rows for a key.  The earlier
    row waits for the later: an app row ``app_wait_ms``, a third-party row ``third_wait_ms``.
    ``keep`` names other columns of either side to come out with its rows.
    """
    joined = interval_join(app, third, key, "app_ms", "third_ms", -third_wait_ms, app_wait_ms, "full_outer")
    status = (F.when(F.col("third_ms").isNull(), "third_missing")
              .when(F.col("app_ms").isNull(), "app_missing").otherwise("matched"))
    return joined.select(key, "app_ms", "third_ms", status.alias("status"), *keep)


def history_join(df: DataFrame, key: str, is_left: Column, order: Sequence[str] = ("seq",),
                 rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Join of the whole history of two sides, told per row instead of per pair.

    A row meets all rows of the other side of its key that came before it: ``n_partners`` says
    how many, ``newest_partner`` is the last column of ``order`` of the newest one (null if
    there is none).  Each pair is counted once, at its later row, so the sum of ``n_partners``
    is the number of pairs; the output has one row per input row, however hot a key is.
    """
    number, place = order[-1], F.struct(*order)
    rows = df.withColumn("side", F.when(is_left, "left").otherwise("right"))
    left, right = F.col("side") == "left", F.col("side") == "right"
    seen = running(rows, [key], order, {
        "_n_left": ("count", F.when(left, 1)), "_n_right": ("count", F.when(right, 1)),
        "_left": ("max", F.when(left, place)), "_right": ("max", F.when(right, place))},
        rows_per_chunk=rows_per_chunk)
    return seen.select(
        *rows.columns, F.when(left, F.col("_n_right")).otherwise(F.col("_n_left")).alias("n_partners"),
        F.when(left, F.col("_right")).otherwise(F.col("_left"))[number].alias("newest_partner"))


def history_pairs(left: DataFrame, right: DataFrame, key: str, most_pairs: int) -> DataFrame:
    """The pairs themselves, which grow with the square of a key: only up to ``most_pairs``.

    The pairs are counted first, from one count per key and side; above the bound this fails.
    """
    def sizes(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(key).agg(F.count(F.lit(1)).cast("decimal(19,0)").alias(name))

    pairs = sizes(left, "_l").join(sizes(right, "_r"), key).agg(F.sum(F.expr("_l * _r"))).first()[0] or 0
    if pairs > most_pairs:
        raise ValueError(f"{pairs} pairs, more than the {most_pairs} that were allowed")
    return left.join(right, key)


def checked_broadcast(rules: DataFrame, limit: int = MAX_RULES) -> DataFrame:
    """Broadcast ``rules`` only if it has at most ``limit`` rows; else leave the join to Spark."""
    return F.broadcast(rules) if rules.limit(limit + 1).count() <= limit else rules


def match_rules(actions: DataFrame, rules: DataFrame, key: str, order: Sequence[str] = ("seq",),
                latest: str | None = None, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Rows whose (previous, current) action of a key matches a rule (action1, action2).

    With ``latest`` (an order column of the rules) only the newest rule counts.
    """
    if latest:
        rules = rules.agg(F.max_by(F.struct("action1", "action2"), latest).alias("r")).select("r.*")
    paired = neighbourhood(actions, [key], order, 1, lambda w: {"action1": F.lag("action", 1).over(w)},
                           rows_per_chunk=rows_per_chunk)
    wanted = checked_broadcast(rules.select("action1", F.col("action2").alias("action")))
    return paired.join(wanted, ["action1", "action"]).withColumnRenamed("action", "action2")
