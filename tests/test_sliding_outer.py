"""Distinct counts of sliding windows without copies, and outer interval joins over slots."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators import joins, windows
from eventloom.streaming import jobs
from eventloom.streaming.replay import append_to_table, finish
from tests.fixtures import SHIFT, rows
from tests.test_streaming import brackets

HOUR = 3_600_000


@pytest.fixture(scope="module")
def visits(spark):
    """A user with over a third of all rows, gaps longer than a window, and null users."""
    rng, data, ms = random.Random(8), [], SHIFT - 7 * HOUR
    for i in range(1500):
        ms += rng.choice([0, 1, 60_000, 900_000, 900_000, 6 * HOUR if i % 50 == 0 else 1])
        data.append((i, 0 if i % 3 == 0 else rng.choice([None, *range(1, 40)]), ms))
    return spark.createDataFrame(data, "seq long, user_id long, ts_ms long").cache()


@pytest.mark.parametrize("size, slide", [(HOUR, HOUR), (2 * HOUR, HOUR), (4 * HOUR, 5 * 60_000)])
@pytest.mark.parametrize("bound", [30, 4_000_000])
def test_distinct_of_sliding_windows(visits, size, slide, bound):
    out = windows.sliding_distinct(visits, "user_id", size, slide, rows_per_chunk=bound)
    per_user = windows.sliding_counts(visits, ["user_id"], size, slide)
    want = per_user.groupBy("window_start", "window_end").agg(F.sum("cnt").alias("pv"), F.count(F.lit(1)).alias("uv"))
    assert rows(out, "window_start", "window_end", "pv", "uv") == rows(want, "window_start", "window_end", "pv", "uv")


def test_distinct_copies_no_row(spark, visits):
    """What is shuffled does not depend on how many windows a row is in."""
    def exploded(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Generate")
    few, many = (windows.sliding_distinct(visits, "user_id", n * 60_000, 60_000) for n in (2, 240))
    assert exploded(few) == exploded(many)
    assert windows.sliding_distinct(visits.limit(0), "user_id", HOUR, HOUR).count() == 0


def outer_pairs(left, right, lower, upper):
    out, met = [], set()
    for k, a in left:
        own = [(i, b) for i, (j, b) in enumerate(right) if j == k and k is not None and None not in (a, b) and lower <= b - a <= upper]
        met |= {i for i, _ in own}
        out += [(k, a, b) for _, b in own] or [(k, a, None)]
    return sorted([*out, *[(k, None, b) for i, (k, b) in enumerate(right) if i not in met]], key=str)


def logs(seed=4):
    rng = random.Random(seed)
    keys = [0, 0, 0, 1, 2, 3]
    left = [(rng.choice(keys), rng.randrange(0, 400) * 100) for _ in range(300)]
    right = [(rng.choice(keys), rng.randrange(0, 400) * 100) for _ in range(300)]
    return left + left[:20], right + right[:20]


@pytest.mark.parametrize("lower, upper", [(-300, 500), (0, 0), (100, 900), (-700, -200)])
def test_outer_interval_join(spark, lower, upper):
    """Repeated rows, null keys and times, a key with half of all rows."""
    left, right = logs()
    left, right = left + [(None, 100), (1, None), (None, 100)], right + [(None, 100), (2, None)]
    l = spark.createDataFrame(left, "k long, a long")
    r = spark.createDataFrame(right, "k long, b long")
    out = joins.interval_join(l, r, "k", "a", "b", lower, upper, "full_outer")
    assert out.columns == ["k", "a", "b"]
    assert sorted(map(tuple, out.collect()), key=str) == outer_pairs(left, right, lower, upper)
    assert joins.interval_join(l.limit(0), r.limit(0), "k", "a", "b", lower, upper, "full_outer").count() == 0


def test_hot_key_of_an_outer_join_is_spread(spark):
    """One key of a million rows a side: every row has its partner one step later, but the last."""
    n = 1_000_000
    l = spark.range(n).select(F.lit(7).alias("k"), (F.col("id") * 1000).alias("a"))
    r = spark.range(1, n).select(F.lit(7).alias("k"), (F.col("id") * 1000 - 990).alias("b"))
    out = joins.interval_join(l, r, "k", "a", "b", 0, 20, "full_outer")
    assert out.where("b - a = 10").count() == n - 1 and out.where("b is null").count() == 1
    per_task = out.groupBy(F.spark_partition_id()).count().agg(F.count("*")).first()[0]
    assert per_task > 1


@pytest.mark.parametrize("how", ["inner", "left_outer", "right_outer", "full_outer"])
def test_streamed_outer_join(spark, tmp_path, how):
    left, right = ([(k, SHIFT + t) for k, t in side] for side in logs(9))
    end = [(9, SHIFT + 10_000_000)]

    def stream(name, data):
        parts = [sorted(data, key=lambda r: r[1])[:150], sorted(data, key=lambda r: r[1])[150:], end]
        return (brackets(spark, str(tmp_path / name), parts, "k long, ms long")
                .select("k", F.timestamp_millis("ms").alias(name)))
    joined = jobs.interval_join(stream("left_ts", left), stream("right_ts", right), "k", -300, 500, how=how)
    finish(append_to_table(joined, str(tmp_path / "out"), str(tmp_path / "checkpoint")))
    got = (spark.read.schema(joined.schema).parquet(str(tmp_path / "out")).where("k <> 9")
           .select("k", F.unix_millis("left_ts"), F.unix_millis("right_ts")).collect())
    want = outer_pairs(left, right, -300, 500)
    if how in ("inner", "right_outer"):
        want = [r for r in want if r[1] is not None or how == "right_outer"]
    if how in ("inner", "left_outer"):
        want = [r for r in want if r[2] is not None or how == "left_outer"]
    if how == "inner":
        want = [r for r in want if None not in r]
    elif how == "right_outer":
        want = [r for r in want if r[2] is not None]
    elif how == "left_outer":
        want = [r for r in want if r[1] is not None]
    assert sorted(map(tuple, got), key=str) == want
