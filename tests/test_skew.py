"""Cut keys must give the same rows as plain windows, for any cut.

The data have one key with over a third of all rows, bursts in time and rows of the same
instant; the bound is set so low that even small keys are cut.
"""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from eventloom.operators import aggregates, lateness, patterns, windows
from eventloom.operators.ordered import chunk_rows, neighbourhood, running
from tests.fixtures import rows

BOUNDS = [4, 25]


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    data, ms = [], 1_000
    for seq in range(900):
        ms += rng.choice([0, 0, 0, 1, 1, 2, 3_000]) if seq % 300 < 250 else 0
        user = 0 if rng.random() < 0.4 else rng.randrange(1, 12)
        data.append((seq, user, rng.choice(["fail", "success", "other", "fail"]), ms, float(rng.randrange(50))))
    data += [(900 + i, None, "fail", ms + i, 1.0) for i in range(30)]
    df = spark.createDataFrame(data, "seq long, user_id long, url string, ts_ms long, value double")
    return df.withColumn("ts", F.timestamp_millis("ts_ms")).repartition(8).cache()


def plain(order=("ts_ms", "seq")):
    return Window.partitionBy("user_id").orderBy(*order)


@pytest.mark.parametrize("bound", BOUNDS)
@pytest.mark.parametrize("inclusive, reverse", [(True, False), (False, True)])
def test_running(skewed, bound, inclusive, reverse):
    out = running(skewed, ["user_id"], ["ts_ms", "seq"], {
        "n": ("count", F.lit(1)), "s": ("sum", F.col("ts_ms")), "hi": ("max", F.col("value")),
        "lo": ("min", F.struct("value", "seq"))}, inclusive=inclusive, reverse=reverse, rows_per_chunk=bound)
    order = [F.col("ts_ms").desc(), F.col("seq").desc()] if reverse else ["ts_ms", "seq"]
    w = plain(order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    want = skewed.select("seq", F.count(F.lit(1)).over(w).alias("n"), F.coalesce(F.sum("ts_ms").over(w), F.lit(0)).alias("s"),
                         F.max("value").over(w).alias("hi"), F.min(F.struct("value", "seq")).over(w).alias("lo"))
    assert rows(out, "seq", "n", "s", "hi", "lo") == rows(want, "seq", "n", "s", "hi", "lo")


@pytest.mark.parametrize("bound", BOUNDS)
def test_running_over_the_whole_table(skewed, bound):
    out = running(skewed, [], ["seq"], {"hi": ("max", F.col("ts_ms"))}, rows_per_chunk=bound)
    want = skewed.select("seq", F.max("ts_ms").over(Window.orderBy("seq")).alias("hi"))
    assert rows(out, "seq", "hi") == rows(want, "seq", "hi")


@pytest.mark.parametrize("bound", [25, 10_000])
def test_running_over_a_table_with_sparse_numbers(skewed, bound):
    """Number and size of the stretches follow the rows, not the numbers."""
    sparse = skewed.withColumn("seq", F.col("seq") * F.col("seq") * 1_000)
    out = running(sparse, [], ["seq"], {"hi": ("max", F.col("ts_ms"))}, rows_per_chunk=bound)
    want = sparse.select("seq", F.max("ts_ms").over(Window.orderBy("seq")).alias("hi"))
    assert rows(out, "seq", "hi") == rows(want, "seq", "hi")
    sizes = chunk_rows(sparse, [], ["seq"], bound).groupBy("_chunk").count().agg(F.max("count"), F.count("*")).first()
    assert sizes[0] <= bound and sizes[1] <= max(1, 4 * 930 // bound)


@pytest.mark.parametrize("bound", BOUNDS)
@pytest.mark.parametrize("before", [1, 3, 9])
def test_neighbourhood(skewed, bound, before):
    def build(w):
        return {"l": F.lag("seq", before).over(w), "s": F.sum("seq").over(w.rowsBetween(-before, 0))}

    out = neighbourhood(skewed, ["user_id"], ["ts_ms", "seq"], before, build, rows_per_chunk=bound)
    want = skewed.withColumns(build(plain()))
    assert rows(out, "seq", "l", "s") == rows(want, "seq", "l", "s")


def test_stretches_keep_to_the_bound(skewed):
    cut = chunk_rows(skewed, ["user_id"], ["ts_ms", "seq"], 25)
    sizes = cut.groupBy("user_id", "_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] <= 25
    assert cut.count() == skewed.count()


def test_second_order_column_runs_against_the_first(skewed):
    """The number that parts rows of one instant need not rise with time."""
    mixed = skewed.withColumn("pos", F.pmod(F.col("seq") * 577, F.lit(1009)))
    order = ["ts_ms", "pos"]
    out = running(mixed, ["user_id"], order, {"n": ("count", F.lit(1))}, rows_per_chunk=4)
    want = mixed.withColumn("n", F.row_number().over(plain(order)))
    assert rows(out, "seq", "n") == rows(want, "seq", "n")

    def build(w):
        return {"l": F.lag("seq", 2).over(w)}

    out = neighbourhood(mixed, ["user_id"], order, 2, build, rows_per_chunk=4)
    assert rows(out, "seq", "l") == rows(mixed.withColumns(build(plain(order))), "seq", "l")


@pytest.mark.parametrize("bound", BOUNDS)
def test_sessions(skewed, bound):
    out = windows.sessions(skewed, ["user_id"], 2, rows_per_chunk=bound)
    w = plain()
    flagged = skewed.withColumn("n", F.when(F.col("ts_ms") - F.lag("ts_ms", 1).over(w) <= 2, 0).otherwise(1))
    want = (flagged.withColumn("s", F.sum("n").over(w)).groupBy("user_id", "s")
            .agg(F.min("ts_ms").alias("window_start"), (F.max("ts_ms") + 2).alias("window_end"), F.count("*").alias("cnt")))
    cols = ["user_id", "window_start", "window_end", "cnt"]
    assert rows(out, *cols) == rows(want, *cols)


@pytest.mark.parametrize("bound", BOUNDS)
def test_count_windows_and_groups_of_n(skewed, bound):
    out = windows.count_windows(skewed, ["user_id"], 10, 2, "value", rows_per_chunk=bound)
    w = plain(("seq",))
    want = (skewed.withColumn("row_no", F.row_number().over(w))
            .withColumn("max_value", F.max("value").over(w.rowsBetween(-9, 0))).where("row_no % 2 = 0"))
    assert rows(out, "seq", "row_no", "max_value") == rows(want, "seq", "row_no", "max_value")
    fives = aggregates.every_nth_average(skewed, "user_id", "ts_ms", 5, rows_per_chunk=bound)
    whole = skewed.groupBy("user_id").count().agg(F.sum(F.expr("count div 5"))).first()[0]
    assert fives.count() == whole


@pytest.mark.parametrize("bound", BOUNDS)
def test_patterns(skewed, bound):
    fail = F.col("url") == "fail"
    w = plain()
    want = skewed.where(F.lit(True)).withColumns({
        "t1": F.lag("ts_ms", 2).over(w), "t2": F.lag("ts_ms", 1).over(w),
        "ok": fail & (F.lag("url", 1).over(w) == "fail") & (F.lag("url", 2).over(w) == "fail")}).where("ok")
    got = patterns.match_times(skewed, ["user_id"], fail, 3, rows_per_chunk=bound)
    assert rows(got, "user_id", "t1", "t2", "t3") == rows(want, "user_id", "t1", "t2", "ts_ms")
    machine = patterns.run_machine(skewed, ["user_id"], "url", patterns.THREE_FAILURES, rows_per_chunk=bound)
    assert rows(machine, "seq") == rows(want, "seq")


@pytest.mark.parametrize("bound", BOUNDS)
def test_machine_with_memory(skewed, bound):
    """States that depend on the whole history, against a plain loop."""
    machine = patterns.Machine(
        states=("even", "odd", "stuck"), initial="even",
        moves={"even": {"fail": "odd", "success": "even", "other": "even"},
               "odd": {"fail": "even", "success": "Matched", "other": "odd"},
               "stuck": {}})
    want, states = [], {}
    for seq, user, kind in skewed.orderBy("ts_ms", "seq").select("seq", "user_id", "url").collect():
        states[user], reports = machine.step(states.get(user, "even"), kind)
        if reports:
            want.append((seq,))
    got = patterns.run_machine(skewed, ["user_id"], "url", machine, rows_per_chunk=bound)
    assert rows(got, "seq") == sorted(want)


@pytest.mark.parametrize("bound", BOUNDS)
def test_machine_of_many_states(skewed, bound):
    """A counter of failures with more states than fit a number, against a plain loop."""
    n = 20
    names = tuple(f"n{i}" for i in range(n))
    moves = {names[i]: {"fail": names[(i + 1) % n], "success": "Matched" if i == n - 1 else names[i], "other": names[i]}
             for i in range(n)}
    machine = patterns.Machine(states=names, initial="n0", moves=moves)
    want, states = [], {}
    for seq, user, kind in skewed.orderBy("ts_ms", "seq").select("seq", "user_id", "url").collect():
        states[user], reports = machine.step(states.get(user, "n0"), kind)
        if reports:
            want.append((seq,))
    assert rows(patterns.run_machine(skewed, ["user_id"], "url", machine, rows_per_chunk=bound), "seq") == sorted(want)


@pytest.mark.parametrize("bound", BOUNDS)
def test_sequence(skewed, bound):
    """Strict, then relaxed, against a plain loop."""
    events = skewed.orderBy("ts_ms", "seq").select("user_id", "url", "ts_ms").collect()
    want = []
    for user in {e.user_id for e in events}:
        own = [e for e in events if e.user_id == user]
        for i, e in enumerate(own[:-1]):
            if e.url == "fail" and own[i + 1].url == "other":
                nxt = next((x.ts_ms for x in own[i + 2:] if x.url == "success"), None)
                if nxt is not None and nxt - e.ts_ms < 5000:
                    want.append((user, e.ts_ms, own[i + 1].ts_ms, nxt))
    kinds = [F.col("url") == k for k in ("fail", "other", "success")]
    got = patterns.match_sequence(skewed, ["user_id"], kinds, [True, False], 5000, rows_per_chunk=bound)
    assert want and rows(got, "user_id", "t1", "t2", "t3") == sorted(want, key=lambda r: tuple((v is None, v) for v in r))


@pytest.mark.parametrize("bound", BOUNDS)
def test_followed_by(skewed, bound):
    events = skewed.orderBy("ts_ms", "seq").select("user_id", "url", "ts_ms").collect()
    newest, want = max(e.ts_ms for e in events), []
    for i, e in enumerate(events):
        if e.url == "other":
            nxt = next((x.ts_ms for x in events[i + 1:] if x.user_id == e.user_id and x.url == "success"), None)
            hit = nxt is not None and nxt - e.ts_ms < 3000
            status = "matched" if hit else "timeout" if newest >= e.ts_ms + 3000 else "pending"
            want.append((e.user_id, e.ts_ms, nxt if hit else None, status))
    got = patterns.match_followed_by(skewed, ["user_id"], F.col("url") == "other", F.col("url") == "success", 3000,
                                     rows_per_chunk=bound)
    assert rows(got, "user_id", "first_ms", "second_ms", "status") == sorted(
        want, key=lambda r: tuple((v is None, v) for v in r))


@pytest.mark.parametrize("bound", BOUNDS)
def test_leader_periodic_and_firings(skewed, bound):
    base = aggregates.running_leader(skewed, "user_id")
    cut = aggregates.running_leader(skewed, "user_id", rows_per_chunk=bound)
    assert rows(cut, "seq", "leader", "leader_cnt") == rows(base, "seq", "leader", "leader_cnt")
    known = skewed.where("user_id IS NOT NULL")
    base = aggregates.periodic_counts(known, "user_id", 5000)
    cut = aggregates.periodic_counts(known, "user_id", 5000, rows_per_chunk=bound)
    assert rows(cut, "user_id", "tick_ms", "pv") == rows(base, "user_id", "tick_ms", "pv")
    arrivals = skewed.withColumn("arrival", F.col("seq") + F.pmod(F.col("seq") * 17, F.lit(41)))
    base = lateness.window_firings(arrivals, "user_id", 1000, 0, 4000)
    cut = lateness.window_firings(arrivals, "user_id", 1000, 0, 4000, rows_per_chunk=bound)
    cols = ["user_id", "window_start", "firing", "cnt"]
    assert rows(cut, *cols) == rows(base, *cols)


def test_order_of_input_does_not_matter(spark, skewed):
    want = rows(windows.over_average(skewed, ["user_id"], "ts_ms", 3, rows_per_chunk=25), "seq", "avg_ts_ms")
    for seed in range(3):
        mixed = skewed.orderBy(F.xxhash64(F.lit(seed), "seq")).repartition(5)
        got = windows.over_average(mixed, ["user_id"], "ts_ms", 3, rows_per_chunk=25)
        assert rows(got, "seq", "avg_ts_ms") == want
