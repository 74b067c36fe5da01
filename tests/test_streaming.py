"""Streams over several micro-batches: equal to the batch operators, also across a restart."""

import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators import aggregates, joins, lateness, patterns, ranking, windows
from eventloom.session import stream_session
from eventloom.sinks import writers
from eventloom.sources.tables import EVENTS_SCHEMA, as_clicks, with_arrival
from eventloom.streaming import jobs, late, processors
from eventloom.streaming.replay import append_to_table, batches_to_table, click_stream, finish, replay, write_slices
from tests.fixtures import LOGINS, ORDERS, SHIFT, rows

HOUR = 3_600_000
SLICES = 5


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """900 events with ties, a hot user and gaps, as slices in time order and a batch frame."""
    data = []
    ms = SHIFT
    kinds = ["click", "error", "error", "purchase", "error", "signup", "view"]
    for i in range(900):
        ms += (i * 7919) % 900_000
        user = 0 if i % 3 == 0 else (i * 31) % 23
        data.append((i, user, kinds[(i * i + i // 7) % 7], ms, float(i % 40)))
    df = (spark.createDataFrame(data, "event_id long, user_id long, event_type string, ms long, value double")
          .select("event_id", F.timestamp_millis("ms").cast("timestamp_ntz").alias("ts"), "user_id", "event_type",
                  "value", F.lit("{}").alias("props")))
    folder = str(tmp_path_factory.mktemp("slices"))
    write_slices(df, folder, "event_id", SLICES)
    return folder, as_clicks(spark.read.schema(EVENTS_SCHEMA).parquet(folder)).cache()


def newest(batch):
    return batch.agg(F.max("ts_ms")).first()[0]


def run(spark, stored, job, **kw):
    return replay(spark, job, stored[0], files_per_batch=1, **kw)


def test_slices_come_as_micro_batches(spark, stored):
    out = run(spark, stored, lambda s: s.groupBy("url").agg(F.count(F.lit(1)).alias("cnt")), mode="update")
    assert out.select("batch_id").distinct().count() == SLICES
    last = out.groupBy("url").agg(F.max("cnt").alias("cnt"))
    assert rows(last, "url", "cnt") == rows(stored[1].groupBy("url").agg(F.count(F.lit(1)).alias("cnt")), "url", "cnt")


WINDOW_JOBS = {
    "tumbling": (lambda s: jobs.tumbling_counts(s, "user_id", HOUR),
                 lambda b: windows.sliding_counts(b, ["user_id"], HOUR, HOUR), ["user_id", "window_end", "cnt"]),
    "sliding": (lambda s: jobs.sliding_counts(s, "url", 2 * HOUR, HOUR),
                lambda b: windows.sliding_counts(b, ["url"], 2 * HOUR, HOUR), ["url", "window_end", "cnt"]),
    "session": (lambda s: jobs.session_counts(s, "user_id", HOUR),
                lambda b: windows.sessions(b, ["user_id"], HOUR), ["user_id", "window_start", "window_end", "cnt"]),
    "visitors": (lambda s: jobs.unique_visitors(s, HOUR),
                 lambda b: aggregates.unique_visitors(b, HOUR), ["window_end", "uv", "pv"]),
    "cogroup": (lambda s: jobs.window_cogroup(s.where("url = 'click'"), s.where("url = 'error'"), "user_id", HOUR),
                lambda b: joins.window_cogroup(b.where("url = 'click'"), b.where("url = 'error'"), "user_id", HOUR, "ts_ms"),
                ["user_id", "window_end", "n_left", "n_right", "first_left", "last_right"]),
    "by_hand": (lambda s: jobs.stateful(s.select("url", "ts", "ts_ms"), "url", processors.TumblingByHand(HOUR), delay_ms=0),
                lambda b: windows.sliding_counts(b, ["url"], HOUR, HOUR), ["url", "window_end", "cnt"]),
}


@pytest.mark.parametrize("name", WINDOW_JOBS)
def test_windows(spark, stored, name):
    stream, batch, cols = WINDOW_JOBS[name]
    slack = 1 if name == "by_hand" else 0
    want = batch(stored[1]).where(F.col("window_end") - slack <= newest(stored[1]))
    assert rows(run(spark, stored, stream), *cols) == rows(want, *cols)


def test_cumulating_windows(spark, stored):
    out = run(spark, stored, lambda s: jobs.cumulating_counts(s, "url", 4 * HOUR, HOUR))
    want = (windows.cumulating_counts(stored[1], ["url"], 4 * HOUR, HOUR)
            .where(F.col("window_start") + 4 * HOUR <= newest(stored[1])))
    cols = ["url", "window_start", "window_end", "cnt"]
    assert rows(out, *cols) == rows(want, *cols)


def test_window_top_n(spark, stored):
    out = run(spark, stored, lambda s: jobs.tumbling_counts(s, "user_id", HOUR), shape=jobs.rank_closed_windows(2, "user_id"))
    want = ranking.window_top_n(stored[1], "user_id", HOUR, 2).where(F.col("window_end") <= newest(stored[1]))
    cols = ["window_end", "row_num", "user_id", "cnt"]
    assert rows(out, *cols) == rows(want, *cols)


def stream_sides(s):
    l = s.where("url = 'click'").select("user_id", F.col("ts").alias("left_ts"), F.col("ts_ms").alias("left_ms"))
    r = s.where("url = 'error'").select("user_id", F.col("ts").alias("right_ts"), F.col("ts_ms").alias("right_ms"))
    return l, r


def test_joins(spark, stored):
    l, r = stream_sides(stored[1])
    cols = ["user_id", "left_ms", "right_ms"]
    out = run(spark, stored, lambda s: jobs.interval_join(*stream_sides(s), "user_id", -HOUR, 2 * HOUR).select(*cols))
    want = joins.interval_join(l, r, "user_id", "left_ms", "right_ms", -HOUR, 2 * HOUR)
    assert rows(out, *cols) == rows(want, *cols)
    out = run(spark, stored, lambda s: jobs.window_join(*stream_sides(s), "user_id", 4 * HOUR).select(*cols))
    assert rows(out, *cols) == rows(joins.window_join(l, r, "user_id", 4 * HOUR), *cols)


STATE_JOBS = {
    "every_nth": ("seq user_id ts_ms", processors.EveryNth(5), None,
                  lambda b: aggregates.every_nth_average(b, "user_id", "ts_ms", 5), ["user_id", "group_no", "avg_ts_ms"]),
    "count_window": ("seq user_id value", processors.CountWindow(10, 2), None,
                     lambda b: windows.count_windows(b, ["user_id"], 10, 2, "value"), ["seq", "row_no", "cnt", "max_value"]),
    "changelog": ("seq user_id", processors.CountChangelog(), None,
                  lambda b: aggregates.count_changelog(b, "user_id"), ["seq", "op", "cnt"]),
    "over": ("seq user_id ts ts_ms url", processors.OverAverage(3), 0,
             lambda b: windows.over_average(b, ["user_id"], "ts_ms", 3), ["seq", "avg_ts_ms"]),
    "times": ("seq user_id ts ts_ms url", processors.ConsecutiveMatch("error", 3, 4 * HOUR), 0,
              lambda b: patterns.match_times(b, ["user_id"], F.col("url") == "error", 3, within_ms=4 * HOUR),
              ["user_id", "t1", "t2", "t3"]),
    "followed": ("seq user_id ts ts_ms url", processors.FollowedBy("signup", "purchase", 2 * HOUR), 0,
                 lambda b: patterns.match_followed_by(b, ["user_id"], F.col("url") == "signup", F.col("url") == "purchase",
                                                      2 * HOUR).where("status <> 'pending'"),
                 ["user_id", "first_ms", "second_ms", "status"]),
    "sequence": ("seq user_id ts ts_ms url", processors.SequenceMatch([["error"], ["click", "view"], ["purchase"]],
                                                                       [True, False], 9 * HOUR), 0,
                 lambda b: patterns.match_sequence(b, ["user_id"], [F.col("url") == "error", F.col("url").isin("click", "view"),
                                                                    F.col("url") == "purchase"], [True, False], 9 * HOUR),
                 ["user_id", "t1", "t2", "t3"]),
    "periodic": ("seq user_id ts ts_ms url", processors.PeriodicCount(HOUR), 0,
                 lambda b: aggregates.periodic_counts(b, "user_id", HOUR), ["user_id", "tick_ms", "pv"]),
}


@pytest.mark.parametrize("name", STATE_JOBS)
def test_keyed_state(spark, stored, name):
    fields, processor, delay, batch, cols = STATE_JOBS[name]
    out = run(spark, stored, lambda s: jobs.stateful(s.select(*fields.split()), "user_id", processor, delay_ms=delay))
    want = rows(batch(stored[1]), *cols)
    assert want and rows(out, *cols) == want


@pytest.mark.parametrize("name", ["every_nth", "over"])
def test_time_slices_of_a_table(spark, stored, name):
    """A table above the slice bound is replayed slice by slice, with the same result."""
    fields, processor, delay, batch, cols = STATE_JOBS[name]
    out = replay(spark, lambda s: jobs.stateful(s.select(*fields.split()), "user_id", processor, delay_ms=delay),
                 stored[0], rows_per_slice=400)
    assert rows(out, *cols) == rows(batch(stored[1]), *cols)


CLOSED_JOBS = {
    "sessions": (lambda s: jobs.session_counts(s, "user_id", HOUR),
                 lambda b: windows.sessions(b, ["user_id"], HOUR), ["user_id", "window_start", "window_end", "cnt"]),
    "timers": (lambda s: jobs.stateful(s.select("seq", "user_id", "ts", "ts_ms", "url"), "user_id",
                                       processors.EventTimer(HOUR), delay_ms=0),
               lambda b: b.select("user_id", (F.col("ts_ms") + HOUR).alias("timer_ms")).distinct(), ["user_id", "timer_ms"]),
    "followed": (lambda s: jobs.stateful(s.select("seq", "user_id", "ts", "ts_ms", "url"), "user_id",
                                         processors.FollowedBy("click", "purchase", 200 * HOUR), delay_ms=0),
                 lambda b: patterns.match_followed_by(b, ["user_id"], F.col("url") == "click", F.col("url") == "purchase",
                                                      200 * HOUR, ended=True),
                 ["user_id", "first_ms", "second_ms", "status"]),
}


@pytest.mark.parametrize("slices", [1, 4])
@pytest.mark.parametrize("name", CLOSED_JOBS)
def test_end_of_input_closes(spark, stored, name, slices):
    """The last sessions, timers and waits come out too, and the closing row itself does not."""
    job, batch, cols = CLOSED_JOBS[name]
    out = replay(spark, job, stored[0], rows_per_slice=900 // slices, closing="click")
    assert rows(out, *cols) == rows(batch(stored[1]), *cols)


def test_closing_an_empty_input(spark, tmp_path):
    spark.createDataFrame([], EVENTS_SCHEMA).write.parquet(str(tmp_path / "none"))
    out = replay(spark, lambda s: jobs.tumbling_counts(s, "user_id", HOUR), str(tmp_path / "none"), closing="click")
    assert out.count() == 0


def test_state_machine_and_rules(spark, stored):
    kind = F.when(F.col("url") == "error", "fail").otherwise(F.col("url"))
    out = run(spark, stored, lambda s: jobs.stateful(s.select("seq", "user_id", "ts_ms", kind.alias("kind")), "user_id",
                                                     processors.RunMachine(patterns.THREE_FAILURES)))
    want = patterns.run_machine(stored[1].withColumn("kind", kind), ["user_id"], "kind", patterns.THREE_FAILURES)
    assert rows(out, "seq", "state") == rows(want, "seq", "state")
    rules = spark.createDataFrame([("click", "error")], "action1 string, action2 string")
    actions = stored[1].select("seq", "user_id", F.col("url").alias("action"))
    pairs = run(spark, stored, lambda s: jobs.stateful(s.select("seq", "user_id", F.col("url").alias("action")), "user_id",
                                                       processors.PreviousAction()))
    got = pairs.join(F.broadcast(rules), ["action1", "action2"])
    assert rows(got, "seq") == rows(joins.match_rules(actions, rules, "user_id"), "seq")


def test_event_timers(spark, stored):
    out = run(spark, stored, lambda s: jobs.stateful(s.select("seq", "user_id", "ts", "ts_ms", "url"), "user_id",
                                                     processors.EventTimer(HOUR), delay_ms=0))
    want = (stored[1].select("user_id", (F.col("ts_ms") + HOUR).alias("timer_ms")).distinct()
            .where(F.col("timer_ms") <= newest(stored[1])))
    assert rows(out, "user_id", "timer_ms") == rows(want, "user_id", "timer_ms")


def test_buffer_survives_restart(spark, stored, tmp_path):
    """Stop after two slices, go on from the checkpoint: no flush is lost or repeated."""
    folder, batch = stored
    session = stream_session(spark)
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "checkpoint"))
    events = spark.read.schema(EVENTS_SCHEMA).parquet(folder)

    def go():
        sharded = click_stream(session, source).select("seq", "url", (F.col("user_id") % 4).alias("shard"))
        finish(append_to_table(jobs.stateful(sharded, "shard", processors.BufferedBatches(10)), out, checkpoint))

    events.where("event_id < 333").coalesce(1).write.mode("append").parquet(source)
    go()
    first = spark.read.parquet(out).count()
    go()  # nothing new
    assert spark.read.parquet(out).count() == first
    events.where("event_id >= 333").coalesce(1).write.mode("append").parquet(source)
    go()
    want = aggregates.buffered_batches(batch.withColumn("shard", F.col("user_id") % 4), "shard", 10, "url").select(
        "shard", "batch_no", F.col("rows")[0]["seq"].alias("first_seq"), F.array_join("rows.url", ",").alias("urls"))
    cols = ["shard", "batch_no", "first_seq", "urls"]
    assert rows(spark.read.parquet(out), *cols) == rows(want, *cols)


def test_keyed_table_from_stream(spark, stored, tmp_path):
    table = writers.KeyedTable(str(tmp_path / "t"), "user_id", "url", ("ts_ms", "seq"))
    stream = click_stream(stream_session(spark), stored[0], files_per_batch=1).select("user_id", "url", "ts_ms", "seq")
    finish(table.writer(stream, str(tmp_path / "c")))
    want = stored[1].groupBy("user_id").agg(F.max_by("url", F.struct("ts_ms", "seq")).alias("url"))
    assert rows(table.latest(spark), "user_id", "url") == rows(want, "user_id", "url")


def test_rolling_text_and_documents(spark, stored, tmp_path):
    session = stream_session(spark)
    lines = click_stream(session, stored[0]).select(F.col("url").alias("value"))
    finish(writers.rolling_text(lines, str(tmp_path / "text"), str(tmp_path / "c1"), max_records=100))
    assert spark.read.text(str(tmp_path / "text")).count() == 900
    assert len(list((tmp_path / "text").glob("part-*"))) >= 9
    docs = click_stream(session, stored[0], 1).select(F.lit("clicks").alias("index_name"), F.col("url").alias("doc"))
    finish(writers.document_bulks(docs, str(tmp_path / "docs"), str(tmp_path / "c2")))
    assert spark.read.text(str(tmp_path / "docs")).where("index_name = 'clicks'").count() == 900


def test_console_and_noop(spark, stored, tmp_path):
    session = stream_session(spark)
    stream = click_stream(session, stored[0]).where("seq < 3").select("seq")
    query = writers.console(stream, "clicks", str(tmp_path / "c")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert query.name == "clicks" and sum(p["numInputRows"] for p in query.recentProgress) > 0
    finish(stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "n")))


# ---- small inputs with one file per bracket ----------------------------------------------

def brackets(spark, folder, groups, schema):
    for group in groups:
        spark.createDataFrame(group, schema).coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.02)
    session = stream_session(spark)
    return (session.readStream.schema(spark.createDataFrame([], schema).schema)
            .option("maxFilesPerTrigger", 1).parquet(folder))


def collect(spark, df, tmp_path, mode="append"):
    out = str(tmp_path / "out")
    finish(batches_to_table(df, out, str(tmp_path / "checkpoint"), mode))
    return spark.read.parquet(out)


def timed(spark, tmp_path, groups):
    seq = iter(range(1000))
    data = [[(next(seq), "u", "x", SHIFT + t) for t in g] for g in groups]
    return (brackets(spark, str(tmp_path / "in"), data, "seq long, user_id string, url string, ts_ms long")
            .withColumn("ts", F.timestamp_millis("ts_ms")))


LATE = [[1000, 2000], [12000], [3000, 25000], [4000, 26000], [90000], [5000]]


def late_step(spark, tmp_path, step, name):
    s = timed(spark, tmp_path / name, LATE).withColumn("arrival", F.col("seq"))
    out = str(tmp_path / name / "out")
    finish(batches_to_table(s, out, str(tmp_path / name / "checkpoint"), "append", step=step))
    return spark.read.parquet(out)


def test_late_rows_go_to_the_side_output(spark, tmp_path):
    out = late_step(spark, tmp_path, late.split(10000, 0, 0), "split")
    assert rows(out.where("tag = 'late'"), "ts_ms") == [(SHIFT + t,) for t in (3000, 4000, 5000)]
    assert out.count() == sum(map(len, LATE))
    fired = late_step(spark, tmp_path, late.firings("url", 10000, 0, 0), "fired")
    assert rows(fired, "window_end", "firing", "cnt") == [
        (SHIFT + 10000, 0, 2), (SHIFT + 20000, 0, 1), (SHIFT + 30000, 0, 2)]


def test_allowed_lateness_fires_again(spark, tmp_path):
    out = late_step(spark, tmp_path, late.split(10000, 0, 60000), "split")
    assert rows(out.where("tag = 'late'"), "ts_ms") == [(SHIFT + 5000,)]
    fired = late_step(spark, tmp_path, late.firings("url", 10000, 0, 60000), "fired")
    assert rows(fired.where("firing > 0"), "window_end", "firing", "cnt") == [(SHIFT + 10000, 1, 3), (SHIFT + 10000, 2, 4)]
    assert rows(fired.where("firing = 0"), "window_end", "cnt") == [
        (SHIFT + 10000, 2), (SHIFT + 20000, 1), (SHIFT + 30000, 2)]


@pytest.mark.parametrize("slices", [1, 4])
def test_lateness_does_not_depend_on_the_batches(spark, stored, slices):
    """Rows that arrive in disorder, in one micro-batch or in several."""
    def out(step, **kw):
        return replay(spark, with_arrival, stored[0], rows_per_slice=900 // slices, step=step,
                      order=F.expr("event_id + pmod(event_id * 17, 41)"), **kw)

    b = with_arrival(stored[1])
    want = lateness.classify(b, HOUR, HOUR, HOUR)
    assert want.select("tag").distinct().count() == 3
    assert rows(out(late.split(HOUR, HOUR, HOUR)), "seq", "tag") == rows(want, "seq", "tag")
    cols = ["url", "window_start", "firing", "cnt"]
    assert (rows(out(late.firings("url", HOUR, HOUR, HOUR), closing="click"), *cols)
            == rows(lateness.window_firings(b, "url", HOUR, HOUR, HOUR), *cols))


def test_update_mode_refines_a_window(spark, tmp_path):
    """With the lateness in the watermark delay, update mode emits the raised counts."""
    s = timed(spark, tmp_path, [[1000, 2000], [12000], [3000]])
    counts = jobs.tumbling_counts(s, "url", 10000, delay_ms=60000)
    out = collect(spark, counts, tmp_path, mode="update").where(F.col("window_end") == SHIFT + 10000)
    assert [r[1] for r in rows(out, "batch_id", "cnt")] == [2, 3]


def test_watermark_of_a_union_is_the_lower_one(spark, tmp_path):
    slow = timed(spark, tmp_path / "a", [[1000], [2000]])
    fast = timed(spark, tmp_path / "b", [[1000], [50000]])
    both = jobs.watermarked(slow).unionByName(jobs.watermarked(fast))
    counts = both.groupBy(windows.tumbling(10000)).agg(F.count(F.lit(1)).alias("cnt"))
    assert collect(spark, windows.window_bounds(counts), tmp_path).count() == 0


def test_login_failures_and_order_timeout(spark, tmp_path):
    def stream(folder, data, groups):
        seqs = [(i, k, v, SHIFT + t) for i, (k, v, t) in enumerate(data)]
        parts = [seqs[a:b] for a, b in groups]
        return (brackets(spark, str(folder / "in"), parts, "seq long, user_id string, url string, ts_ms long")
                .withColumn("ts", F.timestamp_millis("ts_ms")))

    class Logins(processors.ConsecutiveMatch):
        OUT = "user_id string, t1 long, t2 long, t3 long"

    class Orders(processors.FollowedBy):
        OUT = "user_id string, first_ms long, second_ms long, status string"

    logins = stream(tmp_path / "l", [*LOGINS, ("user_9", "end", 100000)], [(0, 2), (2, 5), (5, 8)])
    out = collect(spark, jobs.stateful(logins, "user_id", Logins("fail", 3, 10000), delay_ms=0), tmp_path / "l")
    assert rows(out, "user_id", "t1", "t2", "t3") == [("user_1", SHIFT + 2000, SHIFT + 3000, SHIFT + 5000)]
    orders = stream(tmp_path / "o", ORDERS, [(0, 2), (2, 4), (4, 6)])
    out = collect(spark, jobs.stateful(orders, "user_id", Orders("create", "pay", 15 * 60000), delay_ms=0), tmp_path / "o")
    assert rows(out, "user_id", "status") == [("order_1", "matched"), ("order_2", "timeout"), ("order_3", "matched")]


def test_reconcile(spark, tmp_path):
    app = [[("order-1", 1000), ("order-2", 2000)], [("order-3", 3500)], [("end", 100000)]]
    third = [[("order-1", 3000)], [("order-3", 4000)], [("end", 100000)]]

    def side(name, groups):
        shifted = [[(k, SHIFT + t) for k, t in g] for g in groups]
        return (brackets(spark, str(tmp_path / name), shifted, "id string, ms long")
                .select("id", F.timestamp_millis("ms").alias(name)))

    out = collect(spark, jobs.reconcile(side("left_ts", app), side("right_ts", third), "id", 5000, 5000), tmp_path)
    assert rows(out.where("id <> 'end'"), "id", "status") == [
        ("order-1", "matched"), ("order-2", "third_missing"), ("order-3", "matched")]


def test_three_event_timers(spark, tmp_path):
    class Timers(processors.EventTimer):
        OUT = "user_id string, timer_ms long"

    data = [[(0, "Mary", "x", SHIFT + 1000)], [(1, "Alice", "x", SHIFT + 11000)], [(2, "Bob", "x", SHIFT + 11001)],
            [(3, "end", "x", SHIFT + 60000)]]
    s = (brackets(spark, str(tmp_path / "in"), data, "seq long, user_id string, url string, ts_ms long")
         .withColumn("ts", F.timestamp_millis("ts_ms")))
    out = collect(spark, jobs.stateful(s, "user_id", Timers(10000), delay_ms=0), tmp_path)
    assert rows(out, "timer_ms", "user_id") == [(SHIFT + 11000, "Mary"), (SHIFT + 21000, "Alice"), (SHIFT + 21001, "Bob")]


def watch(spark, df, tmp_path, done, seconds=60):
    """Run a processing-time stream until ``done(output)``; such a stream never ends itself."""
    out = tmp_path / "out"
    query = (batches_to_table(df, str(out), str(tmp_path / "checkpoint"), "append")
             .trigger(processingTime="300 milliseconds").start())
    end = time.time() + seconds
    try:
        while time.time() < end and query.isActive:
            time.sleep(1)
            if list(out.glob("batch_id=*/_SUCCESS")) and done(spark.read.parquet(str(out))):
                break
    finally:
        query.stop()
    return spark.read.parquet(str(out))


def test_processing_time_timer(spark, stored, tmp_path):
    """A timer set with a click fires in a later micro-batch, once its wall-clock wait is over."""
    stream = click_stream(stream_session(spark), stored[0], 1).where("seq < 5").select("seq", "user_id")
    job = jobs.stateful(stream, "user_id", processors.ProcessingTimer(300), time_mode="ProcessingTime")
    seen = watch(spark, job, tmp_path, lambda o: o.where("what = 'timer'").count() == 5)
    assert rows(seen.where("what = 'arrived'"), "seq") == rows(seen.where("what = 'timer'"), "seq") == [(i,) for i in range(5)]


@pytest.mark.parametrize("ttl, total", [(None, 3), (1, 1)])
def test_state_and_its_time_to_live(spark, tmp_path, ttl, total):
    """State older than its time to live is gone when the key comes back."""
    class Profile(processors.StateProfile):
        OUT = processors.StateProfile.OUT.replace("user_id long", "user_id string")

        def open(self):
            super().open()
            self.per_user = self.handle.getMapState("named", "user_id string", "n long",
                                                    **({"ttlDurationMs": self.ttl_ms} if self.ttl_ms else {}))

    s = timed(spark, tmp_path, [[1], [2], [3]]).select("seq", "user_id", "ts_ms", "url")
    job = jobs.stateful(s, "user_id", Profile(ttl), time_mode="ProcessingTime")
    out = watch(spark, job, tmp_path, lambda o: o.count() == 3)
    last = out.orderBy(F.col("batch_id").desc()).first()
    if ttl is None:
        assert (last["list_size"], last["map_count"], last["reduced_ts"]) == (3, 3, SHIFT + 3)
    assert last["agg_text"] == f"count: {total}"
