"""Streaming forms of the operators, run to the end of the stored events.

The stored events are finite, so a closing row lifts the watermark past every window, session,
timer and wait, and each stream is held to the whole SQL of its batch form.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import elementwise, joins, patterns, ranking
from eventloom.plans.catalog import CLICKS_SQL, DAY, HOUR, MINUTE, ORACLES, query
from eventloom.plans.pairs import RELAXED_STEPS, STRICT_STEPS, login_kind, payment_logs, rule_table
from eventloom.plans.rows import WRITERS
from eventloom.sources.tables import table, with_arrival
from eventloom.streaming import jobs, kept, late, processors
from eventloom.streaming.replay import events_path, replay, replay_log

# A kind that passes the filters of all jobs below which close something at the end.
END = "click"
# Parts of a key whose rows are counted apart.
SALTS = 4


def same(batch_query: str) -> str:
    return ORACLES[batch_query]


def stream_query(name: str, sql: str):
    return query(name, sql, "")


@stream_query("stream_replay_count", f"WITH {CLICKS_SQL} SELECT url, count(*) AS cnt FROM clicks GROUP BY url")
def stream_replay_count(spark, sf):
    """Update mode: one row per key and micro-batch that changed it; the last one counts."""
    out = replay(spark, lambda s: s.groupBy("url").agg(F.count(F.lit(1)).alias("cnt")), events_path(sf), mode="update")
    return out.groupBy("url").agg(F.max_by("cnt", "batch_id").alias("cnt"))


@stream_query("stream_filter", same("append_filter"))
def stream_filter(spark, sf):
    return replay(spark, lambda s: s.where("user_id = 7").select("url", "user_id"), events_path(sf))


@stream_query("stream_split_tag", same("split_tag"))
def stream_split_tag(spark, sf):
    def job(s):
        return elementwise.tagged(s.select("seq", "user_id", "url"),
                                  {"first": F.col("user_id") == 7, "second": F.col("user_id") == 8}, "rest")
    return replay(spark, job, events_path(sf))


@stream_query("stream_union", same("union_streams"))
def stream_union(spark, sf):
    def job(s):
        cols = ["seq", "user_id", "ts_ms"]
        return s.where("url = 'click'").select(*cols).unionByName(s.where("url <> 'click'").select(*cols))
    return replay(spark, job, events_path(sf))


@stream_query("stream_tumble_count", same("tumble_count"))
def stream_tumble_count(spark, sf):
    return replay(spark, lambda s: jobs.tumbling_counts(s, "user_id", DAY), events_path(sf), closing=END)


@stream_query("stream_slide_count", same("slide_count"))
def stream_slide_count(spark, sf):
    return replay(spark, lambda s: jobs.sliding_counts(s, "url", 2 * HOUR, HOUR), events_path(sf), closing=END)


@stream_query("stream_session_count", same("session_count"))
def stream_session_count(spark, sf):
    return replay(spark, lambda s: jobs.session_counts(s, "user_id", 8 * HOUR), events_path(sf), closing=END)


@stream_query("stream_cumulate", same("tvf_cumulate"))
def stream_cumulate(spark, sf):
    return replay(spark, lambda s: jobs.cumulating_counts(s, "user_id", DAY, 6 * HOUR), events_path(sf), closing=END)


@stream_query("stream_uv", same("uv_tumbling"))
def stream_uv(spark, sf):
    return replay(spark, lambda s: jobs.unique_visitors(s, HOUR), events_path(sf), closing=END)


@stream_query("stream_window_topn", same("window_topn"))
def stream_window_topn(spark, sf):
    return replay(spark, lambda s: jobs.tumbling_counts(s, "user_id", DAY), events_path(sf), closing=END,
                  shape=jobs.rank_closed_windows(2, "user_id")).drop("batch_id")


@stream_query("stream_topn_url_sliding", same("topn_url_sliding"))
def stream_topn_url_sliding(spark, sf):
    return replay(spark, lambda s: jobs.sliding_counts(s, "url", 2 * HOUR, HOUR), events_path(sf), closing=END,
                  shape=jobs.rank_closed_windows(2, "url")).drop("batch_id")


@stream_query("stream_topn_users", same("topn_users"))
def stream_topn_users(spark, sf):
    """Top-N of an updating count: each micro-batch writes the users that changed."""
    out = replay(spark, lambda s: s.groupBy("user_id").agg(F.count("url").alias("cnt")), events_path(sf), mode="update")
    newest = out.groupBy("user_id").agg(F.max_by("cnt", "batch_id").alias("cnt"))
    return ranking.top_n_overall(newest, "cnt", "user_id", 2)


@stream_query("stream_sql_group_window", same("tumble_count"))
def stream_sql_group_window(spark, sf):
    """SQL text over a streaming view with an event-time column and its watermark."""
    def job(s):
        return s.sparkSession.sql(f"""
            SELECT unix_millis(w.start) AS window_start, unix_millis(w.end) AS window_end, user_id, cnt
            FROM (SELECT window(ts, '{DAY} milliseconds') AS w, user_id, count(*) AS cnt FROM {{clicks}}
                  GROUP BY window(ts, '{DAY} milliseconds'), user_id)""", clicks=jobs.watermarked(s))
    return replay(spark, job, events_path(sf), closing=END)


def stream_sides(s, left: str, right: str):
    l = s.where(F.col("url") == left).select(
        "user_id", F.col("seq").alias("left_seq"), F.col("ts").alias("left_ts"), F.col("ts_ms").alias("left_ms"))
    r = s.where(F.col("url") == right).select(
        "user_id", F.col("seq").alias("right_seq"), F.col("ts").alias("right_ts"), F.col("ts_ms").alias("right_ms"))
    return l, r


@stream_query("stream_window_join", same("window_join"))
def stream_window_join(spark, sf):
    def job(s):
        l, r = stream_sides(s, "click", "purchase")
        return jobs.window_join(l, r, "user_id", DAY).select("user_id", "window_start", "left_seq", "right_seq")
    return replay(spark, job, events_path(sf))


@stream_query("stream_interval_join", same("interval_join"))
def stream_interval_join(spark, sf):
    def job(s):
        l, r = stream_sides(s, "click", "purchase")
        return (jobs.interval_join(l, r, "user_id", -6 * HOUR, 12 * HOUR)
                .select("user_id", "left_seq", "right_seq", "left_ms", "right_ms"))
    return replay(spark, job, events_path(sf))


@stream_query("stream_history_join", same("history_join"))
def stream_history_join(spark, sf):
    def job(s):
        sides = s.select("seq", "user_id", F.when(F.col("url") == "click", "left").otherwise("right").alias("side"))
        return jobs.stateful(sides, "user_id", processors.HistoryPartners())
    return replay(spark, job, events_path(sf), order="event_id")


@stream_query("stream_cogroup", same("window_cogroup"))
def stream_cogroup(spark, sf):
    return replay(spark, lambda s: jobs.window_cogroup(s.where("url = 'click'"), s.where("url <> 'click'"), "user_id", DAY),
                  events_path(sf), closing=END)


@stream_query("stream_reconcile", same("reconcile"))
def stream_reconcile(spark, sf):
    """Both logs as one stream; rows that wait are carried between its micro-batches."""
    app, third = payment_logs(spark, sf)
    log = (app.select("order_id", F.lit("app").alias("side"), F.col("app_ms").alias("ms"))
           .unionByName(third.select("order_id", F.lit("third").alias("side"), F.col("third_ms").alias("ms"))))
    step = kept.reconciled("order_id", app_wait_ms=90 * DAY, third_wait_ms=30 * DAY)
    return replay_log(spark, log, "ms", step, closing={"order_id": -1, "side": "app"}).drop("batch_id")


# ---- keyed state -----------------------------------------------------------------------

@stream_query("stream_avg_every_5", same("avg_every_5"))
def stream_avg_every_5(spark, sf):
    return replay(spark, lambda s: jobs.stateful(s.select("seq", "user_id", "ts_ms"), "user_id", processors.EveryNth(5)),
                  events_path(sf), order="event_id")


@stream_query("stream_buffered_batches", same("buffered_batches"))
def stream_buffered_batches(spark, sf):
    def job(s):
        sharded = s.select("seq", "url", (F.col("user_id") % WRITERS).alias("shard"))
        return jobs.stateful(sharded, "shard", processors.BufferedBatches(10))
    return replay(spark, job, events_path(sf), order="event_id")


@stream_query("stream_count_window", same("count_window"))
def stream_count_window(spark, sf):
    return replay(spark, lambda s: jobs.stateful(s.select("seq", "user_id", "value"), "user_id",
                                                 processors.CountWindow(10, 2)), events_path(sf), order="event_id")


@stream_query("stream_count_changelog", same("count_changelog"))
def stream_count_changelog(spark, sf):
    return replay(spark, lambda s: jobs.stateful(s.select("seq", "user_id"), "user_id", processors.CountChangelog()),
                  events_path(sf), order="event_id")


@stream_query("stream_restart", same("count_changelog"))
def stream_restart(spark, sf):
    """The changelog of a stream that is stopped twice and goes on from its checkpoint: no row is
    lost or counted again."""
    third = -(-table(spark, sf, "events").count() // 3)
    return replay(spark, lambda s: jobs.stateful(s.select("seq", "user_id"), "user_id", processors.CountChangelog()),
                  events_path(sf), order="event_id", rows_per_slice=max(third, 1), restarts=True)


@stream_query("stream_broadcast_rules", same("broadcast_rules"))
def stream_broadcast_rules(spark, sf):
    """Pairs from keyed state, then a join of the stream with the small static rule table."""
    def job(s):
        actions = s.select("seq", "user_id", F.col("url").alias("action"))
        rules = joins.checked_broadcast(rule_table(s.sparkSession).drop("rule_no"))
        return jobs.stateful(actions, "user_id", processors.PreviousAction()).join(rules, ["action1", "action2"])
    return replay(spark, job, events_path(sf), order="event_id")


@stream_query("stream_state_machine", same("state_machine"))
def stream_state_machine(spark, sf):
    def job(s):
        kinds = s.select("seq", "user_id", "ts_ms", login_kind().alias("kind"))
        return jobs.stateful(kinds, "user_id", processors.RunMachine(patterns.THREE_FAILURES))
    return replay(spark, job, events_path(sf), order="event_id")


@stream_query("stream_state_profile", same("state_profile"))
def stream_state_profile(spark, sf):
    out = replay(spark, lambda s: jobs.stateful(s.select("seq", "user_id", "ts_ms", "url"), "user_id",
                                                processors.StateProfile()), events_path(sf), order="event_id")
    newest = F.max_by(F.struct(*out.columns), "list_size").alias("r")
    return out.groupBy("user_id").agg(newest).select("r.*")


def _timed(s):
    return s.select("seq", "user_id", "ts", "ts_ms", "url")


@stream_query("stream_over_avg", same("over_avg"))
def stream_over_avg(spark, sf):
    return replay(spark, lambda s: jobs.stateful(_timed(s), "user_id", processors.OverAverage(3), delay_ms=0), events_path(sf))


@stream_query("stream_event_timer", same("event_timer"))
def stream_event_timer(spark, sf):
    return replay(spark, lambda s: jobs.stateful(_timed(s), "user_id", processors.EventTimer(HOUR), delay_ms=0),
                  events_path(sf), closing=END)


@stream_query("stream_periodic_pv", same("periodic_pv"))
def stream_periodic_pv(spark, sf):
    return replay(spark, lambda s: jobs.stateful(_timed(s), "user_id", processors.PeriodicCount(DAY), delay_ms=0), events_path(sf))


@stream_query("stream_manual_window", same("manual_window"))
def stream_manual_window(spark, sf):
    """Few keys hold the whole log, so each is counted in salted parts that are added up."""
    group = ["url", "window_start", "window_end"]

    def job(s):
        parts = s.select("url", F.pmod(F.xxhash64("seq"), F.lit(SALTS)).alias("salt"), "ts", "ts_ms")
        return jobs.stateful(parts, ["url", "salt"], processors.TumblingByHand(HOUR), delay_ms=0)
    return replay(spark, job, events_path(sf), closing=END, shape=jobs.sum_of_closed(*group)).drop("batch_id")


@stream_query("stream_cep_next_within", same("cep_next_within"))
def stream_cep_next_within(spark, sf):
    return replay(spark, lambda s: jobs.stateful(_timed(s), "user_id", processors.ConsecutiveMatch("error", 3, 3 * DAY),
                                                 delay_ms=0), events_path(sf))


@stream_query("stream_cep_times_k", same("cep_times_k"))
def stream_cep_times_k(spark, sf):
    return replay(spark, lambda s: jobs.stateful(_timed(s), "user_id", processors.ConsecutiveMatch("error", 3),
                                                 delay_ms=0), events_path(sf))


@stream_query("stream_cep_followed_by", same("cep_followed_by"))
def stream_cep_followed_by(spark, sf):
    return replay(spark, lambda s: jobs.stateful(_timed(s), "user_id", processors.FollowedBy("signup", "purchase", 12 * HOUR),
                                                 delay_ms=0), events_path(sf), closing=END)


@stream_query("stream_cep_sequence_strict", same("cep_sequence_strict"))
def stream_cep_sequence_strict(spark, sf):
    return replay(spark, lambda s: jobs.stateful(_timed(s), "user_id", processors.SequenceMatch(STRICT_STEPS, [True] * 3, 10 * DAY),
                                                 delay_ms=0), events_path(sf))


@stream_query("stream_cep_sequence_relaxed", same("cep_sequence_relaxed"))
def stream_cep_sequence_relaxed(spark, sf):
    return replay(spark, lambda s: jobs.stateful(_timed(s), "user_id", processors.SequenceMatch(RELAXED_STEPS, [False] * 2, 10 * DAY),
                                                 delay_ms=0), events_path(sf))


# ---- lateness ----------------------------------------------------------------------------

# Stored rows come in this order, the ``arrival`` of :func:`with_arrival`.
ARRIVAL_ORDER = "event_id + pmod(event_id * 17, 41)"


def _arriving(s):
    return with_arrival(s.select("seq", "user_id", "url", "ts_ms"))


@stream_query("stream_late_split", same("late_split"))
def stream_late_split(spark, sf):
    """Every row comes out, on time, firing again or late: the engine drops nothing."""
    return (replay(spark, _arriving, events_path(sf), order=F.expr(ARRIVAL_ORDER), step=late.split(HOUR, 10 * MINUTE, HOUR))
            .select("seq", "window_start", "window_end", "tag"))


@stream_query("stream_late_refire", same("late_refire"))
def stream_late_refire(spark, sf):
    return (replay(spark, _arriving, events_path(sf), order=F.expr(ARRIVAL_ORDER), closing=END,
                   step=late.firings("url", HOUR, 10 * MINUTE, HOUR)).drop("batch_id"))
