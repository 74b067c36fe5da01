"""Arriving rules, updating ranks, union watermarks, lives of state and patterns with loops:
against plain Python over the rows, for any cut, and as streams for any batching."""

import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators import aggregates, automaton, lateness, ranking, rules, state_life
from eventloom.operators.automaton import Pattern, Step
from eventloom.plans import evolving
from eventloom.sources.tables import EVENTS_SCHEMA, as_clicks
from eventloom.streaming import jobs, kept, processors
from eventloom.streaming.replay import replay
from tests.fixtures import SHIFT, rows
from tests.test_streaming import brackets, collect

HOUR = 3_600_000
N = 600


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Events with bursts, equal times and a user who has a third of them; users 0 and 25 publish rules."""
    rng, data, ms = random.Random(5), [], SHIFT
    for i in range(N):
        ms += rng.choice([0, 0, 1_000, 600_000, 2 * HOUR])
        user = 1 if i % 3 == 0 else rng.choice([0, 2, 3, 4, 5, 25])
        data.append((i, ms, user, rng.choice(evolving.KINDS), float(i)))
    df = spark.createDataFrame(data, "event_id long, ms long, user_id long, event_type string, value double").select(
        "event_id", F.timestamp_millis("ms").cast("timestamp_ntz").alias("ts"), "user_id", "event_type", "value",
        F.lit("{}").alias("props"))
    path = str(tmp_path_factory.mktemp("events") / "events")
    df.write.parquet(path)
    batch = as_clicks(spark.read.schema(EVENTS_SCHEMA).parquet(path)).cache()
    return path, batch, [(r.seq, r.user_id, r.url, r.ts_ms) for r in batch.orderBy("seq").collect()]


def plain_rules(events):
    held, last, out = {}, {}, []
    for seq, user, url, _ in events:
        if user % evolving.PUBLISHERS == 0:
            held[user // evolving.PUBLISHERS % evolving.SLOTS] = (seq, url, evolving.KINDS[seq % 5])
            continue
        out += [(seq, user, last[user], url, slot, at) for slot, (at, a, b) in held.items() if (a, b) == (last.get(user), url)]
        last[user] = url
    return sorted(out)


RULE_COLUMNS = ("seq", "user_id", "action1", "action2", "slot", "rule_seq")


@pytest.mark.parametrize("bound", [9, 4_000_000])
def test_rules_hold_until_replaced(spark, stored, bound):
    c = stored[1]
    actions = c.where(~evolving.is_rule()).select("seq", "user_id", F.col("url").alias("action"))
    out = rules.match_arriving(actions, evolving.as_rules(c), "user_id", rows_per_chunk=bound)
    assert rows(out, *RULE_COLUMNS) == plain_rules(stored[2])
    none = evolving.as_rules(c).limit(0)
    assert rules.match_arriving(actions, none, "user_id").count() == 0
    assert rules.match_arriving(actions.limit(0), evolving.as_rules(c), "user_id").count() == 0


def test_rules_that_change_all_the_time_do_not_multiply_rows(spark):
    """Every rule and every action has the same pair, and the rule is renewed after each action."""
    both = spark.range(20_000).select(F.col("id").alias("seq"))
    actions = both.where("seq % 2 = 0").select("seq", F.lit(1).cast("bigint").alias("user_id"), F.lit("a").alias("action"))
    log = both.where("seq % 2 = 1").select("seq", F.lit(0).cast("bigint").alias("slot"), F.lit("a").alias("action1"),
                                           F.lit("a").alias("action2"))
    out = rules.match_arriving(actions, log, "user_id")
    assert out.where("seq - rule_seq = 1").count() == out.count() == 9_999


@pytest.mark.parametrize("batches", [1, 3, 20])
def test_streamed_rules(spark, stored, batches):
    out = replay(spark, evolving.rules_job, stored[0], order="event_id", rows_per_slice=-(-N // batches),
                 step=kept.arriving_rules("user_id"))
    assert rows(out, *RULE_COLUMNS) == plain_rules(stored[2])


def plain_heads(events, n):
    counts, head, out = {}, [], []
    for seq, user, _, _ in events:
        counts[user] = counts.get(user, 0) + 1
        new = sorted(((c, u) for u, c in counts.items()), key=lambda h: (-h[0], h[1]))[:n]
        for rank, (c, u) in enumerate(new):
            old = head[rank] if rank < len(head) else None
            if old != (c, u):
                out += [(seq, rank + 1, "-U", old[1], old[0])] if old else []
                out.append((seq, rank + 1, "+U" if old else "+I", u, c))
        head = new
    return sorted(out), [(u, c) for c, u in head]


HEAD_COLUMNS = ("seq", "row_num", "op", "user_id", "cnt")


@pytest.mark.parametrize("bound, n", [(7, 2), (50, 3), (4_000_000, 1)])
def test_head_changes(stored, bound, n):
    counted = aggregates.running_count(stored[1].select("seq", "user_id"), ["user_id"])
    out = ranking.top_n_changes(counted, "user_id", n, rows_per_chunk=bound)
    want, last = plain_heads(stored[2], n)
    assert rows(out, *HEAD_COLUMNS) == want
    folded = {}
    for seq, rank, op, user, cnt in sorted(want, key=lambda r: (r[0], r[2] != "-U")):
        if op == "-U":
            assert folded.pop(rank) == (user, cnt)
        else:
            folded[rank] = (user, cnt)
    top = ranking.top_n_overall(stored[1].groupBy("user_id").agg(F.count("url").alias("cnt")), "cnt", "user_id", n)
    assert [folded[i + 1] for i in range(n)] == last == [(r.user_id, r.cnt) for r in top.orderBy("row_num").collect()]


@pytest.mark.parametrize("batches", [1, 7])
def test_streamed_heads_and_leader(spark, stored, batches):
    size = -(-N // batches)
    out = replay(spark, evolving.count_job, stored[0], order="event_id", rows_per_slice=size, step=kept.head_changes("user_id", 2))
    assert rows(out, *HEAD_COLUMNS) == plain_heads(stored[2], 2)[0]
    out = replay(spark, evolving.count_job, stored[0], order="event_id", rows_per_slice=size, step=kept.leader("user_id"))
    want = aggregates.running_leader(stored[1], "user_id")
    assert rows(out, "seq", "leader", "leader_cnt") == rows(want, "seq", "leader", "leader_cnt")


def plain_watermarks(arrivals, inputs, bound, idle):
    newest, last, mark, out = [None] * inputs, [0] * inputs, None, []
    for n, (arrival, seq, source, ms) in enumerate(sorted(arrivals), 1):
        newest[source], last[source] = max(ms, newest[source] or 0), n
        active = [i for i in range(inputs) if n - last[i] < idle]
        if all(newest[i] is not None for i in active):
            own = min(newest[i] for i in active) - bound - 1
            mark = own if mark is None else max(mark, own)
        out.append((seq, mark))
    return sorted(out, key=lambda r: tuple((v is None, v) for v in r))


@pytest.mark.parametrize("idle, lag", [(3, 20), (50, 20), (10, 200)])
def test_lowest_watermark_of_inputs(stored, idle, lag):
    """Three inputs: the second lags, the third has few rows, and begins late."""
    source = F.when((F.col("user_id") == 25) & (F.col("seq") > 300), 2).when(F.col("user_id") % 2 == 0, 1).otherwise(0)
    union = stored[1].select("seq", "ts_ms", source.alias("source")).withColumn(
        "arrival", F.col("seq") + F.when(F.col("source") == 1, lag).otherwise(0))
    want = plain_watermarks([(r.arrival, r.seq, r.source, r.ts_ms) for r in union.collect()], 3, 1000, idle)
    for bound in (11, 4_000_000):
        out = lateness.union_watermark(union, 3, 1000, idle, rows_per_chunk=bound)
        assert rows(out, "seq", "watermark") == want
    assert any(m is None for _, m in want) or idle == 3


@pytest.mark.parametrize("batches", [1, 6])
def test_streamed_watermark_of_inputs(spark, stored, batches):
    arrival = F.expr(f"event_id + pmod(event_id * 17, 41) + {evolving.LAG} * (user_id % 2)")
    out = replay(spark, evolving.lagging_halves, stored[0], order=arrival, rows_per_slice=-(-N // batches),
                 step=kept.lowest_watermark(2, 1000, evolving.IDLE_ROWS))
    want = lateness.union_watermark(evolving.lagging_halves(stored[1]), 2, 1000, evolving.IDLE_ROWS)
    assert rows(out, "seq", "watermark") == rows(want, "seq", "watermark")


def plain_lives(events, refresh):
    live, out = {}, []
    for seq, user, url, ms in sorted(events, key=lambda e: (e[3], e[0])):
        if url not in evolving.ROLES:
            continue
        entry, writes = evolving.ROLES[url]
        touched, value = live.get((user, entry), (None, 0))
        if touched is None or ms - touched >= evolving.LIFE:
            value = 0
        value += writes
        if writes or (value and refresh == "read_write"):
            live[user, entry] = (ms, value)
        out.append((seq, user, entry, value))
    return sorted(out)


@pytest.mark.parametrize("refresh", state_life.REFRESH)
def test_lives_of_state(spark, stored, refresh):
    want = plain_lives(stored[2], refresh)
    for bound in (13, 4_000_000):
        out = state_life.living_counts(evolving.touches(stored[1]), ["user_id", "entry"], evolving.writes(), evolving.LIFE,
                                       refresh=refresh, rows_per_chunk=bound)
        assert rows(out, "seq", "user_id", "entry", "value") == want

    def job(s):
        return jobs.stateful(s.select("seq", "user_id", "ts", "ts_ms", "url"), "user_id",
                             processors.LivingCounts(evolving.ROLES, evolving.LIFE, refresh), delay_ms=0)
    out = replay(spark, job, stored[0], rows_per_slice=150, closing="error")
    assert rows(out, "seq", "user_id", "entry", "value") == want


def plain_pattern(events, pattern):
    """Follow every first row by itself."""
    wanted, out = pattern.rows, []
    by_user = {}
    for seq, user, url, ms in sorted(events, key=lambda e: (e[3], e[0])):
        by_user.setdefault(user, []).append((ms, url))
    for user, own in by_user.items():
        for at, (start, url) in enumerate(own):
            if url not in wanted[0][0]:
                continue
            times, i, broke = [start], at + 1, False
            while len(times) < len(wanted) and i < len(own) and own[i][0] - start < pattern.within_ms:
                kinds, strict = wanted[len(times)]
                if own[i][1] in kinds:
                    times.append(own[i][0])
                elif strict:
                    broke = True
                    break
                i += 1
            if not broke:
                status = "matched" if len(times) == len(wanted) else "timeout"
                out.append((user, status, len(times), *times, *[None] * (len(wanted) - len(times))))
    return sorted(out, key=lambda r: tuple((v is None, v) for v in r))


PATTERNS = {
    "loops": Pattern((Step(("error", "signup"), times=2, consecutive=True), Step(("click",), times=2),
                      Step(("view", "error"), next=True)), 30 * HOUR),
    "one_kind": Pattern((Step(("click",), times=4),), 24 * HOUR),
    "partial": Pattern((Step(("signup",)), Step(("error",)), Step(("purchase",))), 12 * HOUR),
    "single": Pattern((Step(("view",)),), HOUR),
    "overlapping": Pattern((Step(("click", "view")), Step(("click",), next=True, times=2), Step(("view", "click"))), 20 * HOUR),
}


@pytest.mark.parametrize("name", PATTERNS)
def test_patterns_with_loops(stored, name):
    pattern = PATTERNS[name]
    want = plain_pattern(stored[2], pattern)
    assert {r[1] for r in want} == ({"matched"} if name == "single" else {"matched", "timeout"})
    for bound in (10, 4_000_000):
        out = automaton.match_pattern(stored[1], ["user_id"], "url", pattern, ended=True, rows_per_chunk=bound)
        assert out.columns == ["user_id", *pattern.columns]
        assert rows(out, *out.columns) == want


def test_open_matches_are_pending(stored):
    out = automaton.match_pattern(stored[1], ["user_id"], "url", PATTERNS["partial"])
    ended = automaton.match_pattern(stored[1], ["user_id"], "url", PATTERNS["partial"], ended=True)
    newest = max(e[3] for e in stored[2])
    pending = out.where("status = 'pending'")
    assert pending.count() > 0 and pending.where(F.col("t1") + 12 * HOUR <= newest).count() == 0
    assert rows(out.where("status <> 'pending'").unionByName(pending.withColumn("status", F.lit("timeout"))), *out.columns) == rows(
        ended, *out.columns)


@pytest.mark.parametrize("name", ["loops", "partial"])
def test_streamed_patterns(spark, stored, name):
    def job(s):
        return jobs.stateful(s.select("seq", "user_id", "ts", "ts_ms", "url"), "user_id",
                             processors.PatternMatch(PATTERNS[name]), delay_ms=0)
    out = replay(spark, job, stored[0], rows_per_slice=120, closing="view" if name == "loops" else "click")
    assert rows(out, "user_id", *PATTERNS[name].columns) == plain_pattern(stored[2], PATTERNS[name])


def test_processors_with_other_keys(spark, tmp_path):
    """A key of any type, given by its name and type."""
    data = [(i, "ab"[i % 2], kind, SHIFT + 1000 * i) for i, kind in enumerate(["x", "x", "x", "y", "x", "x", "y", "x"])]
    data.append((99, "z", "end", SHIFT + 10 * HOUR))

    def stream(folder):
        return (brackets(spark, str(tmp_path / folder), [data[:3], data[3:]], "seq long, user string, url string, ts_ms long")
                .withColumn("ts", F.timestamp_millis("ts_ms")))
    made = {"consecutive": processors.ConsecutiveMatch("x", 2, key="user string"),
            "sequence": processors.SequenceMatch([["x"], ["x"]], [True], HOUR, key="user string"),
            "pattern": processors.PatternMatch(Pattern((Step(("x",), 2, consecutive=True),), HOUR), key="user string")}
    for name, own in made.items():
        out = collect(spark, jobs.stateful(stream(name), "user", own, delay_ms=0), tmp_path / name)
        if name == "pattern":
            out = out.where("status = 'matched'")
        assert rows(out, "user", "t1", "t2") == [
            ("a", SHIFT, SHIFT + 2000), ("a", SHIFT + 2000, SHIFT + 4000), ("b", SHIFT + 5000, SHIFT + 7000)]
