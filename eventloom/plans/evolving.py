"""Rules, ranks, watermarks and state that change while rows arrive, and patterns with loops:
batch queries and the same over streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import aggregates, automaton, lateness, ranking, rules, state_life, windows
from eventloom.operators.automaton import Pattern, Step
from eventloom.plans.catalog import CLICKS_SQL, DAY, HOUR, MINUTE, query
from eventloom.plans.streams import END, same, stream_query
from eventloom.sources.files import with_event_time
from eventloom.sources.tables import clicks
from eventloom.streaming import jobs, kept, processors
from eventloom.streaming.replay import events_path, replay

# ---- rules that arrive ------------------------------------------------------------------

# Every 25th user publishes rules: for a slot, the kind of its own event after which another is asked for.
PUBLISHERS, SLOTS = 25, 4
KINDS = ["click", "view", "signup", "purchase", "error"]
_RULES_SQL = CLICKS_SQL + f""",
rules AS (SELECT seq AS rule_seq, user_id // {PUBLISHERS} % {SLOTS} AS slot, url AS action1,
                 {KINDS}[seq % {len(KINDS)} + 1] AS action2 FROM clicks WHERE user_id % {PUBLISHERS} = 0),
held AS (SELECT *, lead(rule_seq) OVER (PARTITION BY slot ORDER BY rule_seq) AS until FROM rules),
actions AS (SELECT seq, user_id, lag(url) OVER (PARTITION BY user_id ORDER BY seq) AS action1, url AS action2
            FROM clicks WHERE user_id % {PUBLISHERS} <> 0)"""


def is_rule():
    return F.col("user_id") % PUBLISHERS == 0


def as_rules(c):
    slot = F.expr(f"user_id div {PUBLISHERS}") % SLOTS
    asked = F.array(*map(F.lit, KINDS))
    return c.where(is_rule()).select("seq", slot.alias("slot"), F.col("url").alias("action1"),
                                     F.get(asked, (F.col("seq") % len(KINDS)).cast("int")).alias("action2"))


@query("rules_as_of", """
SELECT a.seq, a.user_id, a.action1, a.action2, r.slot, r.rule_seq FROM actions a JOIN held r
  ON a.action1 = r.action1 AND a.action2 = r.action2 AND a.seq > r.rule_seq AND (r.until IS NULL OR a.seq < r.until)""",
       _RULES_SQL)
def rules_as_of(spark, sf):
    c = clicks(spark, sf)
    actions = c.where(~is_rule()).select("seq", "user_id", F.col("url").alias("action"))
    return rules.match_arriving(actions, as_rules(c), "user_id")


def rules_job(s):
    """Pairs of actions from keyed state, and the rules themselves, in one stream."""
    none = F.lit(None).cast("bigint")
    actions = s.where(~is_rule()).select("seq", "user_id", F.col("url").alias("action"))
    pairs = jobs.stateful(actions, "user_id", processors.PreviousAction())
    arriving = as_rules(s).select("seq", none.alias("user_id"), "action1", "action2", "slot")
    return pairs.withColumn("slot", none).unionByName(arriving)


@stream_query("stream_rules_as_of", same("rules_as_of"))
def stream_rules_as_of(spark, sf):
    return replay(spark, rules_job, events_path(sf), order="event_id", step=kept.arriving_rules("user_id")).drop("batch_id")


# ---- sessions of a hot key ----------------------------------------------------------------


@stream_query("stream_session_parts", same("session_count"))
def stream_session_parts(spark, sf):
    """Sessions from partial ones, so that no task has all rows of a key."""
    return replay(spark, lambda s: s.select("seq", "user_id", "ts_ms"), events_path(sf), closing=END,
                  step=kept.sessions("user_id", 8 * HOUR)).drop("batch_id")


# ---- an updating top-N and leader ---------------------------------------------------------


@query("topn_changelog", """
, counted AS (SELECT seq, user_id, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS cnt FROM clicks),
known AS (SELECT s.seq, u.user_id, max(c.cnt) OVER (PARTITION BY u.user_id ORDER BY s.seq) AS cnt
          FROM (SELECT seq FROM clicks) s CROSS JOIN (SELECT DISTINCT user_id FROM clicks) u
          LEFT JOIN counted c ON c.seq = s.seq AND c.user_id = u.user_id),
heads AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY cnt DESC, user_id) AS row_num
                         FROM known WHERE cnt IS NOT NULL) WHERE row_num <= 2),
steps AS (SELECT *, lag(user_id) OVER w AS old_user, lag(cnt) OVER w AS old_cnt, lag(seq) OVER w AS old_seq
          FROM heads WINDOW w AS (PARTITION BY row_num ORDER BY seq)),
changed AS (SELECT * FROM steps WHERE old_seq IS NULL OR user_id <> old_user OR cnt <> old_cnt)
SELECT seq, row_num, CASE WHEN old_seq IS NULL THEN '+I' ELSE '+U' END AS op, user_id, cnt FROM changed
UNION ALL SELECT seq, row_num, '-U' AS op, old_user AS user_id, old_cnt AS cnt FROM changed WHERE old_seq IS NOT NULL""")
def topn_changelog(spark, sf):
    """The two users with the most events, as a changelog over all rows."""
    counted = aggregates.running_count(clicks(spark, sf).select("seq", "user_id"), ["user_id"])
    return ranking.top_n_changes(counted, "user_id", 2)


def count_job(s):
    return jobs.stateful(s.select("seq", "user_id"), "user_id", processors.RunningCount())


@stream_query("stream_topn_changelog", same("topn_changelog"))
def stream_topn_changelog(spark, sf):
    return replay(spark, count_job, events_path(sf), order="event_id", step=kept.head_changes("user_id", 2)).drop("batch_id")


@stream_query("stream_running_leader", same("running_leader"))
def stream_running_leader(spark, sf):
    return replay(spark, count_job, events_path(sf), order="event_id", step=kept.leader("user_id")).drop("batch_id")


# ---- the watermark of a union --------------------------------------------------------------

# Two halves of the users; the rows of the second arrive 60 places later, out of order.
IDLE_ROWS, LAG = 6, 60
_UNION_SQL = CLICKS_SQL + f""",
arrivals AS (SELECT seq, user_id % 2 AS source, ts_ms, seq + (seq * 17) % 41 + {LAG} * (user_id % 2) AS arrival FROM clicks),
placed AS (SELECT *, row_number() OVER (ORDER BY arrival, seq) AS n FROM arrivals),
seen AS (SELECT *, max(ts_ms) FILTER (source = 0) OVER w AS newest0, max(ts_ms) FILTER (source = 1) OVER w AS newest1,
                n - coalesce(max(n) FILTER (source = 0) OVER w, 0) < {IDLE_ROWS} AS active0,
                n - coalesce(max(n) FILTER (source = 1) OVER w, 0) < {IDLE_ROWS} AS active1
         FROM placed WINDOW w AS (ORDER BY arrival, seq)),
marked AS (SELECT *, CASE WHEN NOT ((active0 AND newest0 IS NULL) OR (active1 AND newest1 IS NULL))
                          THEN least(CASE WHEN active0 THEN newest0 END, CASE WHEN active1 THEN newest1 END) - {10 * MINUTE} - 1
                     END AS own FROM seen)"""


def lagging_halves(c):
    source = F.col("user_id") % 2
    return c.select("seq", source.alias("source"), "ts_ms",
                    (F.col("seq") + F.pmod(F.col("seq") * 17, F.lit(41)) + LAG * source).alias("arrival"))


@query("union_watermark", """
SELECT seq, source, ts_ms, arrival, max(own) OVER (ORDER BY arrival, seq) AS watermark FROM marked""", _UNION_SQL)
def union_watermark(spark, sf):
    return lateness.union_watermark(lagging_halves(clicks(spark, sf)), 2, 10 * MINUTE, IDLE_ROWS)


@stream_query("stream_union_watermark", same("union_watermark"))
def stream_union_watermark(spark, sf):
    arrival = F.expr(f"event_id + pmod(event_id * 17, 41) + {LAG} * (user_id % 2)")
    return replay(spark, lagging_halves, events_path(sf), order=arrival,
                  step=kept.lowest_watermark(2, 10 * MINUTE, IDLE_ROWS)).drop("batch_id")


@stream_query("stream_table_watermark", f"""
WITH {CLICKS_SQL}
SELECT ts_ms // 1000 * 1000 // {DAY} * {DAY} AS window_start, ts_ms // 1000 * 1000 // {DAY} * {DAY} + {DAY} AS window_end,
       url, count(*) AS cnt FROM clicks GROUP BY ALL""")
def stream_table_watermark(spark, sf):
    """Windows over a table that defines its event time and its watermark itself."""
    def job(s):
        defined = with_event_time(s.select("url", "ts_ms"), "ts_ms", delay="1 second")
        return windows.window_bounds(defined.groupBy(windows.tumbling(DAY, "et"), "url").agg(F.count(F.lit(1)).alias("cnt")))
    return replay(spark, job, events_path(sf), closing=END)


# ---- the life of state ----------------------------------------------------------------------

# Two counters for each user: what adds to them and what looks at them.
ROLES = {"purchase": ("bought", True), "click": ("bought", False), "signup": ("joined", True), "view": ("joined", False)}
LIFE = 8 * HOUR


def touches(c):
    entry = F.create_map(*[F.lit(v) for kind, (name, _) in ROLES.items() for v in (kind, name)])
    return c.select("seq", "user_id", "ts_ms", "url", entry[F.col("url")].alias("entry")).where("entry is not null")


def writes():
    return F.col("url").isin(*[kind for kind, (_, w) in ROLES.items() if w])


_TOUCH_SQL = CLICKS_SQL + """,
touches AS (SELECT *, CASE WHEN url IN ('purchase', 'click') THEN 'bought' ELSE 'joined' END AS entry,
                   url IN ('purchase', 'signup') AS writes FROM clicks WHERE url <> 'error')"""


@query("state_life", f"""
, gaps AS (SELECT *, coalesce(ts_ms - lag(ts_ms) OVER w >= {LIFE}, true) AS fresh FROM touches
           WINDOW w AS (PARTITION BY user_id, entry ORDER BY ts_ms, seq)),
lives AS (SELECT *, count(*) FILTER (fresh) OVER (PARTITION BY user_id, entry ORDER BY ts_ms, seq) AS life FROM gaps)
SELECT seq, user_id, entry, count(*) FILTER (writes) OVER (PARTITION BY user_id, entry, life ORDER BY ts_ms, seq) AS value
FROM lives""", _TOUCH_SQL)
def state_life_touched(spark, sf):
    """Counters that live on while they are written or read."""
    return state_life.living_counts(touches(clicks(spark, sf)), ["user_id", "entry"], writes(), LIFE).select(
        "seq", "user_id", "entry", "value")


@query("state_life_written", f"""
, gaps AS (SELECT *, coalesce(ts_ms - max(ts_ms) FILTER (writes) OVER w >= {LIFE}, true) AS gone FROM touches
           WINDOW w AS (PARTITION BY user_id, entry ORDER BY ts_ms, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lives AS (SELECT *, count(*) FILTER (writes AND gone) OVER (PARTITION BY user_id, entry ORDER BY ts_ms, seq) AS life FROM gaps)
SELECT seq, user_id, entry, CASE WHEN gone AND NOT writes THEN 0
       ELSE count(*) FILTER (writes) OVER (PARTITION BY user_id, entry, life ORDER BY ts_ms, seq) END AS value
FROM lives""", _TOUCH_SQL)
def state_life_written(spark, sf):
    """Counters that live on only while they are written."""
    return state_life.living_counts(touches(clicks(spark, sf)), ["user_id", "entry"], writes(), LIFE,
                                    refresh="write").select("seq", "user_id", "entry", "value")


def _living(spark, sf, refresh):
    def job(s):
        return jobs.stateful(s.select("seq", "user_id", "ts", "ts_ms", "url"), "user_id",
                             processors.LivingCounts(ROLES, LIFE, refresh), delay_ms=0)
    return replay(spark, job, events_path(sf))


@stream_query("stream_state_life", same("state_life"))
def stream_state_life(spark, sf):
    return _living(spark, sf, "read_write")


@stream_query("stream_state_life_written", same("state_life_written"))
def stream_state_life_written(spark, sf):
    return _living(spark, sf, "write")


# ---- patterns with loops and with what was left of them ---------------------------------------

# Three errors in a row, then two clicks with anything in between, then a view at once.
REPEATS = Pattern((Step(("error",), times=3, consecutive=True), Step(("click",), times=2), Step(("view",), next=True)), 10 * DAY)
# A signup, an error and a purchase, with anything in between.
UNPAID = Pattern((Step(("signup",)), Step(("error",)), Step(("purchase",))), DAY)

_AHEAD_SQL = CLICKS_SQL + """,
n AS (SELECT user_id, url, ts_ms, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, seq) AS n FROM clicks),
ahead AS (SELECT *, min(CASE WHEN url = 'error' THEN n END) OVER w AS n_error, min(CASE WHEN url = 'click' THEN n END) OVER w AS n_click,
                 min(CASE WHEN url = 'purchase' THEN n END) OVER w AS n_purchase
          FROM n WINDOW w AS (PARTITION BY user_id ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))"""


@query("cep_repeat", f"""
, paths AS (
  SELECT a.user_id, a.ts_ms AS t1, b.ts_ms AS b2, b.url AS u2, c.ts_ms AS b3, c.url AS u3, d.ts_ms AS b4, e.ts_ms AS b5,
         f.ts_ms AS b6, f.url AS u6
  FROM ahead a LEFT JOIN ahead b ON b.user_id = a.user_id AND b.n = a.n + 1
               LEFT JOIN ahead c ON c.user_id = a.user_id AND c.n = a.n + 2
               LEFT JOIN ahead d ON d.user_id = a.user_id AND d.n = c.n_click
               LEFT JOIN ahead e ON e.user_id = a.user_id AND e.n = d.n_click
               LEFT JOIN ahead f ON f.user_id = a.user_id AND f.n = e.n + 1
  WHERE a.url = 'error'),
-- How many rows lie in time, in a row from the first; the very next ones also if they break the match.
near AS (SELECT *, coalesce(b2 - t1 < {10 * DAY}, false) AS i2, coalesce(b3 - t1 < {10 * DAY}, false) AS i3,
                coalesce(b4 - t1 < {10 * DAY}, false) AS i4, coalesce(b5 - t1 < {10 * DAY}, false) AS i5,
                coalesce(b6 - t1 < {10 * DAY}, false) AS i6 FROM paths),
kept AS (SELECT *, CASE WHEN NOT i2 THEN 1 WHEN NOT i3 THEN 2 WHEN NOT i4 THEN 3 WHEN NOT i5 THEN 4 WHEN NOT i6 THEN 5 ELSE 6 END AS reached
         FROM near WHERE NOT (i2 AND u2 <> 'error') AND NOT (i2 AND i3 AND u3 <> 'error')
           AND NOT (i2 AND i3 AND i4 AND i5 AND i6 AND u6 <> 'view'))
SELECT user_id, CASE WHEN reached = 6 THEN 'matched' ELSE 'timeout' END AS status, CAST(reached AS BIGINT) AS reached, t1,
       CASE WHEN reached >= 2 THEN b2 END AS t2, CASE WHEN reached >= 3 THEN b3 END AS t3, CASE WHEN reached >= 4 THEN b4 END AS t4,
       CASE WHEN reached >= 5 THEN b5 END AS t5, CASE WHEN reached >= 6 THEN b6 END AS t6
FROM kept""", _AHEAD_SQL)
def cep_repeat(spark, sf):
    return automaton.match_pattern(clicks(spark, sf), ["user_id"], "url", REPEATS, ended=True)


@query("cep_partial_timeout", f"""
, paths AS (
  SELECT a.user_id, a.ts_ms AS t1, b.ts_ms AS b2, c.ts_ms AS b3
  FROM ahead a LEFT JOIN ahead b ON b.user_id = a.user_id AND b.n = a.n_error
               LEFT JOIN ahead c ON c.user_id = a.user_id AND c.n = b.n_purchase
  WHERE a.url = 'signup'),
kept AS (SELECT *, CASE WHEN b2 - t1 < {DAY} THEN CASE WHEN b3 - t1 < {DAY} THEN 3 ELSE 2 END ELSE 1 END AS reached FROM paths)
SELECT user_id, CASE WHEN reached = 3 THEN 'matched' ELSE 'timeout' END AS status, CAST(reached AS BIGINT) AS reached, t1,
       CASE WHEN reached >= 2 THEN b2 END AS t2, CASE WHEN reached = 3 THEN b3 END AS t3
FROM kept""", _AHEAD_SQL)
def cep_partial_timeout(spark, sf):
    return automaton.match_pattern(clicks(spark, sf), ["user_id"], "url", UNPAID, ended=True)


def _matched(spark, sf, pattern):
    def job(s):
        return jobs.stateful(s.select("seq", "user_id", "ts", "ts_ms", "url"), "user_id",
                             processors.PatternMatch(pattern), delay_ms=0)
    return replay(spark, job, events_path(sf), closing=END)


@stream_query("stream_cep_repeat", same("cep_repeat"))
def stream_cep_repeat(spark, sf):
    return _matched(spark, sf, REPEATS)


@stream_query("stream_cep_partial_timeout", same("cep_partial_timeout"))
def stream_cep_partial_timeout(spark, sf):
    return _matched(spark, sf, UNPAID)
