"""Joins, lateness and sequence patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.operators import joins, lateness, patterns
from eventloom.plans.catalog import CLICKS_SQL, DAY, HOUR, MINUTE, query
from eventloom.sources.tables import clicks, table, with_arrival


def sides(spark, sf, left: str, right: str):
    """Two streams of the click log, with column names apart.  A join takes a pair of kinds of
    event as its two inputs; the others belong to neither."""
    c = clicks(spark, sf)
    l = c.where(F.col("url") == left).select(
        "user_id", F.col("seq").alias("left_seq"), F.col("ts").alias("left_ts"), F.col("ts_ms").alias("left_ms"))
    r = c.where(F.col("url") == right).select(
        "user_id", F.col("seq").alias("right_seq"), F.col("ts").alias("right_ts"), F.col("ts_ms").alias("right_ms"))
    return l, r


_SIDES_SQL = CLICKS_SQL + """,
l AS (SELECT user_id, seq AS left_seq, ts_ms AS left_ms FROM clicks WHERE url = 'click'),
r AS (SELECT user_id, seq AS right_seq, ts_ms AS right_ms FROM clicks WHERE url = 'purchase')"""


@query("window_join", f"""
SELECT l.user_id, left_ms // {DAY} * {DAY} AS window_start, left_seq, right_seq FROM l JOIN r
  ON l.user_id = r.user_id AND left_ms // {DAY} = right_ms // {DAY}""", _SIDES_SQL)
def window_join(spark, sf):
    left, right = sides(spark, sf, "click", "purchase")
    return joins.window_join(left, right, "user_id", DAY).select("user_id", "window_start", "left_seq", "right_seq")


@query("window_cogroup", f"""
SELECT user_id, ts_ms // {DAY} * {DAY} AS window_start, ts_ms // {DAY} * {DAY} + {DAY} AS window_end,
       count(*) FILTER (url = 'click') AS n_left, count(*) FILTER (url <> 'click') AS n_right,
       min(ts_ms) FILTER (url = 'click') AS first_left, max(ts_ms) FILTER (url = 'click') AS last_left,
       min(ts_ms) FILTER (url <> 'click') AS first_right, max(ts_ms) FILTER (url <> 'click') AS last_right
FROM clicks GROUP BY ALL""")
def window_cogroup(spark, sf):
    """Clicks on one side, all other events on the other."""
    c = clicks(spark, sf)
    return joins.window_cogroup(c.where("url = 'click'"), c.where("url <> 'click'"), "user_id", DAY, "ts_ms")


@query("window_cogroup_rows", f"""
, w AS (SELECT user_id, ts_ms // {DAY} * {DAY} AS window_start, ts_ms // {DAY} * {DAY} + {DAY} AS window_end,
               CASE url WHEN 'click' THEN 'left' ELSE 'right' END AS side, ts_ms
        FROM clicks)
SELECT *, count(*) FILTER (side = 'left') OVER g AS n_left, count(*) FILTER (side = 'right') OVER g AS n_right
FROM w WINDOW g AS (PARTITION BY user_id, window_start)""")
def window_cogroup_rows(spark, sf):
    c = clicks(spark, sf)
    return joins.window_cogroup_rows(c.where("url = 'click'"), c.where("url <> 'click'"), "user_id", DAY, "ts_ms")


@query("interval_join", f"""
SELECT l.user_id, left_seq, right_seq, left_ms, right_ms FROM l JOIN r
  ON l.user_id = r.user_id AND right_ms BETWEEN left_ms - {6 * HOUR} AND left_ms + {12 * HOUR}""", _SIDES_SQL)
def interval_join(spark, sf):
    left, right = sides(spark, sf, "click", "purchase")
    return (joins.interval_join(left, right, "user_id", "left_ms", "right_ms", -6 * HOUR, 12 * HOUR)
            .select("user_id", "left_seq", "right_seq", "left_ms", "right_ms"))


def payment_logs(spark, sf):
    """Orders as the app log and the first shipment of each order as the other log."""
    app = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("app_ms"))
    third = (table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("order_id"))
             .agg(F.unix_millis(F.min("l_shipdate").cast("timestamp")).alias("third_ms")))
    return app, third


@query("reconcile", f"""
WITH app AS (SELECT o_orderkey AS order_id, epoch_ms(o_orderdate) AS app_ms FROM orders),
third AS (SELECT l_orderkey AS order_id, epoch_ms(min(l_shipdate)) AS third_ms FROM lineitem GROUP BY 1)
SELECT coalesce(a.order_id, t.order_id) AS order_id, app_ms, third_ms,
       CASE WHEN third_ms IS NULL THEN 'third_missing' WHEN app_ms IS NULL THEN 'app_missing' ELSE 'matched' END AS status
FROM app a FULL JOIN third t ON a.order_id = t.order_id AND third_ms - app_ms BETWEEN {-30 * DAY} AND {90 * DAY}""", "")
def reconcile(spark, sf):
    app, third = payment_logs(spark, sf)
    return joins.reconcile(app, third, "order_id", app_wait_ms=90 * DAY, third_wait_ms=30 * DAY)


@query("history_join", """
SELECT user_id, seq, CASE WHEN url = 'click' THEN 'left' ELSE 'right' END AS side,
       CASE WHEN url = 'click' THEN count(*) FILTER (url <> 'click') OVER w ELSE count(*) FILTER (url = 'click') OVER w END AS n_partners,
       CASE WHEN url = 'click' THEN max(seq) FILTER (url <> 'click') OVER w ELSE max(seq) FILTER (url = 'click') OVER w END AS newest_partner
FROM clicks WINDOW w AS (PARTITION BY user_id ORDER BY seq)""")
def history_join(spark, sf):
    """Clicks against all other events of the user, over the whole history."""
    return (joins.history_join(clicks(spark, sf).select("user_id", "seq", "url"), "user_id", F.col("url") == "click")
            .select("user_id", "seq", "side", "n_partners", "newest_partner"))


RULES = [(1, "click", "purchase"), (2, "signup", "error")]


def rule_table(spark):
    return spark.createDataFrame(RULES, "rule_no long, action1 string, action2 string")


_ACTIONS_SQL = CLICKS_SQL + """,
paired AS (SELECT seq, user_id, lag(url) OVER (PARTITION BY user_id ORDER BY seq) AS action1, url AS action2 FROM clicks)"""


@query("broadcast_rules", """
SELECT * FROM paired WHERE (action1, action2) IN (('click', 'purchase'), ('signup', 'error'))""", _ACTIONS_SQL)
def broadcast_rules(spark, sf):
    actions = clicks(spark, sf).select("seq", "user_id", F.col("url").alias("action"))
    return joins.match_rules(actions, rule_table(spark), "user_id")


@query("broadcast_latest_rule", """
SELECT * FROM paired WHERE action1 = 'signup' AND action2 = 'error'""", _ACTIONS_SQL)
def broadcast_latest_rule(spark, sf):
    actions = clicks(spark, sf).select("seq", "user_id", F.col("url").alias("action"))
    return joins.match_rules(actions, rule_table(spark), "user_id", latest="rule_no")


# ---- watermarks and lateness: 1 h windows, 10 min bound, 1 h lateness --------------------

_ARRIVAL_SQL = CLICKS_SQL + """,
arrivals AS (SELECT *, seq + (seq * 17) % 41 AS arrival FROM clicks),
seen AS (SELECT *, max(ts_ms) OVER (ORDER BY arrival, seq) AS upto,
                max(ts_ms) OVER (ORDER BY arrival, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
         FROM arrivals)"""
_CLASS_SQL = _ARRIVAL_SQL + f""",
classed AS (SELECT *, CASE WHEN window_end + {HOUR} <= earlier - {10 * MINUTE} THEN 'late'
                           WHEN window_end <= earlier - {10 * MINUTE} THEN 'refire' ELSE 'on_time' END AS tag
            FROM (SELECT *, ts_ms // {HOUR} * {HOUR} AS window_start, ts_ms // {HOUR} * {HOUR} + {HOUR} AS window_end FROM seen))"""


def arrivals(spark, sf):
    return with_arrival(clicks(spark, sf).select("seq", "user_id", "url", "ts_ms"))


@query("watermark_trace", f"SELECT seq, arrival, ts_ms, upto - {10 * MINUTE} - 1 AS watermark FROM seen", _ARRIVAL_SQL)
def watermark_trace(spark, sf):
    return (lateness.watermark_trace(arrivals(spark, sf), 10 * MINUTE)
            .select("seq", "arrival", "ts_ms", "watermark"))


@query("late_split", "SELECT seq, window_start, window_end, tag FROM classed", _CLASS_SQL)
def late_split(spark, sf):
    return (lateness.classify(arrivals(spark, sf), HOUR, 10 * MINUTE, HOUR)
            .select("seq", "window_start", "window_end", "tag"))


@query("late_refire", """
SELECT url, window_start, window_end, CAST(0 AS BIGINT) AS firing, count(*) AS cnt
FROM classed WHERE tag = 'on_time' GROUP BY ALL
UNION ALL SELECT url, window_start, window_end, firing, cnt FROM (
  SELECT url, window_start, window_end, tag, count(*) OVER w AS cnt, count(*) FILTER (tag = 'refire') OVER w AS firing
  FROM classed WHERE tag <> 'late'
  WINDOW w AS (PARTITION BY url, window_start ORDER BY arrival, seq)) WHERE tag = 'refire'""", _CLASS_SQL)
def late_refire(spark, sf):
    return lateness.window_firings(arrivals(spark, sf), "url", HOUR, 10 * MINUTE, HOUR)


@query("event_timer", f"""
SELECT DISTINCT user_id, ts_ms + {HOUR} AS timer_ms FROM clicks""")
def event_timer(spark, sf):
    """Timers set an hour after each click; the end of the input fires those still open."""
    return clicks(spark, sf).select("user_id", (F.col("ts_ms") + HOUR).alias("timer_ms")).distinct()


# ---- sequence patterns: error = fail, purchase = success --------------------------------

_LAST3_SQL = CLICKS_SQL + """,
last3 AS (SELECT user_id, url, lag(url, 1) OVER w AS u2, lag(url, 2) OVER w AS u1,
                 ts_ms AS t3, lag(ts_ms, 1) OVER w AS t2, lag(ts_ms, 2) OVER w AS t1, seq
          FROM clicks WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms, seq)),
fails AS (SELECT * FROM last3 WHERE url = 'error' AND u2 = 'error' AND u1 = 'error')"""


def is_fail():
    return F.col("url") == "error"


def login_kind():
    return (F.when(F.col("url") == "error", "fail").when(F.col("url") == "purchase", "success")
            .otherwise(F.col("url")))


@query("cep_next_within", f"SELECT user_id, t1, t2, t3 FROM fails WHERE t3 - t1 < {3 * DAY}", _LAST3_SQL)
def cep_next_within(spark, sf):
    return patterns.match_consecutive(clicks(spark, sf), ["user_id"], [is_fail()] * 3, within_ms=3 * DAY)


@query("cep_times_k", "SELECT user_id, t1, t2, t3 FROM fails", _LAST3_SQL)
def cep_times_k(spark, sf):
    return patterns.match_times(clicks(spark, sf), ["user_id"], is_fail(), 3)


@query("cep_followed_by", f"""
, nexts AS (SELECT user_id, url, ts_ms, min(CASE WHEN url = 'purchase' THEN ts_ms END) OVER (
              PARTITION BY user_id ORDER BY ts_ms, seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM clicks)
SELECT user_id, ts_ms AS first_ms, CASE WHEN nxt - ts_ms < {12 * HOUR} THEN nxt END AS second_ms,
       CASE WHEN nxt - ts_ms < {12 * HOUR} THEN 'matched'
            ELSE 'timeout' END AS status
FROM nexts WHERE url = 'signup'""")
def cep_followed_by(spark, sf):
    """signup = order created, purchase = order paid, 12 h to pay; the end of the input ends every wait."""
    return patterns.match_followed_by(clicks(spark, sf), ["user_id"], F.col("url") == "signup",
                                      F.col("url") == "purchase", 12 * HOUR, ended=True)


BROWSED, WENT_WRONG = ["click", "view"], ["signup", "error"]
# Four rows in a row, and three with anything in between.
STRICT_STEPS = [BROWSED, BROWSED, WENT_WRONG, ["click", "purchase"]]
RELAXED_STEPS = [["signup"], ["error"], ["purchase"]]


def _is_one_of(steps):
    return [F.col("url").isin(kinds) for kinds in steps]


@query("cep_sequence_strict", f"""
, last4 AS (SELECT user_id, ts_ms AS t4, url AS u4, lag(ts_ms, 1) OVER w AS t3, lag(url, 1) OVER w AS u3,
                   lag(ts_ms, 2) OVER w AS t2, lag(url, 2) OVER w AS u2, lag(ts_ms, 3) OVER w AS t1, lag(url, 3) OVER w AS u1
            FROM clicks WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms, seq))
SELECT user_id, t1, t2, t3, t4 FROM last4
WHERE u1 IN ('click', 'view') AND u2 IN ('click', 'view') AND u3 IN ('signup', 'error')
  AND u4 IN ('click', 'purchase') AND t4 - t1 < {10 * DAY}""")
def cep_sequence_strict(spark, sf):
    """Four different steps without rows in between."""
    return patterns.match_sequence(clicks(spark, sf), ["user_id"], _is_one_of(STRICT_STEPS), [True] * 3, 10 * DAY)


@query("cep_sequence_relaxed", f"""
, numbered AS (SELECT user_id, url, ts_ms, row_number() OVER (PARTITION BY user_id ORDER BY ts_ms, seq) AS n FROM clicks),
ahead AS (SELECT *, min(CASE WHEN url = 'error' THEN n END) OVER w AS n_error,
                 min(CASE WHEN url = 'purchase' THEN n END) OVER w AS n_purchase
          FROM numbered WINDOW w AS (PARTITION BY user_id ORDER BY n ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT a.user_id, a.ts_ms AS t1, b.ts_ms AS t2, c.ts_ms AS t3
FROM ahead a JOIN ahead b ON b.user_id = a.user_id AND b.n = a.n_error
             JOIN ahead c ON c.user_id = b.user_id AND c.n = b.n_purchase
WHERE a.url = 'signup' AND c.ts_ms - a.ts_ms < {10 * DAY}""")
def cep_sequence_relaxed(spark, sf):
    """signup, then an error, then a purchase, with other rows in between."""
    return patterns.match_sequence(clicks(spark, sf), ["user_id"], _is_one_of(RELAXED_STEPS), [False] * 2, 10 * DAY)


@query("state_machine", "SELECT user_id, t3 AS ts_ms, seq, 'S2' AS state FROM fails", _LAST3_SQL)
def state_machine(spark, sf):
    return patterns.run_machine(clicks(spark, sf).withColumn("kind", login_kind()), ["user_id"], "kind",
                                patterns.THREE_FAILURES)
