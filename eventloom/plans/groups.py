"""Aggregates, windows, ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions import scalar
from eventloom.operators import aggregates, ranking, windows
from eventloom.plans.catalog import DAY, HOUR, query
from eventloom.sources.files import with_event_time
from eventloom.sources.tables import clicks

# ---- keyed and running aggregates ------------------------------------------------------


@query("running_count", """
SELECT seq, user_id, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS cnt FROM clicks""")
def running_count(spark, sf):
    return aggregates.running_count(clicks(spark, sf).select("seq", "user_id"), ["user_id"])


@query("user_click_count", "SELECT user_id, count(*) AS cnt FROM clicks GROUP BY user_id")
def user_click_count(spark, sf):
    return clicks(spark, sf).groupBy("user_id").agg(F.sum(F.lit(1).cast("bigint")).alias("cnt"))


@query("running_leader", """
, counted AS (SELECT seq, user_id, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS cnt FROM clicks),
best AS (SELECT seq, max({'c': cnt, 's': seq, 'u': user_id}) OVER (ORDER BY seq) AS b FROM counted)
SELECT seq, b.u AS leader, b.c AS leader_cnt FROM best""")
def running_leader(spark, sf):
    return aggregates.running_leader(clicks(spark, sf), "user_id")


@query("keyed_max", """
SELECT seq, user_id, first_value(url) OVER w AS first_url, max(ts_ms) OVER w AS max_ts_ms
FROM clicks WINDOW w AS (PARTITION BY user_id ORDER BY seq)""")
def keyed_max(spark, sf):
    return aggregates.running_max(clicks(spark, sf), "user_id", "ts_ms", "url")


@query("keyed_max_by", """
SELECT user_id, value, url, seq FROM clicks
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value DESC, seq) = 1""")
def keyed_max_by(spark, sf):
    return aggregates.max_row(clicks(spark, sf), "user_id", "value", "url", "seq")


@query("keyed_max_by_running", """
SELECT seq, user_id, arg_max(url, {'v': value, 'a': -seq}) OVER w AS top_url, max(value) OVER w AS top_value
FROM clicks WINDOW w AS (PARTITION BY user_id ORDER BY seq)""")
def keyed_max_by_running(spark, sf):
    return aggregates.running_max_row(clicks(spark, sf), "user_id", "value", "url")


@query("sql_count_url", "SELECT user_id, count(url) AS cnt FROM clicks GROUP BY user_id")
def sql_count_url(spark, sf):
    return spark.sql("SELECT user_id, COUNT(url) AS cnt FROM {clicks} GROUP BY user_id", clicks=clicks(spark, sf))


@query("sql_count_one", "SELECT user_id, count(1) AS cnt FROM clicks GROUP BY user_id")
def sql_count_one(spark, sf):
    return spark.sql("SELECT user_id, COUNT(1) AS cnt FROM {clicks} GROUP BY user_id", clicks=clicks(spark, sf))


@query("avg_every_5", """
SELECT user_id, group_no, CAST(sum(ts_ms) // 5 AS BIGINT) AS avg_ts_ms FROM (
  SELECT user_id, ts_ms, (row_number() OVER (PARTITION BY user_id ORDER BY seq) - 1) // 5 AS group_no FROM clicks)
GROUP BY user_id, group_no HAVING count(*) = 5""")
def avg_every_5(spark, sf):
    return aggregates.every_nth_average(clicks(spark, sf), "user_id", "ts_ms", 5)


@query("state_profile", """
SELECT user_id, count(*) AS list_size, count(*) AS map_count, arg_min(url, seq) AS reduced_url,
       arg_max(ts_ms, seq) AS reduced_ts, 'count: ' || count(*) AS agg_text FROM clicks GROUP BY user_id""")
def state_profile(spark, sf):
    return aggregates.state_profile(clicks(spark, sf))


@query("periodic_pv", f"""
, firsts AS (SELECT user_id, min(ts_ms) AS f FROM clicks GROUP BY user_id),
newest AS (SELECT max(ts_ms) AS m FROM clicks),
ticks AS (SELECT user_id, unnest(range(f + {DAY}, m + 1, {DAY})) AS tick_ms FROM firsts, newest)
SELECT t.user_id, t.tick_ms, count(*) AS pv FROM ticks t JOIN clicks c
  ON c.user_id = t.user_id AND c.ts_ms <= t.tick_ms GROUP BY t.user_id, t.tick_ms""")
def periodic_pv(spark, sf):
    return aggregates.periodic_counts(clicks(spark, sf), "user_id", DAY)


# ---- windowed aggregates ---------------------------------------------------------------

_HOUR_SQL = f"ts_ms // {HOUR} * {HOUR} AS window_start, ts_ms // {HOUR} * {HOUR} + {HOUR} AS window_end"
_DAY_SQL = f"ts_ms // {DAY} * {DAY} AS window_start, ts_ms // {DAY} * {DAY} + {DAY} AS window_end"
_HOP_SQL = f"""
, hops AS (SELECT *, window_start + {2 * HOUR} AS window_end FROM (
    SELECT *, unnest([ts_ms // {HOUR} * {HOUR} - {HOUR}, ts_ms // {HOUR} * {HOUR}]) AS window_start FROM clicks))"""


@query("uv_tumbling", f"SELECT {_HOUR_SQL}, count(DISTINCT user_id) AS uv, count(*) AS pv FROM clicks GROUP BY ALL")
def uv_tumbling(spark, sf):
    return aggregates.unique_visitors(clicks(spark, sf), HOUR).select("window_start", "window_end", "uv", "pv")


@query("uv_full_window", f"""
SELECT {_HOUR_SQL}, count(DISTINCT user_id) AS uv, min(user_id) AS min_user, max(user_id) AS max_user
FROM clicks GROUP BY ALL""")
def uv_full_window(spark, sf):
    """The full-window form of UV: what the window function sees are the distinct users."""
    users = windows.tumble(clicks(spark, sf), HOUR).select("window_start", "window_end", "user_id").distinct()
    return users.groupBy("window_start", "window_end").agg(
        F.count(F.lit(1)).alias("uv"), F.min("user_id").alias("min_user"), F.max("user_id").alias("max_user"))


@query("uv_label", f"""
SELECT strftime(make_timestamp(window_start * 1000), '%Y-%m-%d %H:%M:%S') || '.0~' ||
       strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S') || '.0 UV: ' || uv AS label
FROM (SELECT {_HOUR_SQL}, count(DISTINCT user_id) AS uv FROM clicks GROUP BY ALL)""")
def uv_label(spark, sf):
    uv = aggregates.unique_visitors(clicks(spark, sf), HOUR)
    return uv.select(scalar.uv_text(F.col("window_start"), F.col("window_end"), F.col("uv")).alias("label"))


@query("pv_uv_sliding", _HOP_SQL + """
SELECT window_start, window_end, count(*) AS pv, count(DISTINCT user_id) AS uv,
       round(count(*) / count(DISTINCT user_id), 6) AS pv_uv FROM hops GROUP BY ALL""")
def pv_uv_sliding(spark, sf):
    return aggregates.views_per_visitor(clicks(spark, sf), 2 * HOUR, HOUR)


@query("avg_ts_window", f"""
SELECT {_DAY_SQL}, user_id, CAST(sum(ts_ms) // count(*) AS BIGINT) AS avg_ts FROM clicks GROUP BY ALL""")
def avg_ts_window(spark, sf):
    grouped = clicks(spark, sf).groupBy(windows.tumbling(DAY), "user_id")
    return windows.window_bounds(grouped.agg(scalar.integer_average("ts_ms").alias("avg_ts")))


@query("url_view_count", f"SELECT {_HOUR_SQL}, url, count(*) AS cnt FROM clicks GROUP BY ALL")
def url_view_count(spark, sf):
    return windows.window_bounds(
        clicks(spark, sf).groupBy(windows.tumbling(HOUR), "url").agg(F.count(F.lit(1)).alias("cnt")))


@query("window_all_counts", _HOP_SQL + """
SELECT window_start, window_end, user_id, cnt,
       CAST(rank() OVER (PARTITION BY window_start ORDER BY cnt DESC) AS BIGINT) AS rnk
FROM (SELECT window_start, window_end, user_id, count(*) AS cnt FROM hops GROUP BY ALL)""")
def window_all_counts(spark, sf):
    return ranking.ranked_counts(clicks(spark, sf), "user_id", 2 * HOUR, HOUR)


# ---- windows ---------------------------------------------------------------------------

@query("tumble_count", f"SELECT {_DAY_SQL}, user_id, count(*) AS cnt FROM clicks GROUP BY ALL")
def tumble_count(spark, sf):
    one = F.lit(1).cast("bigint")
    return windows.window_bounds(
        clicks(spark, sf).groupBy(windows.tumbling(DAY), "user_id").agg(F.sum(one).alias("cnt")))


@query("slide_count", _HOP_SQL + """
SELECT window_start, window_end, url, count(*) AS cnt FROM hops GROUP BY ALL""")
def slide_count(spark, sf):
    return windows.sliding_counts(clicks(spark, sf), ["url"], 2 * HOUR, HOUR)


@query("session_count", f"""
, flagged AS (SELECT user_id, ts_ms, seq, CASE WHEN ts_ms - lag(ts_ms) OVER w <= {8 * HOUR} THEN 0 ELSE 1 END AS n
              FROM clicks WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms, seq)),
numbered AS (SELECT user_id, ts_ms, sum(n) OVER (PARTITION BY user_id ORDER BY ts_ms, seq) AS s FROM flagged)
SELECT user_id, min(ts_ms) AS window_start, max(ts_ms) + {8 * HOUR} AS window_end, count(*) AS cnt
FROM numbered GROUP BY user_id, s""")
def session_count(spark, sf):
    return windows.sessions(clicks(spark, sf), ["user_id"], 8 * HOUR)


@query("count_window", """
SELECT seq, user_id, rn AS row_no, cnt, max_value FROM (
  SELECT seq, user_id, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS rn,
         count(*) OVER w AS cnt, max(value) OVER w AS max_value
  FROM clicks WINDOW w AS (PARTITION BY user_id ORDER BY seq ROWS 9 PRECEDING)) WHERE rn % 2 = 0""")
def count_window(spark, sf):
    out = windows.count_windows(clicks(spark, sf).select("seq", "user_id", "value"), ["user_id"], 10, 2, "value")
    return out.select("seq", "user_id", "row_no", "cnt", "max_value")


_ET = f"(ts_ms // 1000 * 1000)"
_ET_DAY_SQL = f"{_ET} // {DAY} * {DAY} + {DAY} AS window_end"


@query("sql_group_window", f"SELECT user_id, count(1) AS cnt, {_ET_DAY_SQL} FROM clicks GROUP BY ALL")
def sql_group_window(spark, sf):
    return spark.sql("""
        SELECT user_id, COUNT(1) AS cnt, unix_millis(window.end) AS window_end
        FROM {clicks} GROUP BY user_id, window(et, '1 day')""",
        clicks=with_event_time(clicks(spark, sf), "ts_ms"))


@query("tvf_tumble", f"SELECT user_id, count(*) AS cnt, {_DAY_SQL} FROM clicks GROUP BY ALL")
def tvf_tumble(spark, sf):
    return (windows.tumble(clicks(spark, sf), DAY)
            .groupBy("user_id", "window_start", "window_end").agg(F.count(F.lit(1)).alias("cnt")))


@query("tvf_hop", f"""
SELECT user_id, window_start, window_start + {2 * DAY} AS window_end, count(*) AS cnt FROM (
  SELECT user_id, unnest([ts_ms // {DAY} * {DAY} - {DAY}, ts_ms // {DAY} * {DAY}]) AS window_start FROM clicks)
GROUP BY ALL""")
def tvf_hop(spark, sf):
    """Sliding windows per user; one count per user and day is copied, not each row."""
    return windows.sliding_counts(clicks(spark, sf), ["user_id"], 2 * DAY, DAY)


@query("tvf_hop_rows", f"""
SELECT seq, window_start, window_start + {2 * DAY} AS window_end FROM (
  SELECT seq, unnest([ts_ms // {DAY} * {DAY} - {DAY}, ts_ms // {DAY} * {DAY}]) AS window_start FROM clicks)""")
def tvf_hop_rows(spark, sf):
    return windows.hop(clicks(spark, sf), 2 * DAY, DAY).select("seq", "window_start", "window_end")


_CUMULATE_SQL = f"""
SELECT {{key}}, ts_ms // {DAY} * {DAY} AS window_start,
       unnest(range(ts_ms // {6 * HOUR} * {6 * HOUR} + {6 * HOUR}, ts_ms // {DAY} * {DAY} + {DAY} + 1, {6 * HOUR})) AS window_end
FROM clicks"""


@query("tvf_cumulate", "SELECT user_id, window_start, window_end, count(*) AS cnt FROM ("
       + _CUMULATE_SQL.format(key="user_id") + ") GROUP BY ALL")
def tvf_cumulate(spark, sf):
    return windows.cumulating_counts(clicks(spark, sf), ["user_id"], DAY, 6 * HOUR)


@query("tvf_cumulate_rows", _CUMULATE_SQL.format(key="seq"))
def tvf_cumulate_rows(spark, sf):
    return windows.cumulate(clicks(spark, sf), DAY, 6 * HOUR).select("seq", "window_start", "window_end")


@query("over_avg", """
SELECT seq, user_id, CAST(sum(ts_ms) OVER w // count(*) OVER w AS BIGINT) AS avg_ts_ms
FROM clicks WINDOW w AS (PARTITION BY user_id ORDER BY ts_ms, seq ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""")
def over_avg(spark, sf):
    out = windows.over_average(clicks(spark, sf).select("seq", "user_id", "ts_ms"), ["user_id"], "ts_ms", 3)
    return out.select("seq", "user_id", "avg_ts_ms")


@query("window_all", f"SELECT {_HOUR_SQL}, count(*) AS cnt, max(value) AS max_value FROM clicks GROUP BY ALL")
def window_all(spark, sf):
    return windows.window_bounds(clicks(spark, sf).groupBy(windows.tumbling(HOUR))
                                 .agg(F.count(F.lit(1)).alias("cnt"), F.max("value").alias("max_value")))


@query("manual_window", f"SELECT {_HOUR_SQL}, url, count(*) AS cnt FROM clicks GROUP BY ALL")
def manual_window(spark, sf):
    """Window bounds by plain arithmetic on epoch ms."""
    start = F.expr(f"ts_ms div {HOUR} * {HOUR}")
    return (clicks(spark, sf).groupBy(start.alias("window_start"), "url").agg(F.count(F.lit(1)).alias("cnt"))
            .withColumn("window_end", F.col("window_start") + HOUR))


# ---- ranking ---------------------------------------------------------------------------

@query("topn_users", """
SELECT user_id, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, user_id) AS INTEGER) AS row_num
FROM (SELECT user_id, count(url) AS cnt FROM clicks GROUP BY user_id) QUALIFY row_num <= 2""")
def topn_users(spark, sf):
    counts = clicks(spark, sf).groupBy("user_id").agg(F.count("url").alias("cnt"))
    return ranking.top_n_overall(counts, "cnt", "user_id", 2)


def _topn_sql(source: str, key: str) -> str:
    return f"""
SELECT window_start, window_end, {key}, cnt,
       CAST(row_number() OVER (PARTITION BY window_start ORDER BY cnt DESC, {key}) AS INTEGER) AS row_num
FROM ({source}) QUALIFY row_num <= 2"""


@query("window_topn", _topn_sql(f"SELECT {_DAY_SQL}, user_id, count(url) AS cnt FROM clicks GROUP BY ALL", "user_id"))
def window_topn(spark, sf):
    return ranking.window_top_n(clicks(spark, sf), "user_id", DAY, 2)


@query("window_topn_url", _topn_sql(f"SELECT {_HOUR_SQL}, url, count(*) AS cnt FROM clicks GROUP BY ALL", "url"))
def window_topn_url(spark, sf):
    return ranking.window_top_n(clicks(spark, sf), "url", HOUR, 2)


_HOP_COUNTS = "SELECT window_start, window_end, {0}, count(*) AS cnt FROM hops GROUP BY ALL"


@query("topn_url_sliding", _HOP_SQL + _topn_sql(_HOP_COUNTS.format("url"), "url"))
def topn_url_sliding(spark, sf):
    return ranking.window_top_n(clicks(spark, sf), "url", 2 * HOUR, 2, slide_ms=HOUR)


@query("topn_window_all", _HOP_SQL + f"""
SELECT window_end, string_agg('No. ' || row_num || '  url: ' || url || '  views: ' || cnt, chr(10) ORDER BY row_num) AS report
FROM ({_topn_sql(_HOP_COUNTS.format("url"), "url")}) GROUP BY window_end""")
def topn_window_all(spark, sf):
    """One text report per window; it holds at most two lines."""
    top = ranking.window_top_n(clicks(spark, sf), "url", 2 * HOUR, 2, slide_ms=HOUR)
    line = F.format_string("No. %d  url: %s  views: %d", "row_num", "url", "cnt")
    return (top.groupBy("window_end")
            .agg(F.sort_array(F.collect_list(F.struct("row_num", line.alias("line")))).alias("l"))
            .select("window_end", F.array_join("l.line", "\n").alias("report")))


@query("top2_agg", f"""
SELECT window_end, cnt, CAST(row_number() OVER (PARTITION BY window_end ORDER BY cnt DESC) AS INTEGER) AS rank
FROM (SELECT {_DAY_SQL}, user_id, count(*) AS cnt FROM clicks GROUP BY ALL) QUALIFY rank <= 2""")
def top2_agg(spark, sf):
    counts = windows.sliding_counts(clicks(spark, sf), ["user_id"], DAY, DAY)
    return ranking.top_two(counts, ["window_end"], "cnt")
