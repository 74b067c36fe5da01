"""Row-level queries: sources, projections, partitioning, functions, sink shaping."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from eventloom.functions import scalar
from eventloom.functions.registry import register_functions
from eventloom.operators import aggregates, elementwise, partitioning
from eventloom.plans.catalog import query
from eventloom.sinks import shaping
from eventloom.sources import files, kafka
from eventloom.sources.tables import clicks, table

# ---- sources ---------------------------------------------------------------------------


@query("parse_lines", """
SELECT CAST(user_id AS VARCHAR) AS user_name, url,
       CASE WHEN url <> 'error' THEN ts_ms END AS ts_ms, url <> 'error' AS ok FROM clicks""")
def parse_lines(spark, sf):
    """Delimited text made from the clicks; the time of an error row is not a number."""
    third = F.when(F.col("url") == "error", F.lit("n/a")).otherwise(F.col("ts_ms").cast("string"))
    lines = clicks(spark, sf).select(
        F.concat_ws(", ", F.col("user_id").cast("string"), "url", third).alias("value"))
    return elementwise.parse_lines(lines, "value", ",", ("user_name", "url", "ts_ms")).drop("value")


@query("computed_event_time", "SELECT seq, ts_ms // 1000 * 1000 AS et_ms FROM clicks")
def computed_event_time(spark, sf):
    return files.with_event_time(clicks(spark, sf), "ts_ms").select("seq", F.unix_millis("et").alias("et_ms"))


@query("ts_scale", "SELECT seq, ts_ms // 1000 AS ts_s, ts_ms // 1000 * 1000 AS from_seconds, ts_ms AS from_ms FROM clicks")
def ts_scale(spark, sf):
    """Event times that arrive in seconds against event times that arrive in ms."""
    s = F.expr("ts_ms div 1000")
    return clicks(spark, sf).select(
        "seq", s.alias("ts_s"), F.unix_millis(F.timestamp_seconds(s)).alias("from_seconds"),
        F.unix_millis(F.timestamp_millis("ts_ms")).alias("from_ms"))


@query("kafka_decode", """
SELECT CAST(user_id AS VARCHAR) AS key, user_id || ',' || url || ',' || ts_ms AS value FROM clicks""")
def kafka_decode(spark, sf):
    text = F.concat_ws(",", F.col("user_id").cast("string"), "url", F.col("ts_ms").cast("string"))
    wire = clicks(spark, sf).select(F.col("user_id").cast("string").cast("binary").alias("key"),
                                    text.cast("binary").alias("value"))
    return kafka.decode(wire)


@query("stream_as_table", "SELECT user_id AS user_name, url, ts_ms AS ts FROM clicks")
def stream_as_table(spark, sf):
    return spark.sql("SELECT user_id AS user_name, url, ts_ms AS ts FROM {clicks}", clicks=clicks(spark, sf))


@query("view_chain", "SELECT url, count(*) AS cnt FROM clicks WHERE user_id = 7 GROUP BY url")
def view_chain(spark, sf):
    clicks(spark, sf).where("user_id = 7").createOrReplaceTempView("clicks_of_one_user")
    return spark.table("clicks_of_one_user").groupBy("url").agg(F.count(F.lit(1)).alias("cnt"))


# ---- projection, filter, 0..n rows -----------------------------------------------------


@query("map_user", "SELECT user_id FROM clicks")
def map_user(spark, sf):
    return clicks(spark, sf).select("user_id")


@query("filter_user", "SELECT * FROM clicks WHERE user_id = 7")
def filter_user(spark, sf):
    return clicks(spark, sf).where(F.col("user_id") == 7).select("seq", "user_id", "url", "ts_ms", "value")


@query("where_select", "SELECT user_id, url FROM clicks WHERE url = 'click'")
def where_select(spark, sf):
    return clicks(spark, sf).where(F.col("url") == "click").select("user_id", "url")


@query("sql_project", 'SELECT url, user_id AS "user", ts_ms AS "timestamp" FROM clicks')
def sql_project(spark, sf):
    return spark.sql("SELECT url, user_id AS `user`, ts_ms AS `timestamp` FROM {clicks}", clicks=clicks(spark, sf))


@query("flatmap_fields", """
SELECT seq, unnest([CAST(user_id AS VARCHAR), url, CAST(ts_ms AS VARCHAR)]) AS field FROM clicks""")
def flatmap_fields(spark, sf):
    return elementwise.emit(clicks(spark, sf), ["seq"], "field",
                            elementwise.fields_as_rows("user_id", "url", "ts_ms"))


@query("flatmap_cond", """
SELECT seq, url AS field FROM clicks WHERE user_id % 3 = 0
UNION ALL
SELECT seq, unnest([CAST(user_id AS VARCHAR), url, CAST(ts_ms AS VARCHAR)]) FROM clicks WHERE user_id % 3 = 1""")
def flatmap_cond(spark, sf):
    """One kind of user emits the url, another all fields, the rest nothing."""
    kind = F.col("user_id") % 3
    rows = (F.when(kind == 0, F.array("url"))
            .when(kind == 1, elementwise.fields_as_rows("user_id", "url", "ts_ms"))
            .otherwise(elementwise.no_rows()))
    return elementwise.emit(clicks(spark, sf), ["seq"], "field", rows)


_TOKENS_SQL = """lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
tokens AS (
  SELECT doc_id, unnest(CASE WHEN length(line) > 0 AND rtrim(line, ' ') = '' THEN []
                             ELSE string_split(rtrim(line, ' '), ' ') END) AS word FROM lines)"""


@query("tokenize", "SELECT doc_id, word, CAST(1 AS BIGINT) AS one FROM tokens", _TOKENS_SQL)
def tokenize(spark, sf):
    return elementwise.tokens(table(spark, sf, "documents"), "text", "doc_id")


@query("word_count", "SELECT word, count(*) AS cnt FROM tokens GROUP BY word", _TOKENS_SQL)
def word_count(spark, sf):
    return (elementwise.tokens(table(spark, sf, "documents"), "text")
            .groupBy("word").agg(F.sum("one").alias("cnt")))


@query("url_length", "SELECT page_id, CAST(length(url) AS BIGINT) AS url_length FROM pages", "")
def url_length(spark, sf):
    return table(spark, sf, "pages").select("page_id", F.length("url").cast("bigint").alias("url_length"))


_EVENT_TEXT_SQL = """'Event{user=''' || user_id || ''', url=''' || url || ''', timestamp='
  || regexp_replace(strftime(make_timestamp(ts_ms * 1000), '%Y-%m-%d %H:%M:%S.%g'), '(\\.\\d+?)0+$', '\\1') || '}'"""


def _event_text():
    return scalar.event_text(F.col("user_id").cast("string"), F.col("url"), F.col("ts_ms"))


@query("process_emit", f"""
SELECT seq, user_id || ' clicks ' || url AS line FROM clicks WHERE user_id % 3 = 0
UNION ALL SELECT seq, unnest([CAST(user_id AS VARCHAR), CAST(user_id AS VARCHAR)]) FROM clicks WHERE user_id % 3 = 1
UNION ALL SELECT seq, {_EVENT_TEXT_SQL} FROM clicks""")
def process_emit(spark, sf):
    user = F.col("user_id").cast("string")
    kind = F.col("user_id") % 3
    extra = (F.when(kind == 0, F.array(F.concat(user, F.lit(" clicks "), "url")))
             .when(kind == 1, F.array(user, user)).otherwise(elementwise.no_rows()))
    return elementwise.emit(clicks(spark, sf), ["seq"], "line", F.concat(extra, F.array(_event_text())))


@query("event_string", f"SELECT seq, {_EVENT_TEXT_SQL} AS line FROM clicks")
def event_string(spark, sf):
    return clicks(spark, sf).select("seq", _event_text().alias("line"))


@query("split_tag", """
SELECT seq, user_id, url, CASE WHEN user_id = 7 THEN 'first' WHEN user_id = 8 THEN 'second' ELSE 'rest' END AS tag
FROM clicks""")
def split_tag(spark, sf):
    return elementwise.tagged(clicks(spark, sf).select("seq", "user_id", "url"),
                              {"first": F.col("user_id") == 7, "second": F.col("user_id") == 8}, "rest")


@query("comap", """
SELECT 'Integer: ' || l_linenumber AS line FROM lineitem
UNION ALL SELECT 'Long: ' || o_orderkey FROM orders""", "")
def comap(spark, sf):
    """An INT and a BIGINT input, each with its own function, in one text output."""
    ints, longs = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return elementwise.co_map(ints, F.concat(F.lit("Integer: "), F.col("l_linenumber").cast("string")),
                              longs, F.concat(F.lit("Long: "), F.col("o_orderkey").cast("string")), "line")


@query("union_streams", """
SELECT seq, user_id, ts_ms FROM clicks WHERE url = 'click'
UNION ALL SELECT seq, user_id, ts_ms FROM clicks WHERE url <> 'click'""")
def union_streams(spark, sf):
    c = clicks(spark, sf)
    cols = ["seq", "user_id", "ts_ms"]
    return c.where("url = 'click'").select(*cols).unionByName(c.where("url <> 'click'").select(*cols))


_PARTS_SQL = """parts AS (
  SELECT page_id, unnest(CASE WHEN length(url) > 0 AND rtrim(url, '?') = '' THEN []
                              ELSE string_split(rtrim(url, '?'), '?') END) AS word FROM pages)"""


@query("lateral_split", "SELECT page_id, word, CAST(length(word) AS INTEGER) AS length FROM parts", _PARTS_SQL)
def lateral_split(spark, sf):
    register_functions(spark)
    return spark.sql("SELECT page_id, s.word, s.length FROM {pages}, LATERAL my_split(url) s",
                     pages=table(spark, sf, "pages"))


# ---- functions -------------------------------------------------------------------------

@query("java_hash", """
SELECT page_id, CAST((h + 2147483648) % 4294967296 - 2147483648 AS INTEGER) AS hash FROM (
  SELECT page_id, list_reduce(list_prepend(CAST(0 AS BIGINT),
           list_transform(string_split(url, ''), lambda c: CAST(ord(c) AS BIGINT))),
           lambda h, u: (h * 31 + u) % 4294967296) AS h FROM pages)""", "")
def java_hash(spark, sf):
    register_functions(spark)
    return spark.sql("SELECT page_id, my_hash(url) AS hash FROM {pages}", pages=table(spark, sf, "pages"))


@query("weighted_avg", """
SELECT user_id, CAST(sum(ts_ms * w) // nullif(sum(w), 0) AS BIGINT) AS w_avg
FROM (SELECT user_id, ts_ms, CAST(floor(value) AS BIGINT) AS w FROM clicks) GROUP BY user_id""")
def weighted_avg(spark, sf):
    weighted = clicks(spark, sf).withColumn("w", F.floor("value").cast("bigint"))
    register_functions(spark)
    return spark.sql("""SELECT user_id, weighted_avg(sum(CAST(ts_ms AS DECIMAL(20, 0)) * w), sum(w)) AS w_avg
                        FROM {weighted} GROUP BY user_id""", weighted=weighted)


# ---- partitioning ----------------------------------------------------------------------
# The number of partitions follows the input; the results say what became of the rows.

@query("key_partition", "SELECT user_id, count(*) AS cnt, CAST(1 AS BIGINT) AS n_partitions FROM clicks GROUP BY user_id")
def key_partition(spark, sf):
    """Hash partitioning by key, with the number of partitions that hold each key."""
    users = clicks(spark, sf).select("user_id")
    placed = partitioning.by_key(users, partitioning.partitions_for(users), "user_id")
    per_task = placed.groupBy("user_id", F.spark_partition_id().alias("pid")).agg(F.count(F.lit(1)).alias("n"))
    return per_task.groupBy("user_id").agg(F.sum("n").alias("cnt"), F.count(F.lit(1)).alias("n_partitions"))


_SPREAD_SQL = """
SELECT count(*) AS n_rows, CAST(sum(seq) AS BIGINT) AS sum_seq, true AS even FROM clicks"""


def _totals(placed, even, **more):
    return partitioning.per_partition(placed, s=F.sum("seq"), **more).agg(
        F.sum("n").alias("n_rows"), F.sum("s").alias("sum_seq"), even.alias("even"))


@query("shuffle_random", _SPREAD_SQL)
def shuffle_random(spark, sf):
    """All rows arrive, and no partition is six standard deviations above the mean."""
    c = clicks(spark, sf).select("seq")
    n = partitioning.partitions_for(c)
    mean = F.sum("n") / n
    return _totals(partitioning.scattered(c, n, "seq"), F.max("n") <= mean + 6 * F.sqrt(mean) + 1)


@query("round_robin", _SPREAD_SQL)
def round_robin(spark, sf):
    """All rows arrive, and sizes differ by at most one row per task of the input."""
    c = clicks(spark, sf).select("seq", F.spark_partition_id().alias("task"))
    n = partitioning.partitions_for(c)
    smallest = F.when(F.count(F.lit(1)) == n, F.min("n")).otherwise(0)
    return _totals(partitioning.round_robin(c, n), F.max("n") - smallest <= F.max("last_task") + 1,
                   last_task=F.max("task"))


@query("partition_preserves", """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS parted, true AS fewer FROM clicks""")
def partition_preserves(spark, sf):
    """Merging neighbours keeps each partition whole: ``parted`` counts those that were not."""
    c = clicks(spark, sf).select("seq")
    n = partitioning.partitions_for(c)
    before = partitioning.round_robin(c, n).withColumn("source", F.spark_partition_id())
    merged = partitioning.rescaled(before, -(-n // 4))
    moves = merged.groupBy("source", F.spark_partition_id().alias("target")).agg(F.count(F.lit(1)).alias("n"))
    sources = moves.groupBy("source").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("targets"),
                                          F.max("target").alias("target"))
    return sources.agg(F.sum("n").alias("n_rows"), F.count_if(F.col("targets") > 1).alias("parted"),
                       (F.max("target") < -(-n // 4)).alias("fewer"))


@query("total_order", """
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS overlaps, min(ts_ms) AS first_ms, max(ts_ms) AS last_ms FROM clicks""")
def total_order(spark, sf):
    """Every partition lies after the one before it: ``overlaps`` counts those that do not."""
    c = clicks(spark, sf).select("seq", "ts_ms")
    ordered = partitioning.total_order(c, partitioning.partitions_for(c), "ts_ms", "seq")
    place = F.struct("ts_ms", "seq")
    parts = partitioning.per_partition(ordered, lowest=F.min(place), highest=F.max(place))
    # One row per partition of the cluster, so a single window is small.
    earlier = F.lag("highest").over(Window.partitionBy(F.lit(0)).orderBy("partition"))
    return parts.withColumn("earlier", earlier).agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("earlier") >= F.col("lowest")).alias("overlaps"),
        F.min("lowest.ts_ms").alias("first_ms"), F.max("highest.ts_ms").alias("last_ms"))


@query("replicate_n", "SELECT seq, CAST(unnest(range(4)) AS INTEGER) AS copy FROM clicks")
def replicate_n(spark, sf):
    return partitioning.replicated(clicks(spark, sf).select("seq"), 4)


@query("custom_partition", "SELECT seq, user_id, CAST(user_id % 2 AS INTEGER) AS partition FROM clicks")
def custom_partition(spark, sf):
    placed = partitioning.custom(clicks(spark, sf).select("seq", "user_id"), 2, F.pmod("user_id", F.lit(2)))
    return placed.withColumn("partition", F.spark_partition_id())


# ---- sink shaping ----------------------------------------------------------------------

@query("kafka_records", f"SELECT CAST(user_id AS VARCHAR) AS key, {_EVENT_TEXT_SQL} AS value FROM clicks")
def kafka_records(spark, sf):
    return kafka.as_records(clicks(spark, sf), F.col("user_id"), _event_text())


@query("upsert_latest", """
SELECT user_id, arg_max(url, seq) AS url, max(seq) AS seq FROM clicks GROUP BY user_id""")
def upsert_latest(spark, sf):
    return shaping.latest_per_key(clicks(spark, sf), "user_id", "url", "ts_ms", "seq").drop("ts_ms")


@query("index_docs", """
SELECT 'clicks' AS index_name, '{"' || user_id || '":"' || url || '"}' AS doc FROM clicks""")
def index_docs(spark, sf):
    return shaping.index_documents(clicks(spark, sf), "clicks", "user_id", "url")


@query("cell_puts", """
SELECT DISTINCT CAST(user_id AS VARCHAR) AS row_key, 'info' AS family, url AS qualifier, '1' AS cell FROM clicks""")
def cell_puts(spark, sf):
    return shaping.cell_puts(clicks(spark, sf), F.col("user_id"), "info", F.col("url"), "1")


@query("append_filter", "SELECT url, user_id FROM clicks WHERE user_id = 7")
def append_filter(spark, sf):
    """Append-only table in the column order of its sink."""
    return shaping.positional(clicks(spark, sf).where("user_id = 7"), "url", "user_id")


WRITERS = 32  # buffering writers side by side


@query("buffered_batches", """
SELECT shard, batch_no, count(*) AS n, min(seq) AS first_seq, max(seq) AS last_seq,
       string_agg(url, ',' ORDER BY seq) AS urls
FROM (SELECT seq, url, user_id % 32 AS shard,
             (row_number() OVER (PARTITION BY user_id % 32 ORDER BY seq) - 1) // 10 AS batch_no FROM clicks)
GROUP BY shard, batch_no HAVING count(*) = 10""")
def buffered_batches(spark, sf):
    sharded = clicks(spark, sf).withColumn("shard", F.col("user_id") % WRITERS)
    out = aggregates.buffered_batches(sharded, "shard", 10, "url")
    return out.select("shard", "batch_no", "n", F.col("rows")[0]["seq"].alias("first_seq"),
                      F.element_at("rows", -1)["seq"].alias("last_seq"),
                      F.array_join("rows.url", ",").alias("urls"))


@query("count_changelog", """
, counted AS (SELECT seq, user_id, row_number() OVER (PARTITION BY user_id ORDER BY seq) AS cnt FROM clicks)
SELECT seq, user_id, '+I' AS op, cnt FROM counted WHERE cnt = 1
UNION ALL SELECT seq, user_id, '-U', cnt - 1 FROM counted WHERE cnt > 1
UNION ALL SELECT seq, user_id, '+U', cnt FROM counted WHERE cnt > 1""")
def count_changelog(spark, sf):
    return aggregates.count_changelog(clicks(spark, sf), "user_id")
