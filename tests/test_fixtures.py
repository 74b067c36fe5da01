"""Operators on inputs whose results are known."""

import pytest
from pyspark.sql import functions as F

from eventloom.functions import scalar
from eventloom.functions.registry import register_functions
from eventloom.operators import aggregates, elementwise, joins, lateness, partitioning, patterns, ranking, windows
from eventloom.sinks import writers
from eventloom.sources import files, kafka
from tests.fixtures import CLICKS, EVENTS8, LOGINS, ORDERS, WORDS, keyed, rows


def clicks(spark):
    return keyed(spark, CLICKS)


def test_word_count_from_text_file(spark, tmp_path):
    (tmp_path / "words.txt").write_text("\n".join(WORDS) + "\n")
    tokens = elementwise.tokens(files.text_lines(spark, str(tmp_path / "words.txt")), "value")
    assert rows(tokens.groupBy("word").agg(F.sum("one").alias("n")), "word", "n") == [
        ("hello", 3), ("java", 1), ("stream", 1), ("world", 1)]


def test_split_keeps_inner_and_drops_trailing_empties(spark):
    df = spark.createDataFrame([("a  b  ",), ("",), ("   ",), (" x",)], "t string")
    got = [r[0] for r in df.select(scalar.words(F.col("t"))).collect()]
    assert got == [["a", "", "b"], [""], [], ["", "x"]]


def test_click_csv_keeps_the_blank_and_reads_the_number(spark, tmp_path):
    path = tmp_path / "clicks.txt"
    path.write_bytes("".join(f"{u}, {v}, {t}\r\n" for u, v, t in CLICKS).encode())
    table = files.click_csv(spark, str(path))
    assert table.count() == 12 and table.where("ts IS NULL").count() == 0
    out = str(tmp_path / "out")
    writers.write_csv(table.where("user_name = 'Bob' AND ts <= 9000"), out, "user_name", "url")
    lines = sorted(r[0] for r in spark.read.text(out).collect())
    assert [l.replace('"', "") for l in lines] == sorted(
        ["Bob, ./home"] * 2 + ["Bob, ./cart"] * 2 + ["Bob, ./prod?id=10", "Bob, ./prod?id=100"])
    timed = files.with_event_time(table)
    assert timed.agg(F.max(F.unix_millis("et"))).first()[0] == 15000


def test_parse_lines_with_both_delimiters(spark):
    df = spark.createDataFrame([("Mary, ./home, 1000",), ("Bob,./cart,x",), ("Bob",)], "v string")
    got = elementwise.parse_lines(df, "v", ",", ("u", "url", "ms"))
    assert rows(got, "u", "url", "ms", "ok") == [
        ("Bob", "./cart", None, False), ("Bob", None, None, False), ("Mary", "./home", 1000, True)]
    spaced = spark.createDataFrame([("Mary ./home 1000",)], "v string")
    assert rows(elementwise.parse_lines(spaced, "v", " ", ("u", "url", "ms")), "ms", "ok") == [(1000, True)]


def test_count_by_user(spark):
    assert rows(clicks(spark).groupBy("user_id").agg(F.count("url").alias("n")), "user_id", "n") == [
        ("Alice", 1), ("Bob", 8), ("Mary", 3)]


def test_tumbling_hop_and_cumulate(spark):
    c = clicks(spark)

    def counts(df):
        return rows(df.groupBy("user_id", "window_start", "window_end").agg(F.count(F.lit(1)).alias("n")),
                    "window_end", "user_id", "n")

    tumble = [(10000, "Alice", 1), (10000, "Bob", 6), (10000, "Mary", 2), (20000, "Bob", 2), (20000, "Mary", 1)]
    hop = [(5000, "Alice", 1), (5000, "Bob", 2), (5000, "Mary", 1), (10000, "Alice", 1), (10000, "Bob", 6),
           (10000, "Mary", 2), (15000, "Bob", 5), (15000, "Mary", 2), (20000, "Bob", 2), (20000, "Mary", 1),
           (25000, "Bob", 1)]
    cumulate = [(5000, "Alice", 1), (5000, "Bob", 2), (5000, "Mary", 1), (10000, "Alice", 1), (10000, "Bob", 6),
                (10000, "Mary", 2), (15000, "Bob", 1), (15000, "Mary", 1), (20000, "Bob", 2), (20000, "Mary", 1)]
    assert counts(windows.tumble(c, 10000)) == tumble
    assert counts(windows.hop(c, 10000, 5000)) == hop
    assert counts(windows.cumulate(c, 10000, 5000)) == cumulate
    assert rows(windows.sliding_counts(c, ["user_id"], 10000, 5000), "window_end", "user_id", "cnt") == hop
    assert rows(windows.cumulating_counts(c, ["user_id"], 10000, 5000), "window_end", "user_id", "cnt") == cumulate


def test_over_average(spark):
    got = rows(windows.over_average(clicks(spark), ["user_id"], "ts_ms", 3), "user_id", "ts_ms", "avg_ts_ms")
    assert [r[2] for r in got] == [2000, 3000, 3500, 4000, 4750, 6000, 7250, 9250, 11250, 1000, 3500, 6000]


def test_top_n(spark):
    counts = clicks(spark).groupBy("user_id").agg(F.count("url").alias("cnt"))
    assert rows(ranking.top_n_overall(counts, "cnt", "user_id", 2), "row_num", "user_id", "cnt") == [
        (1, "Bob", 8), (2, "Mary", 3)]
    assert rows(ranking.window_top_n(clicks(spark), "user_id", 10000, 2), "window_end", "row_num", "user_id", "cnt") == [
        (10000, 1, "Bob", 6), (10000, 2, "Mary", 2), (20000, 1, "Bob", 2), (20000, 2, "Mary", 1)]


def test_functions_in_sql(spark):
    register_functions(spark)
    c = clicks(spark)
    hashes = spark.sql("SELECT DISTINCT user_id, my_hash(user_id) AS h FROM {c}", c=c)
    assert rows(hashes, "user_id", "h") == [("Alice", 63350368), ("Bob", 66965), ("Mary", 2390779)]
    parts = spark.sql("SELECT s.word, s.length FROM {c}, LATERAL my_split(url) s WHERE ts_ms = 3000", c=c)
    assert rows(parts, "word", "length") == [("./prod", 6), ("id=100", 6)]
    avg = spark.sql("SELECT user_id, weighted_avg(sum(ts_ms * 1), sum(1)) AS a FROM {c} GROUP BY user_id", c=c)
    assert rows(avg, "user_id", "a") == [("Alice", 2000), ("Bob", 8000), ("Mary", 6000)]
    assert c.groupBy("user_id").agg(scalar.weighted_average("ts_ms", "0").alias("a")).where("a IS NULL").count() == 3


def test_hash_of_text_beyond_ascii(spark):
    def model(s):
        h, units = 0, s.encode("utf-16-le")
        for i in range(0, len(units), 2):
            h = (31 * h + units[i] + 256 * units[i + 1]) & 0xFFFFFFFF
        return h - 2**32 if h >= 2**31 else h

    texts = ["", "é", "日本語", "a😀b", "the quick brown fox jumps over the lazy dog" * 20]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(scalar.string_hash("t")).collect()] == [model(t) for t in texts]


def test_top_two_keeps_repeats(spark):
    df = spark.createDataFrame([("a", 5), ("a", 5), ("a", 3), ("b", 1)], "g string, cnt long")
    assert rows(ranking.top_two(df, ["g"], "cnt"), "g", "rank", "cnt") == [("a", 1, 5), ("a", 2, 5), ("b", 1, 1)]


def test_running_aggregates(spark):
    e = keyed(spark, EVENTS8)
    leader = rows(aggregates.running_leader(e, "user_id"), "seq", "leader", "leader_cnt")
    assert [(l, n) for _, l, n in leader] == [("Mary", 1), ("Bob", 1), ("Alice", 1), ("Bob", 2), ("Alice", 2),
                                              ("Bob", 3), ("Bob", 4), ("Bob", 5)]
    top = aggregates.running_max(e, "user_id", "ts_ms", "url")
    last = top.groupBy("user_id").agg(F.max_by("first_url", "seq").alias("u"), F.max_by("max_ts_ms", "seq").alias("m"))
    assert rows(last, "user_id", "u", "m") == [
        ("Alice", "./prod?id=100", 3200), ("Bob", "./cart", 4200), ("Mary", "./home", 1000)]
    assert rows(aggregates.max_row(e, "user_id", "ts_ms", "url"), "user_id", "url", "ts_ms") == [
        ("Alice", "./prod?id=200", 3200), ("Bob", "./prod?id=3", 4200), ("Mary", "./home", 1000)]
    tie = keyed(spark, [("a", "x", 5), ("a", "y", 5), ("a", "z", 4)])
    assert rows(aggregates.max_row(tie, "user_id", "ts_ms", "url"), "url") == [("x",)]
    assert [r[1] for r in rows(aggregates.running_max_row(tie, "user_id", "ts_ms", "url"), "seq", "top_url")] == ["x"] * 3


def test_event_text(spark):
    got = keyed(spark, [("Mary", "./home", 1000)]).select(
        scalar.event_text(F.col("user_id"), F.col("url"), F.col("ts_ms"))).first()[0]
    assert got == "Event{user='Mary', url='./home', timestamp=1970-01-01 00:00:01.0}"


def test_interval_join(spark):
    left = spark.createDataFrame([("Mary", 5000), ("Alice", 5000), ("Bob", 20000), ("Alice", 20000), ("Cary", 51000)],
                                 "user string, left_ms long")
    right = spark.createDataFrame(
        [("Bob", "./cart", 2000), ("Alice", "./prod?id=100", 3000), ("Alice", "./prod?id=200", 3500),
         ("Bob", "./prod?id=1", 2500), ("Alice", "./prod?id=200", 36000), ("Bob", "./home", 30000),
         ("Bob", "./prod?id=2", 23000), ("Bob", "./prod?id=3", 33000)], "user string, url string, right_ms long")
    got = joins.interval_join(left, right, "user", "left_ms", "right_ms", -5000, 10000)
    assert rows(got, "user", "left_ms", "right_ms") == [
        ("Alice", 5000, 3000), ("Alice", 5000, 3500), ("Bob", 20000, 23000), ("Bob", 20000, 30000)]


def _sides(spark, right_rows):
    left = spark.createDataFrame([("a", 1000), ("b", 1000), ("a", 2000), ("b", 2000), ("b", 5100)], "k string, ms long")
    right = spark.createDataFrame(right_rows, "k string, ms long")
    return left, right


def test_window_join(spark):
    left, right = _sides(spark, [("a", 3000), ("b", 4000), ("a", 4500), ("b", 5500)])
    got = joins.window_join(
        left.select("k", F.col("ms").alias("l"), F.timestamp_millis("ms").alias("left_ts")),
        right.select("k", F.col("ms").alias("r"), F.timestamp_millis("ms").alias("right_ts")), "k", 5000)
    assert rows(got, "k", "l", "r") == [("a", 1000, 3000), ("a", 1000, 4500), ("a", 2000, 3000), ("a", 2000, 4500),
                                        ("b", 1000, 4000), ("b", 2000, 4000), ("b", 5100, 5500)]


def test_window_cogroup(spark):
    left, right = _sides(spark, [("a", 3000), ("b", 4000), ("a", 4500)])
    left, right = (d.withColumn("ts", F.timestamp_millis("ms")) for d in (left, right))
    got = joins.window_cogroup(left, right, "k", 5000, "ms")
    assert rows(got, "k", "window_start", "n_left", "n_right", "first_left", "last_right") == [
        ("a", 0, 2, 2, 1000, 4500), ("b", 0, 2, 1, 1000, 4000), ("b", 5000, 1, 0, 5100, None)]
    members = joins.window_cogroup_rows(left, right, "k", 5000, "ms")
    assert rows(members.where("k = 'b'"), "window_start", "side", "ms", "n_left", "n_right") == [
        (0, "left", 1000, 2, 1), (0, "left", 2000, 2, 1), (0, "right", 4000, 2, 1), (5000, "left", 5100, 1, 0)]


def test_reconcile(spark):
    app = spark.createDataFrame([("order-1", 1000), ("order-2", 2000), ("order-3", 3500)], "id string, app_ms long")
    third = spark.createDataFrame([("order-1", 3000), ("order-3", 4000)], "id string, third_ms long")
    got = joins.reconcile(app, third, "id", app_wait_ms=5000, third_wait_ms=5000)
    assert rows(got, "id", "status") == [("order-1", "matched"), ("order-2", "third_missing"), ("order-3", "matched")]
    late = joins.reconcile(app, third, "id", app_wait_ms=1000, third_wait_ms=0)
    assert rows(late, "id", "status") == [("order-1", "app_missing"), ("order-1", "third_missing"),
                                          ("order-2", "third_missing"), ("order-3", "matched")]


def test_history_join(spark):
    a = spark.createDataFrame([("a", 1000), ("b", 2000), ("a", 3000)], "k string, l long")
    b = spark.createDataFrame([("a", 3000), ("b", 4000), ("a", 6000)], "k string, r long")
    assert rows(joins.history_pairs(a, b, "k", most_pairs=5), "k", "l", "r") == [
        ("a", 1000, 3000), ("a", 1000, 6000), ("a", 3000, 3000), ("a", 3000, 6000), ("b", 2000, 4000)]
    with pytest.raises(ValueError, match="5 pairs"):
        joins.history_pairs(a, b, "k", most_pairs=4)


def test_history_join_counts_each_pair_once(spark):
    df = spark.createDataFrame([("a", 0, 1), ("a", 1, 0), ("a", 2, 1), ("a", 3, 0), ("b", 4, 1), ("c", 5, 0), ("c", 9, 0)],
                               "k string, seq long, left long")
    for bound in (2, 100):
        out = joins.history_join(df, "k", F.col("left") == 1, rows_per_chunk=bound)
        assert [(r.seq, r.side, r.n_partners, r.newest_partner) for r in out.orderBy("seq").collect()] == [
            (0, "left", 0, None), (1, "right", 1, 0), (2, "left", 1, 1), (3, "right", 2, 2),
            (4, "left", 0, None), (5, "right", 0, None), (9, "right", 0, None)]


def test_rules(spark):
    actions = spark.createDataFrame([(0, "Alice", "login"), (1, "Alice", "pay"), (2, "Bob", "login"), (3, "Bob", "order")],
                                    "seq long, user string, action string")
    rules = spark.createDataFrame([(1, "login", "pay"), (2, "login", "order")], "no long, action1 string, action2 string")
    assert rows(joins.match_rules(actions, rules, "user"), "user", "action2") == [("Alice", "pay"), ("Bob", "order")]
    assert rows(joins.match_rules(actions, rules, "user", latest="no"), "user", "action2") == [("Bob", "order")]


def test_rule_table_above_the_bound_is_not_broadcast(spark):
    small = spark.range(5)
    assert "ResolvedHint" in joins.checked_broadcast(small, 5)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in joins.checked_broadcast(small, 4)._jdf.queryExecution().analyzed().toString()


def test_patterns_on_logins(spark):
    df = keyed(spark, LOGINS, value="kind")
    fail = F.col("kind") == "fail"
    want = [("user_1", 2000, 3000, 5000)]
    assert rows(patterns.match_consecutive(df, ["user_id"], [fail] * 3, within_ms=10000), "user_id", "t1", "t2", "t3") == want
    assert rows(patterns.match_times(df, ["user_id"], fail, 3), "user_id", "t1", "t2", "t3") == want
    assert rows(patterns.run_machine(df, ["user_id"], "kind", patterns.THREE_FAILURES), "user_id", "ts_ms", "state") == [
        ("user_1", 5000, "S2")]
    assert patterns.match_times(df, ["user_id"], fail, 3, within_ms=3000).count() == 0
    again = keyed(spark, [*LOGINS, ("user_1", "fail", 9000)], value="kind")
    assert patterns.match_times(again, ["user_id"], fail, 3).count() == 2
    assert patterns.run_machine(again, ["user_id"], "kind", patterns.THREE_FAILURES).count() == 2


def test_order_timeout(spark):
    df = keyed(spark, ORDERS, key="order_id", value="kind")
    got = patterns.match_followed_by(df, ["order_id"], F.col("kind") == "create", F.col("kind") == "pay", 15 * 60 * 1000)
    assert rows(got, "order_id", "status") == [("order_1", "matched"), ("order_2", "timeout"), ("order_3", "matched")]


def test_custom_partition(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 9)], "v long")
    placed = partitioning.custom(df, 2, F.pmod("v", F.lit(2))).withColumn("p", F.spark_partition_id())
    assert rows(placed, "p", "v") == [(0, 2), (0, 4), (0, 6), (0, 8), (1, 1), (1, 3), (1, 5), (1, 7)]


def test_total_order_partitions_do_not_overlap(spark):
    df = partitioning.total_order(spark.range(1000).select(F.xxhash64("id").alias("h")), 4, "h")
    parts = sorted(df.groupBy(F.spark_partition_id().alias("p")).agg(F.min("h"), F.max("h")).collect())
    assert len(parts) > 1 and all(a[2] < b[1] for a, b in zip(parts, parts[1:]))


def test_co_map(spark):
    ints = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    longs = spark.createDataFrame([(4,), (5,), (6,), (7,)], "v long")
    got = elementwise.co_map(ints, F.concat(F.lit("Integer: "), F.col("v").cast("string")),
                             longs, F.concat(F.lit("Long: "), F.col("v").cast("string")), "t")
    assert rows(got, "t") == [(f"Integer: {i}",) for i in (1, 2, 3)] + [(f"Long: {i}",) for i in (4, 5, 6, 7)]


def test_lateness_classes(spark):
    times = [1000, 2000, 12000, 3000, 25000, 4000, 26000, 90000, 5000]
    df = (keyed(spark, [("u", "x", t) for t in times]).withColumn("arrival", F.col("seq")))
    got = rows(lateness.classify(df, 10000, 0, 0), "seq", "ts_ms", "tag")
    assert [t for _, t, tag in got if tag == "late"] == [3000, 4000, 5000]
    kept = rows(lateness.window_firings(df, "url", 10000, 0, 0), "window_end", "firing", "cnt")
    assert kept == [(10000, 0, 2), (20000, 0, 1), (30000, 0, 2), (100000, 0, 1)]
    refired = rows(lateness.window_firings(df, "url", 10000, 0, 60000), "window_end", "firing", "cnt")
    assert refired == [(10000, 0, 2), (10000, 1, 3), (10000, 2, 4), (20000, 0, 1), (30000, 0, 2), (100000, 0, 1)]


def test_watermark_trace(spark):
    df = keyed(spark, [("u", "x", t) for t in (1000, 5000, 3000, 9000)]).withColumn("arrival", F.col("seq"))
    assert [r[1] for r in rows(lateness.watermark_trace(df, 2000), "seq", "watermark")] == [-1001, 2999, 2999, 6999]


def test_session_gap_is_inclusive(spark):
    df = keyed(spark, [("u", "x", t) for t in (0, 2000, 4001, 9000)])
    assert rows(windows.sessions(df, ["user_id"], 2000), "window_start", "window_end", "cnt") == [
        (0, 4000, 2), (4001, 6001, 1), (9000, 11000, 1)]


def test_periodic_counts(spark):
    df = keyed(spark, [("u", "x", t) for t in (0, 10, 25, 26, 60)] + [("v", "x", 55)])
    assert rows(aggregates.periodic_counts(df, "user_id", 10), "user_id", "tick_ms", "pv") == [
        ("u", 10, 2), ("u", 20, 2), ("u", 30, 4), ("u", 40, 4), ("u", 50, 4), ("u", 60, 5)]


def test_approximate_visitors_are_close(spark):
    df = spark.range(20000).select(F.timestamp_millis(F.lit(0)).alias("ts"), (F.col("id") % 5000).alias("user_id"))
    (uv,) = [r["uv"] for r in aggregates.approx_unique_visitors(df, 10000).collect()]
    assert abs(uv - 5000) < 250


def test_map_with_resource_opens_once_per_task(spark):
    df = spark.range(0, 1000, 1, 4)
    opened = elementwise.map_with_resource(
        df, "id long, token string", lambda: {"token": "t"},
        lambda res, pdf: pdf.assign(token=res["token"]), lambda res: res.clear())
    assert opened.where("token = 't'").count() == 1000


def test_kafka_shapes(spark):
    options = kafka.source_options("host:9092", "clicks", "group")
    assert options["subscribe"] == "clicks" and options["startingOffsets"] == "latest"
    wire = spark.createDataFrame([(b"k", b"v")], "key binary, value binary")
    assert rows(kafka.decode(wire), "key", "value") == [("k", "v")]


def test_with_client_opens_and_closes_per_partition(spark, tmp_path):
    folder = str(tmp_path)

    def open_client():
        import uuid
        return open(f"{folder}/{uuid.uuid4().hex}.txt", "w")

    def put(client, records):
        for r in records:
            client.write(f"{r.id}\n")

    writers.with_client(spark.range(0, 100, 1, 3), open_client, put, lambda c: c.close())
    written = sorted(int(x) for p in tmp_path.glob("*.txt") for x in p.read_text().split())
    assert written == list(range(100)) and len(list(tmp_path.glob("*.txt"))) == 3


def test_keyed_table_over_batches(spark, tmp_path):
    table = writers.KeyedTable(str(tmp_path), "k", "v", ("version",))
    schema = "k string, v string, version long"
    table.write_batch(spark.createDataFrame([("a", "1", 1), ("b", "1", 2), ("a", "2", 3)], schema), 0)
    assert rows(table.latest(spark), "k", "v") == [("a", "2"), ("b", "1")]
    table.compact(spark)
    table.write_batch(spark.createDataFrame([("b", "9", 4)], schema), 1)
    table.write_batch(spark.createDataFrame([("b", "9", 4)], schema), 1)  # the same batch again
    assert rows(table.latest(spark), "k", "v") == [("a", "2"), ("b", "9")]
    table.compact(spark)
    assert rows(table.latest(spark), "k", "v") == [("a", "2"), ("b", "9")]
