"""Small inputs with known answers."""

from pyspark.sql import functions as F

# The demo inputs.
WORDS = ["hello world", "hello stream", "hello java"]
CLICKS = [
    ("Mary", "./home", 1000), ("Alice", "./cart", 2000), ("Bob", "./prod?id=100", 3000),
    ("Bob", "./cart", 4000), ("Bob", "./home", 5000), ("Mary", "./home", 6000),
    ("Bob", "./cart", 7000), ("Bob", "./home", 8000), ("Bob", "./prod?id=10", 9000),
    ("Mary", "./home", 11000), ("Bob", "./cart", 13000), ("Bob", "./cart", 15000)]
EVENTS8 = [
    ("Mary", "./home", 1000), ("Bob", "./cart", 2000), ("Alice", "./prod?id=100", 3000),
    ("Bob", "./prod?id=1", 3300), ("Alice", "./prod?id=200", 3200), ("Bob", "./home", 3500),
    ("Bob", "./prod?id=2", 3800), ("Bob", "./prod?id=3", 4200)]
LOGINS = [
    ("user_1", "fail", 2000), ("user_1", "fail", 3000), ("user_2", "fail", 4000), ("user_1", "fail", 5000),
    ("user_2", "success", 6000), ("user_2", "fail", 7000), ("user_2", "fail", 8000)]
ORDERS = [
    ("order_1", "create", 1000), ("order_2", "create", 2000), ("order_1", "modify", 10000),
    ("order_1", "pay", 60000), ("order_3", "create", 600000), ("order_3", "pay", 1200000)]
SHIFT = 1704067200000  # 2024-01-01, a multiple of all window sizes used


def keyed(spark, rows, key="user_id", value="url", shift=0):
    """(seq, key, value, ts_ms, ts) in the order given."""
    data = [(i, k, v, t + shift) for i, (k, v, t) in enumerate(rows)]
    return (spark.createDataFrame(data, f"seq long, {key} string, {value} string, ts_ms long")
            .withColumn("ts", F.timestamp_millis("ts_ms")))


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=lambda r: tuple((v is None, v) for v in r))
