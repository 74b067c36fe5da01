"""Integer averages of more rows than a BIGINT sum of epoch milliseconds can hold."""

from pyspark.sql import functions as F

from eventloom.functions import scalar
from eventloom.operators import elementwise


def test_averages_do_not_overflow(spark):
    df = spark.range(10_000_000).select((F.col("id") % 2 + 1_704_067_200_000).alias("ts"), F.lit(50).alias("w"))
    row = df.agg(scalar.integer_average("ts").alias("a"), scalar.weighted_average("ts", "w").alias("b")).first()
    assert (row.a, row.b) == (1_704_067_200_000, 1_704_067_200_000)
    low = spark.sql("SELECT * FROM VALUES (-3L), (-4L) t(v)").agg(scalar.integer_average("v")).first()[0]
    assert low == -3


def test_delimiters_are_plain_text(spark):
    df = spark.createDataFrame([("a|b|7",), ("c.d|e|x",)], "line string")
    rows = elementwise.parse_lines(df, "line", "|", ("u", "v", "n")).select("u", "v", "n").collect()
    assert [tuple(r) for r in rows] == [("a", "b", 7), ("c.d", "e", None)]
