"""Functions callable by name from SQL text.

They are SQL-bodied temporary functions, so Catalyst inlines them and no row leaves the
JVM.  An aggregate cannot be a SQL-bodied function; ``weighted_avg`` therefore takes the
two sums: ``weighted_avg(sum(v * w), sum(w))``, which keeps map-side partial sums.  Both are
decimals, since the products of a busy key do not fit a BIGINT: cast ``v`` where it is large.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from eventloom.functions.scalar import string_hash_sql

_SPLIT_SQL = """
SELECT p AS word, length(p) AS length
FROM (SELECT explode(CASE WHEN length(txt) > 0 AND length(rtrim('?', txt)) = 0
                          THEN cast(array() AS ARRAY<STRING>)
                          ELSE split(rtrim('?', txt), '\\\\?') END) AS p)
"""


def register_functions(spark: SparkSession) -> None:
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION my_hash(txt STRING) RETURNS INT "
              "RETURN " + string_hash_sql("txt"))
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION my_split(txt STRING) "
              "RETURNS TABLE(word STRING, length INT) RETURN " + _SPLIT_SQL)
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION weighted_avg(vw DECIMAL(38, 0), w DECIMAL(38, 0)) "
              "RETURNS BIGINT RETURN vw div nullif(w, 0)")
