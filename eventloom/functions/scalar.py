"""Column functions: text splitting, hashing, rendering and integer averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_drop_empty_tail(text: Column, separator: str, pattern: str) -> Column:
    """Split on a one-character separator; empty strings at the end are dropped.

    An empty text gives one empty string, a text of separators alone gives none.
    ``pattern`` is the separator as a regular expression.
    """
    body = F.rtrim(text, F.lit(separator))
    return (F.when((F.length(text) > 0) & (F.length(body) == 0), F.array().cast("array<string>"))
            .otherwise(F.split(body, pattern)))


def words(text: Column) -> Column:
    return split_drop_empty_tail(text, " ", " ")


def url_parts(url: Column) -> Column:
    return split_drop_empty_tail(url, "?", "\\?")


def lines(text: Column) -> Column:
    return F.split(text, "\n")


# The 32-bit string hash h = 31*h + c over UTF-16 code units.  Code points above the basic
# plane count as two units.  `%1$s` is the text expression.
_HASH_SQL = """
cast(aggregate(
  flatten(transform(filter(split(%s, ''), c -> c <> ''), c ->
    CASE WHEN ascii(c) < 65536 THEN array(ascii(c))
         ELSE array(55296 + (ascii(c) - 65536) div 1024, 56320 + (ascii(c) - 65536) %% 1024) END)),
  0L,
  (h, u) -> pmod(h * 31 + u + 2147483648L, 4294967296L) - 2147483648L) AS INT)
"""


def string_hash_sql(text_sql: str) -> str:
    return _HASH_SQL % text_sql


def string_hash(text_sql: str) -> Column:
    return F.expr(string_hash_sql(text_sql))


def timestamp_text(ms: Column) -> Column:
    """Epoch ms as ``yyyy-MM-dd HH:mm:ss.f``: fraction digits without trailing zeros, at least one."""
    text = F.date_format(F.timestamp_millis(ms), "yyyy-MM-dd HH:mm:ss.SSS")
    return F.regexp_replace(text, "(\\.\\d+?)0+$", "$1")


def event_text(user: Column, url: Column, ms: Column) -> Column:
    return F.concat(F.lit("Event{user='"), user, F.lit("', url='"), url,
                    F.lit("', timestamp="), timestamp_text(ms), F.lit("}"))


def uv_text(start_ms: Column, end_ms: Column, uv: Column) -> Column:
    return F.concat(timestamp_text(start_ms), F.lit("~"), timestamp_text(end_ms),
                    F.lit(" UV: "), uv.cast("string"))


def integer_average(value_sql: str) -> Column:
    """Average of an integer column, cut to an integer.

    Sums are decimals: epoch milliseconds of a busy key do not fit a BIGINT.
    """
    return F.expr(f"sum(cast({value_sql} AS DECIMAL(20, 0))) div count({value_sql})")


def weighted_average(value_sql: str, weight_sql: str) -> Column:
    """Integer weighted average; NULL when the weights sum to 0."""
    value, weight = (f"cast({x} AS DECIMAL(20, 0))" for x in (value_sql, weight_sql))
    return F.expr(f"sum({value} * {weight}) div nullif(sum({weight}), 0)")
