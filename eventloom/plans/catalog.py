"""Registry of named queries: a Spark plan and, where SQL can say it, the same in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Parameters of the registered queries, in ms.
SECOND = 1_000
MINUTE = 60 * SECOND
HOUR = 60 * MINUTE
DAY = 24 * HOUR

# The click view in the SQL dialect of the check tool.
CLICKS_SQL = """clicks AS (
  SELECT event_id AS seq, user_id, event_type AS url, epoch_us(ts) // 1000 AS ts_ms, value FROM events)"""


def query(name: str, sql: str | None = None, ctes: str = CLICKS_SQL) -> Callable[[Query], Query]:
    """Register a plan; ``sql`` may use the ``clicks`` view."""
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = f"WITH {ctes}\n{sql}" if ctes else sql
        return fn
    return register
