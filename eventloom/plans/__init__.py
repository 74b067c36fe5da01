"""The registered queries."""

from eventloom.plans import groups, pairs, rows  # noqa: F401  (registers the queries)
from eventloom.plans import outputs, streams  # noqa: F401  (reuse the SQL of the batch queries)
from eventloom.plans import evolving  # noqa: F401
from eventloom.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
