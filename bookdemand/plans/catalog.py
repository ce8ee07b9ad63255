"""All registered queries.  Importing this module registers every query
module; ``QUERIES`` / ``ORACLE_SQL`` are then complete."""

from bookdemand.plans import booking_queries  # noqa: F401
from bookdemand.plans import stats_queries  # noqa: F401
from bookdemand.plans import quality_queries  # noqa: F401
from bookdemand.plans import store_queries  # noqa: F401
from bookdemand.plans import stream_queries  # noqa: F401
from bookdemand.plans import synthetic_queries  # noqa: F401
from bookdemand.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["QUERIES", "ORACLE_SQL"]
