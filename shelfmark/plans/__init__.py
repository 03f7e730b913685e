"""All registered queries."""

from shelfmark.plans import pages, records, streams  # noqa: F401  (registers the queries)
from shelfmark.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
