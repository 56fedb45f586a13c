"""Driver query catalogue: one registered query per operator key, each with its
DuckDB oracle SQL. Importing this package registers every key."""

from ledgerlens.plans.catalog import aggregates, expressions, filters, joins, pricing, reconcile, views  # noqa: F401
from ledgerlens.plans.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
