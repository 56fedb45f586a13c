"""DataFrame -> DataFrame operators. No Python UDFs; no actions but the key counts of a range join."""

from ledgerlens.operators.aggregate import max_or_zero, pivot_by_key, sum_of_sums
from ledgerlens.operators.lookup import (fallback_lookup, fanout_audit, lookup_join, semi_filter,
                                         text_dim, text_lookup)
from ledgerlens.operators.ranges import interval_join, range_condition, reconcile_full
from ledgerlens.operators.ranking import dedupe_keep_null, desc_nulls_first, latest_per_key, surrogate_id
from ledgerlens.operators.sides import coalesce_sides, prefer

__all__ = [
    "pivot_by_key", "sum_of_sums", "max_or_zero",
    "lookup_join", "text_lookup", "fallback_lookup", "fanout_audit", "semi_filter", "text_dim",
    "interval_join", "reconcile_full", "range_condition",
    "latest_per_key", "dedupe_keep_null", "surrogate_id", "desc_nulls_first",
    "coalesce_sides", "prefer",
]
