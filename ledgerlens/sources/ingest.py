"""Reject counts of leniently parsed date text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.codes import DATE_SENTINEL
from ledgerlens.functions.dates import parse_date


def date_rejects(df: DataFrame, date_cols: Sequence[str]) -> DataFrame:
    """Per column: rows whose date text is present, not the sentinel, and does not parse.

    One aggregate pass (partial aggregation per task), one output row per column.
    """
    aggs = []
    for c in date_cols:
        t = F.trim(F.col(c).cast("string"))
        bad = t.isNotNull() & (t != "") & (t != DATE_SENTINEL) & parse_date(t).isNull()
        aggs.append(F.sum(F.when(bad, 1).otherwise(0)).cast("long").alias(c))
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{c}', `{c}`" for c in date_cols)
    return wide.selectExpr(f"stack({len(date_cols)}, {stack}) as (column, rejected_rows)")
