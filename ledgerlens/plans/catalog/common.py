"""Shared helpers of the driver catalogue.

Output conventions (the oracle compare hashes values, so both sides must
render them the same way): dates are ISO text, ids that can be NULL after an
outer join are text, money is a double rounded to 2 places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.text import ColumnOrName, col
from ledgerlens.sources.tables import read_table

# FIXED run date of the catalogue (keeps results reproducible; never CURRENT_DATE).
AS_OF = "1998-06-15"


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def d(c: ColumnOrName) -> Column:
    """DATE of a timestamp column."""
    return col(c).cast("date")


def dtext(c: ColumnOrName) -> Column:
    """ISO text of a date/timestamp column."""
    return F.date_format(col(c), "yyyy-MM-dd")


def idtext(c: ColumnOrName) -> Column:
    return col(c).cast("string")


def money(c: ColumnOrName, places: int = 2) -> Column:
    return F.round(col(c).cast("double"), places)
