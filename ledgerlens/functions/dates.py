"""Date helpers. Text dates are parsed once, leniently (bad text -> NULL)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.codes import DATE_SENTINEL
from ledgerlens.functions.text import ColumnOrName, col, lit_or_col

ISO_DATE = "yyyy-MM-dd"


def parse_date(c: ColumnOrName, fmt: str = ISO_DATE) -> Column:
    """``TO_DATE(text, 'YYYY-MM-DD')`` that yields NULL on unparsable text.

    ``to_date`` raises under ANSI mode; ``try_to_date`` keeps a bad row
    from failing the whole job. Date/timestamp inputs are cast directly.
    """
    return F.try_to_date(col(c).cast("string"), fmt)


def parse_iso_date(text: Column) -> Column:
    """``parse_date`` of a text column, for columns where many texts are bad.

    A text of four, two and two digits is cast; the formatter, which raises inside for
    every text it cannot read, is left to longer years, the one other form it knows.
    """
    plain = F.length(text).eqNullSafe(10) & text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}")
    return F.when(plain, text.try_cast("date")).when(text.rlike("^[+-]?[0-9]{4}"), parse_date(text))


def parse_date_sentinel(c: ColumnOrName, sentinels: Sequence[str] = (DATE_SENTINEL,), fmt: str = ISO_DATE) -> Column:
    """NULL for NULL or a sentinel text such as ``'0000-00-00'``, else the parsed date."""
    c = col(c)
    return F.when(c.isNull() | c.isin(list(sentinels)), F.lit(None).cast("date")).otherwise(parse_date(c, fmt))


def is_real_date_text(c: ColumnOrName, sentinels: Sequence[str] = (DATE_SENTINEL,)) -> Column:
    """``x IS NOT NULL AND x <> '0000-00-00'`` (always true/false)."""
    c = col(c)
    return c.isNotNull() & ~c.isin(list(sentinels))


def to_date_col(c: ColumnOrName) -> Column:
    """Date from a DATE, TIMESTAMP or ISO text column."""
    return col(c).cast("date")


def month_start(c: ColumnOrName) -> Column:
    """``DATE_TRUNC('month', d)`` as a DATE."""
    return F.trunc(to_date_col(c), "MM")


def date_to_text(c: ColumnOrName, fmt: str = ISO_DATE) -> Column:
    """``TO_CHAR(d, 'YYYY-MM-DD')``."""
    return F.date_format(col(c), fmt)


def month_text(c: ColumnOrName) -> Column:
    """``TO_CHAR(DATE_TRUNC('month', d), 'YYYY-MM-DD')``."""
    return date_to_text(month_start(c))


def inclusive_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Days from start to end counting both ends; 0 when either is NULL."""
    s, e = to_date_col(start), to_date_col(end)
    return F.when(s.isNull() | e.isNull(), F.lit(0)).otherwise(F.datediff(e, s) + 1)


def day_span(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``DATE_PART('day', end - start) + 1`` — NULL when either is NULL."""
    return F.datediff(to_date_col(end), to_date_col(start)) + 1


def shift_hours(ts: ColumnOrName, hours: int) -> Column:
    """``ts - INTERVAL 'n HOURS'`` (negative ``hours`` shifts forward)."""
    return col(ts) - F.make_dt_interval(hours=F.lit(hours))


def months_ahead_start(as_of, months: int) -> Column:
    """``DATE_TRUNC('month', as_of) + 'n mons'`` as a DATE."""
    return F.add_months(F.trunc(lit_or_col(as_of).cast("date"), "MM"), months)


def year_text(as_of) -> Column:
    """``TO_CHAR(as_of, 'YYYY')``."""
    return F.date_format(lit_or_col(as_of).cast("date"), "yyyy")


def as_of_date(as_of) -> Column:
    """A run date: a literal (``'1998-06-15'`` / ``date``) or ``current_date()`` when None."""
    if as_of is None:
        return F.current_date()
    return lit_or_col(as_of).cast("date")


def in_range(point: ColumnOrName, lo: ColumnOrName, hi: ColumnOrName) -> Column:
    """``lo <= point <= hi``; any NULL bound -> NULL (no match)."""
    p = col(point)
    return (p >= col(lo)) & (p <= col(hi))


def in_exception_windows(date_col: ColumnOrName, key_col: ColumnOrName, windows, floor, text: bool = False) -> Column:
    """``(key = k1 AND d BETWEEN lo1 AND hi1) OR ... OR d >= floor``.

    ``windows`` is a short list of ``(key, lo, hi)``; it becomes one OR
    predicate (pushed to the scan as far as Parquet statistics allow).
    ``text`` compares ISO date text as it is stored, which keeps it pushable.
    """
    dc, kc = col(date_col) if text else to_date_col(date_col), col(key_col)

    def bound(x):
        return F.lit(x) if text else F.lit(x).cast("date")

    cond = dc >= bound(floor)
    for k, lo, hi in windows:
        cond = cond | ((kc == F.lit(k)) & (dc >= bound(lo)) & (dc <= bound(hi)))
    return cond
