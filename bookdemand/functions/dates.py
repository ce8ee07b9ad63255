"""Calendar helpers (SF-3..SF-5, SF-8, SF-9, SF-16).

The session zone is pinned to UTC (``bookdemand.session``), so a calendar day
of an instant is its UTC day whatever offset the text carried.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from bookdemand.functions._col import as_col


def utc_day(c: str | Column, source_type: DataType | None = None) -> Column:
    """Day of an instant.  Text goes through ``to_timestamp`` first so an
    offset such as ``-05:00`` moves the day the way the instant says (X3)."""
    col = as_col(c)
    if isinstance(source_type, StringType):
        return F.to_date(F.to_timestamp(col))
    return F.to_date(col)


def days_between(later: str | Column, earlier: str | Column) -> Column:
    """Whole days ``later - earlier`` (negative when ``earlier`` is later)."""
    return F.datediff(as_col(later), as_col(earlier))


def is_weekend(day: str | Column) -> Column:
    """Saturday or Sunday.  Spark numbers Sunday=1 … Saturday=7."""
    return F.dayofweek(as_col(day)).isin(1, 7)


def half_year_index(day: str | Column, base_year: int) -> Column:
    """``(year - base_year) * 2 + (month > 6)``: academic half-year counter."""
    d = as_col(day)
    return (F.year(d) - F.lit(base_year)) * 2 + F.when(F.month(d) > 6, 1).otherwise(0)


def iso_date(day: str | Column) -> Column:
    """``YYYY-MM-DD`` text of a date (SF-17)."""
    return F.date_format(as_col(day), "yyyy-MM-dd")


def iso_instant(ts: str | Column) -> Column:
    """ISO 8601 text of an instant in UTC with an explicit ``+00:00`` offset
    (SF-17); the session zone is pinned to UTC."""
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:mm:ssxxx")
