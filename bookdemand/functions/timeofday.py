"""Times of day carried as ``HH:MM:SS`` text (SF-1, SF-2, SF-17).

Spark 4.1 keeps its TIME type behind a flag, so a time of day travels as text
and is turned into seconds with integer arithmetic.  Under ANSI a malformed
text raises instead of yielding null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bookdemand.functions._col import as_col, ident


TIME_OF_DAY = "^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]"


def _valid_sql(t: str) -> str:
    """Eight characters: two digits each for an hour below 24, a minute and a second below 60."""
    return f"length({t}) = 8 AND {t} RLIKE '{TIME_OF_DAY}'"


def _seconds_sql(t: str, otherwise: str | None = None) -> str:
    return (
        f"CASE WHEN {t} IS NULL THEN CAST(NULL AS INT) "
        f"WHEN {_valid_sql(t)} "
        f"THEN CAST(substring({t}, 1, 2) AS INT) * 3600 + CAST(substring({t}, 4, 2) AS INT) * 60 "
        f"+ CAST(substring({t}, 7, 2) AS INT) "
        f"ELSE {otherwise or f"raise_error(concat('not an HH:MM:SS time of day: ', {t}))"} END"
    )


def seconds_of_day(c: str | Column) -> Column:
    """``'HH:MM:SS'`` → seconds after midnight (int); null stays null.

    Fixed-width substrings and int casts (cheap, codegen'd); a text that is
    not two digits each for an hour below 24, a minute and a second below 60
    raises.  A column name is compiled as one SQL expression.
    """
    if isinstance(c, str):
        return F.expr(_seconds_sql(ident(c)))
    t = c
    valid = (F.length(t) == 8) & t.rlike(TIME_OF_DAY)
    value = (
        F.substring(t, 1, 2).cast("int") * 3600
        + F.substring(t, 4, 2).cast("int") * 60
        + F.substring(t, 7, 2).cast("int")
    )
    return F.when(t.isNull(), F.lit(None).cast("int")).when(valid, value).otherwise(
        F.raise_error(F.concat(F.lit("not an HH:MM:SS time of day: "), t))
    )


def try_seconds_of_day(c: str) -> Column:
    """``seconds_of_day`` of column ``c`` with null instead of an error for a
    text that is no time of day (for rules that count such rows)."""
    return F.expr(_seconds_sql(ident(c), otherwise="CAST(NULL AS INT)"))


def seconds_by_pattern(c: str | Column, pattern: str = "HH:mm:ss") -> Column:
    """SF-2: a time of day by a date-time pattern (``H:mm``, ``HHmmss``, …) →
    seconds after midnight; a text that does not fit the pattern raises."""
    at = F.to_timestamp(as_col(c), pattern)
    return (F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)).cast("int")


def minutes_between_sql(start: str, end: str) -> str:
    """SQL text of :func:`minutes_between` over two column names."""
    return f"CAST(floor(({_seconds_sql(ident(end))} - {_seconds_sql(ident(start))}) / 60) AS BIGINT)"


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Whole minutes from ``start`` to ``end``, floored, as long.

    Floor (not truncation) keeps the result right for negative spans too.
    """
    if isinstance(start, str) and isinstance(end, str):
        return F.expr(minutes_between_sql(start, end))
    span = seconds_of_day(end) - seconds_of_day(start)
    return F.floor(span / F.lit(60)).cast("long")


def time_text(minutes: str | Column) -> Column:
    """Minutes after midnight → ``'HH:MM:00'``."""
    m = as_col(minutes)
    hours = F.lpad(F.floor(m / 60).cast("string"), 2, "0")
    mins = F.lpad(F.pmod(m, F.lit(60)).cast("string"), 2, "0")
    return F.concat(hours, F.lit(":"), mins, F.lit(":00"))
