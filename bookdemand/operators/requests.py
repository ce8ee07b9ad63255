"""The booking transformations T1, T2, T4, T5 (T3 lives in ``join``).

All four are lazy: they declare a plan and run nothing.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from bookdemand import schemas as S
from bookdemand.functions.dates import days_between, is_weekend, utc_day
from bookdemand.functions.scoring import flag_bonus, tiered_bonus
from bookdemand.functions._col import ident
from bookdemand.functions.timeofday import minutes_between, minutes_between_sql

# Columns T1 and T5 project, in output order.
REQUEST_VIEW = [
    S.REQUEST_ID, S.ROOM_ID, S.BOOKING_DATE, S.START_TIME, S.END_TIME, S.ATTENDEES, S.STATUS,
]

# Fixed values of the priority formula: occupancy tiers (percent of capacity,
# points) from the top, short-lead threshold and the three flat bonuses.
OCCUPANCY_TIERS = ((90, 1000), (75, 500))
SHORT_LEAD_DAYS = 7
SHORT_LEAD_POINTS = 300
WEEKEND_POINTS = 200
APPROVED_POINTS = 100


def _as_date(c: str) -> Column:
    return F.col(c).cast("date")


def _sql_text(value: str) -> str:
    """``value`` as a SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _day_of(bound: str | date) -> date:
    """A window bound as a date; ``2024-7-1`` is read as ``2024-07-01``, and a
    text that names no day is an error."""
    if isinstance(bound, date):
        return date(bound.year, bound.month, bound.day)
    try:
        year, month, day = (int(part) for part in str(bound).strip().split("-"))
        return date(year, month, day)
    except ValueError:
        raise ValueError(f"not a calendar day: {bound!r}") from None


def filter_requests(
    requests: DataFrame,
    *,
    approved: str = S.APPROVED,
    min_attendees: int = S.MIN_ATTENDEES,
    start: str | date = S.WINDOW_START,
    end: str | date = S.WINDOW_END,
) -> DataFrame:
    """T1: approved requests with at least ``min_attendees`` booked on a day in
    ``[start, end]`` (both inclusive, date semantics), projected to 7 columns.

    The predicate is a plain conjunction on stored columns so Catalyst pushes
    it into the parquet scan (row-group skipping on date and status).
    """
    S.require_columns(requests, REQUEST_VIEW, "filter_requests")
    first, last = _day_of(start), _day_of(end)
    condition = (
        f"{ident(S.STATUS)} = {_sql_text(approved)} AND {ident(S.ATTENDEES)} >= {int(min_attendees)}"
        f" AND CAST({ident(S.BOOKING_DATE)} AS DATE)"
        f" BETWEEN DATE '{first:%Y-%m-%d}' AND DATE '{last:%Y-%m-%d}'"
    )
    if S.BOOKING_MONTH in requests.columns:
        # Landing zone partitioned by month: the implied month range prunes
        # whole directories before any file is listed or opened.
        condition += f" AND {ident(S.BOOKING_MONTH)} BETWEEN '{first:%Y-%m}' AND '{last:%Y-%m}'"
    # one SQL expression: a single round trip to the JVM to build the predicate
    return requests.filter(F.expr(condition)).select(*REQUEST_VIEW)


def demand_by_room(
    requests: DataFrame,
    *,
    key: str = S.ROOM_ID,
    id_col: str = S.REQUEST_ID,
    value_col: str = S.ATTENDEES,
    ordered: bool = True,
) -> DataFrame:
    """T2: per key, count of non-null ids, mean and max of ``value_col``.

    Partial aggregation runs before the shuffle, so each map task ships one
    row per key it saw: a key holding a third of all rows costs no more than
    any other.  ``ordered`` adds the by-key sort of the result (a range
    exchange over one row per key).
    """
    S.require_columns(requests, (key, id_col, value_col), "demand_by_room")
    out = requests.groupBy(key).agg(
        F.count(id_col).alias(S.REQUEST_COUNT),
        F.avg(value_col).alias(S.AVG_ATTENDEES),
        F.max(value_col).alias(S.MAX_ATTENDEES),
    )
    return out.orderBy(F.col(key).asc()) if ordered else out


def priority_score_sql(approved: str = S.APPROVED, *, created_is_text: bool = False) -> str:
    """T4's score as one SQL expression over a joined request row.

    A creation instant kept as text is read as an instant first, so that an
    offset in it counts and the day is the UTC day (X3)."""
    a, cap, st = ident(S.ATTENDEES), ident(S.CAPACITY), ident(S.STATUS)
    day = f"CAST({ident(S.BOOKING_DATE)} AS DATE)"
    tiers = " ".join(
        f"WHEN CAST({a} AS BIGINT) * 100 >= CAST({cap} AS BIGINT) * {pct} THEN {pts}" for pct, pts in OCCUPANCY_TIERS
    )
    created = f"CAST({ident(S.CREATED_AT)} AS TIMESTAMP)" if created_is_text else ident(S.CREATED_AT)
    return (
        f"CAST(CAST({a} AS BIGINT) * {minutes_between_sql(S.START_TIME, S.END_TIME)}"
        f" + CASE {tiers} ELSE 0 END"
        f" + CASE WHEN datediff({day}, to_date({created})) <= {SHORT_LEAD_DAYS}"
        f" THEN {SHORT_LEAD_POINTS} ELSE 0 END"
        f" + CASE WHEN dayofweek({day}) IN (1, 7) THEN {WEEKEND_POINTS} ELSE 0 END"
        f" + CASE WHEN {st} = {_sql_text(approved)} THEN {APPROVED_POINTS} ELSE 0 END AS BIGINT)"
    )


def priority_score_column(approved: str = S.APPROVED) -> Column:
    """T4's score expression over a joined request row (64-bit integer).

    Built from the Column helpers; equal to ``priority_score_sql``."""
    duration = minutes_between(F.col(S.START_TIME), F.col(S.END_TIME))
    day = _as_date(S.BOOKING_DATE)
    lead_days = days_between(day, utc_day(S.CREATED_AT))
    return (
        F.col(S.ATTENDEES).cast("long") * duration
        + tiered_bonus(S.ATTENDEES, S.CAPACITY, OCCUPANCY_TIERS)
        + flag_bonus(lead_days <= F.lit(SHORT_LEAD_DAYS), SHORT_LEAD_POINTS)
        + flag_bonus(is_weekend(day), WEEKEND_POINTS)
        + flag_bonus(F.col(S.STATUS) == F.lit(approved), APPROVED_POINTS)
    ).cast("long")


def priority_score(joined: DataFrame, *, approved: str = S.APPROVED) -> DataFrame:
    """T4: add ``priority_score`` to T3's output (narrow, one projection).

    The status tested is the request's; the room's own state was renamed by
    T3.  A null attendee count or duration makes the score null; a null in a
    bonus condition scores that bonus 0.
    """
    S.require_columns(
        joined,
        (S.ATTENDEES, S.CAPACITY, S.START_TIME, S.END_TIME, S.BOOKING_DATE, S.CREATED_AT, S.STATUS),
        "priority_score",
    )
    as_text = isinstance(joined.schema[S.CREATED_AT].dataType, StringType)
    return joined.withColumn(S.PRIORITY_SCORE, F.expr(priority_score_sql(approved, created_is_text=as_text)))


def top_demand(requests: DataFrame, n: int = S.TOP_N) -> DataFrame:
    """T5: the ``n`` largest requests by attendees ↓, duration ↓, day ↑, id ↑.

    The id makes the order total.  ``orderBy().limit(n)`` plans as
    ``TakeOrderedAndProject``: every task keeps its own top ``n`` and only
    those reach the final merge — no global sort, no skew exposure.
    """
    S.require_columns(requests, REQUEST_VIEW, "top_demand")
    if n <= 0:
        raise ValueError("top_demand needs n > 0")
    return (
        requests.select(*REQUEST_VIEW)
        .withColumn(S.BOOKING_DATE, _as_date(S.BOOKING_DATE))
        .withColumn(S.DURATION_MIN, minutes_between(S.START_TIME, S.END_TIME))
        .orderBy(
            F.col(S.ATTENDEES).desc(),
            F.col(S.DURATION_MIN).desc(),
            F.col(S.BOOKING_DATE).asc(),
            F.col(S.REQUEST_ID).asc(),
        )
        .limit(n)
    )
