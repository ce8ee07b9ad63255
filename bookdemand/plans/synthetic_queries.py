"""Synthetic bookings keyed by the warehouse's own keys (GEN-1 … GEN-5).

The row indexes are the customer keys (rooms) and order keys (requests), so
the generated volume follows the tables.  The draws hash text with MD5, so
the oracle computes the same rows in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookdemand import schemas as S
from bookdemand.operators.quality import booking_quality_report
from bookdemand.plans.registry import register
from bookdemand.sources.synthetic import (
    CAPACITIES, DAYS, DEFAULT_NAMESPACE, DURATIONS_MIN, FIRST_DAY, MAX_UPDATE_MIN, REASONS, REQUEST_STATE_WEIGHTS, REQUESTERS,
    ROOMS_PER_FLOOR, SUBJECTS, TEACHERS, synthetic_requests, synthetic_rooms,
)
from bookdemand.sources.tables import read_table

SEED = 1009


def _generated(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rooms = synthetic_rooms(read_table(spark, sf_dir, "customer"), "c_custkey", seed=SEED)
    requests = synthetic_requests(read_table(spark, sf_dir, "orders"), "o_orderkey", rooms, seed=SEED)
    return rooms, requests


def _uuid5_sql(name_sql: str) -> str:
    """DuckDB form of ``functions.uuid5`` under the generator's namespace."""
    h = f"sha1(unhex('{DEFAULT_NAMESPACE.hex}') || encode({name_sql}))"
    variant = f"substr('89ab', (strpos('0123456789abcdef', substr({h}, 17, 1)) - 1) % 4 + 1, 1)"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' "
            f"|| {variant} || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)")


def _draw(field: str, low, high, row: str = "i") -> str:
    """DuckDB form of ``uniform_int``."""
    h = f"CAST(('0x' || substr(md5('{SEED}:{field}:' || CAST({row} AS VARCHAR)), 1, 15)) AS BIGINT)"
    return f"CAST({low} + {h} % CAST({high} - {low} + 1 AS BIGINT) AS INTEGER)"


def _one_of(field: str, values: list, row: str = "i") -> str:
    return f"list_extract({values!r}, {_draw(field, 1, len(values), row)})"


def _weighted(field: str, values: list, weights: list, row: str) -> str:
    """DuckDB form of ``weighted_choice``."""
    draw = _draw(field, 0, sum(weights) - 1, row)
    return "CASE " + " ".join(f"WHEN {draw} < {sum(weights[:k + 1])} THEN '{v}'" for k, v in enumerate(values)) + " END"


def _named(entity: str, number: str) -> str:
    return _uuid5_sql(f"'{entity}:' || CAST({number} AS VARCHAR)")


def _clock(minutes: str) -> str:
    return f"printf('%02d:%02d:00', CAST({minutes} AS INTEGER) // 60, CAST({minutes} AS INTEGER) % 60)"


_BOOKINGS_CTE = f"""m AS (SELECT CAST(c_custkey AS BIGINT) AS i, {_one_of('capacity', CAPACITIES)} AS capacity FROM customer),
drawn AS (
  SELECT CAST(o_orderkey AS BIGINT) AS i FROM orders
), placed AS (
  SELECT i, {_draw('room', 0, '(SELECT count(*) - 1 FROM customer)')} AS room_index, DATE '{FIRST_DAY}' + {_draw('day', 0, DAYS - 1)} AS booking_date,
         420 + {_draw('start', 0, 24)} * 30 AS start_min, {_one_of('duration', DURATIONS_MIN)} AS duration,
         {_draw('lead_days', 1, 90)} * 1440 + {_draw('lead_hours', 0, 23)} * 60 + {_draw('lead_minutes', 0, 59)} AS lead
  FROM drawn
), synthetic AS (
  SELECT {_named('request', 'p.i')} AS request_id, {_named('requester', _draw('requester', 0, REQUESTERS - 1, 'p.i'))} AS requester_id,
         {_named('teacher', _draw('teacher', 0, TEACHERS - 1, 'p.i'))} AS teacher_id, {_named('room', 'm.i')} AS room_id,
         {_named('subject', _draw('subject', 0, SUBJECTS - 1, 'p.i'))} AS subject_id,
         {_named('term', '(year(booking_date) - 2024) * 2 + CASE WHEN month(booking_date) > 6 THEN 1 ELSE 0 END')} AS term_id,
         booking_date, {_clock('start_min')} AS start_time, {_clock('start_min + duration')} AS end_time,
         {_draw('attendees', 5, 'm.capacity', 'p.i')} AS attendees, {_one_of('reason', REASONS, 'p.i')} AS reason,
         {_weighted('status', S.REQUEST_STATES, REQUEST_STATE_WEIGHTS, 'p.i')} AS status,
         CAST(booking_date AS TIMESTAMP) + to_minutes(CAST(start_min - lead AS BIGINT)) AS created_at,
         CAST(booking_date AS TIMESTAMP) + to_minutes(CAST(start_min - lead + {_draw('update', 0, f'least(lead, {MAX_UPDATE_MIN})', 'p.i')} AS BIGINT)) AS updated_at
  FROM placed p JOIN m ON p.room_index = m.i
)"""


@register("synthetic_bookings", f"WITH {_BOOKINGS_CTE} SELECT * FROM synthetic")
def synthetic_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEN-2: one synthetic request per order, rooms one per customer."""
    return _generated(spark, sf_dir)[1]


# The generator breaks no rule: every violation is a plain zero, and the rows
# checked are those of the tables that the keys come from.
_CHECKED = {
    "requests.columns": str(len(S.REQUEST_COLUMNS)), "rooms.columns": str(len(S.ROOM_COLUMNS)),
    **{f"rooms.{r}": "(SELECT count(*) FROM customer)" for r in ("required_values", "unique_id", "unique_code", "positive_capacity", "row_count")},
    **{f"requests.{r}": "(SELECT count(*) FROM synthetic)" for r in
       ("required_values", "unique_id", "room_exists", "end_after_start", "positive_attendees", "within_capacity", "row_count")},
}


@register("synthetic_quality", f"WITH {_BOOKINGS_CTE} " + " UNION ALL ".join(
    f"SELECT '{rule}' AS rule, CAST({n} AS BIGINT) AS checked, CAST(0 AS BIGINT) AS violations, CAST(NULL AS VARCHAR) AS sample"
    for rule, n in _CHECKED.items()))
def synthetic_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GEN acceptance: the DQ report over the generated tables (all zero)."""
    rooms, requests = _generated(spark, sf_dir)
    n_rooms = read_table(spark, sf_dir, "customer").count()
    return booking_quality_report(
        requests, rooms.drop("room_index"), expected_requests=requests.count(), expected_rooms=n_rooms,
        request_columns=S.REQUEST_COLUMNS, room_columns=S.ROOM_COLUMNS)


@register("uuid5_keys", f"""SELECT c_custkey AS room_index,
  {_uuid5_sql("'room:' || CAST(c_custkey AS VARCHAR)")} AS {S.ROOM_ID},
  {_uuid5_sql(f"'floor:' || CAST(c_custkey // {ROOMS_PER_FLOOR} + 1 AS VARCHAR)")} AS {S.FLOOR_ID},
  printf('LAB-%03d', c_custkey + 1) AS {S.CODE}
FROM customer""")
def uuid5_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SF-13 / SF-14: the generator's deterministic room identifiers (UUIDv5
    of ``room:<key>`` and ``floor:<key // 10 + 1>``, zero-padded code) for
    every customer key.  Pure column expressions, fused into the scan."""
    rooms = synthetic_rooms(read_table(spark, sf_dir, "customer"), "c_custkey", seed=SEED)
    return rooms.select(F.col("room_index"), S.ROOM_ID, S.FLOOR_ID, S.CODE)
