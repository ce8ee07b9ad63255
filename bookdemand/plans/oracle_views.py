"""The same request / room mapping as ``sources.tables``, written as SQL CTEs
for an independent engine (DuckDB) to check the Spark results against."""

# start minute of the slot, duration and time-of-day text, as SQL fragments
_START = "(420 + (o_orderkey % 25) * 30)"
_DUR = "([60, 90, 120, 180][(o_orderkey % 4) + 1])"


def _hhmm(minutes: str) -> str:
    return f"printf('%02d:%02d:00', ({minutes}) // 60, ({minutes}) % 60)"


REQUESTS_CTE = f"""requests AS (
  SELECT o_orderkey AS request_id,
         o_custkey AS room_id,
         CAST(o_orderdate AS DATE) AS booking_date,
         {_hhmm(_START)} AS start_time,
         {_hhmm(_START + ' + ' + _DUR)} AS end_time,
         CAST(5 + o_orderkey % 41 AS INTEGER) AS attendees,
         o_orderstatus AS status,
         CAST(CAST(o_orderdate AS DATE) - CAST(1 + (o_orderkey * 7) % 30 AS INTEGER) AS TIMESTAMP)
           + to_hours(CAST(o_orderkey % 24 AS BIGINT)) AS created_at
  FROM orders)"""

ROOMS_CTE = """rooms AS (
  SELECT c_custkey AS room_id,
         printf('ROOM-%06d', c_custkey) AS code,
         c_name AS name,
         CAST(20 + c_custkey % 26 AS INTEGER) AS capacity,
         c_mktsegment AS state,
         c_acctbal >= 0 AS active
  FROM customer)"""


def secs(col: str) -> str:
    return (
        f"(CAST(split_part({col}, ':', 1) AS INTEGER) * 3600"
        f" + CAST(split_part({col}, ':', 2) AS INTEGER) * 60"
        f" + CAST(split_part({col}, ':', 3) AS INTEGER))"
    )


def minutes_between(start: str, end: str) -> str:
    return f"CAST(floor(({secs(end)} - {secs(start)}) / 60.0) AS BIGINT)"


JOINED_CTE = """joined AS (
  SELECT r.request_id, r.room_id, r.booking_date, r.start_time, r.end_time, r.attendees,
         r.status, r.created_at,
         m.code AS room_code, m.name AS room_name, m.capacity, m.state AS room_state,
         m.active AS room_active
  FROM requests r JOIN rooms m ON r.room_id = m.room_id)"""


def score_sql(approved: str) -> str:
    return f"""CAST(CAST(attendees AS BIGINT) * {minutes_between('start_time', 'end_time')}
    + CASE WHEN CAST(attendees AS BIGINT) * 100 >= CAST(capacity AS BIGINT) * 90 THEN 1000
           WHEN CAST(attendees AS BIGINT) * 100 >= CAST(capacity AS BIGINT) * 75 THEN 500 ELSE 0 END
    + CASE WHEN date_diff('day', CAST(created_at AS DATE), booking_date) <= 7 THEN 300 ELSE 0 END
    + CASE WHEN dayofweek(booking_date) IN (0, 6) THEN 200 ELSE 0 END
    + CASE WHEN status = '{approved}' THEN 100 ELSE 0 END AS BIGINT)"""
