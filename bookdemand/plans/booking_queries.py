"""Booking transformations T1–T5 and WR-1 over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookdemand import schemas as S
from bookdemand.operators.aggregates import control_totals, group_sizes
from bookdemand.operators.join import join_dimension, join_rooms
from bookdemand.operators.ranking import top_n_per_group
from bookdemand.operators.requests import demand_by_room, filter_requests, priority_score, top_demand
from bookdemand.plans.oracle_views import JOINED_CTE, REQUESTS_CTE, ROOMS_CTE, minutes_between, score_sql
from bookdemand.plans.registry import register
from bookdemand.sources.tables import (
    APPROVED_STATUS,
    YEAR_END,
    YEAR_START,
    load_requests,
    load_rooms,
    read_table,
)


# --- T1 ---------------------------------------------------------------------
@register("filter_select", f"""WITH {REQUESTS_CTE}
SELECT request_id, room_id, booking_date, start_time, end_time, attendees, status
FROM requests
WHERE status = '{APPROVED_STATUS}' AND attendees >= {S.MIN_ATTENDEES}
  AND booking_date BETWEEN DATE '{YEAR_START}' AND DATE '{YEAR_END}'""")
def filter_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 over orders-as-requests: approved, ≥25 attendees, one academic year."""
    return filter_requests(
        load_requests(spark, sf_dir), approved=APPROVED_STATUS, start=YEAR_START, end=YEAR_END
    )


@register("filter_select_landing", f"""WITH {REQUESTS_CTE}
SELECT request_id, room_id, booking_date, start_time, end_time, attendees, status
FROM requests
WHERE status = '{APPROVED_STATUS}' AND attendees >= {S.MIN_ATTENDEES}
  AND booking_date BETWEEN DATE '{YEAR_START}' AND DATE '{YEAR_END}'""")
def filter_select_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 on a copy of the requests partitioned by month, bounds without
    leading zeros: only the year's months are listed and read."""
    from bookdemand.session import scratch_path
    from bookdemand.sinks.files import write_landing_zone

    path = scratch_path(spark, "landing")
    write_landing_zone(load_requests(spark, sf_dir), path)
    plain = ["-".join(str(int(p)) for p in day.split("-")) for day in (YEAR_START, YEAR_END)]
    return filter_requests(spark.read.parquet(path), approved=APPROVED_STATUS, start=plain[0], end=plain[1])


# --- T2 ---------------------------------------------------------------------
@register("group_demand", f"""WITH {REQUESTS_CTE}
SELECT room_id, count(request_id) AS request_count, avg(attendees) AS avg_attendees,
       max(attendees) AS max_attendees
FROM requests GROUP BY room_id ORDER BY room_id""")
def group_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2: per room, request count, mean and max attendees, by room."""
    return demand_by_room(load_requests(spark, sf_dir))


@register("csv_roundtrip", f"""WITH {REQUESTS_CTE}
SELECT room_id, count(request_id) AS request_count, avg(attendees) AS avg_attendees,
       max(attendees) AS max_attendees
FROM requests GROUP BY room_id""")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-1/SNK-2 then SRC-3/SRC-4/U-1: T2 published as a staged CSV
    directory under the shared folder, read back as one table from its part
    files with an explicit schema (FAILFAST, header order enforced)."""
    from bookdemand.session import scratch_path
    from bookdemand.sinks.files import publish_staged
    from bookdemand.sources.csv import read_parts

    t2 = demand_by_room(load_requests(spark, sf_dir), ordered=False)
    path = scratch_path(spark, "csv-roundtrip")
    publish_staged(t2, path, fmt="csv")
    return read_parts(spark, path, t2.schema)


# the year that half-years are counted from
HALF_YEAR_BASE = 1992


@register("iso_text", f"""WITH {REQUESTS_CTE}
SELECT request_id, strftime(booking_date, '%Y-%m-%d') AS booking_date, start_time, end_time,
       strftime(created_at, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS created_at,
       CAST((year(booking_date) - {HALF_YEAR_BASE}) * 2 + CASE WHEN month(booking_date) > 6 THEN 1 ELSE 0 END
            AS INTEGER) AS half_year
FROM requests""")
def iso_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SF-17 / SF-16: every request's day and creation instant as the
    published ISO text (``YYYY-MM-DD``, UTC instant with ``+00:00``), next to
    its times, and the academic half-year index of its day."""
    from bookdemand.functions.dates import half_year_index, iso_date, iso_instant

    r = load_requests(spark, sf_dir)
    return r.select(S.REQUEST_ID, iso_date(S.BOOKING_DATE).alias(S.BOOKING_DATE), S.START_TIME, S.END_TIME,
                    iso_instant(S.CREATED_AT).alias(S.CREATED_AT),
                    half_year_index(S.BOOKING_DATE, HALF_YEAR_BASE).alias("half_year"))


@register("group_demand_lineitem", """SELECT l_suppkey, count(l_orderkey) AS request_count,
       avg(l_quantity) AS avg_attendees, max(l_quantity) AS max_attendees
FROM lineitem GROUP BY l_suppkey ORDER BY l_suppkey""")
def group_demand_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2's operator on another table: lines per supplier, quantity stats."""
    return demand_by_room(
        read_table(spark, sf_dir, "lineitem"), key="l_suppkey", id_col="l_orderkey", value_col="l_quantity"
    )


# --- T3 ---------------------------------------------------------------------
@register("join_dimension", f"""WITH {REQUESTS_CTE}, {ROOMS_CTE}, {JOINED_CTE}
SELECT * FROM joined""")
def join_dimension_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3: requests × rooms, many-to-one checked, strategy from measured size."""
    return join_rooms(load_requests(spark, sf_dir), load_rooms(spark, sf_dir))


@register("join_lineitem_part", """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity,
       p.p_name AS part_name, p.p_brand AS part_brand, p.p_size AS part_size
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""")
def join_lineitem_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T3's operator on another star: line items × parts (N:1 on part key)."""
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return join_dimension(
        lines, read_table(spark, sf_dir, "part"), fact_key="l_partkey", dim_key="p_partkey",
        columns=[("p_name", "part_name"), ("p_brand", "part_brand"), ("p_size", "part_size")],
    )


@register("group_sizes", """SELECT l_returnflag, l_linestatus, count(*) AS rows
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def group_sizes_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-4: rows per key (a null key would be its own group)."""
    return group_sizes(read_table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"])


@register("control_totals", """SELECT count(*) AS rows, CAST(sum(l_quantity) AS DOUBLE) AS total,
       CAST(avg(l_quantity) AS DOUBLE) AS mean FROM lineitem""")
def control_totals_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-5: global row count, sum and mean of a control column."""
    return control_totals(read_table(spark, sf_dir, "lineitem"), "l_quantity")


# --- T4 ---------------------------------------------------------------------
@register("priority_score", f"""WITH {REQUESTS_CTE}, {ROOMS_CTE}, {JOINED_CTE}
SELECT *, {score_sql(APPROVED_STATUS)} AS priority_score FROM joined""")
def priority_score_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 on T3's output."""
    joined = join_rooms(load_requests(spark, sf_dir), load_rooms(spark, sf_dir))
    return priority_score(joined, approved=APPROVED_STATUS)


# Hours of the offsets that instants are written with in the text queries.
OFFSETS = (-5, 0, 9, 14)


def _instant_text(created: F.Column, key: F.Column) -> F.Column:
    """The instant as ISO text at one of the offsets, picked by the key."""
    hours = F.element_at(F.array(*[F.lit(h) for h in OFFSETS]), (F.pmod(key, F.lit(len(OFFSETS))) + 1).cast("int"))
    sign = F.when(hours < 0, "-").otherwise("+")
    local = F.date_format(created + F.make_dt_interval(F.lit(0), hours), "yyyy-MM-dd'T'HH:mm:ss")
    return F.concat(local, sign, F.lpad(F.abs(hours).cast("string"), 2, "0"), F.lit(":00"))


@register("priority_score_text", f"""WITH {REQUESTS_CTE}, {ROOMS_CTE}, {JOINED_CTE}
SELECT request_id, {score_sql(APPROVED_STATUS)} AS priority_score FROM joined""")
def priority_score_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T4 with the creation instant as text at several offsets: the same
    scores, because the lead is counted from the instant's UTC day (X3)."""
    r = load_requests(spark, sf_dir)
    r = r.withColumn(S.CREATED_AT, _instant_text(F.col(S.CREATED_AT), F.col(S.REQUEST_ID)))
    scored = priority_score(join_rooms(r, load_rooms(spark, sf_dir)), approved=APPROVED_STATUS)
    return scored.select(S.REQUEST_ID, S.PRIORITY_SCORE)


@register("csv_bookings", f"""WITH {REQUESTS_CTE}, {ROOMS_CTE}, {JOINED_CTE}
SELECT CAST(request_id AS VARCHAR) AS request_id, room_code, capacity, {score_sql(APPROVED_STATUS)} AS priority_score FROM joined""")
def csv_bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-1 / SRC-2 end to end: requests and rooms written as CSV under the
    published headers, read back by the strict readers, joined and scored."""
    from bookdemand.commands import as_published
    from bookdemand.session import scratch_path
    from bookdemand.sinks.files import write_csv
    from bookdemand.sources.csv import read_requests_csv, read_rooms_csv

    requests, rooms = load_requests(spark, sf_dir), load_rooms(spark, sf_dir)
    for c in set(S.REQUEST_COLUMNS) - set(requests.columns):
        requests = requests.withColumn(c, F.col(S.CREATED_AT) if c == S.UPDATED_AT else F.concat(F.lit(f"{c} "), F.col(S.REQUEST_ID).cast("string")))
    for c in set(S.ROOM_COLUMNS) - set(rooms.columns):
        stamp = c in (S.CREATED_AT, S.UPDATED_AT)
        rooms = rooms.withColumn(c, F.lit("2020-01-01 00:00:00").cast("timestamp") if stamp else F.concat(F.lit(f"{c}, "), F.col(S.ROOM_ID).cast("string")))
    paths = [scratch_path(spark, name) for name in ("requests-csv", "rooms-csv")]
    write_csv(as_published(requests.select(*S.REQUEST_COLUMNS), S.PUBLISHED_REQUEST_HEADER), paths[0])
    write_csv(as_published(rooms.select(*S.ROOM_COLUMNS), S.PUBLISHED_ROOM_HEADER), paths[1])
    joined = join_rooms(read_requests_csv(spark, paths[0], S.PUBLISHED_REQUEST_HEADER), read_rooms_csv(spark, paths[1], S.PUBLISHED_ROOM_HEADER))
    return priority_score(joined, approved=APPROVED_STATUS).select(S.REQUEST_ID, S.ROOM_CODE, S.CAPACITY, S.PRIORITY_SCORE)


# --- T5 ---------------------------------------------------------------------
@register("top_demand", f"""WITH {REQUESTS_CTE}
SELECT request_id, room_id, booking_date, start_time, end_time, attendees, status,
       {minutes_between('start_time', 'end_time')} AS duration_min
FROM requests
ORDER BY attendees DESC, duration_min DESC, booking_date ASC, request_id ASC
LIMIT {S.TOP_N}""")
def top_demand_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: top 20 requests under the four-key total order."""
    return top_demand(load_requests(spark, sf_dir), S.TOP_N)


# --- WR-1 -------------------------------------------------------------------
@register("top_events_per_day", """SELECT * FROM (
  SELECT CAST(ts AS DATE) AS day, event_id, user_id, event_type, value,
         CAST(row_number() OVER (PARTITION BY CAST(ts AS DATE)
                                 ORDER BY value DESC, event_id ASC) AS INTEGER) AS rank
  FROM events) WHERE rank <= 3""")
def top_events_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """WR-1: per calendar day, the 3 largest events (value ↓, id ↑)."""
    events = read_table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("day"), "event_id", "user_id", "event_type", "value"
    )
    return top_n_per_group(events, ["day"], [F.col("value").desc(), F.col("event_id").asc()], 3)
