"""Requests and rooms derived from the TPC-H-like parquet tables.

The warehouse has no booking table, so ``orders`` plays the requests and
``customer`` the rooms.  Every booking attribute is a pure column expression
of the order / customer row, so the mapping is a narrow projection that
Catalyst fuses into the scan stage; filters on ``booking_date`` and
``status`` still reach the parquet reader as pushed predicates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookdemand import schemas as S

# Fixed values of the mapping: first slot 07:00 (minute 420), 25 half-hour
# slots, four durations, attendees 5..45, lead 1..30 days, capacity 20..45.
FIRST_SLOT_MIN = 420
SLOTS = 25
DURATIONS_MIN = (60, 90, 120, 180)
ATTENDEES_MIN = 5
ATTENDEES_SPAN = 41
LEAD_SPAN_DAYS = 30
CAPACITY_MIN = 20
CAPACITY_SPAN = 26

# Parameters that make the booking rules meaningful on this mapping: 'F'
# (fulfilled) plays the approved state; the academic year sits inside the
# orders' date range.
APPROVED_STATUS = "F"
YEAR_START = "1996-07-01"
YEAR_END = "1997-06-30"


_RELATIONS: dict[tuple[str, int, str], tuple[list, DataFrame]] = {}


def _file_states(spark: SparkSession, path: str) -> list[tuple]:
    """(name, length, modification time) of the file ``path``, or of the files in that folder."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(jpath))


def read_table(spark: SparkSession, sf_dir: str, name: str, *, refresh: bool = False) -> DataFrame:
    """The parquet table ``name`` under ``sf_dir``.

    The relation (file listing and footer schema, not data) is kept per
    session and path, as a catalog would, until a file's name, length or
    time changes; ``refresh=True`` reads the footer again in any case.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    application = spark.sparkContext.applicationId
    key = (application, id(spark), path)
    states = _file_states(spark, path)
    if refresh or key not in _RELATIONS or _RELATIONS[key][0] != states:
        for old in [k for k in _RELATIONS if k[0] != application]:
            del _RELATIONS[old]  # relations of sessions that have ended
        _RELATIONS[key] = states, spark.read.parquet(path)
    return _RELATIONS[key][1]


def _hhmm(minutes_sql: str) -> str:
    return (f"concat(lpad(CAST(floor(({minutes_sql}) / 60) AS STRING), 2, '0'), ':', "
            f"lpad(CAST(pmod({minutes_sql}, 60) AS STRING), 2, '0'), ':00')")


_START = f"({FIRST_SLOT_MIN} + pmod(o_orderkey, {SLOTS}) * 30)"
_DURATION = (f"element_at(array({', '.join(map(str, DURATIONS_MIN))}), "
             f"CAST(pmod(o_orderkey, {len(DURATIONS_MIN)}) + 1 AS INT))")
_DAY = "CAST(o_orderdate AS DATE)"

REQUEST_EXPRS = [
    f"o_orderkey AS {S.REQUEST_ID}",
    f"o_custkey AS {S.ROOM_ID}",
    f"{_DAY} AS {S.BOOKING_DATE}",
    f"{_hhmm(_START)} AS {S.START_TIME}",
    f"{_hhmm(_START + ' + ' + _DURATION)} AS {S.END_TIME}",
    f"CAST({ATTENDEES_MIN} + pmod(o_orderkey, {ATTENDEES_SPAN}) AS INT) AS {S.ATTENDEES}",
    f"o_orderstatus AS {S.STATUS}",
    f"CAST(date_sub({_DAY}, CAST(1 + pmod(o_orderkey * 7, {LEAD_SPAN_DAYS}) AS INT)) AS TIMESTAMP)"
    f" + make_dt_interval(0, CAST(pmod(o_orderkey, 24) AS INT)) AS {S.CREATED_AT}",
]

ROOM_EXPRS = [
    f"c_custkey AS {S.ROOM_ID}",
    f"format_string('ROOM-%06d', c_custkey) AS {S.CODE}",
    f"c_name AS {S.NAME}",
    f"CAST({CAPACITY_MIN} + pmod(c_custkey, {CAPACITY_SPAN}) AS INT) AS {S.CAPACITY}",
    f"c_mktsegment AS {S.STATE}",
    f"c_acctbal >= 0 AS {S.ACTIVE}",
]


def requests_from_orders(orders: DataFrame) -> DataFrame:
    """One request per order: key, room (customer), day, slot, size, state."""
    return orders.selectExpr(*REQUEST_EXPRS)


def rooms_from_customer(customer: DataFrame) -> DataFrame:
    """One room per customer; a negative balance marks an inactive room."""
    return customer.selectExpr(*ROOM_EXPRS)


_DERIVED: dict[tuple[int, str], tuple[DataFrame, DataFrame]] = {}


def _derived(relation: DataFrame, name: str, build) -> DataFrame:
    """``build(relation)``, kept as long as ``relation`` is the current one.

    A derived view is a pure function of its relation (a plan, no data), so
    it is analysed once per relation like a catalog view; ``read_table(...,
    refresh=True)`` yields a new relation and with it a new view.
    """
    key = (id(relation), name)
    hit = _DERIVED.get(key)
    if hit is None or hit[0] is not relation:
        hit = (relation, build(relation))
        _DERIVED[key] = hit
    return hit[1]


def load_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(read_table(spark, sf_dir, "orders"), "requests", requests_from_orders)


def load_rooms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(read_table(spark, sf_dir, "customer"), "rooms", rooms_from_customer)


def measurements_from_events(events: DataFrame) -> DataFrame:
    """Events as a timing table: each event type is an operator, the user's
    key picks a parallelism of 1, 2 or 4 units, the value is the time."""
    return events.select(
        F.lit("events").alias("engine"),
        F.col("event_type").alias("operator"),
        F.element_at(F.array(F.lit(1), F.lit(2), F.lit(4)), (F.pmod(F.col("user_id"), F.lit(3)) + 1).cast("int"))
        .alias("units"),
        F.col("event_id").alias("repetition"),
        F.col("value").alias("seconds"),
    )


def measurements_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Lines as a second timing series: the return flag is the operator, the
    line number picks a parallelism of 1, 2 or 4 units, the quantity is the
    time."""
    return lineitem.select(
        F.lit("lineitem").alias("engine"),
        F.col("l_returnflag").alias("operator"),
        F.element_at(F.array(F.lit(1), F.lit(2), F.lit(4)), (F.pmod(F.col("l_linenumber"), F.lit(3)) + 1).cast("int"))
        .alias("units"),
        F.col("l_orderkey").alias("repetition"),
        F.col("l_quantity").alias("seconds"),
    )
