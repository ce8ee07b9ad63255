"""Data-quality, fingerprint and equivalence queries over the warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookdemand.operators.aggregates import duplicate_keys
from bookdemand.operators.equivalence import equivalence_report, ordered_check, row_multiset_check
from bookdemand.operators.fingerprint import table_fingerprint
from bookdemand.operators.join import join_rooms
from bookdemand.operators.quality import booking_quality_report, missing_keys
from bookdemand.operators.requests import REQUEST_VIEW, demand_by_room, filter_requests, top_demand
from bookdemand import schemas as S
from bookdemand.plans.oracle_views import REQUESTS_CTE, ROOMS_CTE, minutes_between, secs
from bookdemand.plans.registry import register
from bookdemand.sources.tables import YEAR_END, YEAR_START, load_requests, load_rooms, read_table

# Columns of the fingerprinted tables: doubles marked with a +, instants with an @, texts with a $.
ORDER_TEXTS = ["o_orderkey", "o_custkey", "$o_orderstatus", "+o_totalprice", "@o_orderdate", "$o_orderpriority"]
LINE_TEXTS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "+l_quantity", "+l_extendedprice", "+l_discount", "+l_tax", "$l_returnflag", "$l_linestatus", "@l_shipdate"]
REQ_COLS = ["request_id", "room_id", "booking_date", "start_time", "end_time", "attendees", "status", "created_at"]
REQ_TEXT = {"start_time", "end_time", "status"}
ROOM_COLS = ["room_id", "code", "name", "capacity", "state", "active"]
ROOM_TEXT = {"code", "name", "state"}


def _blank_sql(cols, text):
    return " OR ".join(f"{c} IS NULL" + (f" OR trim({c}) = ''" if c in text else "") for c in cols)


def _rule(name, checked, violations, source, sample):
    return (f"SELECT '{name}' AS rule, CAST({checked} AS BIGINT) AS checked, "
            f"CAST(coalesce({violations}, 0) AS BIGINT) AS violations, CAST({sample} AS VARCHAR) AS sample FROM {source}")


def _unique(name, table, key):
    return _rule(name, "sum(n)", "sum(CASE WHEN n > 1 THEN n END)",
                 f"(SELECT {key}, count(*) AS n FROM {table} GROUP BY {key})", f"min(CASE WHEN n > 1 THEN {key} END)")


def _where(name, bad, table, key):
    return _rule(name, "count(*)", f"sum(CASE WHEN {bad} THEN 1 END)", table, f"min(CASE WHEN {bad} THEN {key} END)")


def _columns(name, table, expected):
    """Columns of the view itself, compared by position with the expected ones."""
    wanted = ", ".join(f"({i}, '{c}')" for i, c in enumerate(expected))
    return (f"SELECT '{name}' AS rule, CAST({len(expected)} AS BIGINT) AS checked, CAST(count(*) FILTER (WHERE bad) AS BIGINT) AS violations, "
            f"CAST(min(coalesce(want, have)) FILTER (WHERE bad) AS VARCHAR) AS sample FROM (SELECT want, have, want IS DISTINCT FROM have AS bad "
            f"FROM (VALUES {wanted}) w(i, want) FULL JOIN (SELECT unnest(range(len(k))) AS i, unnest(k) AS have "
            f"FROM (SELECT json_keys(to_json(t)) AS k FROM {table} t LIMIT 1)) USING (i))")


_DQ_SQL = f"""WITH {REQUESTS_CTE}, {ROOMS_CTE}
{_columns('requests.columns', 'requests', REQ_COLS)}
UNION ALL {_columns('rooms.columns', 'rooms', ROOM_COLS)}
UNION ALL {_where('rooms.required_values', _blank_sql(ROOM_COLS, ROOM_TEXT), 'rooms', 'room_id')}
UNION ALL {_unique('rooms.unique_id', 'rooms', 'room_id')}
UNION ALL {_unique('rooms.unique_code', 'rooms', 'code')}
UNION ALL {_where('rooms.positive_capacity', 'NOT (capacity > 0)', 'rooms', 'room_id')}
UNION ALL {_where('requests.required_values', _blank_sql(REQ_COLS, REQ_TEXT), 'requests', 'request_id')}
UNION ALL {_unique('requests.unique_id', 'requests', 'request_id')}
UNION ALL {_rule('requests.room_exists', 'count(*)', 'sum(CASE WHEN d.room_id IS NULL THEN 1 END)',
                 'requests f LEFT JOIN (SELECT DISTINCT room_id FROM rooms) d ON f.room_id = d.room_id',
                 'min(CASE WHEN d.room_id IS NULL THEN f.request_id END)')}
UNION ALL {_where('requests.end_after_start', f"NOT ({secs('end_time')} > {secs('start_time')})", 'requests', 'request_id')}
UNION ALL {_where('requests.positive_attendees', 'NOT (attendees > 0)', 'requests', 'request_id')}
UNION ALL {_rule('requests.within_capacity', 'count(*)', 'sum(CASE WHEN f.attendees > b.cap THEN 1 END)',
                 'requests f JOIN (SELECT room_id, min(capacity) AS cap FROM rooms GROUP BY room_id) b ON f.room_id = b.room_id',
                 'min(CASE WHEN f.attendees > b.cap THEN f.request_id END)')}
UNION ALL SELECT 'rooms.row_count', (SELECT count(*) FROM rooms), CAST((SELECT count(*) FROM rooms) <> (SELECT count(*) FROM orders) AS BIGINT), NULL
UNION ALL SELECT 'requests.row_count', (SELECT count(*) FROM requests), CAST((SELECT count(*) FROM requests) <> (SELECT count(*) FROM orders) AS BIGINT), NULL"""


@register("dq_report", _DQ_SQL)
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-2 … DQ-13 over requests (orders) and rooms (customer), one row per
    rule.  Rooms are expected to be as many as the orders, which they are not:
    a rule that fails is part of what is compared."""
    orders = read_table(spark, sf_dir, "orders").count()
    return booking_quality_report(
        load_requests(spark, sf_dir), load_rooms(spark, sf_dir), expected_requests=orders, expected_rooms=orders,
        request_columns=REQ_COLS, room_columns=ROOM_COLS)


@register("dq_duplicates", """SELECT l_orderkey, l_linenumber, count(*) AS copies
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def dq_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-7 / DQ-15: (order, line number) keys present more than once."""
    return duplicate_keys(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dq_orphans", """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey
FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)""")
def dq_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-3: line items whose order does not exist (anti join)."""
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return li.join(orders, on="l_orderkey", how="left_anti")


@register("dq_idle_orders", """SELECT o.o_orderkey, o.o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)""")
def dq_idle_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-3 with rows to find: orders that no line item belongs to."""
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return orders.join(lines, on="o_orderkey", how="left_anti")


@register("dq_missing_labels", """SELECT DISTINCT d.doc_id FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""")
def dq_missing_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J-6 / DQ-16: documents that the labels table does not cover."""
    docs = read_table(spark, sf_dir, "documents")
    return missing_keys(docs, read_table(spark, sf_dir, "labels"), ["doc_id"])


def _column_text(name: str) -> str:
    """A column's text as the fingerprint takes it: + marks a double, @ an instant, $ a text."""
    mark, c = (name[0], name[1:]) if name[0] in "+@$" else ("", name)
    if mark == "+":
        count = f"CAST(floor({c} * 1e6 + 0.5) AS BIGINT)"
        other = f"CASE WHEN isnan({c}) THEN 'nan' WHEN isinf({c}) THEN CAST({c} AS VARCHAR) ELSE replace(format('{{:a}}', {c}), 'p+', 'p') END"
        text = f"CASE WHEN abs({c}) < 9e12 AND {count} / 1e6::DOUBLE = {c} THEN CAST({count} AS VARCHAR) ELSE {other} END"
    else:
        text = {"@": f"CAST(epoch_us({c}) AS VARCHAR)", "$": f"octet_length(encode({c})) || ':' || {c}"}.get(mark, f"CAST({c} AS VARCHAR)")
    return f"coalesce({text}, '~')"


def _fingerprint_sql(table: str, columns: list[str]) -> str:
    text = " || '|' || ".join(map(_column_text, columns)) + " || '|'"
    return (f"SELECT '{table}' AS \"table\", count(*) AS rows, CAST(CAST(coalesce(sum(CAST(('0x' || substr(md5({text}), 1, 15)) "
            f"AS BIGINT)), 0) AS HUGEINT) AS VARCHAR) AS fingerprint FROM {table}")


@register("table_fingerprint", _fingerprint_sql("orders", ORDER_TEXTS) + " UNION ALL " + _fingerprint_sql("lineitem", LINE_TEXTS))
def fingerprint_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-14: order- and layout-independent fingerprint of orders and lineitem."""
    o = table_fingerprint(read_table(spark, sf_dir, "orders")).select(F.lit("orders").alias("table"), "*")
    li = table_fingerprint(read_table(spark, sf_dir, "lineitem")).select(F.lit("lineitem").alias("table"), "*")
    return o.unionByName(li)


def _eq_sql(left: str, right: str, value: str, key: str, cols: str) -> str:
    return f"""WITH {REQUESTS_CTE}, {ROOMS_CTE}, lhs AS ({left}), rhs AS ({right}),
ctl AS (SELECT (SELECT count(*) FROM lhs)::DOUBLE AS n0, (SELECT count(*) FROM rhs)::DOUBLE AS n1,
             (SELECT sum({value})::DOUBLE FROM lhs) AS s0, (SELECT sum({value})::DOUBLE FROM rhs) AS s1,
             (SELECT avg({value})::DOUBLE FROM lhs) AS m0, (SELECT avg({value})::DOUBLE FROM rhs) AS m1),
per_key AS (SELECT {key}, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS c0, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS c1
      FROM (SELECT {key}, 0 AS side FROM lhs UNION ALL SELECT {key}, 1 FROM rhs) GROUP BY {key}),
per_row AS (SELECT {cols}, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS c0,
             sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS c1
      FROM (SELECT {cols}, 0 AS side FROM lhs UNION ALL SELECT {cols}, 1 FROM rhs) GROUP BY {cols})
SELECT 'cardinality' AS "check", n0 AS left_value, n1 AS right_value,
       CAST(CASE WHEN n0 = n1 THEN 0 ELSE 1 END AS BIGINT) AS differing,
       CASE WHEN n0 = n1 THEN 'PASS' ELSE 'FAIL' END AS status FROM ctl
UNION ALL SELECT 'control_sum', s0, s1, CAST(CASE WHEN abs(s0 - s1) <= 1e-9 OR (s0 IS NULL AND s1 IS NULL) THEN 0 ELSE 1 END AS BIGINT),
       CASE WHEN abs(s0 - s1) <= 1e-9 OR (s0 IS NULL AND s1 IS NULL) THEN 'PASS' ELSE 'FAIL' END FROM ctl
UNION ALL SELECT 'control_mean', m0, m1, CAST(CASE WHEN abs(m0 - m1) <= 1e-9 OR (m0 IS NULL AND m1 IS NULL) THEN 0 ELSE 1 END AS BIGINT),
       CASE WHEN abs(m0 - m1) <= 1e-9 OR (m0 IS NULL AND m1 IS NULL) THEN 'PASS' ELSE 'FAIL' END FROM ctl
UNION ALL SELECT 'counts_per_key', count(*) FILTER (WHERE c0 > 0)::DOUBLE, count(*) FILTER (WHERE c1 > 0)::DOUBLE,
       CAST(count(*) FILTER (WHERE c0 <> c1) AS BIGINT),
       CASE WHEN count(*) FILTER (WHERE c0 <> c1) = 0 THEN 'PASS' ELSE 'FAIL' END FROM per_key
UNION ALL SELECT 'same_rows', coalesce(sum(c0), 0)::DOUBLE, coalesce(sum(c1), 0)::DOUBLE,
       CAST(coalesce(sum(abs(c0 - c1)), 0) AS BIGINT),
       CASE WHEN coalesce(sum(abs(c0 - c1)), 0) = 0 THEN 'PASS' ELSE 'FAIL' END FROM per_row"""


_T2_DIRECT = ("SELECT room_id, count(request_id) AS request_count, avg(attendees) AS avg_attendees, "
              "max(attendees) AS max_attendees FROM requests GROUP BY room_id")
_T2_VIA_JOIN = ("SELECT r.room_id, count(r.request_id) AS request_count, avg(r.attendees) AS avg_attendees, "
                "max(r.attendees) AS max_attendees FROM requests r JOIN rooms m ON r.room_id = m.room_id "
                "GROUP BY r.room_id")


@register("equivalence_report", _eq_sql(_T2_DIRECT, _T2_VIA_JOIN, "request_count", "room_id",
                                        "room_id, request_count, avg_attendees, max_attendees"))
def equivalence_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EQ-1 … EQ-6: T2 computed directly vs. from T3's joined rows (all PASS)."""
    requests = load_requests(spark, sf_dir)
    direct = demand_by_room(requests, ordered=False)
    via_join = demand_by_room(join_rooms(requests, load_rooms(spark, sf_dir)), ordered=False)
    return equivalence_report(direct, via_join, value_col="request_count", keys=["room_id"])


_T1 = ("SELECT request_id, room_id, booking_date, start_time, end_time, attendees, status FROM requests "
       "WHERE status = '{s}' AND attendees >= 25 AND booking_date BETWEEN DATE '" + YEAR_START
       + "' AND DATE '" + YEAR_END + "'")


@register("equivalence_diff", _eq_sql(_T1.format(s="F"), _T1.format(s="O"), "attendees", "room_id",
                                      "request_id, room_id, booking_date, start_time, end_time, attendees, status"))
def equivalence_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EQ report on two different inputs: T1 for status 'F' vs. status 'O'."""
    requests = load_requests(spark, sf_dir)
    left = filter_requests(requests, approved="F", start=YEAR_START, end=YEAR_END)
    right = filter_requests(requests, approved="O", start=YEAR_START, end=YEAR_END)
    return equivalence_report(left, right, value_col="attendees", keys=["room_id"])


# --- EQ-5 ordered identity: T5 directly vs. from T3's joined rows ------------
_T5_ORDER_SQL = "attendees DESC, duration_min DESC, booking_date ASC, request_id ASC"
_T5_COLS = "request_id, room_id, booking_date, start_time, end_time, attendees, status, duration_min"


def _t5_sql(source: str) -> str:
    return (f"SELECT {_T5_COLS} FROM (SELECT r.request_id, r.room_id, r.booking_date, r.start_time, r.end_time, "
            f"r.attendees, r.status, {minutes_between('r.start_time', 'r.end_time')} AS duration_min "
            f"FROM {source}) ORDER BY {_T5_ORDER_SQL} LIMIT {S.TOP_N}")


def _diff_sql(name: str, cols: str, lhs: str, rhs: str) -> str:
    return (f"SELECT '{name}' AS \"check\", coalesce(sum(c0), 0)::DOUBLE AS left_value, "
            f"coalesce(sum(c1), 0)::DOUBLE AS right_value, CAST(coalesce(sum(abs(c0 - c1)), 0) AS BIGINT) AS differing, "
            f"CASE WHEN coalesce(sum(abs(c0 - c1)), 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status "
            f"FROM (SELECT {cols}, sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS c0, "
            f"sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS c1 "
            f"FROM (SELECT {cols}, 0 AS side FROM {lhs} UNION ALL SELECT {cols}, 1 FROM {rhs}) GROUP BY {cols})")


@register("equivalence_order", f"""WITH {REQUESTS_CTE}, {ROOMS_CTE},
lhs AS ({_t5_sql("requests r")}),
rhs AS ({_t5_sql("requests r JOIN rooms m ON r.room_id = m.room_id")}),
pl AS (SELECT row_number() OVER (ORDER BY {_T5_ORDER_SQL}) AS _pos, request_id AS _id FROM lhs),
pr AS (SELECT row_number() OVER (ORDER BY {_T5_ORDER_SQL}) AS _pos, request_id AS _id FROM rhs)
{_diff_sql("same_rows", _T5_COLS, "lhs", "rhs")}
UNION ALL {_diff_sql("same_order", "_pos, _id", "pl", "pr")}""")
def equivalence_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EQ-5 on T5: the top 20 computed directly and from T3's joined rows are
    the same rows in the same order (both PASS)."""
    requests = load_requests(spark, sf_dir)
    direct = top_demand(requests, S.TOP_N)
    via_join = top_demand(join_rooms(requests, load_rooms(spark, sf_dir)).select(*REQUEST_VIEW), S.TOP_N)
    order = [F.col(S.ATTENDEES).desc(), F.col(S.DURATION_MIN).desc(), F.col(S.BOOKING_DATE).asc(),
             F.col(S.REQUEST_ID).asc()]
    same_rows = row_multiset_check(direct, via_join)
    same_order = ordered_check(direct, via_join, order, S.REQUEST_ID)
    cols = ["check", "left_value", "right_value", "differing", "status"]
    return same_rows.select(*cols).unionByName(same_order.select(*cols))
