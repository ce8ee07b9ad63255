import datetime as dt

import pytest
from pyspark.sql import functions as F

from bookdemand import schemas as S
from bookdemand.operators import demand_by_room, filter_requests, join_rooms, priority_score, top_demand
from bookdemand.plans.inspect import has_operator

REQ = ("request_id string, room_id string, booking_date date, start_time string, end_time string, "
       "attendees int, status string, created_at timestamp")
ROOM = "room_id string, code string, name string, capacity int, state string, active boolean"


def req(spark, rows):
    return spark.createDataFrame(rows, REQ)


def ts(y, m, d, h=0):
    return dt.datetime(y, m, d, h)


def base_row(i, **kw):
    row = dict(request_id=f"r{i}", room_id="A", booking_date=dt.date(2024, 9, 2), start_time="09:00:00",
               end_time="10:00:00", attendees=30, status="APROBADA", created_at=ts(2024, 8, 1))
    row.update(kw)
    return tuple(row[k] for k in ("request_id", "room_id", "booking_date", "start_time", "end_time",
                                  "attendees", "status", "created_at"))


def test_t1_bounds_inclusive_and_projection(spark):
    rows = [
        base_row(1, booking_date=dt.date(2024, 7, 1)),
        base_row(2, booking_date=dt.date(2025, 6, 30)),
        base_row(3, booking_date=dt.date(2024, 6, 30)),
        base_row(4, booking_date=dt.date(2025, 7, 1)),
        base_row(5, attendees=25),
        base_row(6, attendees=24),
        base_row(7, status="PENDIENTE"),
    ]
    out = filter_requests(req(spark, rows))
    assert out.columns == ["request_id", "room_id", "booking_date", "start_time", "end_time", "attendees", "status"]
    assert sorted(r[0] for r in out.collect()) == ["r1", "r2", "r5"]


def test_t1_malformed_text_date_raises(spark):
    df = spark.createDataFrame([("r1", "A", "2024-13-45", "09:00:00", "10:00:00", 30, "APROBADA")],
                               "request_id string, room_id string, booking_date string, start_time string, "
                               "end_time string, attendees int, status string")
    with pytest.raises(Exception):
        filter_requests(df).collect()


def test_missing_columns_sorted(spark):
    df = spark.createDataFrame([("r1",)], "request_id string")
    with pytest.raises(ValueError, match="attendees, booking_date, end_time, room_id, start_time, status"):
        filter_requests(df)


def test_t2_counts_non_null_ids_and_keeps_null_key(spark):
    rows = [base_row(1, attendees=10), base_row(2, attendees=20), base_row(3, attendees=33),
            base_row(4, room_id=None, attendees=5)]
    df = req(spark, rows).withColumn("request_id", F.when(F.col("request_id") == "r3", None)
                                     .otherwise(F.col("request_id")))
    got = {r["room_id"]: r for r in demand_by_room(df).collect()}
    assert got["A"][S.REQUEST_COUNT] == 2            # X12: null id not counted
    assert got["A"][S.AVG_ATTENDEES] == pytest.approx(21.0)
    assert got["A"][S.MAX_ATTENDEES] == 33
    assert got[None][S.REQUEST_COUNT] == 1           # X6: null key is a group


def test_t2_ordered(spark):
    rows = [base_row(i, room_id=k) for i, k in enumerate("CAB")]
    assert [r["room_id"] for r in demand_by_room(req(spark, rows)).collect()] == ["A", "B", "C"]


def rooms(spark, rows=None):
    rows = rows or [("A", "LAB-001", "Lab 1", 30, "DISPONIBLE", True), ("B", "LAB-002", "Lab 2", 20, "OCUPADO", True)]
    return spark.createDataFrame(rows, ROOM)


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "merge", "shuffle_hash", "salted"])
def test_t3_strategies_agree(spark, strategy):
    rows = [base_row(i, room_id=k) for i, k in enumerate(["A", "A", "B", "Z", None])]
    out = join_rooms(req(spark, rows), rooms(spark), strategy=strategy, hot_key_rows=2, salt_buckets=4)
    assert out.columns == ["request_id", "room_id", "booking_date", "start_time", "end_time", "attendees",
                           "status", "created_at", "room_code", "room_name", "capacity", "room_state", "room_active"]
    got = sorted((r["request_id"], r["room_code"], r["capacity"]) for r in out.collect())
    assert got == [("r0", "LAB-001", 30), ("r1", "LAB-001", 30), ("r2", "LAB-002", 20)]


def test_t3_duplicate_dimension_key_rejected(spark):
    dup = rooms(spark, [("A", "x", "x", 1, "s", True), ("A", "y", "y", 2, "s", True)])
    with pytest.raises(ValueError, match="many-to-one"):
        join_rooms(req(spark, [base_row(1)]), dup)


def test_t3_broadcast_only_within_measured_limit(spark):
    df = req(spark, [base_row(1)])
    small = join_rooms(df, rooms(spark))
    assert has_operator(small, "BroadcastHashJoin")
    forced_limit = join_rooms(df, rooms(spark), max_broadcast_bytes=10)
    assert not has_operator(forced_limit, "BroadcastExchange")


def score_of(spark, **kw):
    row = base_row(1, **kw)
    df = join_rooms(req(spark, [row]), rooms(spark), strategy="broadcast", validate=False)
    return priority_score(df).first()[S.PRIORITY_SCORE]


def test_t4_formula(spark):
    # Monday 2024-09-02, 30 of 30 seats, 60 min, lead 32 days, approved
    assert score_of(spark) == 30 * 60 + 1000 + 0 + 0 + 100
    # 23/30 = 76.7 % → 500; lead exactly 7 days → 300; Saturday → 200
    assert score_of(spark, attendees=23, booking_date=dt.date(2024, 9, 7), created_at=ts(2024, 8, 31, 23),
                     status="PENDIENTE") == 23 * 60 + 500 + 300 + 200
    # lead 8 days → no lead bonus; 22/30 = 73 % → no occupancy bonus
    assert score_of(spark, attendees=22, created_at=ts(2024, 8, 25), status="X") == 22 * 60
    # created after the booking (negative lead) still counts as short lead (X11)
    assert score_of(spark, attendees=22, created_at=ts(2024, 9, 5), status="X") == 22 * 60 + 300
    # null attendees → null score (X10)
    assert score_of(spark, attendees=None) is None


def test_t5_total_order_and_n(spark):
    rows = [
        base_row(3, attendees=40, end_time="11:00:00"),
        base_row(2, attendees=40, end_time="11:00:00"),
        base_row(1, attendees=40, end_time="11:00:00", booking_date=dt.date(2024, 9, 3)),
        base_row(4, attendees=40, end_time="12:00:00"),
        base_row(5, attendees=41),
    ]
    out = top_demand(req(spark, rows), n=4)
    assert [r["request_id"] for r in out.collect()] == ["r5", "r4", "r2", "r3"]
    assert out.columns[-1] == S.DURATION_MIN
    assert has_operator(out, "TakeOrderedAndProject")
    for bad in (0, -1):
        with pytest.raises(ValueError):
            top_demand(req(spark, rows), n=bad)


def test_score_sql_equals_column_form(spark):
    from bookdemand.operators.requests import priority_score_column, priority_score_sql
    rows = [base_row(i, attendees=a, booking_date=d, created_at=c, status=s)
            for i, (a, d, c, s) in enumerate([
                (30, dt.date(2024, 9, 2), ts(2024, 8, 1), "APROBADA"),
                (23, dt.date(2024, 9, 7), ts(2024, 8, 31, 23), "PENDIENTE"),
                (None, dt.date(2024, 9, 8), ts(2024, 9, 5), "O'Neil"),
            ])]
    df = join_rooms(req(spark, rows), rooms(spark), strategy="broadcast", validate=False)
    got = df.select(F.expr(priority_score_sql("O'Neil")).alias("a"), priority_score_column("O'Neil").alias("b"))
    assert all(r["a"] == r["b"] for r in got.collect())


def test_t1_state_literal_with_quote_and_backslash(spark):
    odd = "O'K\\x"
    rows = [base_row(1, status=odd), base_row(2, status="O'K"), base_row(3)]
    got = [r["request_id"] for r in filter_requests(req(spark, rows), approved=odd).collect()]
    assert got == ["r1"]


def test_adapter_views_follow_a_refreshed_relation(spark):
    from bookdemand.sources.tables import load_requests, read_table

    sf = "/root/testdata/sf0.001"
    first = load_requests(spark, sf)
    assert load_requests(spark, sf) is first
    read_table(spark, sf, "orders", refresh=True)
    again = load_requests(spark, sf)
    assert again is not first and again.columns == first.columns


def test_size_only_profile_agrees_and_needs_no_key_shuffle(spark):
    from bookdemand.operators.join import profile_dimension
    from bookdemand.plans.inspect import plan_text

    dim = rooms(spark, [("A", "LAB-001", "Lab 1", 30, "X", True), ("A", "LAB-009", "Lab 9", 20, "X", True),
                        (None, "LAB-002", "Lab 2", 20, "Y", False), ("B", "LAB-003", None, 40, "Y", True)])
    full = profile_dimension(dim, "room_id")
    size = profile_dimension(dim, "room_id", per_key=False)
    assert (size.rows, size.null_keys, size.value_bytes) == (full.rows, full.null_keys, full.value_bytes)
    assert full.max_rows_per_key == 2 and size.max_rows_per_key == -1
    measured = dim.agg(F.count(F.lit(1)))
    assert "hashpartitioning" not in plan_text(measured, "simple")


def test_unvalidated_auto_join_decides_by_measured_size(spark):
    rows = [base_row(1), base_row(2, room_id="B")]
    small = join_rooms(req(spark, rows), rooms(spark), validate=False)
    assert has_operator(small, "BroadcastHashJoin") and small.count() == 2
    big = join_rooms(req(spark, rows), rooms(spark), validate=False, max_broadcast_bytes=1)
    assert not has_operator(big, "BroadcastHashJoin") and big.count() == 2
