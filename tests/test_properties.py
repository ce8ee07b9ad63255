"""Random small frames: every operator against a brute-force Python oracle
(the dual-implementation strategy of the original workload)."""

import datetime as dt
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from bookdemand import schemas as S
from bookdemand.operators import demand_by_room, filter_requests, join_rooms, priority_score, top_demand
from bookdemand.operators.quality import booking_quality_report
from bookdemand.operators.quantiles import exact_median

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
REQ = ("request_id string, room_id string, booking_date date, start_time string, end_time string, "
       "attendees int, status string, created_at timestamp")
ROOM = "room_id string, code string, name string, capacity int, state string, active boolean"
ROOM_IDS = ["A", "B", "C"]

request = st.tuples(
    st.sampled_from(ROOM_IDS + [None, "Z"]),
    st.dates(dt.date(2024, 6, 25), dt.date(2024, 7, 10)),
    st.integers(0, 24),                       # slot
    st.sampled_from([60, 90, 120, 180]),
    st.one_of(st.none(), st.integers(0, 50)),
    st.sampled_from(["APROBADA", "PENDIENTE"]),
    st.integers(-3, 12),                      # lead days
    st.integers(0, 23),                       # hour of creation
)
requests_st = st.lists(request, min_size=0, max_size=40)


def hhmm(m):
    return f"{m // 60:02d}:{m % 60:02d}:00"


def build(rows):
    out = []
    for i, (room, day, slot, dur, att, status, lead, hour) in enumerate(rows):
        start = 420 + slot * 30
        created = dt.datetime.combine(day - dt.timedelta(days=lead), dt.time(hour))
        out.append((f"r{i:03d}", room, day, hhmm(start), hhmm(start + dur), att, status, created))
    return out


CAPS = {"A": 30, "B": 20, "C": 45}


def rooms_df(spark):
    return spark.createDataFrame([(k, f"LAB-{k}", f"Lab {k}", c, "DISPONIBLE", True) for k, c in CAPS.items()], ROOM)


def minutes(r):
    def sec(t):
        h, m, s = map(int, t.split(":"))
        return h * 3600 + m * 60 + s
    return (sec(r[4]) - sec(r[3])) // 60


@SETTINGS
@given(requests_st)
def test_t1_t2_t5(spark, rows):
    data = build(rows)
    df = spark.createDataFrame(data, REQ)
    want_t1 = sorted(r[0] for r in data if r[6] == "APROBADA" and r[5] is not None and r[5] >= 25
                     and dt.date(2024, 7, 1) <= r[2] <= dt.date(2025, 6, 30))
    assert sorted(r[0] for r in filter_requests(df).collect()) == want_t1

    groups = {}
    for r in data:
        groups.setdefault(r[1], []).append(r)
    got = {r[S.ROOM_ID]: r for r in demand_by_room(df).collect()}
    assert set(got) == set(groups)
    for k, rs in groups.items():
        vals = [r[5] for r in rs if r[5] is not None]
        assert got[k][S.REQUEST_COUNT] == len(rs)
        assert got[k][S.MAX_ATTENDEES] == (max(vals) if vals else None)
        assert got[k][S.AVG_ATTENDEES] == (pytest.approx(sum(vals) / len(vals)) if vals else None)

    def key(r):  # nulls last for desc keys (Spark's DESC NULLS LAST)
        a = r[5]
        return (a is None, -(a or 0), -minutes(r), r[2], r[0])
    want_t5 = [r[0] for r in sorted(data, key=key)[:5]]
    assert [r[S.REQUEST_ID] for r in top_demand(df, 5).collect()] == want_t5


@SETTINGS
@given(requests_st)
def test_t3_t4_score(spark, rows):
    data = build(rows)
    df = join_rooms(spark.createDataFrame(data, REQ), rooms_df(spark))
    got = {r[S.REQUEST_ID]: r[S.PRIORITY_SCORE] for r in priority_score(df).collect()}
    want = {}
    for r in data:
        if r[1] not in CAPS:
            continue
        att, cap = r[5], CAPS[r[1]]
        if att is None:
            want[r[0]] = None
            continue
        occ = 1000 if att * 100 >= cap * 90 else 500 if att * 100 >= cap * 75 else 0
        lead = (r[2] - r[7].date()).days
        score = att * minutes(r) + occ + (300 if lead <= 7 else 0) + (200 if r[2].weekday() >= 5 else 0)
        want[r[0]] = score + (100 if r[6] == "APROBADA" else 0)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["g1", "g2", None]), st.one_of(st.none(), st.integers(-5, 5))),
                min_size=1, max_size=60))
def test_exact_median(spark, rows):
    df = spark.createDataFrame([(g, None if v is None else float(v)) for g, v in rows], "g string, v double")
    got = {r["g"]: (r["median"], r["n"]) for r in exact_median(df, ["g"], "v", partitions=3).collect()}
    want = {}
    for g, v in rows:
        if v is not None:
            want.setdefault(g, []).append(float(v))
    assert set(got) == set(want)
    for g, vs in want.items():
        assert got[g] == (pytest.approx(statistics.median(vs)), len(vs))


@SETTINGS
@given(requests_st)
def test_quality_rules(spark, rows):
    data = build(rows)
    rep = {r["rule"]: r["violations"] for r in
           booking_quality_report(spark.createDataFrame(data, REQ), rooms_df(spark)).collect()}
    assert rep["requests.room_exists"] == sum(1 for r in data if r[1] not in CAPS)
    assert rep["requests.within_capacity"] == sum(1 for r in data if r[1] in CAPS and r[5] is not None
                                                  and r[5] > CAPS[r[1]])
    assert rep["requests.positive_attendees"] == sum(1 for r in data if r[5] is not None and r[5] <= 0)
    assert rep["requests.required_values"] == sum(1 for r in data if r[1] is None or r[5] is None)


positions_st = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 3)),  # group, score (ties likely)
    min_size=0, max_size=60,
)


@SETTINGS
@given(rows=positions_st, parts=st.integers(1, 7), grouped=st.booleans())
def test_global_positions_equal_sorted_ranks(spark, rows, parts, grouped):
    from pyspark.sql import functions as F

    from bookdemand.operators.ranking import global_positions

    data = [(i, g, s) for i, (g, s) in enumerate(rows)]
    df = spark.createDataFrame(data, "id long, g string, s int")
    order = [F.col("s").desc(), F.col("id").asc()]
    got = {r["id"]: r["pos"] for r in global_positions(
        df, order, partition_cols=["g"] if grouped else (), out_col="pos", partitions=parts).collect()}
    want = {}
    groups = {}
    for i, g, s in data:
        groups.setdefault(g if grouped else 0, []).append((-s, i))
    for members in groups.values():
        for pos, (_, i) in enumerate(sorted(members), start=1):
            want[i] = pos
    assert got == want
