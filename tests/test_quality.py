import datetime as dt

import pytest

from bookdemand.operators.equivalence import (
    assert_equivalent, equivalence_report, ordered_check, row_multiset_check,
)
from bookdemand.operators.fingerprint import table_fingerprint
from bookdemand.operators.quality import (
    assert_fraction, booking_quality_report, missing_keys, raise_on_violations, referential_rule,
)
from pyspark.sql import functions as F

REQ = ("request_id string, room_id string, booking_date date, start_time string, end_time string, "
       "attendees int, status string, created_at timestamp")
ROOM = "room_id string, code string, name string, capacity int, state string, active boolean"
D, T = dt.date(2024, 9, 2), dt.datetime(2024, 8, 1)


def good(i, room="A", attendees=10, start="09:00:00", end="10:00:00", rid=None, status="APROBADA"):
    return (rid or f"r{i}", room, D, start, end, attendees, status, T)


def report(spark, reqs, rooms, **kw):
    rep = booking_quality_report(spark.createDataFrame(reqs, REQ), spark.createDataFrame(rooms, ROOM), **kw)
    return {r["rule"]: (r["checked"], r["violations"]) for r in rep.collect()}


ROOMS = [("A", "LAB-001", "Lab", 30, "DISPONIBLE", True), ("B", "LAB-002", "Lab", 20, "OCUPADO", True)]


def test_clean_data_passes(spark):
    rep = report(spark, [good(1), good(2, room="B")], ROOMS, expected_requests=2, expected_rooms=2)
    assert all(v == 0 for _, v in rep.values()), rep
    assert rep["requests.unique_id"] == (2, 0)


def test_each_rule_catches_its_violation(spark):
    reqs = [
        good(1), good(2, rid="r1"),                      # duplicate request id (2 rows)
        good(3, room="Z"),                               # orphan room
        good(4, start="10:00:00", end="10:00:00"),       # end not after start
        good(5, attendees=0),                            # non-positive attendees
        good(6, room="B", attendees=25),                 # over capacity 20
        good(7, status="  "),                            # blank required value
    ]
    rooms = ROOMS + [("A", "LAB-009", "Dup", 30, "DISPONIBLE", True),   # duplicate room id
                     ("C", "LAB-001", "Lab", 0, "DISPONIBLE", True),    # duplicate code, capacity 0
                     ("D", "LAB-004", None, 10, "OCUPADO", True)]       # null name
    rep = report(spark, reqs, rooms, expected_requests=99, expected_rooms=5)
    assert rep["requests.unique_id"][1] == 2
    assert rep["requests.room_exists"][1] == 1
    assert rep["requests.end_after_start"][1] == 1
    assert rep["requests.positive_attendees"][1] == 1
    assert rep["requests.within_capacity"][1] == 1
    assert rep["requests.required_values"][1] == 1
    assert rep["requests.row_count"] == (7, 1)
    assert rep["rooms.unique_id"][1] == 2
    assert rep["rooms.unique_code"][1] == 2
    assert rep["rooms.positive_capacity"][1] == 1
    assert rep["rooms.required_values"][1] == 1
    assert rep["rooms.row_count"] == (5, 0)
    with pytest.raises(ValueError, match="data-quality rules failed"):
        raise_on_violations(booking_quality_report(spark.createDataFrame(reqs, REQ), spark.createDataFrame(rooms, ROOM)))


def test_schema_rule_detects_order(spark):
    reqs = spark.createDataFrame([good(1)], REQ)
    swapped = reqs.select("room_id", "request_id", *reqs.columns[2:])
    rep = booking_quality_report(swapped, spark.createDataFrame(ROOMS, ROOM), request_columns=reqs.columns)
    got = {r["rule"]: r["violations"] for r in rep.collect()}
    assert got["requests.columns"] == 2


def test_referential_counts_null_keys(spark):
    fact = spark.createDataFrame([("A",), (None,), ("Q",), ("Q",)], "k string")
    dim = spark.createDataFrame([("A",)], "k string")
    r = referential_rule(fact, dim, "k", "x").first()
    assert (r["checked"], r["violations"]) == (4, 3)


def test_missing_keys_and_fraction(spark):
    want = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    have = spark.createDataFrame([(2,)], "k int")
    assert sorted(r[0] for r in missing_keys(want, have, ["k"]).collect()) == [1, 3]
    assert_fraction(spark.createDataFrame([(0.5,), (None,)], "f double"), "f")
    with pytest.raises(ValueError):
        assert_fraction(spark.createDataFrame([(1.5,)], "f double"), "f")


def test_fingerprint_ignores_order_and_partitioning(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("m"))
    a = table_fingerprint(df.repartition(3)).first()
    b = table_fingerprint(df.orderBy(F.col("id").desc()).repartition(9)).first()
    c = table_fingerprint(df.filter("id != 3")).first()
    assert a == b and a["rows"] == 500 and c["fingerprint"] != a["fingerprint"]


def test_equivalence_report(spark):
    left = spark.createDataFrame([("A", 1.0), ("A", 2.0), (None, 3.0)], "k string, v double")
    same = spark.createDataFrame([(None, 3.0), ("A", 2.0), ("A", 1.0)], "k string, v double")
    other = spark.createDataFrame([("A", 1.0), ("B", 2.0), (None, 3.0)], "k string, v double")
    assert_equivalent(equivalence_report(left, same, value_col="v", keys=["k"]))
    rep = {r["check"]: r for r in equivalence_report(left, other, value_col="v", keys=["k"]).collect()}
    assert rep["cardinality"]["status"] == "PASS" and rep["control_sum"]["status"] == "PASS"
    assert rep["counts_per_key"]["differing"] == 2 and rep["counts_per_key"]["status"] == "FAIL"
    assert rep["same_rows"]["differing"] == 2
    with pytest.raises(AssertionError, match="counts_per_key"):
        assert_equivalent(equivalence_report(left, other, value_col="v", keys=["k"]))


def test_multiset_and_order(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (2,)], "x int")
    assert row_multiset_check(a, b).first()["differing"] == 2
    top1 = spark.createDataFrame([("r1", 5), ("r2", 4)], "id string, s int")
    top2 = spark.createDataFrame([("r2", 5), ("r1", 4)], "id string, s int")
    assert ordered_check(top1, top1, [F.col("s").desc(), F.col("id")], "id").first()["status"] == "PASS"
    assert ordered_check(top1, top2, [F.col("s").desc(), F.col("id")], "id").first()["status"] == "FAIL"
