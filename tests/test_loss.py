"""Rows that must not vanish or multiply without a word."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from bookdemand import schemas as S
from bookdemand.functions.timeofday import minutes_between, seconds_by_pattern, try_seconds_of_day
from bookdemand.operators import filter_requests, join_rooms, priority_score
from bookdemand.operators.aggregates import pivot_wide
from bookdemand.operators.join import join_dimension, profile_dimension, salted_join
from bookdemand.operators.quality import booking_quality_report
from bookdemand.operators.scaling import metrics_long, require_ok, speedup_versus, unit_scaling
from bookdemand.sinks.files import write_landing_zone

REQUEST = dict(request_id="r1", room_id="a", booking_date="2024-07-03", start_time="09:00:00", end_time="10:00:00",
               attendees=30, status=S.APPROVED, created_at="2024-07-01T00:00:00Z")
ROOM = dict(room_id="a", code="A", name="n", capacity=40, state="s", active=True)


def requests_of(spark, *changes):
    rows = [{**REQUEST, **c} for c in changes]
    return spark.createDataFrame(pd.DataFrame(rows)).withColumn("booking_date", F.to_date("booking_date"))


def rooms_of(spark, *changes):
    return spark.createDataFrame(pd.DataFrame([{**ROOM, **c} for c in changes]))


def test_bounds_without_leading_zeros(spark, tmp_path):
    flat = requests_of(spark, {}, {"request_id": "r2", "booking_date": "2024-11-03"}, {"request_id": "r3", "booking_date": "2025-01-03"})
    write_landing_zone(flat, str(tmp_path / "z"))
    for frame in (flat, spark.read.parquet(str(tmp_path / "z"))):
        assert {r[0] for r in filter_requests(frame, start="2024-7-1", end="2024-11-30").collect()} == {"r1", "r2"}
    for bad in ("2024-7", "soon", "2024-13-01", ""):
        with pytest.raises(ValueError, match="calendar day"):
            filter_requests(flat, start=bad)


def test_pivot_takes_values_from_the_data_or_rejects_unlisted_ones(spark):
    df = spark.createDataFrame([(1, "click", 2.0), (1, "refund", 3.0), (2, None, 4.0)], "k int, t string, v double")
    wide = {r["k"]: r.asDict() for r in pivot_wide(df, ["k"], "t", None, "v").collect()}
    assert wide[1] == {"k": 1, "click": 2.0, "refund": 3.0} and wide[2] == {"k": 2, "click": None, "refund": None}
    with pytest.raises(Exception, match="refund"):
        pivot_wide(df, ["k"], "t", ["click"], "v").collect()
    with pytest.raises(ValueError, match="more than 1"):
        pivot_wide(df, ["k"], "t", None, "v", max_columns=1)


def test_series_without_reference_stay(spark):
    rows = [("e", "A", 1, 3, 8.0), ("e", "A", 2, 3, 5.0), ("e", "B", 2, 3, 5.0), ("e", "C", 1, 3, 0.0)]
    summary = spark.createDataFrame(rows, "engine string, operator string, units int, runs long, median_seconds double")
    scaled = unit_scaling(summary)
    assert {(r["operator"], r["units"]): r["status"] for r in scaled.collect()} == {
        ("A", 1): "ok", ("A", 2): "ok", ("B", 2): "no reference series", ("C", 1): "time not positive"}
    assert {r["operator"] for r in metrics_long(scaled).collect()} == {"A", "B", "C"}
    with pytest.raises(ValueError, match="e/B/2"):
        require_ok(scaled)
    against = {(r["operator"], r["units"]): (r["speedup"], r["status"]) for r in speedup_versus(summary, {"operator": "A"}, ["engine", "units"]).collect()}
    assert against == {("B", 2): (1.0, "ok"), ("C", 1): (None, "time not positive")}


def test_rewritten_dimension_is_measured_again(spark, tmp_path):
    path = tmp_path / "rooms.parquet"
    requests = requests_of(spark, {})
    pd.DataFrame([ROOM]).to_parquet(path)
    assert join_rooms(requests, spark.read.parquet(str(path))).count() == 1
    pd.DataFrame([ROOM, {**ROOM, "name": "again"}]).to_parquet(path)
    with pytest.raises(ValueError, match="many-to-one"):
        join_rooms(requests, spark.read.parquet(str(path)))


def test_nested_columns_count_with_their_size(spark):
    dim = spark.range(100).select("id", F.sequence(F.lit(1), F.lit(2000)).cast("array<double>").alias("v"))
    assert profile_dimension(dim, "id").value_bytes >= 100 * 2000 * 8
    plan = join_dimension(spark.range(5).withColumnRenamed("id", "k"), dim, fact_key="k", dim_key="id", columns=[("v", "v")],
                          max_broadcast_bytes=1_000_000)
    assert "BroadcastHashJoin" not in plan._jdf.queryExecution().executedPlan().toString()


def test_salted_join_with_a_hot_list_too_large_to_broadcast(spark):
    fact = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    dim = spark.range(7).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert salted_join(fact, dim, "k", salt_buckets=3, hot_key_rows=50).where("x = 2 * k").count() == 1000
    finally:
        spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)


def test_times_out_of_range(spark):
    df = spark.createDataFrame([("09:00:00", "99:99:99"), ("09:00:00", "1 :+5:-1"), ("09:00:00", "9:00"), ("09:00:00", "24:00:00")], "a string, b string")
    for row in df.collect():
        with pytest.raises(Exception, match="time of day"):
            spark.createDataFrame([row]).select(minutes_between("a", "b")).collect()
        with pytest.raises(Exception, match="time of day"):
            spark.createDataFrame([row]).select(minutes_between(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in df.select(try_seconds_of_day("b")).collect()] == [None] * 4
    assert df.select(seconds_by_pattern(F.lit("9:05"), "H:mm")).first()[0] == 9 * 3600 + 300
    with pytest.raises(Exception):
        df.select(seconds_by_pattern("b", "HH:mm:ss")).collect()


def test_score_of_text_instants_and_odd_status(spark):
    change = {"booking_date": "2024-09-10", "status": "it's \\"}
    early, late = "2024-09-02T22:00:00-05:00", "2024-09-02T22:00:00Z"  # UTC days 3 and 2: leads 7 and 8
    df = join_rooms(requests_of(spark, {**change, "created_at": early}, {**change, "created_at": late, "request_id": "r2"}), rooms_of(spark, {}))
    got = {r["request_id"]: r["priority_score"] for r in priority_score(df, approved="it's \\").collect()}
    assert got["r1"] - got["r2"] == 300
    assert got["r1"] - {r["request_id"]: r["priority_score"] for r in priority_score(df, approved="other").collect()}["r1"] == 100


def test_quality_report_counts_bad_rows(spark):
    bad = requests_of(spark, {}, {"request_id": "r2", "start_time": ""}, {"request_id": "r3", "start_time": "9:00"}, {"request_id": "r4", "end_time": "99:99:99"},
                      {"request_id": "r5", "room_id": "zz"}, {"request_id": "r1"})
    report = booking_quality_report(bad, rooms_of(spark, {}, {"room_id": "b", "capacity": -1, "code": "B"}), expected_requests=7, expected_rooms=2,
                                    request_columns=["room_id", *[c for c in bad.columns if c != "room_id"]])
    got = {r["rule"]: (r["violations"], r["sample"]) for r in report.collect()}
    assert got["requests.end_after_start"] == (3, "r2") and got["requests.required_values"] == (1, "r2")
    assert got["requests.room_exists"] == (1, "r5") and got["requests.unique_id"] == (2, "r1")
    assert got["requests.row_count"][0] == 1 and got["rooms.row_count"][0] == 0
    assert got["rooms.positive_capacity"] == (1, "b") and got["rooms.columns"] == (0, None)
    assert got["requests.columns"][0] == 2
