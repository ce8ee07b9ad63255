import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from bookdemand.functions import (
    half_year_index, is_weekend, minutes_between, padded_code, tiered_bonus,
    time_text, uniform_int, utc_day, uuid5, weighted_choice,
)
from pyspark.sql.types import StringType


def one(df, expr):
    return df.select(expr.alias("x")).first()["x"]


def test_minutes_between_floors(spark):
    df = spark.createDataFrame([("09:00:00", "10:30:30"), ("10:30:30", "09:00:00")], "s string, e string")
    got = [r["m"] for r in df.select(minutes_between("s", "e").alias("m")).collect()]
    assert got == [90, -91]


def test_minutes_between_malformed_raises(spark):
    df = spark.createDataFrame([("9h", "10:00:00")], "s string, e string")
    with pytest.raises(Exception):
        df.select(minutes_between("s", "e")).collect()


def test_time_text(spark):
    df = spark.createDataFrame([(420,), (1140 + 180,)], "m int")
    assert [r[0] for r in df.select(time_text("m")).collect()] == ["07:00:00", "22:00:00"]


def test_utc_day_moves_with_offset(spark):
    df = spark.createDataFrame([("2024-01-01T22:00:00-05:00",), ("2024-01-01T22:00:00+00:00",)], "t string")
    got = [r[0] for r in df.select(utc_day("t", StringType())).collect()]
    assert got == [dt.date(2024, 1, 2), dt.date(2024, 1, 1)]


def test_weekend(spark):
    days = [dt.date(2024, 1, d) for d in (5, 6, 7, 8)]  # Fri Sat Sun Mon
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r[0] for r in df.select(is_weekend("d")).collect()] == [False, True, True, False]


def test_half_year_index(spark):
    df = spark.createDataFrame([(dt.date(2024, 6, 30),), (dt.date(2024, 7, 1),), (dt.date(2025, 12, 1),)], "d date")
    assert [r[0] for r in df.select(half_year_index("d", 2024)).collect()] == [0, 1, 3]


def test_tiered_bonus_edges(spark):
    rows = [(27, 30), (26, 30), (15, 20), (14, 20), (None, 20), (20, None)]
    df = spark.createDataFrame(rows, "a int, c int")
    got = [r[0] for r in df.select(tiered_bonus("a", "c", ((90, 1000), (75, 500)))).collect()]
    # 27/30 = 90 % exactly → top tier; 15/20 = 75 % exactly → second tier
    assert got == [1000, 500, 500, 0, 0, 0]


def test_uuid5_matches_python(spark):
    ns = uuid.uuid5(uuid.NAMESPACE_DNS, "example.org")
    names = ["room:0", "room:1", "ñandú:42", ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(uuid5(ns, F.col("n"))).collect()]
    assert got == [str(uuid.uuid5(ns, n)) for n in names]


def test_padded_code(spark):
    df = spark.createDataFrame([(7,), (40,)], "i int")
    assert [r[0] for r in df.select(padded_code("LAB-", "i", 3)).collect()] == ["LAB-007", "LAB-040"]


def test_draws_are_partition_independent(spark):
    a = spark.range(1000).repartition(3).select("id", uniform_int(7, "id", "x", 5, 45).alias("v"))
    b = spark.range(1000).repartition(11).select("id", uniform_int(7, "id", "x", 5, 45).alias("v"))
    ra = sorted(map(tuple, a.collect()))
    assert ra == sorted(map(tuple, b.collect()))
    assert min(v for _, v in ra) >= 5 and max(v for _, v in ra) <= 45


def test_weighted_choice_frequencies(spark):
    df = spark.range(20000).select(weighted_choice(3, "id", "s", ["a", "b", "c"], [70, 20, 10]).alias("s"))
    counts = {r["s"]: r["count"] for r in df.groupBy("s").count().collect()}
    assert set(counts) == {"a", "b", "c"}
    assert 0.66 < counts["a"] / 20000 < 0.74 and 0.08 < counts["c"] / 20000 < 0.12


def test_iso_formats(spark):
    from bookdemand.functions import iso_date, iso_instant
    df = spark.createDataFrame([(dt.datetime(2024, 1, 2, 3, 4, 5), dt.date(2024, 1, 2))], "t timestamp, d date")
    r = df.select(iso_instant("t").alias("i"), iso_date("d").alias("d")).first()
    assert r["i"] == "2024-01-02T03:04:05+00:00" and r["d"] == "2024-01-02"


def test_scale_settings():
    from bookdemand.session import scale_settings
    big = scale_settings(100 * 10**12, 8000)
    assert big["spark.sql.shuffle.partitions"] == "476838"  # 200 MiB each, no upper bound
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 256 << 20
    small = scale_settings(10 << 20, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
