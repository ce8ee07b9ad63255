import datetime as dt
import os

import pytest
from pyspark.sql.types import LongType, StructField, StructType

from bookdemand import schemas as S
from bookdemand.operators import filter_requests
from bookdemand.plans.inspect import plan_text
from bookdemand.sinks.files import (
    publish_staged, with_fixed_decimals, write_csv, write_landing_zone, write_outputs,
)
from bookdemand.sources.csv import read_parts, read_requests_csv, read_rooms_csv

REQ_HEADER = ",".join(S.PUBLISHED_REQUEST_HEADER)
ROOM_HEADER = ",".join(S.PUBLISHED_ROOM_HEADER)


def req_line(i, day="2024-09-02", start="09:00:00", created="2024-08-01T22:00:00-05:00"):
    return (f"r{i},p,t,A,m,h,{day},{start},10:30:00,30,Clase,APROBADA,{created},2024-08-02T00:00:00+00:00")


def write_text(path, lines):
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_published_csv_maps_to_canonical_types(spark, tmp_path):
    f = write_text(tmp_path / "req.csv", [REQ_HEADER, req_line(1), req_line(2, day="2025-07-01")])
    df = read_requests_csv(spark, f, S.PUBLISHED_REQUEST_HEADER)
    assert df.columns == S.REQUEST_COLUMNS
    rows = {r[S.REQUEST_ID]: r for r in df.collect()}
    assert rows["r1"][S.BOOKING_DATE] == dt.date(2024, 9, 2)
    # -05:00 offset: the UTC instant is on the next day
    assert rows["r1"][S.CREATED_AT] == dt.datetime(2024, 8, 2, 3, 0)
    assert [r[S.REQUEST_ID] for r in filter_requests(df).collect()] == ["r1"]
    rooms = write_text(tmp_path / "rooms.csv", [ROOM_HEADER,
                       "A,f,LAB-001,Lab 1,30,Redes,DISPONIBLE,true,2021-01-04T08:00:00+00:00,2022-01-01T08:00:00+00:00"])
    r = read_rooms_csv(spark, rooms, S.PUBLISHED_ROOM_HEADER).first()
    assert r[S.CAPACITY] == 30 and r[S.ACTIVE] is True


def test_malformed_record_fails_fast(spark, tmp_path):
    bad = req_line(1).replace(",30,", ",thirty,")
    f = write_text(tmp_path / "req.csv", [REQ_HEADER, bad])
    with pytest.raises(Exception):
        read_requests_csv(spark, f, S.PUBLISHED_REQUEST_HEADER).collect()


def test_reordered_header_rejected(spark, tmp_path):
    cols = list(S.PUBLISHED_REQUEST_HEADER)
    cols[0], cols[1] = cols[1], cols[0]
    f = write_text(tmp_path / "req.csv", [",".join(cols), req_line(1)])
    with pytest.raises(Exception):
        read_requests_csv(spark, f, S.PUBLISHED_REQUEST_HEADER).collect()


def test_part_directory_is_one_table(spark, tmp_path):
    df = spark.range(100).selectExpr("id", "id * 2 AS v").repartition(3)
    write_csv(df, str(tmp_path / "t"))
    back = read_parts(spark, str(tmp_path / "t"), df.schema)
    assert back.count() == 100
    os.makedirs(tmp_path / "empty")
    with pytest.raises(FileNotFoundError):
        read_parts(spark, str(tmp_path / "empty"), df.schema)


def test_staged_publish_replaces_atomically(spark, tmp_path):
    target = str(tmp_path / "out")
    publish_staged(spark.range(5), target, expected_rows=5)
    publish_staged(spark.range(7), target, expected_rows=7)
    assert spark.read.option("header", True).csv(target).count() == 7
    with pytest.raises(RuntimeError):
        publish_staged(spark.range(3), target, expected_rows=4)
    assert spark.read.option("header", True).csv(target).count() == 7   # old version kept
    assert not [p for p in os.listdir(tmp_path) if ".staging-" in p]
    done = write_outputs({"a": spark.range(2), "b": spark.range(3)}, str(tmp_path / "pub"))
    assert set(done) == {"a", "b"}


def test_reordered_header_is_rejected(spark, tmp_path):
    spark.createDataFrame([(1, 2)], "b long, a long").write.option("header", True).csv(str(tmp_path / "t"))
    with pytest.raises(Exception):
        read_parts(spark, str(tmp_path / "t"), StructType([StructField("a", LongType()), StructField("b", LongType())])).collect()


def test_failed_swap_keeps_the_old_table(spark, tmp_path, monkeypatch):
    from bookdemand.sinks import files

    target = str(tmp_path / "t")
    publish_staged(spark.range(3), target)
    real = files._fs

    class Broken:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            return False if ".staging-" in a.toString() else self.fs.rename(a, b)

    monkeypatch.setattr(files, "_fs", lambda s, p: (Broken(real(s, p)[0]), real(s, p)[1]))
    with pytest.raises(RuntimeError, match="could not move"):
        publish_staged(spark.range(9), target)
    assert spark.read.option("header", True).csv(target).count() == 3


def test_fixed_decimals(spark):
    df = spark.createDataFrame([(1, 0.1 + 0.2)], "k int, v double")
    assert with_fixed_decimals(df).first()["v"] == "0.300000000"


def test_landing_zone_prunes_months(spark, tmp_path):
    rows = [(f"r{i}", "A", dt.date(2024, 1 + i % 12, 5), "09:00:00", "10:00:00", 30, "APROBADA",
             dt.datetime(2024, 1, 1)) for i in range(48)]
    df = spark.createDataFrame(rows, "request_id string, room_id string, booking_date date, start_time string, "
                                     "end_time string, attendees int, status string, created_at timestamp")
    path = str(tmp_path / "lz")
    write_landing_zone(df, path)
    assert len([p for p in os.listdir(path) if p.startswith("booking_month=")]) == 12
    t1 = filter_requests(spark.read.parquet(path), start="2024-07-01", end="2024-09-30")
    assert t1.count() == 12
    pf = [line for line in plan_text(t1).splitlines() if "PartitionFilters" in line]
    assert pf and "booking_month" in pf[0] and ">= 2024-07" in pf[0]


def test_output_job_publishes_every_transformation(spark, tmp_path):
    from bookdemand.jobs import OUTPUT_NAMES, publish_booking_outputs
    from bookdemand.sources.tables import load_requests, load_rooms
    sf = "/root/testdata/sf0.001"
    done = publish_booking_outputs(load_requests(spark, sf), load_rooms(spark, sf), str(tmp_path / "out"),
                                   approved="F", start="1996-07-01", end="1997-06-30")
    assert set(done) == set(OUTPUT_NAMES.values())
    counts = {k: spark.read.option("header", True).csv(p).count() for k, p in done.items()}
    assert counts["T3_join"] == counts["T4_score"] == 1500 and counts["T5_top"] == 20


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    from bookdemand.operators import join_rooms
    from bookdemand.plans.inspect import exchange_count
    from bookdemand.sinks.files import write_bucketed
    from bookdemand.sources.tables import load_requests, load_rooms
    sf = "/root/testdata/sf0.001"
    write_bucketed(load_requests(spark, sf), "bk_requests", S.ROOM_ID, 8, str(tmp_path / "rq"))
    write_bucketed(load_rooms(spark, sf), "bk_rooms", S.ROOM_ID, 8, str(tmp_path / "rm"))
    joined = join_rooms(spark.table("bk_requests"), spark.table("bk_rooms"), strategy="merge")
    text = plan_text(joined, "simple")
    assert "SortMergeJoin" in text and exchange_count(joined) == 0
    assert joined.count() == 1500


def test_output_job_command_line(spark, tmp_path, capsys):
    from bookdemand.jobs import OUTPUT_NAMES, main

    reqs = write_text(tmp_path / "req.csv", [REQ_HEADER] + [req_line(i) for i in range(5)])
    rooms = write_text(tmp_path / "rooms.csv", [ROOM_HEADER,
                       "A,f,LAB-001,Lab 1,30,Redes,DISPONIBLE,true,2021-01-04T08:00:00+00:00,2022-01-01T08:00:00+00:00"])
    out = str(tmp_path / "out")
    assert main(["--requests", reqs, "--rooms", rooms, "--out", out, "--top", "3"]) == 0
    printed = dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())
    assert set(printed) == set(OUTPUT_NAMES.values())
    read = lambda name: spark.read.option("header", True).csv(printed[name])
    assert read("T1_filter").count() == 5 and read("T3_join").count() == 5
    assert read("T2_group").count() == 1 and read("T5_top").count() == 3
    assert "priority_score" in read("T4_score").columns


def test_a_table_that_is_rewritten_is_read_anew(spark, tmp_path):
    from bookdemand.sources.tables import read_table

    for n in (3, 5):
        spark.range(n).write.mode("overwrite").parquet(f"{tmp_path}/numbers.parquet")
        assert read_table(spark, str(tmp_path), "numbers").count() == n
    assert read_table(spark, str(tmp_path), "numbers") is read_table(spark, str(tmp_path), "numbers")
