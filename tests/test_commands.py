import pytest

from bookdemand import schemas as S
from bookdemand.commands import main
from bookdemand.operators.quality import booking_quality_report
from bookdemand.sources.csv import read_requests_csv, read_rooms_csv


def _printed(capsys):
    return dict(line.split("\t") for line in capsys.readouterr().out.strip().splitlines())


def test_generate_csv_reads_back_and_passes_every_rule(spark, tmp_path, capsys):
    out = str(tmp_path / "gen")
    assert main(["generate", "--rooms", "7", "--requests", "3000", "--seed", "11", "--out", out,
                 "--rows-per-partition", "500"]) == 0
    done = _printed(capsys)
    assert set(done) == {"rooms", "requests"}
    rooms = read_rooms_csv(spark, done["rooms"], S.PUBLISHED_ROOM_HEADER)
    reqs = read_requests_csv(spark, done["requests"], S.PUBLISHED_REQUEST_HEADER)
    rep = booking_quality_report(reqs, rooms, expected_requests=3000, expected_rooms=7)
    assert [(r["rule"], r["violations"]) for r in rep.collect() if r["violations"]] == []


def test_generate_parquet_matches_csv_content(spark, tmp_path, capsys):
    main(["generate", "--rooms", "5", "--requests", "800", "--seed", "3", "--out", str(tmp_path / "c")])
    csv = _printed(capsys)
    main(["generate", "--rooms", "5", "--requests", "800", "--seed", "3", "--out", str(tmp_path / "p"),
          "--format", "parquet"])
    pq = _printed(capsys)
    a = read_requests_csv(spark, csv["requests"], S.PUBLISHED_REQUEST_HEADER)
    b = spark.read.parquet(pq["requests"]).select(*a.columns)
    assert a.count() == 800 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_metrics_command_reproduces_published_t3_values(spark, tmp_path, capsys):
    lines = ["engine,operator,units,repetition,seconds"]
    lines += [f"pyspark,T3,{n},1,{t}" for n, t in {1: 1.3615029, 2: 0.7084963, 4: 0.8657363}.items()]
    lines += ["pandas,T3,1,1,0.2888583"]
    f = tmp_path / "raw.csv"
    f.write_text("\n".join(lines) + "\n")
    assert main(["metrics", "--timings", str(f), "--out", str(tmp_path / "m"), "--baseline", "engine=pandas"]) == 0
    done = _printed(capsys)
    assert set(done) == {"summary", "metrics", "speedup"}
    m = {(r["metric"], r["units"]): r["value"] for r in
         spark.read.option("header", True).csv(done["metrics"]).filter("engine = 'pyspark'").collect()}
    assert float(m[("speedup", "4")]) == pytest.approx(1.572653128, abs=1e-8)
    assert float(m[("serial_fraction", "4")]) == pytest.approx(0.514490837, abs=1e-8)
    assert len(m[("speedup", "4")].split(".")[1]) == 9  # nine decimals
    sp = {r["units"]: float(r["speedup"]) for r in spark.read.option("header", True).csv(done["speedup"]).collect()}
    assert sp["4"] == pytest.approx(0.333656218, abs=1e-8)


def test_compare_gate_passes_on_equal_tables_and_fails_on_a_change(spark, tmp_path, capsys):
    left = tmp_path / "left.csv"
    left.write_text("room_id,request_count,avg_attendees\nA,3,20.5\nB,2,11.0\n")
    parts = tmp_path / "right"
    parts.mkdir()
    (parts / "part-00000.csv").write_text("room_id,request_count,avg_attendees\nB,2,11.0\n")
    (parts / "part-00001.csv").write_text("room_id,request_count,avg_attendees\nA,3,20.5\n")
    args = ["compare", "--left", str(left), "--value", "request_count", "--key", "room_id"]
    assert main(args + ["--right", str(parts), "--out", str(tmp_path / "rep")]) == 0
    assert all(line.endswith("PASS") for line in capsys.readouterr().out.strip().splitlines())
    changed = tmp_path / "changed.csv"
    changed.write_text("room_id,request_count,avg_attendees\nA,3,20.5\nB,3,11.0\n")
    assert main(args + ["--right", str(changed)]) == 1
    status = dict(line.split("\t")[0::4] for line in capsys.readouterr().out.strip().splitlines())
    assert status["cardinality"] == "PASS" and status["control_sum"] == "FAIL" and status["same_rows"] == "FAIL"


def test_flow_generate_publish_compare_is_partition_independent(spark, tmp_path, capsys):
    from bookdemand.jobs import main as job

    outs = []
    for rpp in ("97", "1000"):
        base = tmp_path / f"run{rpp}"
        main(["generate", "--rooms", "6", "--requests", "2000", "--seed", "5", "--out", str(base / "data"),
              "--rows-per-partition", rpp])
        data = _printed(capsys)
        job(["--requests", data["requests"], "--rooms", data["rooms"], "--out", str(base / "out")])
        outs.append(_printed(capsys))
    a, b = outs
    assert main(["compare", "--left", a["T2_group"], "--right", b["T2_group"], "--value", "request_count",
                 "--key", "room_id"]) == 0
    assert main(["compare", "--left", a["T5_top"], "--right", b["T5_top"], "--value", "attendees",
                 "--key", "request_id"]) == 0
    capsys.readouterr()
