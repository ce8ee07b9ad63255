"""The topic of segment files: offsets, replay, bounded admission, restarts."""

import os

import pytest
from pyspark.sql import functions as F

from bookdemand.sinks.snapshots import Conflict, resolve
from bookdemand.sources import segments as sg
from bookdemand.sources.segments import publish_topic, topic_bytes, topic_stream
from bookdemand.streaming.core import run_to_end


def rows(spark, start, n):
    return spark.range(start, start + n).select(F.col("id").alias("event"), (F.col("id") % 7).alias("room"), F.lit("é").alias("text"))


def publish(df, path, **kw):
    publish_topic(df, path, key=F.col("room"), order=[F.col("event")], partitions=3, **{"segment_rows": 50, **kw})


def read(spark, path, base, **kw):
    """All batches of one query: [(batch, rows)], and the rows."""
    sizes = []

    def keep(batch, k):
        batch.write.mode("overwrite").parquet(f"{base}/out/batch_id={k}")
        sizes.append((k, batch.count()))

    position = kw.pop("position", f"{base}/position")
    run_to_end(topic_stream(spark, path, position=position, **{"max_bytes": 1 << 30, **kw}), f"{base}/ck", foreach_batch=keep)
    return sizes, spark.read.parquet(f"{base}/out")


def test_offsets_are_dense_ordered_and_one_partition_holds_a_key(spark, tmp_path):
    path = f"file://{tmp_path}/topic"
    publish(rows(spark, 0, 1000), path)
    publish(rows(spark, 1000, 300), path)
    _, got = read(spark, path, tmp_path)
    assert got.count() == 1300 and got.select("event").distinct().count() == 1300
    assert got.groupBy("room").agg(F.count_distinct("_partition").alias("n")).where("n > 1").count() == 0
    for p, found in got.groupBy("_partition").agg(F.sort_array(F.collect_list(F.struct("_offset", "event"))).alias("x")).collect():
        assert [r["_offset"] for r in found] == list(range(len(found)))
        assert [r["event"] for r in found] == sorted(r["event"] for r in found)
    files = resolve(f"{tmp_path}/topic").files
    assert all(f["rows"] == f["last"] - f["first"] + 1 <= 50 for f in files)
    assert len(files) >= 26


def test_replay_from_any_offset_and_two_equal_reads(spark, tmp_path):
    path = f"{tmp_path}/topic"
    publish(rows(spark, 0, 600), path)
    ends = sg.ends(resolve(path))
    start = {p: n // 3 for p, n in ends.items()}
    found = []
    for k in range(2):
        _, got = read(spark, path, tmp_path / str(k), starting=start, max_bytes=2000)
        found.append(sorted(map(tuple, got.drop("batch_id").collect())))
    assert found[0] == found[1]
    assert len(found[0]) == sum(n - n // 3 for n in ends.values())
    assert min(r[4] for r in found[0] if r[3] == 1) == start[1]


def test_batches_are_bounded_and_a_restart_goes_on(spark, tmp_path):
    path = f"{tmp_path}/topic"
    publish(rows(spark, 0, 900), path)
    step = topic_bytes(path) // 6
    sizes, got = read(spark, path, tmp_path, max_bytes=step)
    assert len(sizes) >= 6 and got.count() == 900
    assert max(n for _, n in sizes) <= 900 // 6 + 2 * 50
    publish(rows(spark, 900, 100), path)
    more, got = read(spark, path, tmp_path, max_bytes=step)
    assert [k for k, _ in more] and min(k for k, _ in more) == len(sizes) and sum(n for _, n in more) == 100
    assert got.count() == got.select("event").distinct().count() == 1000
    # the position file ahead of the checkpoint: a longer step, nothing lost
    publish(rows(spark, 1000, 100), path)
    with open(f"{tmp_path}/position", "w") as f:
        f.write(str({str(p): n for p, n in sg.ends(resolve(path)).items()}).replace("'", '"'))
    publish(rows(spark, 1100, 50), path)
    _, got = read(spark, path, tmp_path, max_bytes=step)
    assert got.count() == got.select("event").distinct().count() == 1150
    # lost: the reader refuses to go back
    os.unlink(f"{tmp_path}/position")
    with pytest.raises(Exception, match="would go back"):
        read(spark, path, tmp_path, max_bytes=1)


def test_without_position_one_batch_and_no_second_publication_at_once(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/topic"
    publish(rows(spark, 0, 300), path)
    sizes, got = read(spark, path, tmp_path, position=None, max_bytes=1)
    assert len(sizes) == 1 and got.count() == 300
    old = resolve(path)
    publish(rows(spark, 300, 10), path)
    monkeypatch.setattr(sg, "resolve", lambda root: old)  # a publisher that has not seen the second
    with pytest.raises(Exception, match=Conflict.__name__):
        publish(rows(spark, 400, 10), path)
    monkeypatch.undo()
    assert sum(f["rows"] for f in resolve(path).files) == 310


def test_empty_publication_and_null_keys(spark, tmp_path):
    path = f"{tmp_path}/topic"
    publish(rows(spark, 0, 20).withColumn("room", F.when(F.col("event") > 9, F.col("room"))), path)
    publish(rows(spark, 0, 0), path)
    _, got = read(spark, path, tmp_path)
    assert got.count() == 20 and got.where("room is null").select("_partition").distinct().count() == 1
