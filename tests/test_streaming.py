import datetime as dt

from pyspark.sql import functions as F

from bookdemand.streaming.core import (
    as_event_time, file_stream, idempotent_batch_sink, ranking_upsert_sink, run_available_now, windowed_demand,
)

SCHEMA = "event_id long, ts timestamp_ntz, user_id long, value double"


def write_file(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def t(h, m=0, day=1):
    return dt.datetime(2024, 1, day, h, m)


def test_late_event_dropped_one_batch_after_watermark_moves(spark, tmp_path):
    # The watermark moved by batch N is applied from batch N+2: the late row
    # is placed after one more on-time batch (observed Spark behaviour).
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    write_file(spark, src, [(1, t(0, 30), 7, 1.0)])                 # batch 0
    write_file(spark, src, [(2, t(10), 7, 1.0)])                     # batch 1
    write_file(spark, src, [(3, t(12), 7, 1.0)])                     # batch 2: watermark -> 11:00
    write_file(spark, src, [(4, t(12, 30), 7, 1.0)])                 # batch 3: on time
    write_file(spark, src, [(5, t(8), 7, 100.0)])                    # batch 4: 08:00 < 11:00 -> dropped
    write_file(spark, src, [(6, t(14), 7, 1.0)])                     # batch 5: watermark -> 13:00
    stream = as_event_time(file_stream(spark, src, spark.createDataFrame([], SCHEMA).schema,
                                       max_files_per_trigger=1), "ts")
    agg = windowed_demand(stream, time_col="ts", key="user_id", value_col="value", size="2 hours",
                          watermark="1 hour")
    q = run_available_now(agg, ck, sink_path=out)
    got = {r["window_start"]: (r["events"], r["max_value"]) for r in spark.read.parquet(out).collect()}
    assert got[t(0)] == (1, 1.0)
    assert got[t(10)] == (1, 1.0)                                    # closed once the watermark passed 12:00
    assert t(8) not in got                                           # the late row never opened a window
    assert t(12) not in got and t(14) not in got                     # still open at the end: not emitted
    dropped = sum(p["stateOperators"][0].get("numRowsDroppedByWatermark", 0)
                  for p in q.recentProgress if p.get("stateOperators"))
    assert dropped == 1


def test_restart_from_checkpoint_adds_nothing(spark, tmp_path):
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    write_file(spark, src, [(i, t(1), 1, float(i)) for i in range(10)])
    stream = file_stream(spark, src, spark.createDataFrame([], SCHEMA).schema)
    run_available_now(stream, ck, sink_path=out)
    run_available_now(file_stream(spark, src, spark.createDataFrame([], SCHEMA).schema), ck, sink_path=out)
    assert spark.read.parquet(out).count() == 10
    write_file(spark, src, [(99, t(2), 1, 1.0)])
    run_available_now(file_stream(spark, src, spark.createDataFrame([], SCHEMA).schema), ck, sink_path=out)
    assert spark.read.parquet(out).count() == 11


def test_idempotent_batch_sink_replay(spark, tmp_path):
    path = str(tmp_path / "sink")
    sink = idempotent_batch_sink(path)
    batch = spark.createDataFrame([(1, t(1), 1, 1.0), (2, t(1), 1, 2.0)], SCHEMA)
    sink(batch, 0)
    sink(batch, 0)  # replay of batch 0
    sink(batch.limit(1), 1)
    assert spark.read.parquet(path).count() == 3


def test_ranking_upsert_merges_batches_and_ignores_replays(spark, tmp_path):
    path = str(tmp_path / "rank")
    sink = ranking_upsert_sink(path, window_col="day", id_col="event_id",
                               order_cols=[F.col("value").desc(), F.col("event_id").asc()], n=2)
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    schema = "day date, event_id long, value double"
    b0 = spark.createDataFrame([(d1, 1, 5.0), (d1, 2, 1.0), (d2, 3, 2.0)], schema)
    b1 = spark.createDataFrame([(d1, 4, 3.0), (d1, 5, 9.0)], schema)
    sink(b0, 0)
    sink(b1, 1)
    sink(b1, 1)  # replayed batch
    got = sorted((r["day"], r["rank"], r["event_id"]) for r in spark.read.parquet(path).collect())
    assert got == [(d1, 1, 5), (d1, 2, 1), (d2, 1, 3)]


def test_processing_time_trigger(spark, tmp_path):
    from bookdemand.streaming.core import start_stream
    src, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    write_file(spark, src, [(i, t(1), 1, 1.0) for i in range(5)])
    q = start_stream(file_stream(spark, src, spark.createDataFrame([], SCHEMA).schema), ck, sink_path=out,
                     processing_time="1 second")
    try:
        q.processAllAvailable()
        write_file(spark, src, [(9, t(2), 1, 1.0)])
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(out).count() == 6


def test_ranking_upsert_reads_only_the_batch_span(spark, tmp_path):
    from bookdemand.plans.inspect import plan_text

    path = str(tmp_path / "rank")
    sink = ranking_upsert_sink(path, window_col="day", id_col="event_id",
                               order_cols=[F.col("value").desc(), F.col("event_id").asc()], n=1)
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    schema = "day date, event_id long, value double"
    sink(spark.createDataFrame([(d1, 1, 5.0), (d2, 2, 1.0), (d3, 3, 2.0)], schema), 0)
    sink(spark.createDataFrame([(d2, 4, 3.0), (None, 5, 1.0)], schema), 1)
    sink(spark.createDataFrame([], schema), 2)  # empty batch
    sink(spark.createDataFrame([(None, 6, 0.5), (d3, 7, 0.1)], schema), 3)
    got = sorted(((r["day"] or dt.date(1970, 1, 1)), r["event_id"]) for r in spark.read.parquet(path).collect())
    assert got == [(dt.date(1970, 1, 1), 5), (d1, 1), (d2, 4), (d3, 3)]
    # the sink's read of the stored rankings is a partition-pruned scan
    stored = spark.read.parquet(path).withColumn("day", F.col("day").cast("date"))
    text = plan_text(stored.filter(F.col("day").between(F.lit(d2), F.lit(d3))), "formatted")
    assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text


def _interrupted(spark, path, sink, batch, batch_id, monkeypatch):
    """Run a batch whose partition replacement fails after the journal's commit."""
    from bookdemand.streaming import core

    real = core._delete

    def fail(s, p):
        if p.endswith(".journal"):
            raise RuntimeError("lost")
        real(s, p)

    monkeypatch.setattr(core, "_delete", fail)
    try:
        sink(batch, batch_id)
    except RuntimeError:
        pass
    finally:
        monkeypatch.setattr(core, "_delete", real)


def test_ranking_survives_a_crash_while_replacing(spark, tmp_path, monkeypatch):
    import shutil

    path = str(tmp_path / "rank")
    sink = ranking_upsert_sink(path, window_col="day", id_col="event_id",
                               order_cols=[F.col("value").desc(), F.col("event_id").asc()], n=2)
    d1 = dt.date(2024, 1, 1)
    schema = "day date, event_id long, value double"
    sink(spark.createDataFrame([(d1, 1, 5.0), (d1, 2, 1.0)], schema), 0)
    again = spark.createDataFrame([(d1, 4, 3.0), (d1, 4, 3.0)], schema)
    _interrupted(spark, path, sink, again, 1, monkeypatch)
    shutil.rmtree(f"{path}/day=2024-01-01")  # as if the old partition went before the new one came
    sink(again, 1)
    got = sorted((r["rank"], r["event_id"]) for r in spark.read.parquet(path).collect())
    assert got == [(1, 1), (2, 4)]


def test_store_sink_replays_by_batch_id(spark, tmp_path):
    """A file-backed store: delete what the batch id wrote, then insert."""
    from bookdemand.streaming.core import store_batch_sink

    def store(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{tmp_path}/store/batch_id={batch_id}")

    sink = store_batch_sink(store, dedupe_keys=["event_id"])
    batch = spark.createDataFrame([(1, t(1), 1, 1.0), (1, t(1), 1, 1.0), (2, t(1), 1, 2.0)], SCHEMA)
    for _ in range(2):
        sink(batch, 0)
    sink(batch, 1)
    assert spark.read.parquet(f"{tmp_path}/store").groupBy("batch_id").count().orderBy("batch_id").collect() == [(0, 2), (1, 2)]


def test_one_and_many_batches_agree_and_late_rows_are_counted(spark, tmp_path):
    from bookdemand.sources.segments import publish_topic, topic_bytes, topic_stream
    from bookdemand.streaming.core import late_rows, run_to_end

    rows = [(k, t(0) + dt.timedelta(minutes=37 * ((k * 7919) % 500)), k % 5, float(k)) for k in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = []
    for order, batches in (("ts", 1), ("ts", 9), ("event_id", 9)):
        base = f"{tmp_path}/{order}{batches}"
        publish_topic(df, f"{base}/topic", key=F.lit(0), order=[F.col(order)], partitions=1, segment_rows=20)
        stream = topic_stream(spark, f"{base}/topic", max_bytes=topic_bytes(f"{base}/topic") // batches, position=f"{base}/at")
        agg = windowed_demand(as_event_time(stream, "ts"), time_col="ts", key="user_id", value_col="value", size="6 hours", watermark="1 hour")
        with late_rows(spark) as counter:
            q = run_to_end(agg, f"{base}/ck", sink_path=f"{base}/out")
            late = counter.of(q)
        assert (late > 0) == (order == "event_id")
        found.append(sorted(map(tuple, spark.read.parquet(f"{base}/out").collect())))
    assert found[0] == found[1] and found[0] and found[2] != found[0]
