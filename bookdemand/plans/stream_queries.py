"""Streaming queries over the warehouse tables (S-1 … S-8).

Each query publishes a whole table as a topic of segment files, streams it from
there in bounded micro-batches, eight at least, writes to a fresh folder under
the shared checkpoint directory, and returns the batch read of what the stream
committed — so the same SQL oracles apply.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bookdemand import schemas as S
from bookdemand.operators.join import join_rooms
from bookdemand.operators.requests import filter_requests, priority_score
from bookdemand.plans import booking_queries as BQ
from bookdemand.plans.registry import ORACLE_SQL, register
from bookdemand.session import scratch_path
from bookdemand.sources.segments import OFFSET, PARTITION, publish_topic, topic_bytes, topic_stream
from bookdemand.sources.tables import (
    APPROVED_STATUS, YEAR_END, YEAR_START, load_rooms, read_table, requests_from_orders,
)
from bookdemand.streaming.core import (
    as_event_time, dedup_within_watermark, idempotent_batch_sink, late_rows, ranking_upsert_sink, run_to_end, windowed_demand,
)
from bookdemand.streaming.stateful import late_windows, ranked_windows, ranking_of, state_store, windows_of

EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value"]
LEAST_BATCHES, BATCH_BYTES = 8, 1 << 30
HOUR_US = 3_600_000_000
LEAST_SHARDS, SHARD_ROWS = 64, 1 << 15


def _publish(df: DataFrame, base: str, order: Sequence[Column], *, key: Column | None = None, partitions: int = 1) -> int:
    """Append ``df`` to the topic under ``base``; without a key one partition, whose offsets
    are in order over all rows (its segments are still written and read by many tasks).
    Returns the number of rows."""
    rows = df.count()
    publish_topic(df, f"{base}/topic", key=F.lit(0) if key is None else key, order=order, partitions=partitions,
                  segment_rows=max(1, min(1 << 20, rows // (4 * LEAST_BATCHES * partitions))))
    return rows


def _stream(spark: SparkSession, base: str) -> DataFrame:
    """The topic under ``base``, in micro-batches of a bounded size, eight at least."""
    bound = min(BATCH_BYTES, max(1, topic_bytes(f"{base}/topic") // LEAST_BATCHES))
    return topic_stream(spark, f"{base}/topic", max_bytes=bound, position=f"{base}/_position/at").drop(PARTITION, OFFSET)


def _table_stream(spark: SparkSession, sf_dir: str, name: str, base: str, order: str) -> DataFrame:
    _publish(read_table(spark, sf_dir, name), base, [F.col(order)])
    return _stream(spark, base)


def _run_without_loss(stream: DataFrame, base: str) -> DataFrame:
    """Run to parquet; rows dropped as late are an error here, because the feed is within the watermark."""
    with late_rows(stream.sparkSession) as counter:
        query = run_to_end(stream, f"{base}/_checkpoint", sink_path=f"{base}/out")
        if late := counter.of(query):
            raise RuntimeError(f"{late} rows came after the watermark")
    return stream.sparkSession.read.parquet(f"{base}/out")


def _run_to_parquet(stream: DataFrame, base: str) -> DataFrame:
    run_to_end(stream, f"{base}/_checkpoint", sink_path=f"{base}/out")
    return stream.sparkSession.read.parquet(f"{base}/out")


@register("stream_filter", ORACLE_SQL["filter_select"])
def stream_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-1: T1 as a stateless filter over the orders stream."""
    base = scratch_path(spark, "stream-filter")
    requests = requests_from_orders(_table_stream(spark, sf_dir, "orders", base, "o_orderkey"))
    out = filter_requests(requests, approved=APPROVED_STATUS, start=YEAR_START, end=YEAR_END)
    return _run_to_parquet(out, base)


@register("stream_priority_score", ORACLE_SQL["priority_score"])
def stream_priority_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-3 + S-4: stream–static join to rooms (checked broadcast), then T4."""
    base = scratch_path(spark, "stream-score")
    requests = requests_from_orders(_table_stream(spark, sf_dir, "orders", base, "o_orderkey"))
    scored = priority_score(join_rooms(requests, load_rooms(spark, sf_dir)), approved=APPROVED_STATUS)
    return _run_to_parquet(scored, base)


@register("stream_static_join", """SELECT e.event_id, CAST(e.ts AS TIMESTAMP) AS ts, e.user_id AS room_id,
       e.event_type, e.value, m.code AS room_code, m.capacity
FROM events e JOIN (SELECT c_custkey AS room_id, printf('ROOM-%06d', c_custkey) AS code,
                           CAST(20 + c_custkey % 26 AS INTEGER) AS capacity FROM customer) m
  ON e.user_id = m.room_id""")
def stream_static_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-3: each event joined to its user's room (dimension broadcast only
    within the measured limit)."""
    base = scratch_path(spark, "stream-join")
    events = _table_stream(spark, sf_dir, "events", base, "event_id").select(
        "event_id", "ts", F.col("user_id").alias(S.ROOM_ID), "event_type", "value"
    )
    joined = join_rooms(events, load_rooms(spark, sf_dir))
    out = joined.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), S.ROOM_ID, "event_type",
                        "value", S.ROOM_CODE, S.CAPACITY)
    return _run_to_parquet(out, base)


@register("stream_window_demand", """WITH b AS (
  SELECT user_id, value,
         time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') - unnest([0, 1, 2, 3]) * INTERVAL 6 HOUR AS ws
  FROM events)
SELECT ws AS window_start, ws + INTERVAL 1 DAY AS window_end, user_id, count(*) AS events,
       round(avg(value), 9) AS avg_value, max(value) AS max_value
FROM b GROUP BY ws, user_id
HAVING ws + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""")
def stream_window_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-2: per user, 1-day windows sliding every 6 hours, 1-hour watermark;
    append mode emits each window once the watermark has passed its end.  The
    events come in time order, in micro-batches of a bounded size."""
    base = scratch_path(spark, "stream-window")
    _publish(read_table(spark, sf_dir, "events").select(*EVENT_COLS), base, [F.col("ts"), F.col("event_id")])
    out = windowed_demand(as_event_time(_stream(spark, base), "ts"), time_col="ts", key="user_id", value_col="value",
                          size="1 day", slide="6 hours", watermark="1 hour")
    res = _run_without_loss(out, base)
    return res.withColumn("avg_value", F.round("avg_value", 9))


@register("stream_dedup", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-8: an at-least-once feed deduplicated by event id within the watermark.  Every event
    comes twice, the second time up to 50 minutes after its own time, among later events."""
    base = scratch_path(spark, "stream-dedup")
    events = read_table(spark, sf_dir, "events").select(*EVENT_COLS)
    minutes = F.pmod(F.xxhash64("event_id"), F.lit(51))
    again = events.withColumn("_comes", F.expr("ts") + F.make_dt_interval(mins=minutes.cast("int")))
    feed = events.withColumn("_comes", F.col("ts")).unionByName(again)
    _publish(feed, base, [F.col("_comes"), F.col("event_id")])
    out = dedup_within_watermark(as_event_time(_stream(spark, base).drop("_comes"), "ts"), time_col="ts", keys=["event_id"], watermark="1 hour")
    return _run_without_loss(out.withColumn("ts", F.col("ts").cast("timestamp_ntz")), base)


@register("stream_rank", ORACLE_SQL["top_events_per_day"])
def stream_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-5: daily top 3 events maintained across micro-batches of a bounded
    size (the feed in event-id order, so that every batch touches many days)
    with an idempotent upsert per day."""
    base = scratch_path(spark, "stream-rank")
    _publish(read_table(spark, sf_dir, "events").select(*EVENT_COLS), base, [F.col("event_id")])
    stream = _stream(spark, base).select(F.to_date("ts").alias("day"), "event_id", "user_id", "event_type", "value")
    sink = ranking_upsert_sink(f"{base}/out", window_col="day", id_col="event_id",
                               order_cols=[F.col("value").desc(), F.col("event_id").asc()], n=3)
    run_to_end(stream, f"{base}/_checkpoint", foreach_batch=sink)
    return spark.read.parquet(f"{base}/out")


@register("stream_ranked_state", ORACLE_SQL["top_events_per_day"])
def stream_ranked_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-5 as state of the query (RocksDB): lists of 3 events a day and shard, removed by a
    timer when the day is over.  The query is stopped after half of the events and started
    again from its checkpoint for the rest."""
    base = scratch_path(spark, "stream-state")
    columns = ["event_id", "user_id", "event_type", "value"]
    events = read_table(spark, sf_dir, "events").select("ts", *columns)
    half = events.agg(F.expr("percentile_approx(unix_micros(CAST(ts AS TIMESTAMP)), 0.5)").alias("at")).first()["at"] or 0
    sink = idempotent_batch_sink(f"{base}/out")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    for part in (micros <= half, F.coalesce(micros > half, F.lit(True))):
        _publish(events.where(part), base, [F.col("ts"), F.col("event_id")])
        out = ranked_windows(as_event_time(_stream(spark, base), "ts"), time_col="ts", score="value", id_col="event_id", columns=columns,
                             n=3, size="1 day", watermark="1 hour", shards=4)
        with state_store(spark):
            run_to_end(out, f"{base}/_checkpoint", foreach_batch=sink, output_mode="update")
    ranking = ranking_of(spark.read.parquet(f"{base}/out"), score="value", id_col="event_id", n=3)
    return ranking.select(F.col("window_start").cast("date").alias("day"), *columns, "rank")


@register("stream_late_windows", """WITH b AS (
  SELECT user_id, value,
         time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01') - unnest([0, 1, 2, 3]) * INTERVAL 6 HOUR AS ws
  FROM events)
SELECT ws AS window_start, ws + INTERVAL 1 DAY AS window_end, user_id, count(*) AS events, round(sum(value), 6) AS total, max(value) AS top
FROM b GROUP BY ws, user_id""")
def stream_late_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S-2 with late events tolerated: 1-day windows sliding every 6 hours, 6-hour watermark,
    over a feed in which a fifth of the events comes 4 hours late (they correct their windows)
    and a tenth five days late (they go to the side output).  Corrected windows and late rows
    together are the batch result.  The users are dealt to shards of about ``SHARD_ROWS`` events
    each, so that the cost of a state's read and write does not come once for every user."""
    base = scratch_path(spark, "stream-late")
    events = read_table(spark, sf_dir, "events").select(*EVENT_COLS)
    turn = F.pmod(F.xxhash64("event_id"), F.lit(10))
    hours = F.when(turn == 0, 120).when(turn <= 2, 4).otherwise(0)
    feed = events.withColumn("_comes", F.expr("ts") + F.make_dt_interval(hours=hours))
    rows = _publish(feed, base, [F.col("_comes"), F.col("event_id")], key=F.col("user_id"), partitions=4)
    out = late_windows(as_event_time(_stream(spark, base).drop("_comes"), "ts"), time_col="ts", key="user_id", value_col="value", id_col="event_id",
                       size_us=24 * HOUR_US, slide_us=6 * HOUR_US, watermark="6 hours", shards=max(LEAST_SHARDS, rows // SHARD_ROWS))
    with state_store(spark):
        run_to_end(out, f"{base}/_checkpoint", foreach_batch=idempotent_batch_sink(f"{base}/out"), output_mode="update")
    changes = spark.read.parquet(f"{base}/out")
    columns = ["window_start", "window_end", "user_id", "events", "total", "top"]
    both = windows_of(changes, "user_id").select(*columns).unionByName(changes.where("kind = 'late'").select(*columns))
    return both.groupBy("window_start", "window_end", "user_id").agg(
        F.sum("events").alias("events"), F.round(F.sum("total"), 6).alias("total"), F.max("top").alias("top"))


@register("segment_demand", """SELECT l_partkey, count(*) AS lines, sum(l_quantity) AS quantity, max(l_quantity) AS top
FROM lineitem GROUP BY l_partkey""")
def segment_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-5 without a broker: lineitem as a topic keyed by part in eight partitions, read
    from its offsets in bounded micro-batches, demand per part kept in update mode."""
    base = scratch_path(spark, "segments")
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    _publish(lines, base, [F.col("l_orderkey"), F.col("l_linenumber")], key=F.col("l_partkey"), partitions=8)
    demand = _stream(spark, base).groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("quantity"), F.max("l_quantity").alias("top"))
    run_to_end(demand, f"{base}/_checkpoint", foreach_batch=idempotent_batch_sink(f"{base}/out"), output_mode="update")
    last = F.max_by(F.struct("lines", "quantity", "top"), "batch_id")
    return spark.read.parquet(f"{base}/out").groupBy("l_partkey").agg(last.alias("x")).select("l_partkey", "x.*")


del BQ  # imported so the batch oracles above are registered first
