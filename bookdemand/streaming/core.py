"""Streaming building blocks.

The batch operators are reused unchanged on streaming DataFrames wherever
they are stateless (T1 filter, T4 score, the stream–static join); the
stateful parts are event-time windows with a watermark, deduplication within
the watermark, and a per-window ranking kept idempotent in ``foreachBatch``.
State and output live under the shared checkpoint folder.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StructType, TimestampNTZType

from bookdemand.operators.ranking import top_n_per_group


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)


def file_stream(
    spark: SparkSession,
    directory: str,
    schema: StructType,
    *,
    fmt: str = "parquet",
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A replayable file source (S-7): files are offsets, so a restart from
    the checkpoint re-reads exactly the files of an unfinished batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory)


def kafka_stream(spark: SparkSession, servers: str, topic: str, *, starting_offsets: str = "earliest") -> DataFrame:
    """SRC-5: a replayable topic keyed by room (needs the spark-sql-kafka
    package on the classpath; offsets are tracked in the query checkpoint).
    Returns ``key``, ``value`` (text), ``partition``, ``offset``, ``timestamp``."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .load()
    )
    return raw.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
        "partition", "offset", "timestamp",
    )


def as_event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need TIMESTAMP; a TIMESTAMP_NTZ column is read as UTC."""
    if isinstance(df.schema[column].dataType, TimestampNTZType):
        return df.withColumn(column, F.col(column).cast("timestamp"))
    return df


def windowed_demand(
    events: DataFrame,
    *,
    time_col: str,
    key: str,
    value_col: str,
    size: str,
    slide: str | None = None,
    watermark: str = "1 hour",
) -> DataFrame:
    """S-2: T2 per key over sliding event-time windows.

    The watermark bounds the state: a window is final — and emitted in
    append mode — once the watermark passes its end; events later than that
    are dropped and counted in the query progress.
    """
    win = F.window(F.col(time_col), size, slide) if slide else F.window(F.col(time_col), size)
    return (
        events.withWatermark(time_col, watermark)
        .groupBy(win.alias("window"), F.col(key))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.avg(value_col).alias("avg_value"),
            F.max(value_col).alias("max_value"),
        )
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"),
            F.col("window.end").cast("timestamp_ntz").alias("window_end"),
            key, "events", "avg_value", "max_value",
        )
    )


def dedup_within_watermark(events: DataFrame, *, time_col: str, keys: Sequence[str], watermark: str) -> DataFrame:
    """S-8: drop replays of a key seen within the watermark delay; the
    state for a key is dropped once the watermark passes."""
    return events.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(list(keys))


def idempotent_batch_sink(path: str, *, fmt: str = "parquet") -> Callable[[DataFrame, int], None]:
    """S-7: each micro-batch overwrites its own ``batch_id=<id>`` folder, so
    a batch replayed after a failure replaces — never duplicates — its rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/batch_id={batch_id}")

    return write


def store_batch_sink(
    write_batch: Callable[[DataFrame, int], None], *, dedupe_keys: Sequence[str] | None = None,
) -> Callable[[DataFrame, int], None]:
    """SNK-7: hand every micro-batch and its id to an operational-store writer.

    A batch may come again after a failure, under the same id: the writer
    first removes what it stored under that id, then inserts (delete-then-
    insert by ``batch_id``), so that a replay neither doubles nor fails.  With
    ``dedupe_keys`` a batch is deduplicated before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.dropDuplicates(list(dedupe_keys)) if dedupe_keys else batch, batch_id)

    return write


def _delete(spark: SparkSession, path: str) -> None:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def ranking_upsert_sink(
    path: str,
    *,
    window_col: str,
    id_col: str,
    order_cols: Sequence[Column],
    n: int,
) -> Callable[[DataFrame, int], None]:
    """S-5: keep the top ``n`` per window across micro-batches.

    Per batch: the stored top-n of the windows this batch touches is merged
    with the batch rows (only the partitions inside the batch's window range
    are read), rows beyond the ``n``-th place are cut before the shuffle,
    copies by ``id_col`` (equal under the total order) are dropped among the
    few that are left, and only those windows' partitions are replaced.
    State per window is ≤ n rows.

    The new rankings are committed to a journal beside ``path`` first and
    copied from there.  A crash while partitions are being replaced leaves
    the journal, and the next batch (or the replay) copies it again before
    anything else; a replayed batch changes nothing.
    """
    journal = f"{path.rstrip('/')}.journal"

    def apply_journal(spark: SparkSession) -> None:
        spark.read.parquet(journal).write.mode("overwrite").option("partitionOverwriteMode", "dynamic") \
            .partitionBy(window_col).parquet(path)
        _delete(spark, journal)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if _exists(spark, f"{journal}/_SUCCESS"):
            apply_journal(spark)
        elif _exists(spark, journal):
            _delete(spark, journal)  # a batch that did not get as far as committing
        w = F.col(window_col)
        batch = batch.persist()
        try:
            # the batch's window range (one row) prunes the stored partitions
            # statically, so a batch reads the windows it touches, not the history
            span = batch.agg(F.min(w).alias("lo"), F.max(w).alias("hi"),
                             F.count(F.when(w.isNull(), F.lit(1))).alias("nulls")).first()
            if span["lo"] is None and span["nulls"] == 0:
                return  # empty batch: nothing to merge
            touched = batch.select(window_col).distinct()
            merged = batch
            if _exists(spark, path):
                stored = spark.read.schema(batch.schema).parquet(path)
                in_span = w.between(F.lit(span["lo"]), F.lit(span["hi"])) if span["lo"] is not None else F.lit(False)
                stored = stored.filter(in_span | w.isNull() if span["nulls"] else in_span)
                # null-safe: a null window is a group of its own, as in the ranking itself
                in_touched = stored[window_col].eqNullSafe(touched[window_col])
                merged = batch.unionByName(stored.join(touched, on=in_touched, how="left_semi"))
            # copies of a row tie: the places count distinct rows
            place = F.dense_rank().over(Window.partitionBy(window_col).orderBy(*order_cols))
            few = merged.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")
            ranked = top_n_per_group(few.dropDuplicates([id_col]), [window_col], list(order_cols), n)
            ranked.write.mode("overwrite").parquet(journal)
        finally:
            batch.unpersist()
        apply_journal(spark)

    return write


class LateRows(StreamingQueryListener):
    """Counts the rows that stateful operators drop as late, over all batches of a query
    (``recentProgress`` keeps the last hundred only)."""

    def __init__(self) -> None:
        self.dropped: dict[str, int] = {}
        self.ended: dict[str, threading.Event] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        late = sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)
        self.dropped[run] = self.dropped.get(run, 0) + late

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def of(self, query: StreamingQuery, timeout: float = 120.0) -> int:
        """Rows dropped by ``query``, which must have ended; its events come in order, its end last."""
        run = str(query.runId)
        if not self.ended.setdefault(run, threading.Event()).wait(timeout):
            raise RuntimeError("the query's progress did not arrive")
        return self.dropped.get(run, 0)


@contextmanager
def late_rows(spark: SparkSession) -> Iterator[LateRows]:
    """A counter of late rows for the queries that run inside."""
    listener = LateRows()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def run_to_end(
    stream: DataFrame,
    checkpoint: str,
    *,
    sink_path: str | None = None,
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    output_mode: str = "append",
) -> StreamingQuery:
    """Process what a topic holds now, batch after batch, then stop.

    For sources that bound their own micro-batches (:mod:`bookdemand.sources.segments`);
    batches without data run too, so that timers fire."""
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if foreach_batch is not None:
        writer = writer.foreachBatch(foreach_batch)
    else:
        writer = writer.format("parquet").option("path", sink_path)
    query = writer.trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def run_available_now(
    stream: DataFrame,
    checkpoint: str,
    *,
    sink_path: str | None = None,
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    output_mode: str = "append",
    fmt: str = "parquet",
) -> StreamingQuery:
    """Process everything available now in micro-batches, then stop (S-6:
    production would use ``trigger(processingTime='30 seconds')``)."""
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if foreach_batch is not None:
        writer = writer.foreachBatch(foreach_batch)
    else:
        writer = writer.format(fmt).option("path", sink_path)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return query


def start_stream(
    stream: DataFrame,
    checkpoint: str,
    *,
    sink_path: str | None = None,
    foreach_batch: Callable[[DataFrame, int], None] | None = None,
    output_mode: str = "append",
    processing_time: str = "30 seconds",
    fmt: str = "parquet",
    name: str | None = None,
) -> StreamingQuery:
    """S-6: a long-running query with a processing-time trigger (the
    production form of ``run_available_now``); the caller owns ``stop()``."""
    writer = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if foreach_batch is not None:
        writer = writer.foreachBatch(foreach_batch)
    else:
        writer = writer.format(fmt).option("path", sink_path)
    return writer.trigger(processingTime=processing_time).start()
