"""Stateful operators whose state belongs to the query (RocksDB or any store provider).

``late_windows`` keeps event-time windows open to correction until the watermark passes
their end and hands what comes later to a side output instead of dropping it;
``RankKeeper`` keeps a bounded ranked list per window with timers that expire it.
Both see a group's rows in Arrow batches and keep only bounded state: open windows per key, lists per window.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from bookdemand.operators.ranking import top_n_per_group

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
WINDOW, LATE = "window", "late"
COLUMNS = ["kind", "key", "start", "events", "counted", "total", "top", "row_id", "t"]
MERGE_ROWS = 1 << 16  # (event, window) pairs of a shard that wait to be added up


@contextmanager
def state_store(spark: SparkSession, provider: str = ROCKSDB) -> Iterator[None]:
    """Queries started inside keep their state in ``provider``; the session's own setting
    comes back afterwards."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, provider)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _windows_of(ts: np.ndarray, size: int, slide: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, window start) of every window that holds each instant (microseconds)."""
    last = ts - ts % slide
    n = -(-size // slide)
    starts = last[:, None] - slide * np.arange(n)[None, :]
    held = starts + size > ts[:, None]
    row, _ = np.nonzero(held)
    return row, starts[held]


class WindowKeeper(StatefulProcessor):
    """Open windows of the keys of one shard: (key, start, events, counted, total, top), kept as
    one Arrow table, so that a shard costs one read and one write of its state a batch however
    many keys it holds.  Sums and maxima run over arrays of all its keys."""

    SCHEMA = pa.schema([("key", pa.string()), ("start", pa.int64()), ("events", pa.int64()), ("counted", pa.int64()), ("total", pa.float64()), ("top", pa.float64())])

    def __init__(self, size: int, slide: int) -> None:
        self.size, self.slide = size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("open", "windows binary")

    def _held(self) -> dict[str, np.ndarray]:
        if not self.state.exists():
            return {f.name: np.empty(0, object if f.name == "key" else f.type.to_pandas_dtype()) for f in self.SCHEMA}
        table = pa.ipc.open_stream(bytes(self.state.get()[0])).read_all()
        return {c: table[c].to_numpy() for c in table.column_names}

    def _keep(self, held: dict[str, np.ndarray], watermark: int) -> int | None:
        """Store the windows that are still open; returns when a timer is to come for the first to close."""
        still = held["start"] + self.size > watermark
        if not still.any():
            self.state.clear()
            return None
        table = pa.table([pa.array(held[f.name][still], f.type, from_pandas=f.name == "key") for f in self.SCHEMA], schema=self.SCHEMA)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        self.state.update((sink.getvalue().to_pybytes(),))
        return (int(held["start"][still].min()) + self.size) // 1000 + 1

    @staticmethod
    def _added(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
        """One row for each (key, start) of ``parts``."""
        rows = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        if not len(rows["start"]):
            return rows
        code, keys = pd.factorize(rows["key"], use_na_sentinel=False)
        order = np.lexsort((rows["start"], code))
        code, start = code[order], rows["start"][order]
        first = np.flatnonzero(np.append(True, (code[1:] != code[:-1]) | (start[1:] != start[:-1])))
        best = {c: np.maximum.reduceat(rows[c][order], first) for c in ("top", "changed")}
        sums = {c: np.add.reduceat(rows[c][order], first) for c in ("events", "counted", "total")}
        return {"key": keys[code[first]], "start": start[first], **sums, **best}

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark, held = timerValues.getCurrentWatermarkInMs() * 1000, self._held()
        parts, waiting = [{**held, "changed": np.zeros(len(held["start"]), bool)}], 0
        for frame in rows:
            ts, value, known = frame["t"].to_numpy(np.int64), frame["value"].to_numpy(np.float64), frame["known"].to_numpy(bool)
            row, start = _windows_of(ts, self.size, self.slide)
            late = start + self.size <= watermark
            if late.any():
                behind = frame.iloc[row[late]]
                yield pd.DataFrame({"kind": LATE, "key": behind["key"].to_numpy(), "start": start[late], "events": 1, "counted": behind["known"].astype(int).to_numpy(),
                                    "total": behind["value"].to_numpy(), "top": behind["value"].to_numpy(),
                                    "row_id": behind["row_id"].to_numpy(), "t": behind["t"].to_numpy()})[COLUMNS]
            row, start = row[~late], start[~late]
            n = len(row)
            # without a value: nothing to the sum, and below every maximum
            parts.append({"key": frame["key"].to_numpy(object)[row], "start": start, "events": np.ones(n, np.int64), "counted": known[row].astype(np.int64),
                          "total": np.where(known, value, 0.0)[row], "top": np.where(known, value, -np.inf)[row], "changed": np.ones(n, bool)})
            waiting += n
            if waiting > max(MERGE_ROWS, len(parts[0]["start"])):
                parts, waiting = [self._added(parts)], 0
        held = self._added(parts)
        changed = np.flatnonzero(held["changed"])
        for some in (changed[k:k + MERGE_ROWS] for k in range(0, len(changed), MERGE_ROWS)):
            found = pd.DataFrame({c: held[c][some] for c in self.SCHEMA.names})
            top = found["top"].where(found["counted"] > 0)
            yield found.assign(kind=WINDOW, top=top, row_id=None, t=None)[COLUMNS]
        due = self._keep(held, watermark)
        timers = list(self.handle.listTimers())
        for t in timers:
            if t != due:
                self.handle.deleteTimer(t)
        if due is not None and due not in timers:
            self.handle.registerTimer(due)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        due = self._keep(self._held(), timerValues.getCurrentWatermarkInMs() * 1000)
        if due is not None:
            self.handle.registerTimer(due)
        return iter(())

    def close(self) -> None:
        pass


def late_windows(
    events: DataFrame, *, time_col: str, key: str, value_col: str, id_col: str, size_us: int, slide_us: int, watermark: str, shards: int = 64,
) -> DataFrame:
    """S-2 with late events tolerated: one stream of two kinds of rows.

    ``window`` rows (update mode): each time a window of ``key`` changes, its new count,
    sum and maximum; the last row of a window is its result.  An event corrects every
    window that holds it and whose end the watermark has not passed.
    ``late`` rows: the event (``row_id``, ``event_time``) once for each window that holds it
    and was closed before it came.  Every (event, window) pair is in exactly one of the two,
    so windows and late rows add up to the batch result.

    ``counted`` is the number of values that are not null (a null value counts as an event).
    The keys are dealt to ``shards`` lists of open windows, each read and written once a
    micro-batch: take so many that a shard's keys, times the (size + delay) / slide windows that
    each has open, fit a task many times over.  A checkpoint holds for one number of shards.  A timer
    removes windows when the watermark passes.  Rows with a null time are in no window and
    are left out, as a window function leaves them out.
    """
    # the copies carry no watermark mark: what is late arrives here and is not dropped
    slim = events.where(F.col(time_col).isNotNull()).withWatermark(time_col, watermark).select(
        F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(shards)).cast("int").alias("shard"),
        F.col(key).cast("string").alias("key"), F.unix_micros(F.col(time_col).cast("timestamp")).alias("t"),
        F.col(value_col).cast("double").alias("value"), F.col(value_col).isNotNull().alias("known"), F.col(id_col).cast("string").alias("row_id"))
    out = slim.groupBy("shard").transformWithStateInPandas(
        WindowKeeper(size_us, slide_us),
        outputStructType="kind string, key string, start long, events long, counted long, total double, top double, row_id string, t long",
        outputMode="update", timeMode="EventTime")
    instant = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return out.select("kind", instant(F.col("start")).alias("window_start"), instant(F.col("start") + size_us).alias("window_end"),
                      F.col("key").cast(events.schema[key].dataType).alias(key),
                      "events", "counted", "total", "top", F.col("row_id").cast(events.schema[id_col].dataType).alias(id_col), instant(F.col("t")).alias("event_time"))


class RankKeeper(StatefulProcessor):
    """The first ``n`` rows of one window (and shard), highest score first, then lowest id."""

    def __init__(self, columns: Sequence[str], schema: str, score: str, id_col: str, n: int) -> None:
        self.columns, self.schema, self.score, self.id_col, self.n = list(columns), schema, score, id_col, n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getListState("best", self.schema)

    def _first(self, frame: pd.DataFrame) -> pd.DataFrame:
        ordered = frame.sort_values([self.score, self.id_col], ascending=[False, True], na_position="last", kind="stable")
        return ordered.drop_duplicates(self.id_col).head(self.n)

    def _rows(self, key: tuple, frame: pd.DataFrame, kind: str) -> pd.DataFrame:
        return frame.assign(kind=kind, window=key[0], shard=key[1])[["kind", "window", "shard", *self.columns]]

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        ends, watermark = None, timerValues.getCurrentWatermarkInMs()
        held = pd.DataFrame(list(self.best.get()), columns=self.columns, dtype=object) if self.best.exists() else None
        before, changed = held, False
        for frame in rows:
            ends = int(frame["ends"].iloc[0])
            if ends <= watermark:
                yield self._rows(key, frame, LATE)
                continue
            few = self._first(frame[self.columns]).astype(object)
            held, changed = few if held is None else self._first(pd.concat([held, few])), True
        if not changed:
            return
        held = held.where(held.notna(), None)
        if before is None or list(held.itertuples(index=False, name=None)) != list(before.itertuples(index=False, name=None)):
            self.best.put(list(held.itertuples(index=False, name=None)))
            yield self._rows(key, held, WINDOW)
        if before is None:
            self.handle.registerTimer(ends)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.best.clear()
        return iter(())

    def close(self) -> None:
        pass


def ranked_windows(
    events: DataFrame, *, time_col: str, score: str, id_col: str, columns: Sequence[str], n: int, size: str, watermark: str, shards: int = 8,
) -> DataFrame:
    """S-5 as state of the query: the first ``n`` rows of each window by ``score`` (highest
    first, null last), then ``id_col`` (integer), which also tells copies of a row.

    Update mode: rows (kind 'window', window_start, shard, ``columns``) are the whole list
    of a window's shard whenever it changes; rows of kind 'late' came after the watermark had
    passed the window's end, when a timer had removed its list.  A window that holds a third of all
    rows is dealt to ``shards`` lists; :func:`ranking_of` merges them.  State: at most n rows
    a shard of each open window."""
    win = F.window(F.col(time_col), size)
    slim = events.where(F.col(time_col).isNotNull()).withWatermark(time_col, watermark).select(
        F.unix_micros(win["start"]).alias("window"), F.pmod(F.xxhash64(id_col), F.lit(shards)).cast("int").alias("shard"),
        F.unix_millis(win["end"]).alias("ends"), *columns)
    types = ", ".join(f"{c} {events.schema[c].dataType.simpleString()}" for c in columns)
    out = slim.groupBy("window", "shard").transformWithStateInPandas(
        RankKeeper(columns, types, score, id_col, n), outputStructType=f"kind string, window long, shard int, {types}",
        outputMode="update", timeMode="EventTime")
    return out.select("kind", F.timestamp_micros("window").cast("timestamp_ntz").alias("window_start"), "shard", *columns)


def ranking_of(changes: DataFrame, *, score: str, id_col: str, n: int, rank_col: str = "rank") -> DataFrame:
    """The ranking from the kept changes (with ``batch_id``): a shard's last list counts."""
    lists = changes.where(F.col("kind") == WINDOW)
    last = lists.groupBy("window_start", "shard").agg(F.max("batch_id").alias("batch_id"))
    rows = lists.join(last, ["window_start", "shard", "batch_id"]).drop("kind", "shard", "batch_id")
    return top_n_per_group(rows, ["window_start"], [F.col(score).desc_nulls_last(), F.col(id_col).asc()], n, rank_col)


def windows_of(changes: DataFrame, key: str) -> DataFrame:
    """Each window's last row from the kept changes (with ``batch_id``)."""
    rows = changes.where(F.col("kind") == WINDOW)
    about = F.struct("batch_id", "events", "counted", "total", "top")
    return rows.groupBy("window_start", "window_end", key).agg(F.max_by(about, "batch_id").alias("x")).select(
        "window_start", "window_end", key, "x.events", "x.counted", "x.total", "x.top")
