"""A replayable topic without a broker (SRC-5): segment files, offsets per partition.

Rows of one key go to one partition and have consecutive offsets there, in the order in
which they were published.  Segments are parquet files that hold a range of offsets of one
partition; the commit log of :mod:`bookdemand.sinks.snapshots` lists them, so that a
publication is seen whole or not at all, and each starts where the last one ended.

The streaming reader hands out offsets in steps of about ``maxBytesPerTrigger``.  Spark's
checkpoint alone decides what has been read: any range of offsets can be read again.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from bookdemand.operators.ranking import global_positions
from bookdemand.sinks.snapshots import PartWriter, Version, Written, local_path, publish, remove, resolve

FORMAT = "bookdemand_segments"
PARTITION, OFFSET = "_partition", "_offset"
SEGMENT_BYTES, SEGMENT_ROWS = 64 << 20, 1 << 20  # of a segment at most, uncompressed


def ends(version: Version) -> dict[int, int]:
    """The offset after the last one of each partition."""
    out: dict[int, int] = {}
    for f in version.files:
        out[f["partition"]] = max(out.get(f["partition"], 0), f["last"] + 1)
    return out


class SegmentWriter(DataSourceArrowWriter):
    """Rows arrive sorted by partition and offset; a file holds one run of offsets."""

    def __init__(self, options: dict, schema: StructType) -> None:
        self.root, self.schema = local_path(options["path"]), schema
        self.segment_bytes, self.segment_rows, self.expect = (int(options[k]) for k in ("segmentbytes", "segmentrows", "expect"))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        parts = PartWriter(self.root, self.segment_bytes)
        for batch in iterator:
            numbers, offsets = (batch.column(c).to_numpy() for c in (PARTITION, OFFSET))
            per_row = max(1, batch.nbytes // max(1, batch.num_rows))
            at = 0
            while at < batch.num_rows:
                number, first = int(numbers[at]), int(offsets[at])
                if parts.writer is not None and (parts.files[-1]["partition"], parts.files[-1]["last"] + 1) != (number, first):
                    parts.close()
                about = parts.files[-1] if parts.writer is not None else {"rows": 0, "bytes": 0}
                # to the end of the run, of the batch, or of the segment
                room = min(self.segment_rows - about["rows"], 1 + (self.segment_bytes - about["bytes"]) // per_row)
                run = int(np.searchsorted(numbers[at:], number, side="right"))
                n = max(1, min(room, run))
                parts.add(batch.slice(at, n), partition=number, first=first)
                parts.files[-1]["last"] = int(offsets[at + n - 1])
                if parts.files[-1]["rows"] >= self.segment_rows:
                    parts.close()
                at += n
        parts.close()
        return Written(parts.files)

    def commit(self, messages: list[Written | None]) -> None:
        publish(self.root, [f for m in messages if m is not None for f in m.files], self.schema, replace=False, expect=self.expect)

    def abort(self, messages: list[Written | None]) -> None:
        remove(self.root, [f for m in messages if m is not None for f in m.files])


@dataclass
class Range(InputPartition):
    """Offsets from ``start`` to before ``end`` of one segment."""

    file: str
    start: int
    end: int


class SegmentReader(DataSourceStreamReader):
    """Offsets are {partition: next offset}, as text for Spark's offset log."""

    def __init__(self, options: dict, schema: StructType) -> None:
        self.root, self.schema = local_path(options["path"]), schema
        self.step = int(options.get("maxbytespertrigger", 1 << 30))
        self.starting = options.get("startingoffsets", "earliest")
        # the file that says where admission stands, see latestOffset
        self.position = options.get("position")
        self.at: dict[str, int] | None = None

    def _files(self) -> list[dict]:
        return sorted(resolve(self.root).files, key=lambda f: (f["partition"], f["first"]))

    def initialOffset(self) -> dict:
        now = {str(p): n for p, n in ends(resolve(self.root)).items()}
        if self.starting == "latest":
            return now
        chosen = {} if self.starting == "earliest" else json.loads(self.starting)
        return {p: int(chosen.get(p, 0)) for p in {*now, *chosen}}

    def latestOffset(self) -> dict:
        """Without ``position`` the topic's end; with it a step further: whole segments,
        partitions in turn, until the step's bytes are full.

        A step starts where the last one ended, or, after a restart, where the position file
        says.  If that file is ahead of Spark's log a step is only longer: Spark reads from
        its own offset to the one returned here."""
        files = self._files()
        if not self.position:
            return {str(p): n for p, n in ends(resolve(self.root)).items()}
        if self.at is None:
            self.at = self._remembered() or self.initialOffset()
        waiting: dict[str, list[dict]] = {}
        for f in files:
            if f["last"] >= self.at.get(str(f["partition"]), 0):
                waiting.setdefault(str(f["partition"]), []).append(f)
        at, left = dict(self.at), self.step
        while left > 0 and waiting:
            for p in sorted(waiting, key=int):
                if left <= 0:
                    break
                f = waiting[p].pop(0)
                at[p], left = f["last"] + 1, left - f["bytes"]
                if not waiting[p]:
                    del waiting[p]
        if at != self.at:
            self._remember(at)
        return at

    def _remembered(self) -> dict[str, int] | None:
        where = local_path(self.position)
        if not os.path.exists(where):
            return None
        with open(where) as f:
            return json.load(f)

    def _remember(self, at: dict[str, int]) -> None:
        self.at, where = at, local_path(self.position)
        os.makedirs(os.path.dirname(where), exist_ok=True)
        draft = f"{where}.{uuid.uuid4().hex}"
        with open(draft, "x") as f:
            json.dump(at, f)
        os.replace(draft, where)

    def partitions(self, start: dict, end: dict) -> Sequence[Range]:
        if back := [p for p in start if end.get(p, 0) < start[p]]:
            raise RuntimeError(f"partitions {back} would go back: the file {self.position} is older than the query's checkpoint")
        out = []
        for f in self._files():
            lo, hi = max(f["first"], start.get(str(f["partition"]), 0)), min(f["last"] + 1, end.get(str(f["partition"]), 0))
            if lo < hi:
                out.append(Range(f"{self.root}/{f['file']}", lo, hi))
        return out or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        wanted = [f.name for f in self.schema.fields]
        for batch in pq.ParquetFile(partition.file).iter_batches(batch_size=16_384):
            offsets = batch.column(OFFSET)
            held = pc.and_(pc.greater_equal(offsets, partition.start), pc.less(offsets, partition.end))
            yield batch.select(wanted).filter(held)

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class SegmentTopic(DataSource):
    """``spark.readStream.format("bookdemand_segments").option("path", ...)``; options
    ``startingOffsets`` ("earliest", "latest" or {"partition": offset}),
    ``position`` (a file beside the query's checkpoint) and, with it, ``maxBytesPerTrigger``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        found = resolve(local_path(self.options["path"])).schema
        if found is None:
            raise ValueError(f"{self.options['path']} has no segments yet")
        return found

    def writer(self, schema: StructType, overwrite: bool) -> SegmentWriter:
        return SegmentWriter(self.options, schema)

    def streamReader(self, schema: StructType) -> SegmentReader:
        return SegmentReader(self.options, schema)


def publish_topic(
    df: DataFrame, path: str, *, key: Column, order: Sequence[Column], partitions: int, segment_bytes: int = SEGMENT_BYTES,
    segment_rows: int = SEGMENT_ROWS,
) -> None:
    """Append ``df`` to the topic at ``path``: rows of one ``key`` in one of ``partitions``
    partitions, offsets by ``order`` from the partition's end on.

    Offsets come from range partitions, so a partition of a third of all rows is written by
    many tasks.  If another publication came in between, this raises a conflict and adds
    nothing (the offsets would be taken twice)."""
    spark = df.sparkSession
    spark.dataSource.register(SegmentTopic)
    now = resolve(local_path(path))
    dealt = df.withColumn(PARTITION, F.pmod(F.xxhash64(key), F.lit(partitions)).cast("int"))
    ranked = global_positions(dealt, list(order), partition_cols=[PARTITION], out_col=OFFSET)
    base = F.lit(0)
    for number, end in sorted(ends(now).items()):
        base = F.when(F.col(PARTITION) == number, F.lit(end)).otherwise(base)
    numbered = ranked.withColumn(OFFSET, (F.col(OFFSET) - 1 + base).cast("long"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (numbered.repartitionByRange(width, PARTITION, OFFSET).sortWithinPartitions(PARTITION, OFFSET)
     .write.format(FORMAT).options(path=path, segmentBytes=str(segment_bytes), segmentRows=str(segment_rows), expect=str(now.version)).mode("append").save())


def topic_bytes(path: str) -> int:
    return sum(f["bytes"] for f in resolve(local_path(path)).files)


def topic_stream(spark: SparkSession, path: str, *, max_bytes: int, starting: str | dict[int, int] = "earliest", position: str | None = None) -> DataFrame:
    """The topic as a stream, with ``_partition`` and ``_offset``; ``max_bytes`` bounds a
    micro-batch if ``position`` names a file that lives as long as the query's checkpoint."""
    spark.dataSource.register(SegmentTopic)
    reader = spark.readStream.format(FORMAT).option("path", path).option("maxBytesPerTrigger", str(max_bytes))
    reader = reader.option("startingOffsets", starting if isinstance(starting, str) else json.dumps({str(p): n for p, n in starting.items()}))
    return (reader.option("position", position) if position else reader).load()
