"""T2 kept up to date by partition: only months whose files have changed are read again.

For every month of a landing zone the demand per room is kept as mergeable parts (counts,
sum, maximum), under the state of the month's files (names, lengths, times).  A refresh
lists the files, aggregates the months whose state is another one, and publishes the new
list of parts by one manifest: a reader sees the old demand or the new one.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookdemand import schemas as S
from bookdemand.sinks.snapshots import local_path, publish, resolve

PARTS = [S.ROOM_ID, "ids", "counted", "total", "top"]


def month_states(spark: SparkSession, zone: str) -> dict[str, str]:
    """A digest of the files of each month folder of ``zone`` (a listing; no data is read)."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(zone)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = {}
    for folder in fs.listStatus(root):
        name = folder.getPath().getName()
        if folder.isDirectory() and name.startswith(f"{S.BOOKING_MONTH}="):
            files = sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(folder.getPath())
                           if not f.getPath().getName().startswith(("_", ".")))
            out[name.split("=", 1)[1]] = hashlib.sha256(repr(files).encode()).hexdigest()
    return out


def refresh_demand(spark: SparkSession, zone: str, kept: str) -> list[str]:
    """Bring the parts at ``kept`` up to the landing zone's state; returns the months that were
    read.  Months that are gone from the zone go from the parts.  If another refresh was
    faster this raises a conflict and leaves its result."""
    states = month_states(spark, zone)
    now = resolve(local_path(kept))
    have = {f["month"]: f for f in now.files}
    changed = sorted(m for m, state in states.items() if have.get(m, {}).get("state") != state)
    gone = [m for m in have if m not in states]
    if not changed and not gone and now.version:
        return []
    files = [f for m, f in have.items() if m in states and m not in changed]
    rows = spark.read.option("basePath", zone).parquet(*[f"{zone.rstrip('/')}/{S.BOOKING_MONTH}={m}" for m in changed]) if changed else None
    schema = now.schema
    if rows is not None:
        parts = rows.groupBy(F.col(S.BOOKING_MONTH).cast("string").alias("month"), S.ROOM_ID).agg(
            F.count(S.REQUEST_ID).alias("ids"), F.count(S.ATTENDEES).alias("counted"), F.sum(S.ATTENDEES).alias("total"), F.max(S.ATTENDEES).alias("top"))
        folder = f"parts-{uuid.uuid4().hex}"
        parts.write.partitionBy("month").parquet(f"{kept.rstrip('/')}/{folder}")
        schema = parts.select(*PARTS).schema
        files += [{"file": f"{folder}/month={m}", "rows": 0, "month": m, "state": states[m]} for m in changed]
    publish(local_path(kept), sorted(files, key=lambda f: f["month"]), schema, replace=True, expect=now.version)
    return changed


def kept_demand(spark: SparkSession, kept: str) -> DataFrame:
    """T2 from the parts: what ``demand_by_room`` gives for the rows of the last refresh."""
    now = resolve(local_path(kept))
    if now.schema is None:
        raise ValueError(f"{kept} has not been refreshed yet")
    paths = [f"{kept.rstrip('/')}/{f['file']}" for f in now.files]
    parts = spark.read.schema(now.schema).parquet(*paths) if paths else spark.createDataFrame([], now.schema)
    return parts.groupBy(S.ROOM_ID).agg(
        F.sum("ids").alias(S.REQUEST_COUNT), (F.sum("total") / F.sum("counted")).alias(S.AVG_ATTENDEES), F.max("top").alias(S.MAX_ATTENDEES))
