"""Queries over what is written: snapshots, observed writes, quarantine, kept trees and sketches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookdemand import schemas as S
from bookdemand.operators.differences import differing_rows, hash_tree, leaf_width
from bookdemand.operators.maintained import kept_demand, refresh_demand
from bookdemand.operators.requests import filter_requests
from bookdemand.operators.sketches import quantiles, sketches, true_ranks
from bookdemand.plans.oracle_views import REQUESTS_CTE
from bookdemand.plans.registry import register
from bookdemand.session import scratch_path
from bookdemand.sinks.files import publish_staged, write_landing_zone
from bookdemand.sinks.snapshots import publish_snapshot, read_snapshot
from bookdemand.sources.quarantine import read_csv_quarantine
from bookdemand.sources.tables import YEAR_END, YEAR_START, load_requests, read_table

DEMAND_COLUMNS = [S.REQUEST_ID, S.ROOM_ID, S.ATTENDEES]


@register("snapshot_versions", f"""WITH {REQUESTS_CTE}
SELECT room_id, count(*) AS requests, sum(attendees)::BIGINT AS attendees,
       count(*) FILTER (request_id % 2 = 0) AS first_requests
FROM requests GROUP BY room_id""")
def snapshot_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-2, S-7: requests with an even key are version 1, the others are appended as version
    2; demand per room of the newest version beside the count of the first, still readable."""
    path = scratch_path(spark, "snapshots")
    requests = load_requests(spark, sf_dir).select(*DEMAND_COLUMNS)
    even = F.col(S.REQUEST_ID) % 2 == 0
    publish_snapshot(requests.where(even), path)
    publish_snapshot(requests.where(~even), path, mode="append")
    newest = read_snapshot(spark, path).withColumn("first", F.lit(0))
    first = read_snapshot(spark, path, 1).withColumn("first", F.lit(1))
    return newest.unionByName(first).groupBy(S.ROOM_ID).agg(
        F.count(F.when(F.col("first") == 0, 1)).alias("requests"), F.sum(F.when(F.col("first") == 0, F.col(S.ATTENDEES))).alias("attendees"),
        F.count(F.when(F.col("first") == 1, 1)).alias("first_requests"))


@register("observed_publish", f"""WITH {REQUESTS_CTE}
SELECT count(*) AS rows, sum(attendees)::BIGINT AS attendees, min(request_id) AS low, max(request_id) AS high,
       count(*) FILTER (room_id IS NULL) AS without_room, count(*) FILTER (attendees <= 0) AS not_positive, count(*) AS stored
FROM requests""")
def observed_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-5, DQ-7, DQ-13 while writing: control totals and rule counts observed on the rows as
    they are published; the last column counts what a reader finds."""
    path = scratch_path(spark, "observed")
    requests = load_requests(spark, sf_dir).select(*DEMAND_COLUMNS)
    metrics = {
        "attendees": F.sum(S.ATTENDEES), "low": F.min(S.REQUEST_ID), "high": F.max(S.REQUEST_ID),
        "without_room": F.count(F.when(F.col(S.ROOM_ID).isNull(), 1)), "not_positive": F.count(F.when(F.col(S.ATTENDEES) <= 0, 1)),
    }
    seen = publish_staged(requests, path, fmt="parquet", metrics=metrics,
                          check=lambda m: [n for n in ("without_room", "not_positive") if m[n]])
    row = [F.lit(seen.get(n)).cast("long").alias(n) for n in ("rows", *metrics)]
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("stored")).select(*row, "stored")


# The faults that the query plants: every 97th request loses a field, every 89th has no number
# of attendees, every 83rd no room, every 79th a day that is none.
_REASON = ("CASE WHEN request_id % 97 = 0 OR request_id % 89 = 0 THEN 'record' WHEN request_id % 83 = 0 THEN 'blank' "
           "WHEN request_id % 79 = 0 THEN 'booking_date' ELSE 'accepted' END")


@register("csv_quarantine", f"""WITH {REQUESTS_CTE}, r AS (SELECT *, {_REASON} AS reason FROM requests)
SELECT reason, count(*) AS records, CASE WHEN reason = 'accepted' THEN sum(attendees)::BIGINT ELSE 0 END AS attendees,
       CASE WHEN reason = 'accepted' THEN min(booking_date)::VARCHAR ELSE '' END AS first_day
FROM r GROUP BY reason""")
def csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DQ-1 … DQ-3 at the source: requests written as CSV with planted faults, read with a
    quarantine; records by reason, totals of the accepted ones."""
    path = scratch_path(spark, "csv-faults")
    key = F.col(S.REQUEST_ID)
    fields = [key.cast("string"), F.when(key % 83 == 0, "").otherwise(F.col(S.ROOM_ID).cast("string")),
              F.when(key % 79 == 0, "1996-13-41").otherwise(F.col(S.BOOKING_DATE).cast("string")),
              F.when(key % 89 == 0, "many").otherwise(F.col(S.ATTENDEES).cast("string"))]
    lines = load_requests(spark, sf_dir).select(F.when(key % 97 == 0, F.concat_ws(",", *fields[:3])).otherwise(F.concat_ws(",", *fields)).alias("line"))
    schema = f"{S.REQUEST_ID} long, {S.ROOM_ID} long, {S.BOOKING_DATE} string, {S.ATTENDEES} int"
    header = ",".join(c.split(" ")[0] for c in schema.split(", "))
    # one header line a file: a header row before each partition's lines
    ordered = lines.withColumn("turn", F.lit(1)).withColumn("part", F.spark_partition_id())
    headers = ordered.select("part").distinct().select(F.lit(header).alias("line"), F.lit(0).alias("turn"), "part")
    (ordered.unionByName(headers).repartition("part").sortWithinPartitions("part", "turn")
     .select("line", "part").write.partitionBy("part").text(path))
    found = read_csv_quarantine(spark, path, spark.createDataFrame([], schema).schema, required=[S.REQUEST_ID, S.ROOM_ID],
                                typed={S.BOOKING_DATE: F.expr(f"try_to_date({S.BOOKING_DATE}, 'yyyy-MM-dd')")})
    good = found.accepted.groupBy().agg(F.lit("accepted").alias("reason"), F.count(F.lit(1)).alias("records"), F.sum(S.ATTENDEES).alias("attendees"),
                                        F.min(S.BOOKING_DATE).cast("string").alias("first_day")).where("records > 0")
    bad = found.rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("records"), F.lit(0).cast("long").alias("attendees"), F.lit("").alias("first_day"))
    return good.unionByName(bad)


_T1_COLUMNS = "request_id, room_id, booking_date, start_time, end_time, attendees, status"
_T1 = (f"SELECT {_T1_COLUMNS} FROM requests WHERE attendees >= 25 AND booking_date BETWEEN DATE '{YEAR_START}' AND DATE '{YEAR_END}' AND status = ")


@register("difference_rows", f"""WITH {REQUESTS_CTE}, lhs AS ({_T1}'F'), rhs AS ({_T1}'O')
SELECT *, 'left' AS side, count(*) AS copies FROM (SELECT * FROM lhs EXCEPT ALL SELECT * FROM rhs) GROUP BY ALL
UNION ALL SELECT *, 'right', count(*) FROM (SELECT * FROM rhs EXCEPT ALL SELECT * FROM lhs) GROUP BY ALL""")
def difference_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """EQ-4, EQ-5 with names: the rows in which T1 for status 'F' and for 'O' differ."""
    requests = load_requests(spark, sf_dir)
    left, right = (filter_requests(requests, approved=s, start=YEAR_START, end=YEAR_END) for s in ("F", "O"))
    return differing_rows(left, right, S.REQUEST_ID)


@register("difference_rows_kept", """SELECT l_orderkey, l_linenumber, l_quantity, side, copies FROM (
  SELECT l_orderkey, l_linenumber, l_quantity, 'left' AS side, 1::BIGINT AS copies FROM lineitem WHERE l_orderkey % 1000 = 7
  UNION ALL SELECT l_orderkey, l_linenumber, l_quantity + 1, 'right', 1 FROM lineitem WHERE l_orderkey % 1000 = 7)""")
def difference_rows_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for two states of a table that are nearly equal (the lines of one order in a
    thousand have changed), with trees kept beside them: only ranges that differ are read."""
    path = scratch_path(spark, "states")
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    changed = lines.withColumn("l_quantity", F.when(F.col("l_orderkey") % 1000 == 7, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    states = []
    for name, df in (("before", lines), ("after", changed)):
        publish_staged(df.repartitionByRange("l_orderkey").sortWithinPartitions("l_orderkey"), f"{path}/{name}", fmt="parquet")
        states.append(spark.read.schema(df.schema).parquet(f"{path}/{name}"))
    bits = leaf_width(states[0], "l_orderkey")
    trees = tuple(hash_tree(df, "l_orderkey", leaf_bits=bits) for df in states)
    found = differing_rows(*states, "l_orderkey", trees=trees)
    return found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copy").withColumn("copies", F.lit(1).cast("long"))


@register("median_sketch", """SELECT event_type, r.rank, count(value) AS n, 0.01::DOUBLE AS rank_error, true AS "within"
FROM events, (SELECT unnest([0.25, 0.5, 0.9])::DOUBLE AS rank) r WHERE value IS NOT NULL GROUP BY event_type, r.rank""")
def median_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-6 from mergeable sketches: one kept for each event type and month, merged for three
    quantiles; the last column compares each answer's true rank with the error."""
    path = scratch_path(spark, "sketches")
    events = read_table(spark, sf_dir, "events").select("event_type", "value", F.date_format("ts", "yyyy-MM").alias("month"))
    sketches(events, ["event_type"], "value", period="month").write.partitionBy("month").parquet(path)
    answers = quantiles(spark.read.parquet(path), ["event_type"], [0.25, 0.5, 0.9])
    return true_ranks(events, answers, ["event_type"], "value").select("event_type", "rank", "n", "rank_error", "within")


@register("maintained_demand", f"""WITH {REQUESTS_CTE}, r AS (
  SELECT request_id, room_id, attendees + CASE WHEN strftime(booking_date, '%Y-%m') = '1995-03' THEN 1 ELSE 0 END AS attendees FROM requests)
SELECT room_id, count(request_id) AS request_count, avg(attendees) AS avg_attendees, max(attendees) AS max_attendees FROM r GROUP BY room_id""")
def maintained_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T2 kept up to date by partition: a landing zone by month, demand kept for it, one month
    written anew (everybody brings a guest), and a refresh that reads that month only."""
    path = scratch_path(spark, "maintained")
    requests = load_requests(spark, sf_dir).select(*DEMAND_COLUMNS, S.BOOKING_DATE)
    write_landing_zone(requests, f"{path}/zone")
    refresh_demand(spark, f"{path}/zone", f"{path}/kept")
    march = requests.where(F.date_format(S.BOOKING_DATE, "yyyy-MM") == "1995-03").withColumn(S.ATTENDEES, F.col(S.ATTENDEES) + 1)
    march.write.mode("overwrite").parquet(f"{path}/zone/{S.BOOKING_MONTH}=1995-03")
    read = refresh_demand(spark, f"{path}/zone", f"{path}/kept")
    if read != ["1995-03"]:
        raise RuntimeError(f"the refresh read {read}")
    return kept_demand(spark, f"{path}/kept")
