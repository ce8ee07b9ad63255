"""One key holding a third (or more) of all rows."""

import pytest
from pyspark.sql import functions as F

from bookdemand import schemas as S
from bookdemand.operators import demand_by_room, join_rooms, top_n_per_group
from bookdemand.operators.quantiles import exact_median, value_pieces


@pytest.fixture(scope="module")
def skewed(spark):
    # 9000 requests, 3600 (40 %) on room 0, the rest spread over 60 rooms
    return spark.range(9000).select(
        F.col("id").alias(S.REQUEST_ID),
        F.when(F.col("id") % 5 < 2, F.lit(0)).otherwise(1 + F.col("id") % 60).alias(S.ROOM_ID),
        (5 + F.col("id") % 41).cast("int").alias(S.ATTENDEES),
        (F.col("id") * 7 % 9001).cast("double").alias("v"),  # all distinct: the hot group stays hot
    )


def rooms(spark):
    return spark.range(61).select(
        F.col("id").alias(S.ROOM_ID), F.format_string("R%02d", "id").alias(S.CODE), F.lit("n").alias(S.NAME),
        F.lit(30).alias(S.CAPACITY), F.lit("OK").alias(S.STATE), F.lit(True).alias(S.ACTIVE),
    )


def test_hot_key_aggregate(skewed):
    got = {r[S.ROOM_ID]: r[S.REQUEST_COUNT] for r in demand_by_room(skewed).collect()}
    assert got[0] == 3600 and sum(got.values()) == 9000


def test_salted_join_spreads_hot_key_and_keeps_every_row(spark, skewed):
    plain = join_rooms(skewed, rooms(spark), strategy="merge")
    salted = join_rooms(skewed, rooms(spark), strategy="salted", hot_key_rows=1000, salt_buckets=8)
    cols = [S.REQUEST_ID, S.ROOM_ID, S.ROOM_CODE]
    assert sorted(map(tuple, plain.select(*cols).collect())) == sorted(map(tuple, salted.select(*cols).collect()))
    assert salted.count() == 9000


def test_median_splits_hot_group_over_pieces(spark, skewed):
    pieces = value_pieces(skewed, [S.ROOM_ID], "v", partitions=8)
    hot = pieces.filter(F.col(S.ROOM_ID) == 0).select("_pid").distinct().count()
    assert hot >= 3
    med = {r[S.ROOM_ID]: r["median"] for r in exact_median(skewed, [S.ROOM_ID], "v", partitions=8).collect()}
    ref = {r[S.ROOM_ID]: r["m"] for r in skewed.groupBy(S.ROOM_ID).agg(F.median("v").alias("m")).collect()}
    assert med == pytest.approx(ref)


def test_top_n_in_hot_group(skewed):
    out = top_n_per_group(skewed, [S.ROOM_ID], [F.col("v").desc(), F.col(S.REQUEST_ID)], 2)
    assert out.count() == skewed.select(S.ROOM_ID).distinct().count() * 2
    hot = [r[S.REQUEST_ID] for r in out.filter(F.col(S.ROOM_ID) == 0).orderBy("rank").collect()]
    assert len(hot) == 2


def test_global_positions_match_row_number_with_hot_leading_key(spark):
    from pyspark.sql import Window

    from bookdemand.operators.ranking import global_positions

    # a third of the rows share the leading key; id makes the order total
    df = spark.range(30_000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 101).alias("k"),
        (F.col("id") % 13).alias("v"),
    )
    order = [F.col("k").desc(), F.col("v").asc(), F.col("id").asc()]
    got = global_positions(df, order, out_col="pos", partitions=8)
    want = df.withColumn("pos", F.row_number().over(Window.orderBy(*order)))
    assert got.count() == 30_000
    assert got.select("id", "pos").exceptAll(want.select("id", "pos")).count() == 0
    # the hot key is spread over several range partitions
    hot_parts = (df.repartitionByRange(8, *order).filter(F.col("k") == 7)
                 .select(F.spark_partition_id()).distinct().count())
    assert hot_parts > 1


def test_ordered_check_is_not_bounded(spark):
    from bookdemand.operators.equivalence import ordered_check

    n = 150_000  # above any single-task bound
    a = spark.range(n).select(F.col("id"), (F.col("id") % 1000).alias("s"))
    order = [F.col("s").desc(), F.col("id").asc()]
    assert ordered_check(a, a, order, "id").first()["status"] == "PASS"
    # same rows, one score changed so two ids trade places
    b = a.withColumn("s", F.when(F.col("id") == 5, F.lit(999)).otherwise(F.col("s")))
    rep = ordered_check(a, b, order, "id").first()
    assert rep["status"] == "FAIL" and rep["differing"] > 0


@pytest.mark.parametrize("max_pieces", [1_000_000, 0])  # broadcast offsets / joined offsets
def test_grouped_positions_match_row_number_with_hot_and_null_groups(spark, max_pieces):
    from pyspark.sql import Window

    from bookdemand.operators.ranking import global_positions

    df = spark.range(24_000).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot"))
        .when(F.col("id") % 17 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("g"), (F.col("id") % 29).cast("string"))).alias("g"),
        (F.col("id") % 11).alias("v"),
    )
    order = [F.col("v").desc(), F.col("id").asc()]
    got = global_positions(df, order, partition_cols=["g"], out_col="pos", partitions=8,
                           max_broadcast_pieces=max_pieces)
    want = df.withColumn("pos", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    assert got.count() == 24_000
    assert got.select("id", "pos").exceptAll(want.select("id", "pos")).count() == 0
    hot_parts = (df.repartitionByRange(8, F.col("g"), *order).filter(F.col("g") == "hot")
                 .select(F.spark_partition_id()).distinct().count())
    assert hot_parts > 1
