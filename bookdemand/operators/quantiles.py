"""Exact median per group without gathering a group into one task (A-6).

``F.median`` / ``percentile`` keep every value of a group in one aggregation
buffer: a group holding a third of the data would sit in one task's memory.
Here the median is found by rank instead:

1. equal values are counted first (partial aggregation before the shuffle);
2. the distinct (group, value) rows are range-partitioned on (group, value),
   so a hot group is cut into many value ranges handled by many tasks, and
   checkpointed so the partition id of every row is fixed even if a task or
   an executor is lost and recomputed;
3. per (partition, group) the counts give prefix offsets — a table of at most
   ``groups + partitions`` rows — which name the one or two pieces of each
   group that hold its middle ranks; all others are left behind;
4. a running sum inside those pieces gives their values' rank intervals, and
   the values covering the middle ranks give the median, interpolated the
   way ``percentile(v, 0.5)`` does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bookdemand.operators.join import broadcast_limit, profile_dimension
from bookdemand.session import checkpoint_dir


def value_pieces(df: DataFrame, group_cols: Sequence[str], value_col: str,
                 partitions: int | None = None) -> DataFrame:
    """Distinct (group, value, count ``_n``) rows range-partitioned on
    (group, value) and tagged with their piece ``_pid``; checkpointed, so the
    tags are fixed even if an executor is lost later."""
    spark = df.sparkSession
    g = list(group_cols)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = (
        df.select(*g, value_col).filter(F.col(value_col).isNotNull())
        .groupBy(*g, value_col).agg(F.count(F.lit(1)).alias("_n"))
    )
    checkpoint_dir(spark)
    return (
        counted.repartitionByRange(parts, *[F.col(c) for c in g], F.col(value_col))
        .withColumn("_pid", F.spark_partition_id())
        .checkpoint(eager=True)
    )


def exact_median(
    df: DataFrame,
    group_cols: Sequence[str],
    value_col: str,
    *,
    out_col: str = "median",
    count_col: str | None = "n",
    partitions: int | None = None,
) -> DataFrame:
    """Per group: the exact (interpolated) median of non-null ``value_col``
    and, if ``count_col`` is given, the number of non-null values.
    Groups with only null values are absent (as with ``groupBy().agg``)."""
    g = list(group_cols)
    v = value_col
    spark = df.sparkSession
    ranged = value_pieces(df, g, v, partitions)
    totals = ranged.groupBy("_pid", *g).agg(F.sum("_n").alias("_t"))
    before = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_off", F.coalesce(F.sum("_t").over(before), F.lit(0))) \
        .withColumn("_size", F.sum("_t").over(Window.partitionBy(*g)))
    # 1-based ranks of the lower and upper middle values
    k_lo, k_hi = F.floor((F.col("_size") - 1) / 2) + 1, F.floor(F.col("_size") / 2) + 1
    # the one or two pieces of each group that hold them
    middle = offsets.filter((F.col("_off") < k_hi) & (k_lo <= F.col("_off") + F.col("_t")))
    # null-safe on the group columns: a null group is a group, as in groupBy
    middle = middle.select(F.col("_pid").alias("_o_pid"), *[F.col(c).alias(f"_o_{c}") for c in g], "_off", "_size")
    if profile_dimension(middle, "_o_pid", per_key=False).broadcast_bytes <= broadcast_limit(spark):
        middle = F.broadcast(middle)
    cond = [F.col("_pid") == F.col("_o_pid")] + [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in g]
    held = ranged.join(middle, on=cond, how="inner").select(
        "_pid", *g, v, "_n", "_off", "_size")
    piece = Window.partitionBy("_pid", *g).orderBy(v).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = held.withColumn("_last", F.col("_off") + F.sum("_n").over(piece)) \
        .withColumn("_first", F.col("_last") - F.col("_n") + 1)
    covers_lo = (F.col("_first") <= k_lo) & (k_lo <= F.col("_last"))
    covers_hi = (F.col("_first") <= k_hi) & (k_hi <= F.col("_last"))
    picked = ranked.filter(covers_lo | covers_hi).groupBy(*g).agg(
        F.max(F.when(covers_lo, F.col(v))).alias("_lo"),
        F.max(F.when(covers_hi, F.col(v))).alias("_hi"),
        F.max("_size").alias("_size"),
    )
    median = (F.col("_lo") * 0.5 + F.col("_hi") * 0.5).cast("double")
    cols = [*g, median.alias(out_col)]
    if count_col:
        cols.append(F.col("_size").alias(count_col))
    return picked.select(*cols)


def approx_median(
    df: DataFrame, group_cols: Sequence[str], value_col: str, *, out_col: str = "median",
    count_col: str | None = "n", accuracy: int = 10000,
) -> DataFrame:
    """Bounded-memory sketch median (``percentile_approx``), one shuffle."""
    aggs = [F.percentile_approx(F.col(value_col), 0.5, accuracy).cast("double").alias(out_col)]
    if count_col:
        aggs.append(F.count(value_col).alias(count_col))
    return df.groupBy(*group_cols).agg(*aggs)
