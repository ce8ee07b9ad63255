"""Top-n per group (WR-1) and global positions under a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookdemand.operators.join import broadcast_limit, profile_dimension
from bookdemand.session import checkpoint_dir

# monotonically_increasing_id(): partition index in the upper 31 bits, the
# record number inside the partition in the lower 33.
_LOCAL_BITS = 33


def top_n_per_group(
    df: DataFrame,
    group_cols: Sequence[str | Column],
    order_cols: Sequence[Column],
    n: int,
    rank_col: str = "rank",
) -> DataFrame:
    """Keep the first ``n`` rows of every group under a total order.

    ``row_number() <= n`` lets Catalyst insert a partial ``WindowGroupLimit``
    before the shuffle: each map task forwards at most ``n`` rows per group,
    so a group holding a third of the data never reaches one task whole.  For
    ``n`` beyond ``spark.sql.optimizer.windowGroupLimitThreshold``
    (``build_session`` sets it to a million) the limit is applied after the
    shuffle only.
    """
    if n <= 0:
        raise ValueError("top_n_per_group needs n > 0")
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= F.lit(n))


def global_positions(
    df: DataFrame,
    order_cols: Sequence[Column],
    *,
    partition_cols: Sequence[str] = (),
    out_col: str = "position",
    partitions: int | None = None,
    max_broadcast_pieces: int | None = None,
) -> DataFrame:
    """Every row of ``df`` with its 1-based position under ``order_cols``
    inside its ``partition_cols`` group (the whole frame when none) — what
    ``row_number()`` over that window gives, without one task per group.

    A window sorts a whole group (or, unpartitioned, everything) in one task.
    Here rows are range-partitioned on (group, order) — checkpointed in the
    shared folder, so each row's partition is fixed even if an executor is
    lost — sorted and numbered inside each partition.  A *piece* is the part
    of one group in one partition; from the piece counts (at most groups +
    partitions rows) come the rows of the group in earlier partitions and the
    piece's first local number.  That table is broadcast only when its
    counted size is at most ``max_broadcast_pieces`` rows, else joined by
    key.  With a total order (a unique last key) a hot group is split over
    many partitions.
    """
    spark = df.sparkSession
    g = list(partition_cols)
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c) for c in g] + list(order_cols)
    checkpoint_dir(spark)
    ranged = df.repartitionByRange(parts, *keys).checkpoint(eager=True)
    mid = F.monotonically_increasing_id()
    numbered = (
        ranged.sortWithinPartitions(*keys)
        .withColumn("_mid", mid)
        .withColumn("_pid", F.shiftright(F.col("_mid"), _LOCAL_BITS).cast("int"))
        .withColumn("_local", F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
    )
    pieces = ranged.groupBy(F.spark_partition_id().alias("_pid"), *g).agg(F.count(F.lit(1)).alias("_n"))
    # groups are contiguous inside a partition, in the sort's group order
    in_partition = Window.partitionBy("_pid")
    in_group = Window.partitionBy(*g) if g else Window.partitionBy()
    if g:
        in_partition = in_partition.orderBy(*[F.col(c) for c in g])
    else:
        in_partition = in_partition.orderBy("_pid")
    in_group = in_group.orderBy("_pid")
    before = (Window.unboundedPreceding, -1)
    offsets = pieces.select(
        "_pid", *[F.col(c).alias(f"_o_{c}") for c in g],
        F.coalesce(F.sum("_n").over(in_partition.rowsBetween(*before)), F.lit(0)).alias("_first"),
        F.coalesce(F.sum("_n").over(in_group.rowsBetween(*before)), F.lit(0)).alias("_off"),
    )
    if not g:
        fits = True  # one row per partition
    elif max_broadcast_pieces is not None:
        fits = pieces.count() <= max_broadcast_pieces
    else:
        fits = profile_dimension(pieces, "_pid", per_key=False).broadcast_bytes <= broadcast_limit(spark)
    if fits:
        offsets = F.broadcast(offsets)
    cond = [numbered["_pid"] == offsets["_pid"]] + [numbered[c].eqNullSafe(offsets[f"_o_{c}"]) for c in g]
    position = F.col("_off") + F.col("_local") - F.col("_first") + F.lit(1)
    return numbered.join(offsets, on=cond, how="inner").select(
        *[numbered[c] for c in df.columns], position.alias(out_col)
    )
