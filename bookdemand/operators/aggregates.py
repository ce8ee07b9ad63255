"""Grouping helpers: group sizes, control aggregates, duplicates, pivot."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_sizes(df: DataFrame, keys: Sequence[str], count_col: str = "rows") -> DataFrame:
    """A-4: rows per key; a null key is its own group."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))


def control_totals(df: DataFrame, value_col: str) -> DataFrame:
    """A-5: one row — row count, sum and mean of ``value_col``."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(value_col).cast("double").alias("total"),
        F.avg(value_col).cast("double").alias("mean"),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "copies") -> DataFrame:
    """A-7: keys that occur more than once, with their number of copies.

    Partial aggregation before the shuffle: a key repeated a billion times
    costs one row per map task.
    """
    return group_sizes(df, keys, count_col).filter(F.col(count_col) > 1)


def pivot_wide(
    df: DataFrame,
    index: Sequence[str],
    pivot_col: str,
    values: Sequence[str] | None,
    value: Column | str,
    *,
    max_columns: int = 1000,
) -> DataFrame:
    """A-8: one row per ``index``, one column per pivot value.

    ``values`` None takes them from the data (one distinct job, sorted; more
    than ``max_columns`` is an error).  Given values fix the output schema; a
    row with another non-null value then fails the query instead of
    vanishing.  ``first`` fills each cell (one value per cell is the caller's
    contract).
    """
    val = F.col(value) if isinstance(value, str) else value
    if values is None:
        found = df.select(pivot_col).where(F.col(pivot_col).isNotNull()).distinct().limit(max_columns + 1).collect()
        if len(found) > max_columns:
            raise ValueError(f"'{pivot_col}' has more than {max_columns} values; a pivot needs fewer")
        values = sorted(r[0] for r in found)
    else:
        listed = F.col(pivot_col).isNull() | F.col(pivot_col).isin(list(values))
        unlisted = F.concat(F.lit(f"'{pivot_col}' has a value without a column: "), F.col(pivot_col).cast("string"))
        df = df.withColumn(pivot_col, F.when(listed, F.col(pivot_col)).otherwise(F.raise_error(unlisted)))
    return df.groupBy(*index).pivot(pivot_col, list(values)).agg(F.first(val))


def append_series(*frames: DataFrame) -> DataFrame:
    """U-2: stack measurement tables from several runs by column name."""
    return reduce(lambda a, b: a.unionByName(b), frames)


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """CCH-1 / CCH-2: keep ``df`` materialised (spilling to disk) for the
    block, and always release it afterwards."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
