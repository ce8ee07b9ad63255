"""Quantiles from mergeable sketches (A-6 at scale), with their rank error.

A KLL sketch per series and period is a few kilobytes; sketches are stored and merged,
so a quantile over any periods needs no second look at the values.  The size is chosen
so that the rank of every answer is within ``rank_error`` of the asked one.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The published rank error of these sketches at 99 % confidence, 2.296 / k^0.9723.
ERROR_SCALE, ERROR_POWER = 2.296, 0.9723
SAFETY = 3.0  # times that error fits into the rank error asked for
LARGEST_K = 65_535


def sketch_size(rank_error: float) -> int:
    """The sketch parameter k for a rank error in (0, 1)."""
    if not 0 < rank_error < 1:
        raise ValueError("rank_error must lie between 0 and 1")
    k = math.ceil((SAFETY * ERROR_SCALE / rank_error) ** (1 / ERROR_POWER))
    if k > LARGEST_K:
        raise ValueError(f"no sketch has a rank error as small as {rank_error}; take exact_median")
    return max(8, k)


def sketches(df: DataFrame, series: Sequence[str], value: str, *, period: str, rank_error: float = 0.01) -> DataFrame:
    """(series, period, sketch): one pass; partial sketches are merged after the shuffle.
    Null values are left out; a series and period without values has no row."""
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(*series, period).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(sketch_size(rank_error))).alias("sketch"))


def quantiles(stored: DataFrame, series: Sequence[str], ranks: Sequence[float], *, rank_error: float = 0.01) -> DataFrame:
    """(series, n, rank, value, rank_error) over all periods of ``stored`` sketches."""
    merged = stored.groupBy(*series).agg(F.kll_merge_agg_double("sketch", F.lit(sketch_size(rank_error))).alias("sketch"))
    answers = F.array(*[F.struct(F.lit(float(r)).alias("rank"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(r))).alias("value")) for r in ranks])
    return merged.select(*series, F.kll_sketch_get_n_double("sketch").alias("n"), F.explode(answers).alias("x")).select(
        *series, "n", "x.rank", "x.value", F.lit(rank_error).alias("rank_error"))


def true_ranks(df: DataFrame, answers: DataFrame, series: Sequence[str], value: str) -> DataFrame:
    """``answers`` with ``below`` and ``to`` (the shares of values under and up to the answer)
    and ``within``: is the asked rank at most the rank error away?  One row per series is
    joined to the values, which are counted before they are shuffled."""
    mark = answers.select(*series, "rank", F.col("value").alias("_answer"))
    known = df.where(F.col(value).isNotNull()).select(*series, F.col(value).cast("double").alias("_v"))
    shares = known.join(mark, list(series)).groupBy(*series, "rank").agg(
        (F.sum((F.col("_v") < F.col("_answer")).cast("long")) / F.count(F.lit(1))).alias("below"),
        (F.sum((F.col("_v") <= F.col("_answer")).cast("long")) / F.count(F.lit(1))).alias("to"))
    return answers.join(shares, [*series, "rank"]).withColumn(
        "within", (F.col("below") - F.col("rank_error") <= F.col("rank")) & (F.col("rank") <= F.col("to") + F.col("rank_error")))
