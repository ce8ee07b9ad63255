"""Conditional bonuses (SF-10, SF-12, F-6)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from bookdemand.functions._col import as_col


def tiered_bonus(
    amount: str | Column, capacity: str | Column, tiers: Sequence[tuple[int, int]]
) -> Column:
    """Points for the first tier whose percentage of ``capacity`` is reached.

    ``tiers`` is ``[(percent, points), ...]`` from the highest percent down.
    The ratio is tested without division, ``amount*100 >= capacity*percent``,
    in 64-bit arithmetic so no product can overflow an int.  A null on either
    side scores 0, as does falling below every tier.
    """
    scaled = as_col(amount).cast("long") * F.lit(100)
    cap = as_col(capacity).cast("long")
    expr = None
    for percent, points in tiers:
        cond = scaled >= cap * F.lit(percent)
        expr = F.when(cond, F.lit(points)) if expr is None else expr.when(cond, F.lit(points))
    return F.lit(0) if expr is None else expr.otherwise(F.lit(0))


def flag_bonus(condition: Column, points: int) -> Column:
    """``points`` when ``condition`` is true, else 0 (null counts as false)."""
    return F.when(condition, F.lit(points)).otherwise(F.lit(0))
