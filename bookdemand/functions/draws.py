"""Seeded, partition-independent random draws (GEN-4, GEN-5).

Each draw is a hash of (seed, row key, field tag).  Unlike ``rand(seed)`` the
value does not depend on how rows are split into partitions or on task
retries, so a lost executor recomputes exactly the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from bookdemand.functions._col import as_col


def text_hash(text: Column) -> Column:
    """The first 15 hexadecimal digits of the text's MD5, as a number: 60 bits
    that any engine can compute."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def _unit_hash(seed: int, row: Column, field: str) -> Column:
    return text_hash(F.concat(F.lit(f"{seed}:{field}:"), row.cast("string")))


def uniform_int(seed: int, row: str | Column, field: str, low: int | Column, high: int | Column) -> Column:
    """Integer uniform on ``[low, high]`` (both inclusive; bounds may be columns)."""
    lo = low if isinstance(low, Column) else F.lit(low)
    hi = high if isinstance(high, Column) else F.lit(high)
    span = (hi - lo + 1).cast("long")
    return (lo + F.pmod(_unit_hash(seed, as_col(row), field), span)).cast("int")


def weighted_choice(seed: int, row: str | Column, field: str, values: Sequence, weights: Sequence[int]) -> Column:
    """Pick ``values[i]`` with probability ``weights[i] / sum(weights)``."""
    total = int(sum(weights))
    draw = F.pmod(_unit_hash(seed, as_col(row), field), F.lit(total))
    expr = None
    upper = 0
    for value, weight in zip(values, weights):
        upper += int(weight)
        cond = draw < F.lit(upper)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr
