"""Scaling metrics over a table of timings (M-1 … M-10), as column
expressions and equi-joins — no driver-side arithmetic.

Input rows: ``engine, operator, units, repetition, seconds``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookdemand.operators.quantiles import exact_median

SERIES = ["engine", "operator", "units"]


def median_summary(measurements: DataFrame, series: Sequence[str] = SERIES, *, ordered: bool = False) -> DataFrame:
    """M-1: per series, the number of runs and the exact median time
    (O-5: ``ordered`` sorts the summary by series key)."""
    out = exact_median(measurements, list(series), "seconds", out_col="median_seconds", count_col="runs")
    return out.orderBy(*series) if ordered else out


OK = "ok"


def _status(reference: Column) -> Column:
    return (
        F.when(reference.isNull(), F.lit("no reference series"))
        .when(~((reference > 0) & F.coalesce(F.col("median_seconds") > 0, F.lit(False))), F.lit("time not positive"))
        .otherwise(F.lit(OK))
    )


def require_ok(metrics: DataFrame) -> None:
    """Stop when a series has no reference or a time that is not positive."""
    bad = metrics.filter(F.col("status") != OK).select("engine", "operator", "units", "status").distinct().limit(20).collect()
    if bad:
        raise ValueError("no metrics for: " + "; ".join(f"{r[0]}/{r[1]}/{r[2]} ({r[3]})" for r in bad))


def speedup_versus(summary: DataFrame, baseline: dict[str, object], join_on: Sequence[str]) -> DataFrame:
    """M-2: ``T_baseline / T`` for every non-baseline series.

    ``baseline`` selects the reference series by column equality (for example
    ``{"engine": "pandas"}``); ``join_on`` names the columns both must share.
    No series is dropped: one without a baseline, or with a time that is not
    positive, keeps a null speedup and says why in ``status``.  The baseline's
    time (the largest, if a key has several) comes from a window, so the
    summary is planned once.
    """
    is_base = F.lit(True)
    for col, val in baseline.items():
        is_base = is_base & (F.col(col) == F.lit(val))
    is_base = F.coalesce(is_base, F.lit(False))
    shared = F.lit(True)
    for col in join_on:
        shared = shared & F.col(col).isNotNull()  # a null key shares nothing
    base = F.max(F.when(is_base, F.col("median_seconds"))).over(Window.partitionBy(*join_on))
    return (
        summary.withColumn("_base", F.when(shared, base)).filter(~is_base).withColumn("status", _status(F.col("_base")))
        .withColumn("speedup", F.when(F.col("status") == OK, F.col("_base") / F.col("median_seconds"))).drop("_base")
    )


def unit_scaling(summary: DataFrame, group: Sequence[str] = ("engine", "operator")) -> DataFrame:
    """M-3 … M-8 per (engine, operator, units):

    speedup S(N) = T(1)/T(N); efficiency E = S/N (and percent); observed serial
    fraction f(N) = (N/S - 1)/(N - 1) for N > 1 (Karp–Flatt); with f_ref the
    fraction at the largest N of the group: Amdahl 1/(f + (1-f)/N), Gustafson
    N - f(N-1) (only for f in [0, 1]), limit 1/f; ``f_in_range`` flags
    whether f_ref is a fraction at all (DQ-17 as a column).

    The one-unit time comes from a window over the group, so the summary is
    planned once; a group without one, or a time that is not positive, keeps
    its rows with null metrics and says why in ``status``.
    """
    g = list(group)
    n = F.col("units").cast("double")
    one = F.max(F.when(F.col("units") == 1, F.col("median_seconds"))).over(Window.partitionBy(*g))
    s = summary.withColumn("_t1", one).withColumn("status", _status(F.col("_t1"))).withColumn(
        "speedup", F.when(F.col("status") == OK, F.col("_t1") / F.col("median_seconds"))
    )
    s = s.withColumn("efficiency", F.col("speedup") / n).withColumn("efficiency_pct", F.col("efficiency") * 100)
    s = s.withColumn("serial_fraction", F.when(F.col("units") > 1, (n / F.col("speedup") - 1) / (n - 1)))
    by_n = Window.partitionBy(*g).orderBy(F.col("units").desc())
    s = s.withColumn("_f", F.first("serial_fraction").over(by_n.rowsBetween(Window.unboundedPreceding,
                                                                            Window.unboundedFollowing)))
    in_range = (F.col("_f") >= 0) & (F.col("_f") <= 1)
    s = (
        s.withColumn("f_in_range", in_range)
        .withColumn("_den", F.col("_f") + (1 - F.col("_f")) / n)
        .withColumn("amdahl", F.when(F.col("_den") != 0, 1 / F.col("_den")))
        .withColumn("gustafson", F.when(in_range, n - F.col("_f") * (n - 1)))
        .withColumn("amdahl_limit", F.when(F.col("_f") != 0, 1 / F.col("_f")))
        .withColumn("reference_fraction", F.col("_f"))
    )
    trend = Window.partitionBy(*g).orderBy("units")
    s = s.withColumn("serial_fraction_change", F.col("serial_fraction") - F.lag("serial_fraction").over(trend))
    return s.drop("_t1", "_f", "_den")


METRICS = [
    ("speedup", "ratio to units=1"),
    ("efficiency", "S(N)/N"),
    ("efficiency_pct", "percent"),
    ("serial_fraction", "observed non-scaling share"),
    ("amdahl", "theoretical ratio"),
    ("gustafson", "scaled ratio"),
    ("amdahl_limit", "maximum theoretical ratio"),
    ("serial_fraction_change", "change of f against the next smaller N"),
]


def metrics_long(scaled: DataFrame, group: Sequence[str] = ("engine", "operator")) -> DataFrame:
    """M-9: long format ``metric, <group>, units, value, unit, status``.

    A metric that is not defined for a sound series (the serial fraction at
    one unit, say) has no row; a series that is not sound keeps all its rows,
    with null values and its status."""
    pairs = ", ".join(f"'{name}', CAST({name} AS DOUBLE), '{unit}'" for name, unit in METRICS)
    long = scaled.select(
        *group, "units", "status",
        F.expr(f"stack({len(METRICS)}, {pairs}) AS (metric, value, unit)"),
    )
    return long.filter(F.col("value").isNotNull() | (F.col("status") != OK))
