"""Do two datasets agree?  (EQ-1 … EQ-6)

Both sides are tagged and unioned, then aggregated — no
cross or outer joins.  Grouping treats null keys as one group, so the
per-key comparison is null-safe by construction, and partial aggregation
keeps hot keys cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookdemand.operators.ranking import global_positions

REPORT_COLUMNS = ["check", "left_value", "right_value", "differing", "status"]


def _tagged(left: DataFrame, right: DataFrame, cols: Sequence[str]) -> DataFrame:
    return left.select(*cols, F.lit(0).alias("_side")).unionByName(right.select(*cols, F.lit(1).alias("_side")))


def _on(side: int, value: Column) -> Column:
    return F.when(F.col("_side") == side, value)


def _status(ok: Column) -> Column:
    return F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL"))


def row_multiset_check(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """EQ-5: the same rows with the same multiplicities (``exceptAll`` both
    ways, as one grouped count).  ``differing`` is the number of unmatched rows."""
    cols = list(columns or left.columns)
    t = _tagged(left, right, cols)
    per_row = t.groupBy(*cols).agg(
        F.count(_on(0, F.lit(1))).alias("c0"), F.count(_on(1, F.lit(1))).alias("c1")
    )
    return per_row.agg(
        F.lit("same_rows").alias("check"),
        F.coalesce(F.sum("c0"), F.lit(0)).cast("double").alias("left_value"),
        F.coalesce(F.sum("c1"), F.lit(0)).cast("double").alias("right_value"),
        F.coalesce(F.sum(F.abs(F.col("c0") - F.col("c1"))), F.lit(0)).cast("long").alias("differing"),
    ).withColumn("status", _status(F.col("differing") == 0))


def ordered_check(left: DataFrame, right: DataFrame, order_cols: Sequence[Column], id_col: str) -> DataFrame:
    """EQ-5 for ranked results: the same ids at the same positions.

    Both sides are numbered in one pass by ``ranking.global_positions``
    (the side is the group; range-partitioned, no single-task sort), so
    inputs of any size are checked whole.
    """
    cols = list(left.columns)
    both = left.select(*cols, F.lit(0).alias("_side")).unionByName(right.select(*cols, F.lit(1).alias("_side")))
    pos = global_positions(both, order_cols, partition_cols=["_side"], out_col="_pos")
    pos = pos.select("_side", "_pos", F.col(id_col).alias("_id"))
    return row_multiset_check(
        pos.filter(F.col("_side") == 0).drop("_side"), pos.filter(F.col("_side") == 1).drop("_side")
    ).withColumn("check", F.lit("same_order"))


def equivalence_report(
    left: DataFrame,
    right: DataFrame,
    *,
    value_col: str,
    keys: Sequence[str],
    compare_rows: bool = True,
    tol: float = 1e-9,
) -> DataFrame:
    """EQ-6: one PASS/FAIL row per check.

    The tagged union is grouped by all columns (or by keys and value when
    ``compare_rows`` is off) with a count per side, those groups by the keys,
    and those into one row, which is unfolded into the checks: row multiset,
    counts per key, cardinality, control sum (Σ value·count) and control
    mean.  Each input is planned and read once.  Identical inputs give
    bit-identical sums because equal rows share a group.
    """
    cols = list(left.columns) if compare_rows else list(dict.fromkeys([*keys, value_col]))
    t = _tagged(left, right, cols)
    per_row = t.groupBy(*cols).agg(
        F.count(_on(0, F.lit(1))).alias("_c0"), F.count(_on(1, F.lit(1))).alias("_c1")
    )
    v = F.col(value_col).cast("double")
    sides = (0, 1)
    per_key = per_row.groupBy(*keys).agg(
        *[F.sum(f"_c{i}").alias(f"n{i}") for i in sides],
        *[F.sum(v * F.col(f"_c{i}")).alias(f"s{i}") for i in sides],
        *[F.sum(F.when(v.isNotNull(), F.col(f"_c{i}"))).alias(f"k{i}") for i in sides],
        F.sum(F.abs(F.col("_c0") - F.col("_c1"))).alias("rowdiff"),
    )
    ctl = per_key.agg(
        *[F.sum(c).alias(c) for c in ("n0", "n1", "s0", "s1", "k0", "k1")],
        F.coalesce(F.sum("rowdiff"), F.lit(0)).alias("rowdiff"),
        *[F.count(F.when(F.col(f"n{i}") > 0, 1)).alias(f"keys{i}") for i in sides],
        F.count(F.when(F.col("n0") != F.col("n1"), 1)).alias("keydiff"),
    )

    def check(name: str, a: Column, b: Column, differing: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), a.cast("double").alias("left_value"), b.cast("double").alias("right_value"),
                        differing.cast("long").alias("differing"))

    def apart(a: Column, b: Column, by: float) -> Column:
        """0 if both agree within ``by`` or are both null, else 1."""
        return F.when(F.coalesce(F.abs(a - b) <= F.lit(by), F.lit(False)) | (a.isNull() & b.isNull()), 0).otherwise(1)

    n0, n1, s0, s1 = (F.col(c).cast("double") for c in ("n0", "n1", "s0", "s1"))
    mean0, mean1 = (F.when(F.col(f"k{i}") > 0, F.col(f"s{i}") / F.col(f"k{i}")) for i in sides)
    checks = [
        check("cardinality", n0, n1, apart(n0, n1, 0.0)),
        check("control_sum", s0, s1, apart(s0, s1, tol)),
        check("control_mean", mean0, mean1, apart(mean0, mean1, tol)),
        check("counts_per_key", F.col("keys0"), F.col("keys1"), F.col("keydiff")),
    ]
    if compare_rows:
        zero = F.lit(0.0)
        checks.append(check("same_rows", F.coalesce(n0, zero), F.coalesce(n1, zero), F.col("rowdiff")))
    report = ctl.select(F.inline(F.array(*checks)))
    return report.withColumn("status", _status(F.col("differing") == 0)).select(*REPORT_COLUMNS)


def assert_equivalent(report: DataFrame) -> None:
    failed = [r["check"] for r in report.filter(F.col("status") != "PASS").select("check").collect()]
    if failed:
        raise AssertionError("datasets differ: " + ", ".join(sorted(failed)))
