"""Data-quality rules as one report DataFrame (DQ-2 … DQ-17).

Each rule yields one row ``rule, checked, violations, sample``; the sample is
the smallest key (as text) that breaks the rule, null if none does.  Row-level rules on
a table share one aggregate pass; uniqueness, referential and cross-table
rules aggregate *before* they shuffle or join (per key, per key-and-value),
so a key holding a third of the rows costs one row per map task, and the
cross-table join works on those pre-aggregated rows only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from bookdemand import schemas as S
from bookdemand.functions.timeofday import try_seconds_of_day

REPORT_COLUMNS = ["rule", "checked", "violations", "sample"]


def _row(df: DataFrame, rule: str, checked: Column, violations: Column, sample: Column | None = None) -> DataFrame:
    """``sample``: the smallest offending key, an aggregate."""
    return df.agg(
        F.coalesce(checked, F.lit(0)).cast("long").alias("checked"),
        F.coalesce(violations, F.lit(0)).cast("long").alias("violations"),
        (F.lit(None) if sample is None else sample).cast("string").alias("sample"),
    ).select(F.lit(rule).alias("rule"), "checked", "violations", "sample")


def _literal(spark: SparkSession, rule: str, checked: int, violations: int, sample: str | None = None) -> DataFrame:
    return spark.createDataFrame([(rule, checked, violations, sample)],
                                 "rule string, checked long, violations long, sample string")


def blank(df: DataFrame, column: str) -> Column:
    """Null, or (for text) empty after trimming."""
    c = F.col(column)
    if isinstance(df.schema[column].dataType, StringType):
        return c.isNull() | (F.trim(c) == F.lit(""))
    return c.isNull()


def schema_rule(df: DataFrame, expected: Sequence[str], rule: str) -> DataFrame:
    """DQ-2: columns present and in order (metadata only, no data read)."""
    actual = list(df.columns)
    off = [name for i, name in enumerate(expected) if i >= len(actual) or actual[i] != name] + actual[len(expected):]
    return _literal(df.sparkSession, rule, len(expected), len(off), min(off, default=None))


def row_count_rule(df: DataFrame, expected: int, rule: str) -> DataFrame:
    """DQ-7, DQ-13: the table has exactly ``expected`` rows (1 violation if not)."""
    n = F.count(F.lit(1))
    return _row(df, rule, n, F.when(n != F.lit(expected), 1).otherwise(0))


def unique_rule(df: DataFrame, keys: Sequence[str], rule: str) -> DataFrame:
    """DQ-4, DQ-5, DQ-8, DQ-15: rows whose key occurs more than once."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    repeated = F.col("_n") > 1
    return _row(per_key, rule, F.sum("_n"), F.sum(F.when(repeated, F.col("_n"))), F.min(F.when(repeated, F.col(keys[0]))))


def referential_rule(fact: DataFrame, dim: DataFrame, key: str, rule: str, dim_key: str | None = None) -> DataFrame:
    """DQ-9 / J-3: fact rows whose key has no dimension row (null keys included).

    The fact side is reduced to one row per key before the join.
    """
    dk = dim_key or key
    fact_keys = fact.groupBy(F.col(key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    dim_keys = dim.groupBy(F.col(dk).alias("_k")).agg(F.lit(1).alias("_hit"))
    joined = fact_keys.join(dim_keys, on="_k", how="left")
    lost = F.col("_hit").isNull()
    return _row(joined, rule, F.sum("_n"), F.sum(F.when(lost, F.col("_n"))), F.min(F.when(lost, F.col("_k"))))


def missing_keys(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """DQ-16 / J-6: expected keys that the actual table lacks."""
    want = expected.select(*keys).distinct()
    have = actual.select(*keys).distinct()
    return want.join(have, on=list(keys), how="left_anti")


def assert_fraction(df: DataFrame, column: str) -> None:
    """DQ-17: refuse to go on when a fraction leaves [0, 1] (one small job)."""
    bad = df.filter(F.col(column).isNotNull() & ((F.col(column) < 0) | (F.col(column) > 1))).limit(1).count()
    if bad:
        raise ValueError(f"{column} has a value outside [0, 1]")


def _stacked(agg: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Turn one aggregate row into one report row per (rule, checked, violations);
    the sample of violations ``v`` is the column ``v_key``."""
    pairs = ", ".join(f"'{rule}', CAST(coalesce({c}, 0) AS BIGINT), CAST(coalesce({v}, 0) AS BIGINT), CAST({v}_key AS STRING)"
                      for rule, c, v in rules)
    return agg.select(F.expr(f"stack({len(rules)}, {pairs}) AS (rule, checked, violations, sample)"))


def booking_quality_report(
    requests: DataFrame,
    rooms: DataFrame,
    *,
    expected_requests: int | None = None,
    expected_rooms: int | None = None,
    request_columns: Sequence[str] | None = None,
    room_columns: Sequence[str] | None = None,
) -> DataFrame:
    """All booking rules in one report, one row per rule.

    Fused for scale: requests are read twice — once grouped by
    (room, attendees), which carries the row-level, referential and capacity
    rules, and once grouped by request id for uniqueness; rooms are read
    twice — by id (row rules, uniqueness, capacity bounds) and by code.
    """
    rq_cols = list(request_columns or requests.columns)
    rm_cols = list(room_columns or rooms.columns)
    any_blank_rq = reduce(lambda a, b: a | b, [blank(requests, c) for c in rq_cols])
    any_blank_rm = reduce(lambda a, b: a | b, [blank(rooms, c) for c in rm_cols])
    # a blank or malformed time of day is a violation, not an error of the report
    bad_time = ~F.coalesce(try_seconds_of_day(S.END_TIME) > try_seconds_of_day(S.START_TIME), F.lit(False))

    per_room = rooms.groupBy(S.ROOM_ID).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(F.when(any_blank_rm, 1)).alias("_blank"),
        F.count(F.when(~(F.col(S.CAPACITY) > 0), 1)).alias("_nonpos"),
        F.min(S.CAPACITY).alias("_bound"),
    )
    room_rules = _stacked(
        per_room.agg(
            F.sum("_n").alias("n"), F.sum("_blank").alias("blank"), F.sum("_nonpos").alias("nonpos"),
            F.sum(F.when(F.col("_n") > 1, F.col("_n"))).alias("dup"),
            *[F.min(F.when(bad, F.col(S.ROOM_ID))).alias(f"{v}_key")
              for v, bad in (("blank", F.col("_blank") > 0), ("nonpos", F.col("_nonpos") > 0), ("dup", F.col("_n") > 1))],
        ),
        [("rooms.required_values", "n", "blank"), ("rooms.unique_id", "n", "dup"),
         ("rooms.positive_capacity", "n", "nonpos")],
    )
    pairs = requests.groupBy(S.ROOM_ID, S.ATTENDEES).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(F.when(any_blank_rq, 1)).alias("_blank"),
        F.count(F.when(bad_time, 1)).alias("_badtime"),
        F.min(S.REQUEST_ID).alias("_key"),
        F.min(F.when(any_blank_rq, F.col(S.REQUEST_ID))).alias("_blank_key"),
        F.min(F.when(bad_time, F.col(S.REQUEST_ID))).alias("_badtime_key"),
    )
    bounds = per_room.select(S.ROOM_ID, "_bound", F.lit(1).alias("_hit"))
    joined = pairs.join(bounds, on=S.ROOM_ID, how="left")
    hit = F.col("_hit").isNotNull()
    request_rules = _stacked(
        joined.agg(
            F.sum("_n").alias("n"), F.sum("_blank").alias("blank"), F.sum("_badtime").alias("badtime"),
            F.sum(F.when(~(F.col(S.ATTENDEES) > 0), F.col("_n"))).alias("nonpos"),
            F.sum(F.when(~hit, F.col("_n"))).alias("orphan"),
            F.sum(F.when(hit, F.col("_n"))).alias("matched"),
            F.sum(F.when(hit & (F.col(S.ATTENDEES) > F.col("_bound")), F.col("_n"))).alias("over"),
            F.min("_blank_key").alias("blank_key"), F.min("_badtime_key").alias("badtime_key"),
            F.min(F.when(~(F.col(S.ATTENDEES) > 0), F.col("_key"))).alias("nonpos_key"),
            F.min(F.when(~hit, F.col("_key"))).alias("orphan_key"),
            F.min(F.when(hit & (F.col(S.ATTENDEES) > F.col("_bound")), F.col("_key"))).alias("over_key"),
        ),
        [("requests.required_values", "n", "blank"), ("requests.room_exists", "n", "orphan"),
         ("requests.end_after_start", "n", "badtime"), ("requests.positive_attendees", "n", "nonpos"),
         ("requests.within_capacity", "matched", "over")],
    )
    parts = [
        schema_rule(requests, rq_cols, "requests.columns"),
        schema_rule(rooms, rm_cols, "rooms.columns"),
        room_rules,
        unique_rule(rooms, [S.CODE], "rooms.unique_code"),
        request_rules,
        unique_rule(requests, [S.REQUEST_ID], "requests.unique_id"),
    ]
    if expected_rooms is not None:
        parts.append(row_count_rule(rooms, expected_rooms, "rooms.row_count"))
    if expected_requests is not None:
        parts.append(row_count_rule(requests, expected_requests, "requests.row_count"))
    return reduce(DataFrame.unionByName, parts)


def raise_on_violations(report: DataFrame) -> None:
    """Stop at any failed rule (the report is one row per rule: small)."""
    failed = report.filter(F.col("violations") > 0).collect()
    if failed:
        raise ValueError("data-quality rules failed: "
                         + ", ".join(f"{r['rule']}={r['violations']} (e.g. {r['sample']})" for r in failed))
