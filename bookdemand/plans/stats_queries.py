"""Medians, pivots and scaling metrics over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookdemand.operators.aggregates import append_series, pivot_wide
from bookdemand.operators.quantiles import exact_median
from bookdemand.operators.scaling import METRICS, median_summary, metrics_long, speedup_versus, unit_scaling
from bookdemand.plans.registry import register
from bookdemand.sources.tables import measurements_from_events, measurements_from_lineitem, read_table

# The event types of the events table, for the oracle's pivot
# columns (the query takes them from the data).
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
DIGITS = 9  # doubles are published with 9 decimals

MEASUREMENTS_CTE = """m AS (
  SELECT 'events' AS engine, event_type AS operator, CAST(1 << (user_id % 3) AS INTEGER) AS units,
         event_id AS repetition, value AS seconds
  FROM events)"""
SUMMARY_CTE = """s AS (
  SELECT engine, operator, units, count(seconds) AS runs, median(seconds) AS median_seconds
  FROM m WHERE seconds IS NOT NULL GROUP BY engine, operator, units)"""


def _r(c: str) -> F.Column:
    return F.round(F.col(c), DIGITS).alias(c)


@register("median_series", f"""SELECT event_type, round(median(value), {DIGITS}) AS median_value,
       count(value) AS n
FROM events WHERE value IS NOT NULL GROUP BY event_type""")
def median_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-6: exact median and size of each event type's value series."""
    med = exact_median(read_table(spark, sf_dir, "events"), ["event_type"], "value", out_col="median_value")
    return med.select("event_type", _r("median_value"), "n")


@register("pivot_median", f"""WITH c AS (
  SELECT CAST(ts AS DATE) AS day, event_type, round(median(value), {DIGITS}) AS m
  FROM events WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT day, {", ".join(f"max(m) FILTER (WHERE event_type = '{t}') AS {t}" for t in EVENT_TYPES)}
FROM c GROUP BY day""")
def pivot_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A-8: per day one column per event type holding that cell's median."""
    events = read_table(spark, sf_dir, "events").select(F.to_date("ts").alias("day"), "event_type", "value")
    med = exact_median(events, ["day", "event_type"], "value", out_col="m", count_col=None)
    return pivot_wide(med.select("day", "event_type", _r("m")), ["day"], "event_type", None, "m")


@register("timing_summary", f"""WITH {MEASUREMENTS_CTE}, {SUMMARY_CTE}
SELECT engine, operator, units, runs, round(median_seconds, {DIGITS}) AS median_seconds FROM s""")
def timing_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-1: runs and exact median time per (engine, operator, units)."""
    s = median_summary(measurements_from_events(read_table(spark, sf_dir, "events")))
    return s.select("engine", "operator", "units", "runs", _r("median_seconds"))


APPENDED_CTE = MEASUREMENTS_CTE[:-1] + """
  UNION ALL
  SELECT 'lineitem' AS engine, l_returnflag AS operator, CAST(1 << (l_linenumber % 3) AS INTEGER) AS units,
         l_orderkey AS repetition, l_quantity AS seconds
  FROM lineitem)"""


@register("appended_summary", f"""WITH {APPENDED_CTE}, {SUMMARY_CTE}
SELECT engine, operator, units, runs, round(median_seconds, {DIGITS}) AS median_seconds FROM s""")
def appended_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U-2 then M-1: two timing series from two sources appended by column
    name, then runs and exact median per (engine, operator, units)."""
    runs = append_series(
        measurements_from_events(read_table(spark, sf_dir, "events")),
        measurements_from_lineitem(read_table(spark, sf_dir, "lineitem")),
    )
    s = median_summary(runs)
    return s.select("engine", "operator", "units", "runs", _r("median_seconds"))


@register("speedup_vs_baseline", f"""WITH {MEASUREMENTS_CTE}, {SUMMARY_CTE},
b AS (SELECT engine, units, median_seconds AS base FROM s WHERE operator = 'click')
SELECT s.engine, s.operator, s.units, s.runs, round(s.median_seconds, {DIGITS}) AS median_seconds,
       round(CASE WHEN base > 0 AND median_seconds > 0 THEN base / median_seconds END, {DIGITS}) AS speedup
FROM s LEFT JOIN b USING (engine, units) WHERE s.operator <> 'click'""")
def speedup_vs_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-2: each operator's median against the 'click' series at equal units."""
    s = median_summary(measurements_from_events(read_table(spark, sf_dir, "events")))
    out = speedup_versus(s, {"operator": "click"}, ["engine", "units"])
    return out.select("engine", "operator", "units", "runs", _r("median_seconds"), _r("speedup"))


_SCALING_SQL = f"""WITH {MEASUREMENTS_CTE}, {SUMMARY_CTE},
one AS (SELECT engine, operator, median_seconds AS t1 FROM s WHERE units = 1),
j AS (SELECT s.*, CASE WHEN t1 > 0 AND median_seconds > 0 THEN t1 / median_seconds END AS speedup
      FROM s JOIN one USING (engine, operator)),
k AS (SELECT *, speedup / units AS efficiency, speedup / units * 100 AS efficiency_pct,
             CASE WHEN units > 1 THEN (units / speedup - 1) / (units - 1) END AS serial_fraction FROM j),
r AS (SELECT *, first_value(serial_fraction) OVER (PARTITION BY engine, operator ORDER BY units DESC
             ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS f FROM k),
x AS (SELECT *,
             CASE WHEN f + (1 - f) / units <> 0 THEN 1 / (f + (1 - f) / units) END AS amdahl,
             CASE WHEN f >= 0 AND f <= 1 THEN units - f * (units - 1) END AS gustafson,
             CASE WHEN f <> 0 THEN 1 / f END AS amdahl_limit,
             serial_fraction - lag(serial_fraction) OVER (PARTITION BY engine, operator ORDER BY units)
               AS serial_fraction_change
      FROM r)
SELECT engine, operator, units, metric, round(value, {DIGITS}) AS value, unit FROM (
{chr(10).join(("  UNION ALL " if i else "  ") + f"SELECT engine, operator, units, '{name}' AS metric, CAST({name} AS DOUBLE) AS value, '{unit}' AS unit FROM x" for i, (name, unit) in enumerate(METRICS))}
) WHERE value IS NOT NULL"""


@register("scaling_metrics", _SCALING_SQL)
def scaling_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M-3 … M-10 in long format (metric, value, unit) per operator and units."""
    s = median_summary(measurements_from_events(read_table(spark, sf_dir, "events")))
    long = metrics_long(unit_scaling(s))
    return long.select("engine", "operator", "units", "metric", _r("value"), "unit")
