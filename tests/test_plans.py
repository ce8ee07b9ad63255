"""Plan-shape tests: the physical plans are the ones we designed for scale."""

import pytest

from bookdemand.plans.catalog import QUERIES
from bookdemand.plans.inspect import has_operator, plan_text, pushed_filters, read_schemas, uses_python

from conftest import SF001

BATCH = ["filter_select", "group_demand", "group_demand_lineitem", "join_dimension", "priority_score",
         "top_demand", "top_events_per_day", "dq_report", "dq_duplicates", "dq_orphans", "dq_missing_labels",
         "table_fingerprint", "equivalence_report", "equivalence_diff", "median_series", "timing_summary",
         "scaling_metrics", "pivot_median", "speedup_vs_baseline", "synthetic_bookings"]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_in_any_plan(spark, name):
    assert not uses_python(QUERIES[name](spark, SF001))


def test_t1_filters_reach_parquet(spark):
    df = QUERIES["filter_select"](spark, SF001)
    pushed = " ".join(pushed_filters(df))
    assert "EqualTo(o_orderstatus,F)" in pushed
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed


def test_t2_reads_only_needed_columns(spark):
    schema = read_schemas(QUERIES["group_demand"](spark, SF001))[0]
    assert schema == "struct<o_orderkey:bigint,o_custkey:bigint>"


def test_t2_partial_aggregation_before_shuffle(spark):
    text = plan_text(QUERIES["group_demand"](spark, SF001), "simple")
    assert text.count("HashAggregate") >= 2  # partial + final


def test_t3_broadcasts_measured_dimension(spark):
    df = QUERIES["join_dimension"](spark, SF001)
    assert has_operator(df, "BroadcastHashJoin")
    assert "c_custkey" in " ".join(read_schemas(df))


def test_t5_is_take_ordered(spark):
    df = QUERIES["top_demand"](spark, SF001)
    assert has_operator(df, "TakeOrderedAndProject") and not has_operator(df, "Sort ")


def test_top_n_per_group_limits_before_shuffle(spark):
    text = plan_text(QUERIES["top_events_per_day"](spark, SF001), "simple")
    assert "WindowGroupLimit" in text and "Partial" in text
