import random
import statistics

import pytest
from pyspark.sql import functions as F

from bookdemand.operators.aggregates import duplicate_keys, pivot_wide
from bookdemand.operators.quantiles import approx_median, exact_median
from bookdemand.operators.scaling import median_summary, metrics_long, speedup_versus, unit_scaling


def test_exact_median_matches_python_on_skewed_groups(spark):
    rnd = random.Random(5)
    rows = [("hot", float(rnd.randint(0, 40))) for _ in range(4000)]
    rows += [(f"g{i % 5}", rnd.random()) for i in range(1001)]
    rows += [("one", 3.0), ("two", 1.0), ("two", 2.0), ("nul", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: (r["median"], r["n"]) for r in exact_median(df, ["g"], "v", partitions=7).collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g][0] == pytest.approx(statistics.median(vs), abs=1e-12)
        assert got[g][1] == len(vs)


def test_exact_median_agrees_with_spark_median(spark):
    df = spark.range(3000).select((F.col("id") % 4).alias("g"), (F.col("id") * 7 % 101).cast("double").alias("v"))
    ours = {r["g"]: r["median"] for r in exact_median(df, ["g"], "v").collect()}
    theirs = {r["g"]: r["m"] for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    assert ours == pytest.approx(theirs)


def test_approx_median_close(spark):
    df = spark.range(10001).select(F.lit(1).alias("g"), F.col("id").cast("double").alias("v"))
    assert approx_median(df, ["g"], "v").first()["median"] == pytest.approx(5000, abs=5)


def test_duplicates_and_pivot(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (2, 1), (2, 1), (2, 1)], "a int, b int")
    assert sorted(map(tuple, duplicate_keys(df, ["a", "b"]).collect())) == [(1, 1, 2), (2, 1, 3)]
    cells = spark.createDataFrame([("d1", "x", 1.0), ("d1", "y", 2.0), ("d2", "x", 3.0)], "d string, k string, m double")
    wide = pivot_wide(cells, ["d"], "k", ["x", "y", "z"], "m")
    assert wide.columns == ["d", "x", "y", "z"]
    assert sorted(map(tuple, wide.collect())) == [("d1", 1.0, 2.0, None), ("d2", 3.0, None, None)]


# and the metrics it derived from them.
T3_MEDIANS = {1: 1.3615029, 2: 0.7084963, 4: 0.8657363}


def test_scaling_metrics_reproduce_published_values(spark):
    rows = [("pyspark", "T3", n, 1, t) for n, t in T3_MEDIANS.items()]
    rows += [("pandas", "T3", 1, 1, 0.2888583), ("pyspark", "T3x", 1, 1, 2.0)]
    m = spark.createDataFrame(rows, "engine string, operator string, units int, repetition int, seconds double")
    s = median_summary(m)
    scaled = {(r["operator"], r["units"]): r for r in unit_scaling(s).filter("engine = 'pyspark'").collect()}
    r2, r4 = scaled[("T3", 2)], scaled[("T3", 4)]
    assert r2["speedup"] == pytest.approx(1.921679619, abs=1e-6)
    assert r2["efficiency_pct"] == pytest.approx(96.083980961, abs=1e-5)
    assert r4["speedup"] == pytest.approx(1.572653128, abs=1e-6)
    assert r4["efficiency_pct"] == pytest.approx(39.316328194, abs=1e-5)
    assert r4["serial_fraction"] == pytest.approx(0.514490837, abs=1e-6)
    assert r2["amdahl"] == pytest.approx(1.320575834, abs=1e-6)
    assert r4["amdahl"] == pytest.approx(1.572653128, abs=1e-6)
    assert r2["gustafson"] == pytest.approx(1.485509163, abs=1e-6)
    assert r4["gustafson"] == pytest.approx(2.456527489, abs=1e-6)
    assert r4["amdahl_limit"] == pytest.approx(1.943669212, abs=1e-6)
    assert r2["f_in_range"] is True
    vs = speedup_versus(s, {"engine": "pandas"}, ["operator"]).filter("operator = 'T3'")
    assert {r["units"]: r["speedup"] for r in vs.collect()}[4] == pytest.approx(0.333656218, abs=1e-6)
    long = metrics_long(unit_scaling(s))
    assert {"speedup", "efficiency", "serial_fraction", "amdahl", "gustafson", "amdahl_limit"} <= {
        r["metric"] for r in long.collect()}


def test_append_series_and_persisted(spark):
    from bookdemand.operators.aggregates import append_series, persisted
    a = spark.createDataFrame([("x", 1)], "k string, v int")
    b = spark.createDataFrame([(2, "y")], "v int, k string")
    both = append_series(a, b)
    with persisted(both) as cached:
        assert cached.is_cached and cached.count() == 2
    assert not both.is_cached
