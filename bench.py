"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

median of ``BENCH_REPS`` (default 5) timed runs; a run builds the plan and
writes every column to the ``noop`` sink.  Inputs are read from parquet on
every run (no caching).  Prints one JSON line; ``value`` is the sum of the
T1–T5 medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = {
    "T1_filter_select": "filter_select",
    "T2_group_demand": "group_demand",
    "T3_join_dimension": "join_dimension",
    "T4_priority_score": "priority_score",
    "T5_top_demand": "top_demand",
}
EXTRA = [
    "group_demand_lineitem", "top_events_per_day", "median_series", "pivot_median", "scaling_metrics",
    "dq_report", "dq_duplicates", "filter_select_landing", "equivalence_report", "table_fingerprint",
]


def reference_scale(spark, reps: int) -> dict:
    """T1–T5 on the original workload's shape and size: 500,000 requests ×
    40 rooms (14 + 10 columns) from the seeded generator, inputs persisted
    and counted before timing and T4 timed on a persisted T3, as in the
    """
    from pyspark import StorageLevel

    from bookdemand.operators import demand_by_room, filter_requests, join_rooms, priority_score, top_demand
    from bookdemand.sinks.files import write_noop
    from bookdemand.sources.synthetic import synthetic_requests, synthetic_rooms

    rooms = synthetic_rooms(spark.range(40), "id", seed=1009)
    requests = synthetic_requests(spark.range(500_000), "id", rooms, seed=1009)
    rooms = rooms.drop("room_index").persist(StorageLevel.MEMORY_AND_DISK)
    requests = requests.persist(StorageLevel.MEMORY_AND_DISK)
    rooms.count(), requests.count()
    joined = join_rooms(requests, rooms).persist(StorageLevel.MEMORY_AND_DISK)
    joined.count()
    plans = {
        "T1": lambda: filter_requests(requests),
        "T2": lambda: demand_by_room(requests),
        "T3": lambda: join_rooms(requests, rooms),
        "T4": lambda: priority_score(joined),
        "T5": lambda: top_demand(requests, 20),
    }
    out = {}
    for label, build in plans.items():
        write_noop(build())
        runs = []
        for _ in range(reps):
            t0 = time.perf_counter()
            write_noop(build())
            runs.append(time.perf_counter() - t0)
        out[label] = round(statistics.median(runs), 4)
    out["sum"] = round(sum(out[k] for k in plans), 4)
    out["rows"] = 500_000
    for df in (joined, requests, rooms):
        df.unpersist()
    return out


def main() -> None:
    from bookdemand.session import build_session
    from bookdemand.sinks.files import write_noop
    from bookdemand.plans.catalog import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "5"))
    extra = os.environ.get("BENCH_EXTRA", "1") != "0"
    spark = build_session(
        f"local[{cpus}]",
        app_name="bookdemand-bench",
        shuffle_partitions=max(2, cpus * 2),
        extra={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    from bookdemand.operators.join import forget_profiles

    def timed(name: str) -> float:
        write_noop(QUERIES[name](spark, sf_dir))  # warm-up, discarded
        runs = []
        for _ in range(reps):
            forget_profiles()  # every run measures its dimensions anew
            t0 = time.perf_counter()
            write_noop(QUERIES[name](spark, sf_dir))
            runs.append(time.perf_counter() - t0)
        return round(statistics.median(runs), 4)

    results = {label: timed(name) for label, name in HEADLINE.items()}
    if extra:
        for name in EXTRA:
            results[name] = timed(name)
    same_scale = reference_scale(spark, reps) if os.environ.get("BENCH_REFERENCE_SCALE", "1") != "0" else {}
    spark.stop()
    sf = Path(sf_dir).name.replace("sf", "")
    print(json.dumps({
        "metric": "t1_t5_median_sum",
        "value": round(sum(results[k] for k in HEADLINE), 4),
        "unit": "sec",
        "queries": results,
        "sf": sf,
        "cpus": cpus,
        "reps": reps,
        "reference_scale": same_scale,
    }))


if __name__ == "__main__":
    main()
