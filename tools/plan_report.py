"""Physical-plan summary of every registered batch query (markdown table).

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

STREAMING = {"stream_filter", "stream_priority_score", "stream_static_join", "stream_window_demand",
             "stream_dedup", "stream_rank"}
MARKERS = ["BroadcastHashJoin", "SortMergeJoin", "TakeOrderedAndProject", "WindowGroupLimit", "Window ",
           "RangePartitioning", "Expand", "Generate"]


def summarize(df) -> dict:
    from bookdemand.plans.inspect import plan_text, pushed_filters, read_schemas, uses_python

    simple = plan_text(df, "simple")
    shuffles = sum(1 for line in simple.splitlines() if "Exchange " in line and "BroadcastExchange" not in line
                   and "ReusedExchange" not in line)
    broadcasts = simple.count("BroadcastExchange")
    cols = []
    for schema in read_schemas(df):
        cols.append(str(len(re.findall(r"[a-z_0-9]+:", schema))))
    pushed = [p for p in pushed_filters(df) if p and p != "[]"]
    return {
        "shuffles": shuffles,
        "broadcasts": broadcasts,
        "scan_cols": "/".join(cols),
        "pushed": "yes" if any("IsNotNull" not in p or "," in p for p in pushed) else "-",
        "ops": ", ".join(m.strip() for m in MARKERS if m in simple),
        "python": "yes" if uses_python(df) else "no",
    }


def main(argv: list[str]) -> None:
    from bookdemand.plans.catalog import QUERIES
    from bookdemand.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8, extra={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    print(f"# Physical plans ({Path(sf_dir).name}, local[8], AQE on, before AQE re-planning)\n")
    print("Shuffles = hash/range exchanges (broadcasts and reused exchanges excluded); scan cols = columns read "
          "per parquet scan.\n")
    print("| query | shuffles | broadcasts | scan cols | pushed filters | notable operators | python |")
    print("|---|---:|---:|---|---|---|---|")
    for name, fn in QUERIES.items():
        if name in STREAMING:
            continue
        s = summarize(fn(spark, sf_dir))
        print(f"| {name} | {s['shuffles']} | {s['broadcasts']} | {s['scan_cols']} | {s['pushed']} | {s['ops']} "
              f"| {s['python']} |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
