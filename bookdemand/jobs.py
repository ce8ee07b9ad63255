"""The output job: T1–T5 built from requests and rooms, each published
under a fixed name with a staged (commit-then-swap) write."""

from __future__ import annotations

from pyspark.sql import DataFrame

from bookdemand import schemas as S
from bookdemand.operators import demand_by_room, filter_requests, join_rooms, priority_score, top_demand
from bookdemand.sinks.files import write_outputs

# Fixed output names, one per transformation.
OUTPUT_NAMES = {
    "T1": "T1_filter",
    "T2": "T2_group",
    "T3": "T3_join",
    "T4": "T4_score",
    "T5": "T5_top",
}


def booking_outputs(
    requests: DataFrame,
    rooms: DataFrame,
    *,
    approved: str = S.APPROVED,
    min_attendees: int = S.MIN_ATTENDEES,
    start: str = S.WINDOW_START,
    end: str = S.WINDOW_END,
    n: int = S.TOP_N,
) -> dict[str, DataFrame]:
    """Lazy plans of T1–T5 (T4 runs on T3's output, the others on the raw
    tables), keyed by their output names."""
    joined = join_rooms(requests, rooms)
    plans = {
        "T1": filter_requests(requests, approved=approved, min_attendees=min_attendees, start=start, end=end),
        "T2": demand_by_room(requests),
        "T3": joined,
        "T4": priority_score(joined, approved=approved),
        "T5": top_demand(requests, n),
    }
    return {OUTPUT_NAMES[k]: v for k, v in plans.items()}


def publish_booking_outputs(requests: DataFrame, rooms: DataFrame, base: str, **params) -> dict[str, str]:
    """Write every output as a CSV directory under ``base`` (staged publish)."""
    return write_outputs(booking_outputs(requests, rooms, **params), base, staged=True)


def main(argv: list[str] | None = None) -> int:
    """Command line: ``spark-submit bookdemand/jobs.py --requests R --rooms M --out DIR``
    (or ``python -m bookdemand.jobs ...``).  Reads the two tables (strict CSV
    with the published or canonical header, or parquet with canonical
    columns) and publishes T1–T5 under ``DIR``; prints one ``name<TAB>path``
    line per output."""
    import argparse

    from bookdemand.session import build_session, scratch_path, size_to_input
    from bookdemand.sources.csv import read_requests_csv, read_rooms_csv

    p = argparse.ArgumentParser(prog="bookdemand.jobs", description="Publish T1-T5 for a requests and a rooms table.")
    p.add_argument("--requests", required=True, help="requests table (file or directory)")
    p.add_argument("--rooms", required=True, help="rooms table (file or directory)")
    p.add_argument("--out", required=True, help="base directory of the outputs")
    p.add_argument("--format", choices=("csv", "parquet"), default="csv")
    p.add_argument("--header", choices=("published", "canonical"), default="published",
                   help="CSV header names: the published dataset's or the canonical ones")
    p.add_argument("--master", default=None, help="only outside spark-submit, e.g. local[*]")
    p.add_argument("--approved", default=S.APPROVED)
    p.add_argument("--min-attendees", type=int, default=S.MIN_ATTENDEES)
    p.add_argument("--start", default=S.WINDOW_START)
    p.add_argument("--end", default=S.WINDOW_END)
    p.add_argument("--top", type=int, default=S.TOP_N)
    args = p.parse_args(argv)

    spark = build_session(args.master)
    size_to_input(spark, args.requests, args.rooms)
    if args.format == "parquet":
        requests, rooms = spark.read.parquet(args.requests), spark.read.parquet(args.rooms)
    else:
        published = args.header == "published"
        requests = read_requests_csv(spark, args.requests, S.PUBLISHED_REQUEST_HEADER if published else None)
        rooms = read_rooms_csv(spark, args.rooms, S.PUBLISHED_ROOM_HEADER if published else None)
        # five outputs read the requests: parse the text once
        landed = scratch_path(spark, "requests")
        requests.write.parquet(landed)
        requests = spark.read.schema(requests.schema).parquet(landed)
    done = publish_booking_outputs(
        requests, rooms, args.out, approved=args.approved, min_attendees=args.min_attendees,
        start=args.start, end=args.end, n=args.top,
    )
    for name, path in sorted(done.items()):
        print(f"{name}\t{path}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
