"""Command line for the flows around the output job (``bookdemand.jobs``).

    python -m bookdemand.commands generate --rooms 40 --requests 500000 --seed 7 --out DIR
    python -m bookdemand.commands metrics --timings raw.csv --out DIR --baseline engine=pandas
    python -m bookdemand.commands compare --left A --right B --value request_count --key room_id

``generate`` writes synthetic rooms and requests (GEN-1 … GEN-5) under
``DIR/rooms`` and ``DIR/requests``: CSV with the published header (dates and
instants as ISO text), which the strict readers take back, or parquet with
canonical columns.  ``metrics`` turns raw timings ``engine, operator, units,
repetition, seconds`` into the median summary (M-1), speedups against a
baseline series (M-2) and the long metric table (M-3 … M-10), doubles with
nine decimals (SNK-6).  ``compare`` is the equivalence gate between two
published result tables (EQ-1 … EQ-6): it prints the PASS/FAIL report and
exits with status 1 if any check fails.  Every output is a staged publish.
"""

from __future__ import annotations

import argparse
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampType

from bookdemand import schemas as S
from bookdemand.functions.dates import iso_date, iso_instant
from bookdemand.operators.equivalence import equivalence_report
from bookdemand.operators.quality import assert_fraction
from bookdemand.operators.scaling import median_summary, metrics_long, require_ok, speedup_versus, unit_scaling
from bookdemand.session import build_session, size_to_input
from bookdemand.sinks.files import publish_staged, with_fixed_decimals, write_outputs
from bookdemand.sources.csv import read_csv_strict
from bookdemand.sources.synthetic import synthetic_requests, synthetic_rooms

TIMINGS_SCHEMA = StructType([
    StructField("engine", StringType()),
    StructField("operator", StringType()),
    StructField("units", IntegerType()),
    StructField("repetition", IntegerType()),
    StructField("seconds", DoubleType()),
])


def as_published(df: DataFrame, header: Mapping[str, str]) -> DataFrame:
    """Canonical columns → the published header, in its order; dates and
    instants rendered as ISO text (SF-17)."""
    types = {f.name: f.dataType for f in df.schema.fields}
    cols = []
    for published, canonical in header.items():
        c = F.col(canonical)
        if isinstance(types[canonical], DateType):
            c = iso_date(c)
        elif isinstance(types[canonical], TimestampType):
            c = iso_instant(c)
        cols.append(c.alias(published))
    return df.select(*cols)


def generate(spark, rooms: int, requests: int, seed: int, out: str, *, fmt: str = "csv",
             rows_per_partition: int = 2_000_000) -> dict[str, str]:
    """Write ``rooms`` rooms and ``requests`` requests; the row ranges are
    split so no task generates more than ``rows_per_partition`` rows."""
    parallelism = spark.sparkContext.defaultParallelism
    slices = max(parallelism, -(-requests // rows_per_partition))
    room_df = synthetic_rooms(spark.range(rooms), "id", seed=seed)
    request_df = synthetic_requests(spark.range(0, requests, 1, slices), "id", room_df, seed=seed)
    room_df = room_df.drop("room_index")
    if fmt == "parquet":
        done = {}
        for name, df in (("rooms", room_df), ("requests", request_df)):
            done[name] = f"{out.rstrip('/')}/{name}"
            publish_staged(df, done[name], fmt="parquet")
        return done
    return write_outputs(
        {"rooms": as_published(room_df, S.PUBLISHED_ROOM_HEADER),
         "requests": as_published(request_df, S.PUBLISHED_REQUEST_HEADER)},
        out, staged=True,
    )


def metrics(spark, timings: str, out: str, baseline: Mapping[str, str] | None = None) -> dict[str, str]:
    """Summary, speedups and long metrics from a raw timings CSV."""
    raw = read_csv_strict(spark, timings, TIMINGS_SCHEMA)
    summary = median_summary(raw, ordered=True)
    scaled = unit_scaling(summary)
    require_ok(scaled)
    assert_fraction(scaled, "reference_fraction")  # DQ-17
    outputs = {
        "summary": summary,
        "metrics": metrics_long(scaled).drop("status").orderBy("engine", "operator", "units", "metric"),
    }
    if baseline:
        speedups = speedup_versus(summary, dict(baseline), ["operator"])
        require_ok(speedups)
        outputs["speedup"] = speedups.drop("status").orderBy("engine", "operator", "units")
    return write_outputs({k: with_fixed_decimals(v) for k, v in outputs.items()}, out, staged=True)


def read_result(spark, path: str, schema: str | None = None) -> DataFrame:
    """A published result table (one CSV file or a directory of parts), read
    by its header: with ``schema`` (DDL) typed, else every column as text —
    never inferred.  An empty location is an error."""
    reader = spark.read.option("header", True).option("mode", "FAILFAST")
    if schema:
        reader = reader.schema(schema).option("enforceSchema", False)
    else:
        reader = reader.option("inferSchema", False)
    df = reader.csv(path)
    if not df.inputFiles():
        raise FileNotFoundError(f"no CSV files at {path}")
    return df


def compare(spark, left: str, right: str, *, value: str, keys: list[str], schema: str | None = None,
            compare_rows: bool = True, tol: float = 1e-9) -> DataFrame:
    """EQ report of two result tables; the control column is read as a number."""
    a, b = read_result(spark, left, schema), read_result(spark, right, schema)
    if a.columns != b.columns:
        raise ValueError(f"different columns: {a.columns} vs {b.columns}")
    a = a.withColumn(value, F.col(value).cast("double"))
    b = b.withColumn(value, F.col(value).cast("double"))
    return equivalence_report(a, b, value_col=value, keys=keys, compare_rows=compare_rows, tol=tol)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="bookdemand.commands")
    p.add_argument("--master", default=None, help="only outside spark-submit, e.g. local[*]")
    sub = p.add_subparsers(dest="command", required=True)
    g = sub.add_parser("generate", help="synthetic rooms and requests")
    g.add_argument("--rooms", type=int, default=40)
    g.add_argument("--requests", type=int, default=500_000)
    g.add_argument("--seed", type=int, required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--format", choices=("csv", "parquet"), default="csv")
    g.add_argument("--rows-per-partition", type=int, default=2_000_000)
    m = sub.add_parser("metrics", help="summary and scaling metrics from raw timings")
    m.add_argument("--timings", required=True, help="CSV: engine,operator,units,repetition,seconds")
    m.add_argument("--out", required=True)
    m.add_argument("--baseline", action="append", default=[], metavar="COLUMN=VALUE",
                   help="baseline series for speedups, e.g. engine=pandas (repeatable)")
    c = sub.add_parser("compare", help="equivalence gate between two result tables")
    c.add_argument("--left", required=True)
    c.add_argument("--right", required=True)
    c.add_argument("--value", required=True, help="control column (count, sum and mean compared)")
    c.add_argument("--key", action="append", required=True, help="key column(s) for counts per key")
    c.add_argument("--schema", default=None, help="DDL of both tables; default: all columns as text")
    c.add_argument("--no-rows", action="store_true", help="skip the exact row multiset check")
    c.add_argument("--tol", type=float, default=1e-9)
    c.add_argument("--out", default=None, help="also publish the report here")
    args = p.parse_args(argv)

    spark = build_session(args.master)
    if args.command == "compare":
        size_to_input(spark, args.left, args.right)
        report = compare(spark, args.left, args.right, value=args.value, keys=args.key, schema=args.schema,
                         compare_rows=not args.no_rows, tol=args.tol)
        if args.out:
            write_outputs({"report": with_fixed_decimals(report)}, args.out, staged=True)
        rows = report.collect()  # one row per check
        for r in rows:
            print("\t".join(str(r[k]) for k in ("check", "left_value", "right_value", "differing", "status")))
        return 0 if all(r["status"] == "PASS" for r in rows) else 1
    if args.command == "generate":
        done = generate(spark, args.rooms, args.requests, args.seed, args.out, fmt=args.format,
                        rows_per_partition=args.rows_per_partition)
    else:
        size_to_input(spark, args.timings)
        base = dict(item.split("=", 1) for item in args.baseline)
        done = metrics(spark, args.timings, args.out, base or None)
    for name, path in sorted(done.items()):
        print(f"{name}\t{path}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
