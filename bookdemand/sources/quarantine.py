"""CSV with a place for bad records (DQ-1, DQ-2, DQ-3 at the source).

Every line is parsed once, permissively, and written once to the shared scratch folder:
sound records typed, bad ones as they stand, with file, position and reason.  So the
lines of a table are the accepted ones, the rejected ones and one header a file.

Records are lines: a quoted field must not hold a line end.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bookdemand.session import scratch_path

RECORD, BLANK, HEADER = "record", "blank", "header"


@dataclass(frozen=True)
class Quarantine:
    """``accepted`` (the schema's columns, typed), ``rejected`` (file, position: the line's
    number in its file, reason, raw) and ``report`` (rule, checked, violations, sample)."""

    accepted: DataFrame
    rejected: DataFrame
    report: DataFrame


def read_csv_quarantine(
    spark: SparkSession, path: str, schema: StructType, *, required: Sequence[str] = (), typed: Mapping[str, Column] | None = None,
) -> Quarantine:
    """Read CSV files whose first line names ``schema``'s columns.

    Rejected with reason 'record': a line with too few or too many fields, or a field that is
    not of its type; 'blank': one of the ``required`` columns is null or blank; a column's
    name: ``typed`` (an expression over the columns that gives null for a bad value, such as
    ``try_to_date``) gives null for a text that is there; 'header': every line of a file
    whose first line is another one (that line included).  Empty lines are no records.
    """
    bad = "_bad_record"
    while bad in schema.fieldNames():
        bad = "_" + bad
    fields = [StructField(f.name, f.dataType, True) for f in schema.fields]
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad, "header": "false"}
    lines = spark.read.text(path).select(
        F.regexp_replace("value", "\r$", "").alias("raw"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    parsed = lines.withColumn("x", F.from_csv("raw", StructType([*fields, StructField(bad, StringType(), True)]).simpleString()[7:-1].replace(":", " "), options))
    columns = {f.name: F.col("x")[f.name] for f in fields}
    values = parsed.select("raw", "file", "block", "at", F.col("x")[bad].isNotNull().alias("_broken"), *[c.alias(n) for n, c in columns.items()])
    blank = F.lit(False)
    for name in required:
        blank = blank | F.col(name).isNull() | (F.trim(F.col(name).cast("string")) == "")
    reason = F.when(F.col("raw") == "", F.lit("")).when(F.col("_broken"), RECORD).when(blank, BLANK)
    out_columns = {f.name: F.col(f.name) for f in fields}
    for name, expression in (typed or {}).items():
        reason = reason.when(expression.isNull() & F.col(name).isNotNull() & (F.trim(F.col(name).cast("string")) != ""), name)
        out_columns[name] = expression
    head = ",".join(f.name for f in fields)
    marked = values.select(
        F.coalesce(reason, F.lit("ok")).alias("reason"), "file", "block", "at", (F.col("raw") == head).alias("is_header"),
        F.when(reason.isNotNull() | (F.col("raw") == head), F.col("raw")).alias("raw"),
        *[F.when(reason.isNull(), c).alias(f"c_{n}") for n, c in out_columns.items()])
    where = scratch_path(spark, "quarantine")
    marked.write.partitionBy("reason").parquet(where)  # the one scan of the input
    kept = spark.read.schema(marked.schema).parquet(where)

    # a line's number: its place in its block, after the lines of the file's earlier blocks
    blocks = kept.groupBy("file", "block").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("lines"), F.min_by("is_header", "at").alias("head"))
    before = F.coalesce(F.sum("lines").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = blocks.select("file", "block", "first", before.alias("before"), F.when(F.col("block") == 0, F.col("head")).alias("head"))
    wrong = ranges.where(~F.col("head")).select("file").distinct()
    named = [F.col(f"c_{n}").alias(n) for n in out_columns]

    accepted = kept.where("reason = 'ok'").join(wrong, "file", "left_anti").where(~F.col("is_header")).select(*named)
    misnamed = kept.join(wrong, "file", "left_semi").withColumn("reason", F.lit(HEADER))
    broken = kept.where("reason not in ('ok', '')").join(wrong, "file", "left_anti")
    rejected = broken.unionByName(misnamed).where("raw is null or raw <> ''").join(ranges.drop("head"), ["file", "block"]).withColumn(
        "position", (F.col("at") - F.col("first") + F.col("before") + 1).cast("long"))
    rejected = rejected.where((F.col("position") > 1) | ~F.col("is_header"))
    # sound lines of a file with a wrong header are kept as values: write them out again
    text = F.concat_ws(",", *[F.coalesce(F.col(f"c_{n}").cast("string"), F.lit("")) for n in out_columns])
    rejected = rejected.select("file", "position", "reason", F.coalesce("raw", text).alias("raw"))

    counts = rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("file", "position")).alias("first"))
    files = ranges.where("block = 0").agg(F.count(F.lit(1)).alias("checked")).withColumn("rule", F.lit("source.header"))
    records = kept.where("reason <> ''").groupBy().agg((F.count(F.lit(1)) - F.count(F.when(F.col("is_header"), 1))).alias("checked"))
    rules = [("source.well_formed", RECORD), ("source.required_values", BLANK), *[(f"source.valid_{n}", n) for n in (typed or {})]]
    named_rules = records.select("checked", F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(x).alias("reason")) for r, x in rules])))
    sample = F.concat_ws(":", F.element_at(F.split(F.col("first.file"), "/"), -1), F.col("first.position").cast("string"))
    report = named_rules.join(counts, "reason", "left").select(
        "rule", "checked", F.coalesce("n", F.lit(0)).cast("long").alias("violations"), F.when(F.col("first").isNotNull(), sample).alias("sample"))
    headers = files.crossJoin(wrong.agg(F.count(F.lit(1)).alias("violations"), F.min("file").alias("file"))).select(  # one row beside one row
        "rule", "checked", "violations", F.element_at(F.split("file", "/"), -1).alias("sample"))
    return Quarantine(accepted, rejected, headers.unionByName(report))
