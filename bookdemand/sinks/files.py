"""Sinks (SNK-1 … SNK-6, SNK-8 batch form).

Every writer is a DataFrameWriter call executed by the executors; the driver
only renames a committed directory (staged publish).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from bookdemand import schemas as S


def write_noop(df: DataFrame) -> None:
    """SNK-5: evaluate every column, keep nothing (timing sink)."""
    df.write.format("noop").mode("overwrite").save()


def write_csv(df: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """SNK-1: a directory of CSV parts with a header line each."""
    df.write.mode(mode).option("header", True).csv(path)


def with_fixed_decimals(df: DataFrame, digits: int = 9) -> DataFrame:
    """SNK-6: doubles rendered as text with ``digits`` decimals."""
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (DoubleType, FloatType)):
            cols.append(F.format_string(f"%.{digits}f", F.col(field.name)).alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


class RuleViolated(RuntimeError):
    """A staged write whose observed metrics break a rule; nothing was published."""


def publish_staged(
    df: DataFrame, path: str, *, fmt: str = "csv", expected_rows: int | None = None,
    metrics: Mapping[str, Column] | None = None, check: Callable[[dict], Sequence[str]] | None = None,
) -> dict:
    """SNK-2: write next to ``path``, check the commit, then swap it in; returns the metrics.

    Readers of ``path`` never see a half-written table: the job commits into
    a staging directory; only a committed (``_SUCCESS``) directory replaces the old
    one, which is moved aside first and deleted last, so that a crash between leaves one
    of the two whole under a name that says what it is.  On
    stores without atomic rename the swap is a copy; :mod:`bookdemand.sinks.snapshots`
    needs no rename.

    ``metrics`` (aggregates by name; ``rows`` is always one) are observed on the rows while
    they are written, so nothing is read again.  ``check`` gets them and names the rules they
    break; if it names any, or ``rows`` is not ``expected_rows``, the staged files are
    removed and this raises.
    """
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.staging-{uuid.uuid4().hex[:12]}"
    observation = Observation(f"publish-{uuid.uuid4().hex[:12]}")
    writer = df.observe(observation, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (metrics or {}).items()]).write.mode("error")
    if fmt == "csv":
        writer.option("header", True).csv(staging)
    else:
        writer.format(fmt).save(staging)
    fs, jstaging = _fs(spark, staging)
    jvm = spark.sparkContext._jvm
    if not fs.exists(jvm.org.apache.hadoop.fs.Path(staging + "/_SUCCESS")):
        raise RuntimeError(f"staged write of {path} did not commit")
    seen = {"rows": 0, **observation.get}
    broken = list(check(seen)) if check else []
    if expected_rows is not None and seen["rows"] != expected_rows:
        broken.append(f"it has {seen['rows']} rows, expected {expected_rows}")
    if broken:
        fs.delete(jstaging, True)
        raise RuleViolated(f"{path} is not published: " + "; ".join(broken))
    _, jtarget = _fs(spark, path)
    retired = jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}.retired-{uuid.uuid4().hex[:12]}")
    replaces = fs.exists(jtarget)
    if replaces and not fs.rename(jtarget, retired):
        raise RuntimeError(f"could not move the old {path} aside; the new one is at {staging}")
    if not fs.rename(jstaging, jtarget):
        if replaces:
            fs.rename(retired, jtarget)
        raise RuntimeError(f"could not move {staging} to {path}; the old table is in place")
    if replaces:
        fs.delete(retired, True)
    return seen


def write_outputs(outputs: Mapping[str, DataFrame], base: str, *, staged: bool = True) -> dict[str, str]:
    """SNK-3: one output directory per named result, fixed names."""
    done = {}
    for name, df in outputs.items():
        target = f"{base.rstrip('/')}/{name}"
        if staged:
            publish_staged(df, target)
        else:
            write_csv(df, target)
        done[name] = target
    return done


def write_landing_zone(requests: DataFrame, path: str, *, mode: str = "overwrite") -> None:
    """Bookings as parquet partitioned by booking month.

    T1's date-range filter then prunes whole month directories before any
    file is opened.  The ``rebalance`` hint clusters rows by month and lets
    AQE split a heavy month over several tasks (and files) instead of
    sending it to one.
    """
    month = F.date_format(F.col(S.BOOKING_DATE), "yyyy-MM")
    (
        requests.withColumn(S.BOOKING_MONTH, month)
        .hint("rebalance", S.BOOKING_MONTH)
        .write.mode(mode)
        .partitionBy(S.BOOKING_MONTH)
        .parquet(path)
    )


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, path: str, *, mode: str = "overwrite") -> str:
    """Save ``df`` as a parquet table bucketed and sorted by ``key``.

    Two tables bucketed the same way on the join key join with a sort-merge
    join that needs no shuffle (the fact and a dimension too large to
    broadcast are co-located once, at write time).  The table is external
    (``path``) in the session catalog.
    """
    (
        df.write.mode(mode)
        .format("parquet")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    return table
