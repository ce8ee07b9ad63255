"""CSV sources with explicit schemas (SRC-1 … SRC-4).

No inference: the schema is declared, a malformed record fails the read
(``FAILFAST``) and the header must match the declared column order
(``enforceSchema=false``).  Dates and instants are typed in one projection
right after the read — under ANSI a bad value raises instead of turning
into null.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from bookdemand import schemas as S


def _renamed(schema: StructType, header: Mapping[str, str] | None) -> StructType:
    if not header:
        return schema
    back = {v: k for k, v in header.items()}
    return StructType([StructField(back[f.name], f.dataType, f.nullable) for f in schema.fields])


def read_csv_strict(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )


def read_requests_csv(spark: SparkSession, path: str, header: Mapping[str, str] | None = None) -> DataFrame:
    """SRC-1: requests CSV → canonical typed columns.

    ``header`` maps file column names to canonical ones, e.g.
    ``schemas.PUBLISHED_REQUEST_HEADER`` for the published booking dataset.
    """
    raw = read_csv_strict(spark, path, _renamed(S.REQUESTS_CSV_SCHEMA, header))
    if header:
        raw = raw.select(*[F.col(src).alias(dst) for src, dst in header.items()])
    return raw.select(
        *[F.col(c) for c in S.REQUEST_COLUMNS[:6]],
        F.to_date(F.col(S.BOOKING_DATE), "yyyy-MM-dd").alias(S.BOOKING_DATE),
        F.col(S.START_TIME), F.col(S.END_TIME), F.col(S.ATTENDEES), F.col(S.REASON), F.col(S.STATUS),
        F.to_timestamp(F.col(S.CREATED_AT)).alias(S.CREATED_AT),
        F.to_timestamp(F.col(S.UPDATED_AT)).alias(S.UPDATED_AT),
    )


def read_rooms_csv(spark: SparkSession, path: str, header: Mapping[str, str] | None = None) -> DataFrame:
    """SRC-2: rooms CSV → canonical typed columns."""
    raw = read_csv_strict(spark, path, _renamed(S.ROOMS_CSV_SCHEMA, header))
    if header:
        raw = raw.select(*[F.col(src).alias(dst) for src, dst in header.items()])
    return raw.select(
        *[F.col(c) for c in (S.ROOM_ID, S.FLOOR_ID, S.CODE, S.NAME, S.CAPACITY, S.DESCRIPTION, S.STATE, S.ACTIVE)],
        F.to_timestamp(F.col(S.CREATED_AT)).alias(S.CREATED_AT),
        F.to_timestamp(F.col(S.UPDATED_AT)).alias(S.UPDATED_AT),
    )


def read_parts(spark: SparkSession, directory: str, schema: StructType) -> DataFrame:
    """SRC-3 / SRC-4 / U-1: a directory of ``part-*.csv`` files is one table.
    A part whose header names other columns, or another order, fails the read.

    Raises ``FileNotFoundError`` when the directory holds no part file (file
    listing only; no data is read on the driver).
    """
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("pathGlobFilter", "part-*.csv")
        .csv(directory)
    )
    if not df.inputFiles():
        raise FileNotFoundError(f"no part-*.csv files in {directory}")
    return df
