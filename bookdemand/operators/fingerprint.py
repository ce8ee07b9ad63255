"""Content fingerprint of a table (DQ-14).

Row count plus the sum of a 60-bit hash of every row, summed as a 38-digit
decimal: independent of row order, partitioning and file layout, computed in
one aggregate pass with partial sums.  A row is hashed as text that other
engines write alike and that no other row has: every column ends with a bar,
texts start with their byte count, null is a tilde, instants are microseconds
since 1970 in UTC, and doubles are written whole — those that a count of
millionths gives back exactly as that count, all others in hexadecimal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, FloatType, StringType, TimestampNTZType, TimestampType

from bookdemand.functions.draws import text_hash

NULL_MARK = "~"
END = "|"
MICRO = 1e6
LARGEST = 9e12  # millionths of a larger number need not fit 64 bits


def double_text(c: Column) -> Column:
    """A text for each double: the count of millionths that gives it back, else its
    hexadecimal form, 'nan', 'inf' or '-inf'.  Zero and minus zero are equal."""
    counted = F.when(F.abs(c) < F.lit(LARGEST), F.floor(c * F.lit(MICRO) + F.lit(0.5)).cast("long"))
    plain = F.regexp_replace(F.format_string("%a", c), r"\.0p", "p")
    other = F.when(F.isnan(c), "nan").when(c == F.lit(float("inf")), "inf").when(c == F.lit(float("-inf")), "-inf").otherwise(plain)
    return F.when(counted / F.lit(MICRO) == c, counted.cast("string")).otherwise(other)


def _as_text(df: DataFrame, column: str) -> Column:
    c, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, (DoubleType, FloatType)):
        text = double_text(c.cast("double"))
    elif isinstance(kind, (TimestampType, TimestampNTZType)):
        text = F.unix_micros(c.cast("timestamp")).cast("string")
    elif isinstance(kind, (StringType, BinaryType)):
        text = F.concat(F.octet_length(c).cast("string"), F.lit(":"), c.cast("string") if isinstance(kind, StringType) else F.hex(c))
    else:
        text = c.cast("string")
    return F.coalesce(text, F.lit(NULL_MARK))


def row_text(df: DataFrame, columns: list[str] | None = None) -> Column:
    parts = [_as_text(df, c) for c in (columns or df.columns)]
    return F.concat_ws(END, *parts, F.lit(""))


def table_fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    hashed = df.select(text_hash(row_text(df, columns)).alias("h"))
    # 20 bits at a time: sums of longs, exact for up to 2^43 rows
    piece = [F.shiftrightunsigned("h", 20 * k).bitwiseAND(F.lit((1 << 20) - 1)) for k in range(3)]
    sums = hashed.agg(F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(p), F.lit(0)).alias(f"s{k}") for k, p in enumerate(piece)])
    whole = sum((F.col(f"s{k}").cast("decimal(38,0)") * F.lit(1 << (20 * k)).cast("decimal(18,0)") for k in (1, 2)), F.col("s0").cast("decimal(38,0)"))
    return sums.select("rows", whole.cast("decimal(38,0)").cast("string").alias("fingerprint"))
