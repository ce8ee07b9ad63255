"""Deterministic identifiers (SF-13, SF-14) as built-in expressions."""

from __future__ import annotations

import uuid as _uuid

from pyspark.sql import Column
from pyspark.sql import functions as F

from bookdemand.functions._col import as_col


def uuid5(namespace: str | _uuid.UUID, name: str | Column) -> Column:
    """RFC 4122 version-5 UUID of ``name`` (UTF-8) in ``namespace``.

    SHA-1 over namespace bytes + name bytes, first 16 bytes, version nibble 5,
    variant bits 10 — all JVM-side, no Python UDF.
    """
    ns_hex = _uuid.UUID(str(namespace)).hex
    digest = F.sha1(F.concat(F.unhex(F.lit(ns_hex)), F.encode(as_col(name), "UTF-8")))
    variant_nibble = F.lower(
        F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8))
    )
    return F.concat_ws(
        "-",
        F.substring(digest, 1, 8),
        F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant_nibble, F.substring(digest, 18, 3)),
        F.substring(digest, 21, 12),
    )


def padded_code(prefix: str, number: str | Column, width: int) -> Column:
    """``prefix`` + zero-padded number, e.g. ``LAB-007``."""
    return F.format_string(f"{prefix}%0{width}d", as_col(number))
