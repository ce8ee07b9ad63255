"""Read a DataFrame's physical plan the way a Spark user does: ``explain``."""

from __future__ import annotations

import contextlib
import io

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def has_operator(df: DataFrame, name: str) -> bool:
    return name in plan_text(df, "simple")


def uses_python(df: DataFrame) -> bool:
    """True if any Python UDF / Arrow evaluation node is in the plan."""
    text = plan_text(df, "simple")
    return any(tag in text for tag in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas",
                                       "FlatMapGroupsInPandas"))


def pushed_filters(df: DataFrame) -> list[str]:
    """The ``PushedFilters`` lists of every parquet scan in the plan."""
    out = []
    for line in plan_text(df, "formatted").splitlines():
        line = line.strip()
        if line.startswith("PushedFilters:"):
            out.append(line.split(":", 1)[1].strip())
    return out


def read_schemas(df: DataFrame) -> list[str]:
    out = []
    for line in plan_text(df, "formatted").splitlines():
        line = line.strip()
        if line.startswith("ReadSchema:"):
            out.append(line.split(":", 1)[1].strip())
    return out


def exchange_count(df: DataFrame) -> int:
    """Number of shuffle exchanges (broadcasts excluded) in the physical plan."""
    return sum(1 for line in plan_text(df, "simple").splitlines()
               if "Exchange " in line and "BroadcastExchange" not in line)
