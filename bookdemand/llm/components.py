"""Connected components of an edge list by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookdemand.llm.base import stored


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(
        F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
        F.struct(F.col("b").alias("u"), F.col("a").alias("v")),
    )).alias("e")).select("e.u", "e.v")


def _star(pairs: DataFrame, larger: bool) -> DataFrame:
    """Point neighbours of each node at the smallest node they can see.

    The minimum is a partial aggregate, and the join back is an ordinary
    equi-join whose skewed keys Spark splits, so a hub needs no task of its own.
    """
    low = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    linked = pairs.join(low, "u")
    moved = linked.where("v > u" if larger else "v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
    if not larger:
        moved = moved.union(low.where("u != m").select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a != b").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a, b; any order, repeats
    and loops allowed); root is the smallest node of the component.  Rows with a
    null end are ignored.  An empty edge list gives an empty table.

    Each round's edges are written to the shared scratch folder.  Raises if the
    rounds do not suffice (their number grows with the logarithm of the size).
    """
    flat = (edges.where("a is not null and b is not null and a != b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    now = stored(flat, "edges")
    mark = None
    for _ in range(max_rounds):
        large = _star(_both_ways(now), True)
        pairs = large.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        now = stored(_star(pairs, False), "edges")
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if (seen["n"], seen["h"]) == mark:
            break
        mark = (seen["n"], seen["h"])
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return roots.union(now.select("b", F.col("b").alias("root")).distinct())
