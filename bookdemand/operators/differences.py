"""Which rows differ?  (EQ-4, EQ-5 with names), by a hash tree over key ranges.

A tree holds, for every range of keys, the number of rows and two order-independent
sums of row hashes; a node covers the ranges of its 256 children.  Two trees are compared
from the root down, opening only branches that differ; only the rows of leaves that
differ are read again and compared in full.  A tree is a small table and can be kept
beside its data, so that two states of a table are compared without reading either whole.

Keys are integers.  A range is a prefix of the key's bits, so it does not depend on the
data and both sides have the same ranges; null keys are a range of their own.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookdemand.session import scratch_path

FAN_BITS = 8
LEVELS = 7  # a shift by 64 bits would be none
NULLS = -1  # the leaf of null keys


@dataclass(frozen=True)
class HashTree:
    """``nodes`` (level, node, rows, sum, mix): level 0 holds the leaves, ``node`` is the
    key moved to start at 0 and shifted by ``leaf_bits`` + 8 bits a level; ``key`` and
    ``columns`` say what was hashed."""

    nodes: DataFrame
    leaf_bits: int
    key: str
    columns: tuple[str, ...]


def _moved(key: Column) -> Column:
    """The key's bits in order from 0 up; two's complement keeps order within 63 bits."""
    return F.shiftrightunsigned(key.cast("long").bitwiseXOR(F.lit(-(1 << 63))), 1)


def leaf_of(key: Column, leaf_bits: int) -> Column:
    return F.coalesce(F.shiftright(_moved(key), leaf_bits - 1), F.lit(NULLS))


def bounds_of(leaf: int, leaf_bits: int) -> tuple[int, int]:
    """First and last key of a leaf."""
    low = (leaf << leaf_bits) - (1 << 63)
    return low, low + (1 << leaf_bits) - 1


def leaf_width(df: DataFrame, key: str, leaves: int = 4096) -> int:
    """Bits of a leaf's range such that the keys of ``df`` fall into about ``leaves`` ranges."""
    row = df.agg(F.min(key).cast("long").alias("low"), F.max(key).cast("long").alias("high")).first()
    if row["low"] is None:
        return 8
    return max(1, (row["high"] - row["low"]).bit_length() - (leaves.bit_length() - 1))


def hash_tree(df: DataFrame, key: str, columns: Sequence[str] | None = None, *, leaf_bits: int) -> HashTree:
    """The tree of ``df``'s rows: one aggregate pass with partial sums, whatever the key's skew.

    Hashes read types, not texts, and null and absent values differ.  The nodes are written
    to the shared scratch folder, a folder a level, so that a comparison reads only them."""
    cols = list(columns or df.columns)
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    one, two = F.xxhash64(F.lit(1), *cols, nulls), F.xxhash64(F.lit(2), nulls, *cols)
    half = F.lit((1 << 31) - 1)
    level = df.select(leaf_of(F.col(key), leaf_bits).alias("node"), one.alias("a"), two.alias("b")).groupBy("node").agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col("a").bitwiseAND(half).cast("decimal(38,0)")).alias("sum"),
        F.sum(F.shiftrightunsigned("b", 33).cast("decimal(38,0)")).alias("mix"))
    spark, where = df.sparkSession, scratch_path(df.sparkSession, "hash-tree")
    level.write.parquet(f"{where}/leaves")
    level = spark.read.schema(level.schema).parquet(f"{where}/leaves")
    out = level.select(F.lit(0).alias("level"), "*")
    for k in range(1, LEVELS + 1):
        if leaf_bits + FAN_BITS * (k - 1) >= 64:
            break
        up = F.when(F.col("node") == NULLS, F.lit(NULLS)).otherwise(F.shiftright("node", FAN_BITS * k))
        out = out.unionByName(level.select(F.lit(k).alias("level"), up.alias("node"), "rows", "sum", "mix").groupBy("level", "node").agg(
            F.sum("rows").alias("rows"), F.sum("sum").alias("sum"), F.sum("mix").alias("mix")))
    out.write.partitionBy("level").parquet(f"{where}/nodes")
    return HashTree(spark.read.schema(out.schema).parquet(f"{where}/nodes"), leaf_bits, key, tuple(cols))


def unequal_leaves(left: HashTree, right: HashTree) -> list[int]:
    """The leaves in which two trees differ, from the top down: a level reads only the
    children of nodes that differ.  As many as the trees have leaves at most."""
    if (left.leaf_bits, left.key, left.columns) != (right.leaf_bits, right.key, right.columns):
        raise ValueError("the trees are of other keys, columns or ranges")
    top = max(k for k in range(LEVELS + 1) if k == 0 or left.leaf_bits + FAN_BITS * (k - 1) < 64)
    opened: list[int] | None = None
    for level in reversed(range(top + 1)):
        sides = []
        for k, tree in enumerate((left, right)):
            nodes = tree.nodes.where(F.col("level") == level)
            if opened is not None:
                parent = F.when(F.col("node") == NULLS, F.lit(NULLS)).otherwise(F.shiftright("node", FAN_BITS))
                nodes = nodes.where(parent.isin(opened))
            sides.append(nodes.select("node", "rows", "sum", "mix", F.lit(k).alias("side")))
        both = sides[0].unionByName(sides[1]).groupBy("node", "rows", "sum", "mix").agg(F.count(F.lit(1)).alias("n")).where("n = 1")
        opened = sorted(r["node"] for r in both.select("node").distinct().collect())
        if not opened:
            return []
    return opened or []


def _ranges(leaves: Sequence[int], leaf_bits: int) -> list[tuple[int, int]]:
    """Key ranges of ``leaves``, neighbours joined."""
    out: list[tuple[int, int]] = []
    for leaf in sorted(x for x in leaves if x != NULLS):
        low, high = bounds_of(leaf, leaf_bits)
        if out and out[-1][1] + 1 == low:
            out[-1] = out[-1][0], high
        else:
            out.append((low, high))
    return out


def in_leaves(df: DataFrame, key: str, leaves: Sequence[int], leaf_bits: int, most_ranges: int = 200) -> DataFrame:
    """The rows of ``df`` in ``leaves``.  The ranges are predicates on the stored key, which
    the scan takes; if they are many, neighbours are read with the gap between them first."""
    c, ranges = F.col(key), _ranges(leaves, leaf_bits)
    while len(ranges) > most_ranges:  # join the pair with the smallest gap
        k = min(range(len(ranges) - 1), key=lambda i: ranges[i + 1][0] - ranges[i][1])
        ranges[k:k + 2] = [(ranges[k][0], ranges[k + 1][1])]
    held = c.isNull() if NULLS in leaves else F.lit(False)
    for low, high in ranges:
        held = held | ((c >= F.lit(low)) & (c <= F.lit(high)))
    exact = leaf_of(c, leaf_bits).isin(list(leaves)) if len(leaves) <= 4096 else F.lit(True)
    return df.where(held).where(exact)


def differing_rows(left: DataFrame, right: DataFrame, key: str, columns: Sequence[str] | None = None, *,
                   trees: tuple[HashTree, HashTree] | None = None, leaves: int = 4096) -> DataFrame:
    """``columns``, ``side`` ('left' or 'right': where the row is more often) and ``copies``
    (how many more times): what ``exceptAll`` gives both ways, equal rows together.

    ``trees`` are kept ones of the two sides; without them both are made here."""
    cols = list(columns or left.columns)
    if trees is None:
        bits = leaf_width(left.select(key).unionByName(right.select(key)), key, leaves)
        trees = tuple(hash_tree(df, key, cols, leaf_bits=bits) for df in (left, right))
    open_leaves = unequal_leaves(*trees)
    sides = [in_leaves(df, key, open_leaves, trees[0].leaf_bits).select(*cols, F.lit(n).alias("_n")) for df, n in ((left, 1), (right, -1))]
    counted = sides[0].unionByName(sides[1]).groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return counted.select(*cols, F.when(F.col("_n") > 0, "left").otherwise("right").alias("side"), F.abs("_n").alias("copies"))
