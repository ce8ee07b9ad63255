"""Embedding near-duplicates by PCA-ordered tiled comparison.

Unit vectors are turned into the axes of their largest variance.  Two vectors above the
cosine threshold are close on every axis, so rows are dealt into strips of the first
axis, each strip into tiles, and tiles are compared pairwise: products of the leading
axes first, the rest bounded by suffix norms, and only pairs that can still reach the
threshold go on.  What remains is decided in the given coordinates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookdemand.llm.base import stored
from bookdemand.llm.components import connected_components

LEADS = (8, 16, 32)
SLACK = 1e-9  # bounds are kept this much looser than the threshold


def usable(rows: DataFrame) -> DataFrame:
    """vec_id, label, embedding (doubles) of the rows that can link: label and vector not
    null, no null or non-finite component, not all zero."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label"), F.col("embedding").cast("array<double>").alias("embedding"))
            .where(F.col("label").isNotNull() & F.col("embedding").isNotNull())
            .where(finite & F.exists("embedding", lambda x: x != 0)))


def matrix(column: pa.Array) -> np.ndarray:
    """The lists of an Arrow column of equal length as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # keeps squares of extreme values finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def axes(distinct: DataFrame) -> dict[int, np.ndarray]:
    """For each vector length, an orthogonal matrix: principal axes by falling variance of
    all unit vectors.  Tasks return their sums of products, Spark adds them up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            sizes = np.asarray(batch.column(1))
            for d in np.unique(sizes):
                x = unit(matrix(batch.column(0).filter(pa.array(sizes == d))))
                x = np.hstack([x, np.ones((len(x), 1))])
                sums[int(d)] = sums.get(int(d), 0) + x.T @ x
        for d, s in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(s.size, d)), pa.array(np.arange(s.size)), pa.array(s.ravel())], names=["d", "at", "s"])

    parts = distinct.select("embedding", F.size("embedding").cast("long").alias("d")).mapInArrow(run, "d long, at long, s double")
    found: dict[int, np.ndarray] = {}
    for d, at, s in parts.groupBy("d", "at").agg(F.sum("s").alias("s")).collect():  # (d + 1) squared numbers for each length
        found.setdefault(d, np.zeros((d + 1) * (d + 1)))[at] = s
    out = {}
    for d, s in found.items():
        s = s.reshape(d + 1, d + 1)
        spread = s[:d, :d] / s[d, d] - np.outer(s[d, :d], s[d, :d]) / s[d, d] ** 2
        out[d] = np.linalg.eigh(spread)[1][:, ::-1].copy()
    return out


def tile_links(a: np.ndarray, b: np.ndarray, a_own: np.ndarray, b_own: np.ndarray, same: bool, threshold: float,
               block: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Positions (i in a, j in b) of all pairs with cosine >= threshold.  ``a`` and ``b``
    are turned unit vectors, ``a_own`` and ``b_own`` the given ones; same: a is b, i < j."""
    cuts = [k for k in LEADS if k < a.shape[1]]
    rest = {k: (np.sqrt((a[:, k:] ** 2).sum(axis=1)), np.sqrt((b[:, k:] ** 2).sum(axis=1))) for k in cuts}
    left, right = [], []
    for start in range(0, len(a), block):
        rows = a[start:start + block]
        first = cuts[0] if cuts else a.shape[1]
        partial = rows[:, :first] @ b[:, :first].T
        bound = partial + np.outer(rest[first][0][start:start + block], rest[first][1]) if cuts else partial
        i, j = np.nonzero(bound >= threshold - SLACK)
        if same:
            keep = i + start < j
            i, j = i[keep], j[keep]
        so_far = partial[i, j]
        for k, cut in enumerate(cuts):
            upto = cuts[k + 1] if k + 1 < len(cuts) else a.shape[1]
            parts = [np.einsum("ij,ij->i", rows[i[p:p + 65536], cut:upto], b[j[p:p + 65536], cut:upto]) for p in range(0, len(i), 65536)]
            so_far = so_far + (np.concatenate(parts) if parts else 0)
            tail = rest[upto][0][i + start] * rest[upto][1][j] if upto in rest else 0
            keep = so_far + tail >= threshold - SLACK
            i, j, so_far = i[keep], j[keep], so_far[keep]
        exact = np.empty(len(i))
        for p in range(0, len(i), 65536):
            x, y = a_own[i[p:p + 65536] + start], b_own[j[p:p + 65536]]
            exact[p:p + 65536] = (x * y).sum(axis=1) / np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1))
        left.append(i[exact >= threshold] + start)
        right.append(j[exact >= threshold])
    return np.concatenate(left or [np.empty(0, np.int64)]), np.concatenate(right or [np.empty(0, np.int64)])


def _roots(i: np.ndarray, j: np.ndarray, count: int) -> np.ndarray:
    label = np.arange(count)
    while True:
        before = label.copy()
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if np.array_equal(before, label):
            return label


def near_duplicates(rows: DataFrame, threshold: float = 0.98, tile_rows: int = 4096) -> DataFrame:
    """One row for each row of ``rows`` (vec_id, embedding, label): vec_id, n_links (other
    rows of the label with cosine >= threshold, repeats counted), component_id (smallest
    vec_id reachable, its own included) and kept (vec_id = component_id).

    Vectors that are null, zero or hold null or non-finite components, and rows without
    a label, link with nothing; vectors of different length never link.  Equal vectors
    are compared once and counted as often as they occur.  Rows with a null vec_id link
    like others but name no component and are not kept; an empty table gives none.
    """
    if not 0 < threshold < 1:
        raise ValueError("the threshold must lie between 0 and 1")
    slim = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding")
    good = usable(slim)
    distinct = stored(good.groupBy("label", "embedding").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
                      .withColumn("node", F.monotonically_increasing_id()), "distinct_vectors")
    turn = rows.sparkSession.sparkContext.broadcast(axes(distinct))  # one square matrix for each vector length
    width = math.sqrt(2 - 2 * threshold) * (1 + 1e-6)

    def strips(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.array([len(x) for x in batch.column(1)])
            strip = np.empty(len(sizes), np.int64)
            for d in np.unique(sizes):
                x = unit(matrix(batch.column(1).filter(pa.array(sizes == d))))
                strip[sizes == d] = np.floor(x @ turn.value[int(d)][:, 0] / width)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(strip), pa.array(sizes)], names=["label", "embedding", "node", "copies", "strip", "d"])

    kind = distinct.schema["label"].dataType.simpleString()
    placed = distinct.select("label", "embedding", "node", "copies").mapInArrow(
        strips, f"label {kind}, embedding array<double>, node long, copies long, strip long, d long")
    both = placed.withColumn("at", F.explode(F.array(F.struct(F.col("strip").alias("s"), F.lit(True).alias("home")),
                                                     F.struct((F.col("strip") + 1).alias("s"), F.lit(False).alias("home")))))
    both = both.select("label", "d", F.col("at.s").alias("strip"), F.col("at.home").alias("home"), "embedding", "node", "copies")
    homes = placed.groupBy("label", "d", "strip").agg(F.count("*").alias("n"))
    sizes = homes.union(homes.select("label", "d", F.col("strip") + 1, "n")).groupBy("label", "d", "strip").agg(F.sum("n").alias("n"))
    tiles = F.ceil(F.col("n") / tile_rows).cast("int")
    dealt = both.join(sizes, ["label", "d", "strip"]).withColumn("tiles", tiles).withColumn(
        "tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "label", "d", "strip", F.least("tile", "other").alias("p"), F.greatest("tile", "other").alias("q"), "tile", "home", "embedding", "node", "copies")

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        p, q = key[3].as_py(), key[4].as_py()
        node, tile = group.column("node").to_numpy(), group.column("tile").to_numpy()
        home, copies = group.column("home").to_numpy(), group.column("copies").to_numpy()
        own = unit_scale(group.column("embedding"))
        order = np.lexsort((node, tile))
        node, tile, home, copies, own = node[order], tile[order], home[order], copies[order], own[order]
        turned = unit(own) @ turn.value[own.shape[1]]
        first = int(np.searchsorted(tile, p, "right"))
        if p == q:
            i, j = tile_links(turned, turned, own, own, True, threshold)
        else:
            i, j = tile_links(turned[:first], turned[first:], own[:first], own[first:], False, threshold)
            j = j + first
        keep = home[i] | home[j]
        i, j = i[keep], j[keep]
        degree = np.bincount(i, copies[j], len(node)) + np.bincount(j, copies[i], len(node))
        linked = np.flatnonzero(degree)
        return pa.table({"node": node[linked], "links": degree[linked].astype(np.int64), "root": node[_roots(i, j, len(node))[linked]]})

    found = stored(dealt.groupBy("label", "d", "strip", "p", "q").applyInArrow(compare, "node long, links long, root long"), "vector_links")
    degrees = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = distinct.select("node", "first_id").join(roots, "node").groupBy("root").agg(F.min("first_id").alias("group_id"))
    grouped = roots.join(named, "root").select("node", "group_id")
    facts = (distinct.join(degrees, "node", "left").join(grouped, "node", "left")
             .select("label", "embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                     F.coalesce("group_id", "first_id").alias("component_id")))
    linked = good.join(facts, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    fit = F.coalesce(F.col("label").isNotNull() & finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    alone = slim.where(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def unit_scale(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of a chunked list column, scaled so that squares of extreme values stay finite."""
    x = np.concatenate([matrix(c) for c in column.chunks])
    return x / np.exp2(np.floor(np.log2(np.abs(x).max(axis=1, keepdims=True))))
