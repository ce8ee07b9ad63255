"""Mixing sources to target weights by iterative proportional fitting.

Every document has a source, a language and a topic; their token counts make a table
of cells.  The cells' weights are raked in turn to the target shares of each dimension
until all three hold, and a document is kept with the probability that turns its cell's
tokens into the cell's share of the token budget.
"""

from __future__ import annotations

import math
import sys
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookdemand.llm.base import free_name, stored

DIMENSIONS = ("source", "lang", "topic")
MISSING = "(none)"  # a null source or language is a category of its own


def measured(docs: DataFrame, topics: int = 8) -> DataFrame:
    """doc_id, draw, source, lang, tokens, groups of every row: its words, counted whole
    and by ``topics`` word groups, and a hash of id and text for the draw."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, groups = [], []
            for text in batch.column(4):
                words = (text.as_py() or "").lower().encode("utf-8", "surrogatepass").split()
                sizes.append(len(words))
                codes = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
                groups.append(np.bincount((codes >> 7) % topics, minlength=topics))
            counts = np.concatenate(groups) if groups else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(counts) + 1, topics), pa.int32()), pa.array(counts, pa.int32()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(sizes, pa.int64()), lists],
                                             names=["doc_id", "draw", "source", "lang", "tokens", "groups"])

    slim = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("draw"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(MISSING)).alias(c) for c in ("source", "lang")],
        F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, draw long, source string, lang string, tokens long, groups array<int>")


def with_topic(measures: DataFrame, topics: int = 8) -> DataFrame:
    """``topic``: the word group of which a document has the most compared with the share
    that its language's documents have of it altogether (ties: the smaller number;
    no words: MISSING)."""
    names = [f"g{k}" for k in range(topics)]
    shares = measures.groupBy("lang").agg(
        F.sum("tokens").alias("all"), *[F.sum(F.col("groups")[k]).alias(n) for k, n in enumerate(names)])
    usual = shares.select("lang", F.array(*[F.greatest(F.col(n), F.lit(1)) / F.greatest(F.col("all"), F.lit(1)) for n in names]).alias("usual"))
    joined = measures.join(usual, "lang")
    lift = F.zip_with("groups", "usual", lambda g, u: g / u)
    first = F.array_position(lift, F.array_max(lift)) - 1
    return joined.withColumn("topic", F.when(F.col("tokens") > 0, F.concat(F.lit("t"), first.cast("string"))).otherwise(F.lit(MISSING))).drop("groups", "usual")


def category(column: str, table: Mapping[str, float]) -> Column:
    """The value that ``table`` has for the column's category."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.element_at(F.create_map(*pairs), F.col(column))


def tempered(totals: Mapping[str, float], power: float) -> dict[str, float]:
    """Shares in proportion to the ``power`` of each category's tokens."""
    raised = {k: float(v) ** power for k, v in totals.items() if v > 0}
    whole = sum(raised.values())
    return {k: v / whole for k, v in raised.items()}


def marginals(cells: DataFrame, value: Column, dimensions: tuple[str, ...], max_categories: int) -> dict[str, dict[str, float]]:
    """Sums of ``value`` by each dimension's category, of which there may be at most
    ``max_categories`` in all: they come to the driver, more is an error."""
    pairs = F.explode(F.array(*[F.struct(F.lit(d).alias("d"), F.col(d).alias("c")) for d in dimensions]))
    rows = (cells.select(value.alias("v"), pairs.alias("p")).groupBy("p.d", "p.c").agg(F.sum("v").alias("v"))
            .limit(max_categories + 1).collect())
    if len(rows) > max_categories:
        raise ValueError(f"more than {max_categories} categories; group rare ones first")
    out: dict[str, dict[str, float]] = {d: {} for d in dimensions}
    for d, c, v in rows:
        out[d][c] = float(v)
    return out


def rake(cells: DataFrame, targets: Mapping[str, Mapping[str, float]], max_rounds: int = 60,
         tolerance: float = 1e-4, max_categories: int = 100_000) -> dict[str, dict[str, float]]:
    """A factor for each category of each dimension, such that tokens times the factors
    of a cell meet the target share of every category within ``tolerance``.

    Each step sums the weighted cells of one dimension in Spark; only the sums by
    category come back.  Targets that no weights can meet (a category whose cells all lie
    in categories with too small a target) settle at the nearest such weights; the
    rounds are then all used.
    """
    factors = {d: {c: 1.0 for c in targets[d]} for d in targets}
    for _ in range(max_rounds):
        worst = 0.0
        for d in targets:
            weight = F.col("tokens").cast("double")
            for other in targets:
                weight = weight * category(other, factors[other])
            sums = marginals(cells, weight, (d,), max_categories)[d]
            whole = sum(sums.values())
            for c, share in targets[d].items():
                now = sums.get(c, 0.0)
                if now > 0:
                    worst = max(worst, abs(now / whole - share))
                    factors[d][c] *= share / now
        if worst <= tolerance:
            break
    return factors


def scale_for(cells: DataFrame, budget: float, tolerance: float = 1e-9, width: int = 32) -> float:
    """The largest k for which the expected tokens, sum of tokens * min(1, k * ratio), stay
    within ``budget``, to a relative ``tolerance`` of the budget; ratios may lie any number
    of magnitudes apart.

    Each step sums the cells in one pass for ``width`` values of k in geometric steps. The
    expected tokens are a concave function of k, made of straight pieces: every tangent
    meets the budget at or below the right k, every chord at or above it.
    """
    seen = cells.agg(F.min("ratio").alias("low"), F.sum("tokens").alias("tokens"),
                     F.sum(F.col("tokens") * F.col("ratio")).alias("mass")).first()
    if not seen["low"] or budget <= 0:
        return 0.0
    high = min(2.0 / seen["low"], sys.float_info.max)
    if seen["tokens"] <= budget:
        return high
    low = budget / seen["mass"]  # the tangent at 0
    while True:
        span = math.log(high) - math.log(low)
        tries = [low, *(low * math.exp(span * j / width) for j in range(1, width)), high]
        whole = [F.col("ratio") * F.lit(k) >= 1 for k in tries]
        sums = cells.agg(*[F.sum(F.when(w, F.col("tokens")).otherwise(0)).alias(f"w{j}") for j, w in enumerate(whole)],
                         *[F.sum(F.when(w, 0.0).otherwise(F.col("tokens") * F.col("ratio"))).alias(f"p{j}") for j, w in enumerate(whole)]).first()
        points = [(k, sums[f"w{j}"], sums[f"p{j}"]) for j, k in enumerate(tries)]
        expected = [w + k * p for k, w, p in points]
        if expected[0] >= budget * (1 - tolerance):
            return low
        j = max(j for j, e in enumerate(expected) if e <= budget)
        if j == width:
            return high
        (left, _, _), (right, _, _) = points[j], points[j + 1]
        chord = left + (right - left) * (budget - expected[j]) / (expected[j + 1] - expected[j])
        tangents = [(budget - w) / p for _, w, p in points if p > 0]
        low, high = max(left, *(t for t in tangents if t <= right)), min(right, chord * (1 + 1e-12))
        if high <= low * (1 + tolerance):
            return low


def mix(docs: DataFrame, targets: Mapping[str, Mapping[str, float]] | None = None, power: float = 0.5,
        keep_share: float = 0.6, topics: int = 8, seed: int = 17, max_categories: int = 100_000) -> DataFrame:
    """One row for each row of ``docs``: doc_id, draw, source, lang, topic, tokens, weight
    (the share of the mixture that a token of its cell stands for, times the corpus'
    tokens), probability and kept.

    ``targets`` gives shares by dimension and category; what it leaves out gets the
    ``power`` of its token share.  Categories are at most ``max_categories`` in all.
    ``keep_share`` of all tokens is the expected size of the sample; where cells with a
    high weight run out of tokens, all of them are kept.  The draw is a hash of doc_id,
    text and seed: equal rows share a fate, and a rerun keeps the same rows.  Documents
    without words have a probability of 0: they add nothing to any target.  Null sources
    and languages are a category.
    """
    rows = stored(with_topic(stored(measured(docs, topics), "measures"), topics), "mixture_rows")
    cells = stored(rows.where("tokens > 0").groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "cells")
    totals = marginals(cells, F.col("tokens"), DIMENSIONS, max_categories)
    whole = sum(totals["lang"].values())
    if not whole:
        return rows.select("doc_id", "draw", *DIMENSIONS, "tokens", F.lit(0.0).alias("weight"), F.lit(0.0).alias("probability"), F.lit(False).alias("kept"))
    wanted = {}
    for d in DIMENSIONS:
        given = {c: s for c, s in ((targets or {}).get(d) or {}).items() if c in totals[d]}
        rest = tempered({c: v for c, v in totals[d].items() if c not in given}, power)
        left = max(0.0, 1 - sum(given.values())) if rest else 0.0
        merged = {**given, **{c: left * s for c, s in rest.items()}}
        size = sum(merged.values())
        wanted[d] = {c: s / size for c, s in merged.items()}
    factors = rake(cells, wanted, max_categories=max_categories)
    ratio = F.lit(1.0)
    for d in DIMENSIONS:
        ratio = ratio * category(d, factors[d])
    raked = stored(cells.withColumn("ratio", ratio).where("ratio > 0"), "raked")
    mass = raked.agg(F.sum(F.col("tokens") * F.col("ratio"))).first()[0]
    k = scale_for(raked, keep_share * whole)
    probability = F.when(F.col("tokens") > 0, F.least(F.lit(1.0), F.lit(k) * ratio)).otherwise(F.lit(0.0))
    drawn = F.pmod(F.xxhash64("draw", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return rows.select("doc_id", "draw", *DIMENSIONS, "tokens",
                       F.when(F.col("tokens") > 0, ratio * F.lit(whole / mass)).otherwise(F.lit(0.0)).alias("weight"),
                       probability.alias("probability"), (drawn < probability).alias("kept"))


def sampled(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that ``mix`` keeps, columns as they are."""
    draw = free_name("draw", docs.columns)
    kept = mix(docs, **settings).where("kept").select(F.col("draw").alias(draw)).distinct()
    keyed = docs.withColumn(draw, F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")))
    return keyed.join(kept, draw, "left_semi").select(*docs.columns)
