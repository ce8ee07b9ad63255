"""Exact top-k by inner product of integer vectors: MaxScore.

The dimensions are the terms, a row's components its postings.  Rows of a shard stand in
chunks that keep every term's highest and lowest value, so that a query knows how much a
term can add in a chunk at least and at most.  For each query the chunks are taken by
falling bound until the next one's bound is below the threshold, the k-th best score so
far.  In a chunk the terms with the smallest spread, as many as together cannot lift a row
to the threshold, are non-essential; the essential ones' postings are summed for all rows,
and only rows still competitive are probed for the others.  The threshold rises from chunk
to chunk, and with it more terms become non-essential.  Shards' results are merged.

Components are integers in doubles.  Where products could pass 2**53 the sums are taken in
whole numbers of any length.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GROUP = 8  # non-essential terms probed at a time
CHUNK = 4096
MOST, LEAST = (1 << 63) - 1, -(1 << 63)


class Shard:
    """Rows by rising id (ties as they came), in chunks with bounds."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, chunk: int = CHUNK) -> None:
        self.ids, self.starts = ids, np.arange(0, len(ids), chunk)
        self.columns = [np.ascontiguousarray(rows[s:s + chunk].T) for s in self.starts]
        self.high = np.array([c.max(axis=1) for c in self.columns]).reshape(len(self.starts), rows.shape[1])
        self.low = np.array([c.min(axis=1) for c in self.columns]).reshape(len(self.starts), rows.shape[1])

    def best(self, query: np.ndarray, own: int, k: int, essential: list[int] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, score) of the k best rows whose id is not ``own``, highest score first, then
        smallest row.  ``essential`` collects the number of essential terms of each chunk taken."""
        top, bottom = np.where(query > 0, self.high, self.low) * query, np.where(query > 0, self.low, self.high) * query
        bound, floor = top.sum(axis=1), bottom.sum(axis=1)
        best_row, best_score, threshold = np.empty(0, np.int64), np.empty(0), -math.inf
        for c in np.argsort(-bound, kind="stable").tolist():
            if bound[c] < threshold:
                break  # no chunk after this one can hold a better row
            spread = top[c] - bottom[c]
            rising = np.argsort(spread, kind="stable")
            # the largest set of small spreads that does not lift the least score to the threshold
            split = int(np.searchsorted(np.cumsum(spread[rising]), threshold - floor[c], side="left"))
            others, needed = rising[:split][::-1], rising[split:]
            if essential is not None:
                essential.append(len(needed))
            columns, start = self.columns[c], int(self.starts[c])
            if len(others):
                weights = query.copy()
                weights[others] = 0
            score = (query if not len(others) else weights) @ columns
            place = np.arange(columns.shape[1])
            left = top[c][others].sum()
            for at in range(0, len(others), GROUP):
                keep = score + left >= threshold
                if not keep.all():
                    place, score = place[keep], score[keep]
                if not len(place):
                    break
                group = others[at:at + GROUP]
                score = score + query[group] @ columns[np.ix_(group, place)]
                left -= top[c][group].sum()
            place = place + start
            other = (self.ids[place] != own) & (score >= threshold)
            best_row, best_score = np.concatenate([best_row, place[other]]), np.concatenate([best_score, score[other]])
            if len(best_row) > k:
                first = np.lexsort((best_row, -best_score))[:k]
                best_row, best_score = best_row[first], best_score[first]
            if len(best_row) == k:
                threshold = best_score.min()
        first = np.lexsort((best_row, -best_score))
        return best_row[first], best_score[first]


def top_of_shard(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[list[int], list[int], list[int]]:
    """(query position, row position, score) of the k best rows for each query, ties to the
    smaller id; rows whose id is the query's own (``own``) do not count.  Scores are exact."""
    order = np.argsort(ids, kind="stable")
    rows, ids = rows[order], ids[order]
    limit = math.isqrt((1 << 53) // max(rows.shape[1], 1))  # below it sums in doubles are exact
    wide, wide_query = (np.abs(m).max(axis=1, initial=0) >= limit for m in (rows, queries))
    narrow = np.flatnonzero(~wide)
    shard = Shard(rows[narrow].astype(np.float64), ids[narrow])
    at_wide = np.flatnonzero(wide)
    whole = lambda m: [[int(x) for x in row] for row in m]
    long_rows = dict(zip(at_wide.tolist(), whole(rows[at_wide])))
    out = []
    for at, query in enumerate(queries):
        if wide_query[at]:
            long_rows |= {k: [int(x) for x in rows[k]] for k in range(len(ids)) if k not in long_rows}
            found, slow = [], range(len(ids))
        else:
            row, score = shard.best(query.astype(np.float64), own[at], k)
            found, slow = [(-int(s), int(narrow[r])) for r, s in zip(row, score)], at_wide.tolist()
        if len(slow):
            terms = [int(x) for x in query]
            found += [(-sum(map(int.__mul__, terms, long_rows[r])), r) for r in slow if ids[r] != own[at]]
        out += [(at, int(order[r]), -s) for s, r in sorted(found)[:k]]
    return tuple(map(list, zip(*out))) if out else ([], [], [])


def as_integers(rows: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and v = floor(scale * x) of each component, an integer in a double (exact for a
    ``scale`` that is a power of two); rows with a null id or vector, or with null or
    non-finite components, are left out, and so are those whose scaled components overflow."""
    # from 2**53 on every double is whole, and Spark's floor stops at 64 bits
    whole = lambda x: F.when(F.abs(x) < F.lit(2.0 ** 53), F.floor(x).cast("double")).otherwise(x)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
            .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite)
            .select("vec_id", F.transform("embedding", lambda x: whole(F.lit(float(scale)) * x)).alias("v"))
            .where(F.forall("v", lambda x: F.abs(x) < F.lit(math.inf))))


def top_k(queries: DataFrame, rows: DataFrame, k: int = 5, shard_rows: int = 16_384, query_block: int = 16_384) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k rows of ``rows`` with the highest inner
    product for each row of ``queries`` (both vec_id, v), all rows if there are fewer.

    Ties go to the smaller vec_id.  Rows with the query's own vec_id are not candidates;
    vectors of another length than the query's are not either.  Repeated query rows are
    answered once, repeated rows count each.  Queries and rows are dealt into blocks by a
    hash, and each task compares a block of queries with a shard of rows.  Scores are exact;
    one of the k highest that does not fit 64 bits is an error.
    """
    sized = rows.withColumn("d", F.size("v"))
    asked = queries.dropDuplicates().withColumn("d", F.size("v")).withColumn("ask", F.xxhash64("vec_id", "v"))
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-queries.count() // query_block))
    left = (sized.withColumn("shard", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    right = (asked.withColumn("block", F.pmod("ask", F.lit(blocks)).cast("int"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))))

    def compare(some: pa.Table, ask: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("ask", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("over", pa.bool_())])
        if not some.num_rows or not ask.num_rows:
            return schema.empty_table()
        x, q = (np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in t.column("v").chunks]).reshape(t.num_rows, -1) for t in (some, ask))
        ids, own, keys = some.column("vec_id").to_numpy(), ask.column("vec_id").to_numpy(), ask.column("ask").to_numpy()
        at, row, score = top_of_shard(q, own, x, ids, k)
        held = [min(max(s, LEAST), MOST) for s in score]
        return pa.table([own[at], keys[at], ids[row], held, [s != h for s, h in zip(score, held)]], schema=schema)

    keys = ["d", "shard", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(compare, "query_id long, ask long, vec_id long, score long, over boolean")
    order = Window.partitionBy("query_id", "ask").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", F.when(~F.col("over"), F.col("score")).otherwise(
                F.raise_error(F.format_string("the score of rows %d and %d does not fit 64 bits", "query_id", "vec_id"))).alias("score")))
