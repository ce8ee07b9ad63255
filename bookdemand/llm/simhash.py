"""SimHash near-duplicates through vantage-point trees.

Every text becomes a 64-bit fingerprint.  Distinct fingerprints are dealt to the
leaves of vantage-point trees; a branch is skipped when the triangle inequality
rules it out, and a fingerprint whose distance lies in the boundary band goes to
both sides, so two fingerprints within the bit distance meet in a leaf.  Leaves
compare exactly and return a spanning forest, never all pairs of a dense group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bookdemand.llm.base import Shared, free_name, stored
from bookdemand.llm.components import connected_components

LANES = np.uint64(0x0101010101010101)
ALL_BITS = np.uint64(0xFFFFFFFFFFFFFFFF)


# ---------------------------------------------------------------- fingerprints

def text_hashes(text: str | None, words_per_shingle: int, seed: int) -> np.ndarray:
    """XXH64 of every shingle, repeats included; a-z for A-Z, words split at the six
    ASCII white-space bytes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = partial(xxhash.xxh64_intdigest, seed=seed)
    if len(words) < words_per_shingle:
        return np.array([digest(b" ".join(words))], np.uint64)
    columns = [words[k:] for k in range(words_per_shingle)]
    count = len(words) - words_per_shingle + 1
    return np.fromiter(map(digest, map(b" ".join, zip(*columns))), np.uint64, count)


def majority(hashes: np.ndarray) -> int:
    """The bits set in more than half of ``hashes`` (none: zero).

    Eight bits at a time ride in the byte lanes of a word; 255 rows fit a lane.
    """
    n = len(hashes)
    if n == 0:
        return 0
    starts = np.arange(0, n, 255)
    out = 0
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & LANES, starts)
        counts = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
        for byte in np.flatnonzero(2 * counts > n):
            out |= 1 << (8 * int(byte) + bit)
    return out


def fingerprints(docs: DataFrame, words_per_shingle: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) and text_hash (XXH64 of the text, as Spark's
    xxhash64 gives it; null as empty) of every row of ``docs``, whole texts.  Null and blank texts have fingerprint zero; repeated rows stay repeated;
    other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([majority(text_hashes(t.as_py(), words_per_shingle, seed)) for t in batch.column(1)], np.uint64)
            texts = np.array([xxhash.xxh64_intdigest((t.as_py() or "").encode("utf-8", "surrogatepass"), seed=42) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64)), pa.array(texts.view(np.int64))], names=["doc_id", "fp", "text_hash"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, fp long, text_hash long")


# ---------------------------------------------------------------- trees

class Tree:
    """A binary tree in arrays.  Node k sends a fingerprint left when its distance to
    the vantage under the mask is at most ``radius``, and right when it is more than
    ``radius - slack``: both within the boundary band.  Children < 0 are leaves."""

    def __init__(self) -> None:
        self.rows: list[list] = []
        self.leaves = 0

    def freeze(self) -> Tree:
        columns = list(zip(*self.rows)) or [()] * 6
        self.vantage, self.mask = (np.array(c, np.uint64) for c in columns[:2])
        self.radius, self.slack, self.left, self.right = (np.array(c, np.int64) for c in columns[2:])
        return self

    def route(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position in ``prints``, leaf) of every leaf that each fingerprint enters."""
        at = np.arange(len(prints))
        node = np.zeros(len(prints), np.int64) if self.rows else np.full(len(prints), -1, np.int64)
        done_at, done_leaf = [], []
        while len(at):
            ended = node < 0
            done_at.append(at[ended])
            done_leaf.append(-1 - node[ended])
            at, node = at[~ended], node[~ended]
            far = np.bitwise_count((prints[at] ^ self.vantage[node]) & self.mask[node]).astype(np.int64)
            near, over = far <= self.radius[node], far > self.radius[node] - self.slack[node]
            at, node = (np.concatenate([at[near], at[over]]),
                        np.concatenate([self.left[node[near]], self.right[node[over]]]))
        return np.concatenate(done_at or [at]), np.concatenate(done_leaf or [node])


def _split(points: np.ndarray, mask: np.uint64, slack: int, rng: np.random.Generator):
    """The vantage and radius that leave the least work, or None if nothing helps."""
    best = None
    for vantage in rng.choice(points, min(6, len(points)), replace=False):
        counts = np.bincount(np.bitwise_count((points ^ vantage) & mask), minlength=66)
        total = counts.cumsum()
        for radius in range(int(np.flatnonzero(counts)[-1])):
            inside = total[radius] / len(points)
            outside = 1 - (total[radius - slack] if radius >= slack else 0) / len(points)
            work = inside ** 2 + outside ** 2
            if inside and max(inside, outside) < 0.9 and (best is None or work < best[0]):
                best = (work, vantage, radius)
    return best


def build_tree(sample: np.ndarray, mask: np.uint64, slack: int, whole_slack: int, leaf: int, seed: int = 7) -> Tree:
    """Split the sample until at most ``leaf`` of its points are left or no split helps;
    a node that the masked distance cannot split is split by the whole distance."""
    tree, rng = Tree(), np.random.default_rng(seed)
    todo: list[tuple[np.ndarray, int, int]] = [(sample, -1, 0)]
    while todo:
        points, parent, side = todo.pop()
        cut = metric = None
        if len(points) > leaf:
            for metric in ((mask, slack), (ALL_BITS, whole_slack)):
                if cut := _split(points, metric[0], metric[1], rng):
                    break
        if cut is None:
            tree.leaves += 1
            place = -tree.leaves
        else:
            _, vantage, radius = cut
            place = len(tree.rows)
            tree.rows.append([vantage, metric[0], radius, metric[1], 0, 0])
            inside = np.bitwise_count((points ^ vantage) & metric[0]) <= radius
            todo += [(points[inside], place, 4), (points[~inside], place, 5)]
        if parent >= 0:
            tree.rows[parent][side] = place
    return tree.freeze()


def forest(prints: np.ndarray, distance: int, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(position, smallest position of its component) of every fingerprint that links
    with another; exact.  A dense group is swept breadth first, so that each found
    point leaves the comparison; work is then far below all pairs."""
    n = len(prints)
    label = np.arange(n)
    left, right = [], []
    kept = 0
    for start in range(0, n, block):
        rows = prints[start:start + block]
        i, j = np.nonzero(np.bitwise_count(rows[:, None] ^ prints[None, start:]) <= distance)
        keep = i < j
        left.append(i[keep] + start)
        right.append(j[keep] + start)
        kept += int(keep.sum())
        if kept > 20 * n + 100_000:
            break
    else:
        a, b = np.concatenate(left or [label[:0]]), np.concatenate(right or [label[:0]])
        while True:
            before = label.copy()
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, a, low)
            np.minimum.at(label, b, low)
            label = label[label]
            if np.array_equal(before, label):
                break
        linked = np.unique(np.concatenate([a, b]))
        return linked, label[linked]
    unseen, found, roots = np.arange(n), [], []
    while len(unseen):
        root, front, unseen = unseen[0], unseen[:1], unseen[1:]
        while len(front):
            part, front = front[:block], front[block:]
            hit = np.zeros(len(unseen), bool)
            for start in range(0, len(unseen), 1 << 16):
                hit[start:start + (1 << 16)] = (np.bitwise_count(prints[part][:, None] ^ prints[unseen[start:start + (1 << 16)]][None, :]) <= distance).any(axis=0)
            new, unseen = unseen[hit], unseen[~hit]
            found.append(new)
            roots.append(np.full(len(new), root))
            front = np.concatenate([front, new])
    found_at = np.concatenate(found) if found else label[:0]
    return found_at, np.concatenate(roots) if roots else label[:0]


def links(distinct: DataFrame, max_bits: int = 3, bands: int = 2, leaf_rows: int = 2048,
          max_sample: int = 1 << 20, seed: int = 7) -> DataFrame:
    """Edges (a, b) between fingerprints of ``distinct`` (column fp, no repeats) that
    span the groups linked by at most ``max_bits`` differing bits.

    With ``bands`` equal parts of the word, fingerprints within ``max_bits`` are within
    ``max_bits // bands`` in one part at least; one tree is built for each part under
    that smaller bound, whose boundary band is thinner.  Trees are fitted on a sample of
    at most ``max_sample`` fingerprints (about 32 for each leaf wanted); the sample sets
    the shape of the tree only, every fingerprint is routed.
    """
    spark = distinct.sparkSession
    total = distinct.count()
    wanted = min(max_sample, 64 + 32 * (total // leaf_rows))
    rate = 2.0 * wanted / max(total, 1)
    picked = distinct if rate >= 1 else distinct.where(
        F.pmod(F.xxhash64("fp", F.lit(seed)), F.lit(1 << 30)) < int(rate * (1 << 30)))
    sample = np.sort(np.array([r["fp"] for r in picked.orderBy(F.xxhash64("fp", F.lit(seed)), "fp").limit(wanted).collect()],
                              np.int64)).view(np.uint64)
    width = 64 // bands
    trees, first = [], []
    for band in range(bands):
        mask = np.uint64(((1 << width) - 1) << (band * width)) if bands > 1 else ALL_BITS
        share = 32 if total > leaf_rows else max(len(sample), 1)
        trees.append(build_tree(sample, mask, max_bits // bands, max_bits, share, seed + band))
        first.append(sum(t.leaves for t in trees[:-1]))
    shared = Shared(spark, trees)  # at most max_sample nodes

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for start in range(0, len(prints), 4096):
                part = prints[start:start + 4096]
                for tree, offset in zip(shared.value, first):
                    at, leaf = tree.route(part)
                    yield pa.RecordBatch.from_arrays([pa.array(leaf + offset), pa.array(part[at].view(np.int64))], names=["leaf", "fp"])

    def compare(group: pa.Table) -> pa.Table:
        prints = np.sort(group.column("fp").to_numpy()).view(np.uint64)
        at, root = forest(prints, max_bits)
        keep = at != root
        return pa.table({"a": prints[at[keep]].view(np.int64), "b": prints[root[keep]].view(np.int64)})

    dealt = distinct.select("fp").mapInArrow(deal, "leaf long, fp long")
    return dealt.groupBy("leaf").applyInArrow(compare, "a long, b long")


def grouped(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 3, seed: int = 42, **tree) -> DataFrame:
    """doc_id, fp, text_hash, component (its smallest fingerprint as a signed long) and
    component_id (its smallest doc_id; null if all are null) of every row of ``docs``."""
    prints = stored(fingerprints(docs, words_per_shingle, seed), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct_prints")
    roots = stored(connected_components(links(distinct, max_bits, **tree)), "roots")
    first = (distinct.join(roots.withColumnRenamed("node", "fp"), "fp")
             .groupBy("root").agg(F.min("first_id").alias("component_id")))
    moved = roots.join(first, "root").select(F.col("node").alias("fp"), F.col("root").alias("component"), "component_id")
    whole = distinct.join(moved, "fp", "left").select(
        "fp", F.coalesce("component", "fp").alias("component"), F.coalesce("component_id", "first_id").alias("component_id"))
    return prints.join(whole, "fp").select("doc_id", "fp", "text_hash", "component", "component_id")


def near_duplicates(docs: DataFrame, words_per_shingle: int = 3, max_bits: int = 3, seed: int = 42, **tree) -> DataFrame:
    """doc_id, fp and component_id of every row of ``docs``.

    component_id is the smallest doc_id reachable over links of at most ``max_bits``
    bits, the row's own included.  Null and empty texts have fingerprint zero, which
    links like any other.  Rows with a null doc_id take part; a component whose ids
    are all null has component_id null.  Repeated rows come out as often as they came
    in; an empty table gives an empty table; other columns are not read.
    """
    return grouped(docs, words_per_shingle, max_bits, seed, **tree).select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, **settings) -> DataFrame:
    """One row of ``docs`` for each near-duplicate group: the row with the smallest doc_id
    (null last), of several rows with that id the one whose text has the smallest XXH64, of
    several with that text too the lowest by the columns in order.  Unlike texts under one
    doc_id are in groups of their own and stay; so do rows with a null doc_id, one a group.
    Columns stay as they are, whatever their names."""
    found = stored(grouped(docs, **settings), "grouped")
    key, held, copies, low = (free_name(n, docs.columns) for n in ("id", "hash", "copies", "row"))
    first = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("r")).select("r.*")
    counts = found.groupBy("doc_id", "text_hash").count()
    chosen = first.join(counts, first["doc_id"].eqNullSafe(counts["doc_id"]) & (first["text_hash"] == counts["text_hash"])).select(
        first["doc_id"].alias(key), first["text_hash"].alias(held), F.col("count").alias(copies))
    own = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    kept = docs.join(chosen, docs["doc_id"].cast("long").eqNullSafe(F.col(key)) & (own == F.col(held)))
    lowest = kept.where(F.col(copies) > 1).groupBy(key, held).agg(F.min(F.struct(*docs.columns)).alias(low))
    return kept.where(F.col(copies) == 1).select(*docs.columns).union(lowest.select(*[F.col(low)[c].alias(c) for c in docs.columns]))
