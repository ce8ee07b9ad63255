"""A content-addressed Merkle manifest of a table, and inclusion proofs by descent.

Every row is a leaf.  Leaves of a tree stand in order; every three consecutive nodes
become their hash until one node, the tree's subroot, is left; the subroots, in the
order of their trees, are hashed likewise to the root.

What is kept is content-addressed: records (digest -> children), packed by six
generations under the digest of the pack's top node.  A request starts at the root's
digest, looks up the record of the digest it stands on, takes the child that the next
base-3 digit of its rank names and collects the children it does not take; the path
is turned round at the end.  Requests of one pack go down together, so a level costs
one join of packs and not one join of all requests, and the top records are no hot key.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookdemand.llm.base import stored
from bookdemand.operators.ranking import global_positions

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 3
GENERATIONS = 6
SPAN = ARITY ** GENERATIONS  # leaves of a full pack
RECORDS = "array<struct<digest:string,children:array<string>>>"
PATH = "array<struct<left:string,right:string>>"


def digest_of(*values: Column) -> Column:
    """Lower-case hex SHA-256 of the values' texts, each with its byte count; null is '-'."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def tree_key(column: Column) -> Column:
    """A text that orders as ``column`` does bytewise, null first, and is never null itself."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (tree, rank from 0, leaf and the columns carried along), ``trees`` (tree, n,
    rank, digest of the subroot), the packs of each tier of the trees and of the trees'
    own tree (digest, records: map of digest to children), and ``root`` (one row or none)."""

    leaves: DataFrame
    trees: DataFrame
    packs: tuple[DataFrame, ...]
    top_packs: tuple[DataFrame, ...]
    root: DataFrame


def _steps(nodes: Column, pack: Column) -> Column:
    """Generations between a pack's nodes and its top: six, but for the only pack of a tier."""
    few = sum((nodes > ARITY ** k).cast("int") for k in range(GENERATIONS))
    return F.when(pack > 0, GENERATIONS).otherwise(few)


def _pack(nodes: DataFrame) -> DataFrame:
    """(tree, rank, digest, records) of the next tier from nodes (tree, rank, digest)."""
    kids = F.transform(F.array_sort(F.collect_list(F.struct("rank", "digest"))), lambda x: x["digest"])
    grouped = nodes.groupBy("tree", F.expr(f"rank div {SPAN}").alias("pack")).agg(kids.alias("level"))

    def hashed(run: Column) -> Column:
        return F.struct(F.sha2(F.array_join(run, ""), 256).alias("digest"), run.alias("children"))

    def up(state: Column, _: Column) -> Column:
        level = state["level"]
        made = F.transform(F.sequence(F.lit(0), F.floor((F.size(level) - 1) / ARITY).cast("int")),
                           lambda k: hashed(F.slice(level, k * ARITY + 1, ARITY)))
        # one-element transform: a name for ``made``, which is hashed once only
        return F.transform(F.array(made), lambda m: F.struct(
            F.transform(m, lambda r: r["digest"]).alias("level"), F.concat(state["records"], m).alias("records")))[0]

    turns = F.slice(F.array(*[F.lit(k) for k in range(GENERATIONS)]), 1, _steps(F.size("level"), F.col("pack")))
    made = F.aggregate(turns, F.struct("level", F.array().cast(RECORDS).alias("records")), up)
    return grouped.select("tree", F.col("pack").alias("rank"), made.alias("made")).select(
        "tree", "rank", F.col("made.level")[0].alias("digest"),
        F.map_from_entries(F.array_distinct("made.records")).alias("records"))


def _largest(df: DataFrame) -> int:
    return (df.agg(F.max("rank")).first()[0] or 0) + 1


def _build(nodes: DataFrame, name: str) -> tuple[DataFrame, tuple[DataFrame, ...]]:
    """The top node of each tree (tree, digest) and the packs of its tiers, lowest first."""
    packs, largest = [], _largest(nodes)
    while not packs or largest > 1:
        packs.append(stored(_pack(nodes), f"{name}-{len(packs)}"))
        nodes, largest = packs[-1].drop("records"), -(-largest // SPAN)
    return nodes.select("tree", "digest"), tuple(packs)


def build(rows: DataFrame, order: Sequence[Column]) -> Manifest:
    """The manifest of ``rows``: columns ``tree`` (not null), ``leaf`` (hex digest) and any
    others, which go along.  Leaves of a tree stand by ``order``, equal ones by ``leaf``.

    Ranks come from range partitions, so a tree of a third of all rows is no hot task; a
    pack holds at most 729 nodes.  An empty table has no root."""
    ranked = global_positions(rows, [*order, F.col("leaf").asc()], partition_cols=["tree"])
    leaves = stored(ranked.withColumn("rank", F.col("position") - 1).drop("position"), "merkle-leaves")
    tops, packs = _build(leaves.select("tree", "rank", F.col("leaf").alias("digest")), "merkle-packs")
    sizes = leaves.groupBy("tree").agg((F.max("rank") + 1).alias("n"))
    trees = stored(global_positions(tops.join(sizes, "tree"), [F.col("tree").asc()], out_col="position")
                   .withColumn("rank", F.col("position") - 1).drop("position"), "merkle-trees")
    root, top_packs = _build(trees.select(F.lit("").alias("tree"), "rank", "digest"), "merkle-top")
    return Manifest(leaves, trees, packs, top_packs, root.select(F.col("digest").alias("root")))


def _walk(digest: Column, records: Column, offset: Column, steps: Column) -> Column:
    """Down one pack by the base-3 digits of ``offset``: (at, path from the top)."""
    powers = F.slice(F.array(*[F.lit(ARITY ** k) for k in reversed(range(GENERATIONS))]), GENERATIONS + 1 - steps, steps)
    digits = F.transform(powers, lambda p: F.pmod(F.floor(offset / p), F.lit(ARITY)).cast("int"))

    def down(state: Column, digit: Column) -> Column:
        found = F.try_element_at(records, state["at"])
        return F.transform(F.array(found), lambda kids: F.struct(
            F.coalesce(F.get(kids, digit), F.raise_error(F.concat(F.lit("no record leads on from "), state["at"]))).alias("at"),
            F.concat(state["path"], F.array(F.struct(
                F.array_join(F.slice(kids, 1, digit), "").alias("left"),
                F.array_join(F.slice(kids, digit + 2, ARITY), "").alias("right")))).alias("path")))[0]

    return F.aggregate(digits, F.struct(digest.alias("at"), F.array().cast(PATH).alias("path")), down)


def _descend(roots: DataFrame, packs: Sequence[DataFrame], requests: DataFrame) -> DataFrame:
    """Requests (tree, rank, wanted: a struct) that start at ``roots`` (tree, n, digest, path,
    about: a struct): rows (tree, about, wanted, at: the digest reached, path from the root down)."""
    wanted = [requests.select("tree", "rank", "wanted")]
    for _ in packs[1:]:
        wanted.append(wanted[-1].select("tree", F.expr(f"rank div {SPAN}").alias("rank")).distinct()
                      .withColumn("wanted", F.struct("rank")))
    front = roots.withColumn("rank", F.lit(0).cast("long"))
    for tier in reversed(range(len(packs))):
        asked = (wanted[tier].withColumn("pack", F.expr(f"rank div {SPAN}"))
                 .groupBy("tree", "pack").agg(F.collect_list(F.struct((F.col("rank") % SPAN).alias("offset"), "wanted")).alias("asked")))
        store = packs[tier].select("digest", "records").dropDuplicates(["digest"])
        nodes = F.least(F.ceil(F.col("n") / SPAN ** tier), F.lit(SPAN))
        met = (front.withColumnRenamed("rank", "pack").join(asked, ["tree", "pack"]).join(store, "digest", "left")
               .withColumn("steps", _steps(nodes, F.col("pack"))))
        # lambdas see the pack's columns; a pack's map is never copied for each request
        each = F.transform("asked", lambda r: F.struct(
            r["wanted"].alias("wanted"), _walk(F.col("digest"), F.col("records"), r["offset"], F.col("steps")).alias("end")))
        reached = (met.select("tree", "n", "about", "path", F.explode(each).alias("each"))
                   .select("tree", "n", "about", "each.wanted", F.col("each.end.at").alias("at"), F.concat("path", "each.end.path").alias("path")))
        front = reached.select("tree", "n", "about", F.col("at").alias("digest"), "path", *([F.col("wanted.rank").alias("rank")] if tier else ["wanted"]))
    return front.withColumnRenamed("digest", "at")


def proofs(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """One row for each row of ``requests``: rows of ``manifest.leaves``, all or some, each
    place asked at most once.  Adds ``root``, ``subroot`` and ``path``, an array from the leaf
    up to the root of the siblings' digests on the left and on the right (joined text; a run
    of one has none).

    A digest without a record, or a way that does not end in the leaf, is an error."""
    columns = [c for c in requests.columns if c not in ("tree", "rank")]
    top = manifest.root.select(F.lit("").alias("tree"), F.col("root").alias("digest"), F.array().cast(PATH).alias("path"), F.struct("root").alias("about"))
    count = manifest.trees.groupBy().agg(F.count(F.lit(1)).alias("n"))
    ways = _descend(top.crossJoin(count), manifest.top_packs,  # one row beside one row
                    manifest.trees.select(F.lit("").alias("tree"), "rank", F.struct("tree", "n").alias("wanted")))
    roots = ways.select("wanted.tree", "wanted.n", F.col("at").alias("digest"), "path",
                        F.struct("about.root", F.col("at").alias("subroot")).alias("about"))
    found = _descend(roots, manifest.packs, requests.select("tree", "rank", F.struct("rank", *columns).alias("wanted")))
    return found.select("tree", "wanted.*", "about.*", F.when(F.col("at") == F.col("wanted.leaf"), F.reverse("path")).otherwise(
        F.raise_error(F.concat(F.lit("the way to leaf "), "wanted.leaf", F.lit(" ends at "), "at"))).alias("path"))


def path_text(path: Column) -> Column:
    """All siblings of a proof, level by level from the leaf up, left to right."""
    return F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "")


def folded(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` leads to with a proof's siblings."""
    return F.aggregate(path, leaf, lambda at, p: F.sha2(F.concat(p["left"], at, p["right"]), 256))


def document_manifest(docs: DataFrame, shown: Column | None = None) -> Manifest:
    """The manifest of documents: one tree a source, leaves by doc_id (null first; repeated
    ids by leaf digest).  ``shown`` is a text that is offered in place of ``text``; its
    leaf goes along as ``shown``.  Nulls hash as '-'; other columns are not read."""
    values = [F.col(c) for c in FIELDS]
    leaf = digest_of(*values)
    rows = docs.select(tree_key(F.col("source")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"), leaf.alias("leaf"),
                       leaf.alias("shown") if shown is None else
                       F.when(shown.eqNullSafe(F.col("text")), leaf).otherwise(digest_of(*values[:-1], shown)).alias("shown"))
    return build(rows, [F.col("doc_id").asc_nulls_first()])
