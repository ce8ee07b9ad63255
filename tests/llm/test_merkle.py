"""The Merkle manifest against a plain version and its SQL."""

import hashlib
import random
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from bookdemand.llm import merkle
from bookdemand.llm.queries import ORACLE_SQL, QUERIES

from conftest import SF01

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, rank int, digest string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def plain_levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][k:k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def siblings(levels, k):
    out = []
    for level in levels[:-1]:
        run = level[k - k % 3:k - k % 3 + 3]
        out.append(("".join(run[:k % 3]), "".join(run[k % 3 + 1:])))
        k //= 3
    return out


def plain(rows):
    """(doc_id, leaf, subroot, root, path) of every row, by loops."""
    trees = defaultdict(list)
    for row in rows:
        trees[row[1]].append((row[0] is not None, row[0] or 0, plain_leaf(row), row[0]))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    levels = {s: plain_levels([x[2] for x in sorted(trees[s])]) for s in names}
    top = plain_levels([levels[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, leaf in enumerate(sorted(trees[s])):
            out.append((leaf[3], leaf[2], levels[s][-1][0], top[-1][0], siblings(levels[s], i) + siblings(top, k)))
    return out


def rows_of(sizes, seed=5):
    pick = random.Random(seed)
    out = []
    for source, n in sizes:
        for k in range(n):
            out.append((pick.randrange(1 << 40) if k % 50 else -k, source, pick.choice(["en", None, "de"]), pick.choice([None, k]),
                        pick.choice([None, "", "é\n\n", "a" * k, "x:1-"]), "clash", k, "clash"))
    return out


ODD = [(None, "b", None, None, None, "t", 1, "d"), (None, "b", "en", 1, "x", "t", 1, "d"), (7, "b", "en", 1, "x", "t", 1, "d"),
       (7, "b", "en", 1, "x", "t", 1, "d"), (7, "b", "en", 1, "y", "t", 1, "d"), (7, "", "en", 1, "x", "t", 1, "d"), (1, "-", "", 0, "", "t", 1, "d")]


@pytest.mark.parametrize("sizes, extra", [
    ([("hot", 2300), (None, 5), ("one", 1), ("two", 730), ("three", 729)], []),
    ([(None, 4)], ODD), ([("only", 1)], []), ([(f"s{k}", 1 + k % 3) for k in range(40)], ODD)])
def test_proofs_equal_the_plain_version(spark, sizes, extra):
    rows = rows_of(sizes) + extra
    made = merkle.document_manifest(spark.createDataFrame(rows, SCHEMA))
    got = merkle.proofs(made, made.leaves)
    assert got.count() == len(rows)
    found = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(p) for p in r["path"]]) for r in got.collect()]
    assert sorted(found, key=repr) == sorted(plain(rows), key=repr)


def test_some_requests_and_changed_leaves(spark):
    rows = rows_of([("a", 1500), ("b", 3)])
    shown = F.when(F.col("source") == "b", "other").otherwise(F.col("text"))
    made = merkle.document_manifest(spark.createDataFrame(rows, SCHEMA), shown)
    some = merkle.proofs(made, made.leaves.where("rank % 700 = 1"))
    checked = some.select("tree", (merkle.folded(F.col("leaf"), F.col("path")) == F.col("root")).alias("own"),
                          (merkle.folded(F.col("shown"), F.col("path")) == F.col("root")).alias("other")).collect()
    assert sorted(map(tuple, checked)) == [("=a", True, True)] * 3 + [("=b", True, False)]


def test_a_missing_record_is_an_error_and_an_empty_table_is_empty(spark):
    rows = spark.createDataFrame(rows_of([("a", 900)]), SCHEMA)
    made = merkle.document_manifest(rows)
    holed = merkle.Manifest(made.leaves, made.trees, (made.packs[0].where("rank = 0"), *made.packs[1:]), made.top_packs, made.root)
    with pytest.raises(Exception, match="no record leads on"):
        merkle.proofs(holed, made.leaves).collect()
    empty = merkle.document_manifest(rows.limit(0))
    assert merkle.proofs(empty, empty.leaves).collect() == [] and empty.root.collect() == []


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF01}/documents.parquet')")
    got = QUERIES["op12_merkle"](spark, SF01)
    want = con.execute(ORACLE_SQL["op12_merkle"])
    assert [c[0] for c in want.description] == got.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)
