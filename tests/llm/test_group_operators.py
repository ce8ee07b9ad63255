"""SimHash, embeddings, top-k, mixing and components against brute force."""

import os
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from bookdemand.llm import mixing, near_embed, simhash, topk
from bookdemand.llm.base import table
from bookdemand.llm.components import connected_components
from bookdemand.llm.queries import ORACLE_SQL, QUERIES
from tools.oracle_check import canon, duck

from conftest import ROOT, SF001, SF01


def groups(n, edges):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    r = random.Random(seed)
    n = 300
    edges = [(r.randrange(n), r.randrange(n)) for _ in range(220)] + [(k, k + 1) for k in range(100, 160)] + [(7, x) for x in range(200, 260)] + [(5, 5)]
    frame = spark.createDataFrame([*edges, *edges[:20], (None, 3), (4, None)], "a long, b long")
    want = groups(n, edges)
    got = {r["node"]: r["root"] for r in connected_components(frame).collect()}
    touched = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: want[x] for x in touched}
    assert connected_components(frame.limit(0)).collect() == []


# ---------------------------------------------------------------- SimHash

def plain_fingerprint(text):
    import xxhash

    words = [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate({9: " ", 10: " ", 11: " ", 12: " ", 13: " "}).split(" ") if w]
    shingles = [" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check_simhash(rows, found, bits=3):
    """``found``: (doc_id, fp, component_id) rows for (doc_id, text) ``rows``."""
    prints = np.array([plain_fingerprint(t) for _, t in rows], np.uint64)
    edges = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows)) if int(np.bitwise_count(prints[i] ^ prints[j])) <= bits]
    root = groups(len(rows), edges)
    smallest = {}
    for (i, _), g in zip(rows, root):
        if i is not None:
            smallest[g] = min(i, smallest.get(g, i))
    want = [(i, int(p.astype(np.int64)), smallest.get(g)) for (i, _), p, g in zip(rows, prints, root)]
    assert sorted(want, key=repr) == sorted([tuple(r) for r in found], key=repr)


def test_simhash_of_odd_rows(spark):
    r = random.Random(4)
    base = [" ".join(r.choice("abcdefgh") * 3 for _ in range(60)) for _ in range(6)]
    rows = [(k, t) for k, t in enumerate([None, "", " \n ", "one", "ONE", "one two", *base, *[b + " x" for b in base], *[b.upper() for b in base], "é É", "long " * 30_000])]
    rows += [(None, base[0]), (None, "alone in the world"), (3, "one"), (3, "one"), (-5, base[1] + " y")]
    docs = spark.createDataFrame([(i, t, 1, "fp") for i, t in rows], "doc_id long, text string, fp int, component_id string")
    check_simhash(rows, simhash.near_duplicates(docs).collect())
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    left = [x["doc_id"] for x in kept.collect()]
    reps = {x["component_id"] for x in simhash.near_duplicates(docs).collect()} - {None}
    assert sorted(x for x in left if x is not None) == sorted(reps)
    assert left.count(None) == 1  # the one that is alone; the other has a copy with an id


def test_one_row_of_each_component(spark):
    r = random.Random(6)
    text = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(50))
    a, b, c, d = (text() for _ in range(4))
    rows = [(1, a, 1), (1, b, 2), (1, b, 1), (2, a, 3), (3, b, 4), (None, c, 5), (None, c, 4), (None, c, 4), (None, d, 1), (4, d, 1), (4, d, 1), (9, None, 1), (8, "", 1)]
    docs = spark.createDataFrame(rows, "id long, text string, hash int").withColumnsRenamed({"id": "doc_id"}).withColumns({"row": F.lit(1), "copies": F.lit(2)})
    got = sorted(((x["doc_id"], x["text"], x["hash"]) for x in simhash.one_of_each(docs).collect()), key=repr)
    assert got == sorted([(1, a, 1), (1, b, 1), (None, c, 4), (4, d, 1), (8, "", 1)], key=repr)


def test_tasks_need_no_package():
    """Executors that have the libraries but not this package run every operator."""
    script = """
import sys; sys.path.insert(0, sys.argv[1])
from pyspark.sql import functions as F
from bookdemand.session import build_session
from bookdemand.llm import alignment, html_crf, pii, quality, secrets, simhash, toxicity
import public_tokenizers as p
spark = build_session("local[2]", shuffle_partitions=2)
def absent(_):
    try:
        import bookdemand
    except ModuleNotFoundError:
        return ["absent"]
    return ["there"]
assert spark.sparkContext.parallelize([1], 1).mapPartitions(absent).collect() == ["absent"]
docs = spark.createDataFrame([(k, f"you idiot {k} wrote token = {k:040x} mail a{k}@b.com") for k in range(20)], "doc_id long, text string")
labels = docs.select("doc_id", (F.col("doc_id") % 2).alias("quality"), (F.col("doc_id") % 3).cast("boolean").cast("int").alias("toxic"))
pages = spark.createDataFrame([(1, "u", "<html><body><p>Some words here.</p></body></html>")], "page_id long, url string, html string")
n = [quality.score(docs, quality.fit(docs, labels, allowed=F.lit(True))).count(), toxicity.score(docs, toxicity.fit(docs, labels, allowed=F.lit(True))).where("score >= 0").count(),
     html_crf.extract(pages, html_crf.default_field()).collect()[0]["n_chars"] >= 0, simhash.near_duplicates(docs).count(),
     pii.find(docs, pii.learn_contexts(docs)).count(), secrets.find(docs).count(),
     alignment.align(docs, p.path("byte_bpe_50k.json"), p.path("piece_bpe_32k.model")).count()]
assert n == [20, 20, True, 20, 20, 20, 20], n
quality.score(docs, quality.fit(docs, labels, allowed=F.lit(True))).collect()
print("done")
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script, str(ROOT)], cwd="/tmp", env=env, capture_output=True, text=True, timeout=600)
    assert "done" in done.stdout, done.stderr[-3000:]


def test_simhash_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF001, "documents").collect()]
    found = QUERIES["op4_simhash"](spark, SF001).collect()
    check_simhash(rows, [(r["doc_id"], int(np.uint64(int(r["fingerprint"], 16)).astype(np.int64)), r["component_id"]) for r in found])


@pytest.mark.parametrize("dense", [False, True])
def test_trees_lose_no_link(spark, dense):
    """Many small leaves, near copies at 0 to 5 bits, and a dense cluster about one point."""
    rng = np.random.default_rng(5)
    seeds = rng.integers(0, 1 << 63, 1 if dense else 600, dtype=np.uint64)
    prints = list(seeds)
    for p in np.repeat(seeds, 900 if dense else 1):
        mask = np.uint64(0)
        for b in rng.choice(64, rng.integers(0, 6), replace=False):
            mask |= np.uint64(1) << np.uint64(b)
        prints.append(p ^ mask)
    prints = np.unique(np.array(prints, np.uint64))
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    edges = simhash.links(frame, 3, leaf_rows=16).collect()
    place = {int(p): k for k, p in enumerate(prints.view(np.int64))}
    want = groups(len(prints), [(i, j) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints) <= 3).tolist() if i < j])
    assert groups(len(prints), [(place[e["a"]], place[e["b"]]) for e in edges]) == want


def test_forest_dense_and_sparse():
    rng = np.random.default_rng(6)
    for prints in (np.unique(rng.integers(0, 1 << 10, 900, dtype=np.uint64)), np.unique(rng.integers(0, 1 << 63, 500, dtype=np.uint64))):
        at, root = simhash.forest(prints, 3)
        want = groups(len(prints), [(i, int(j)) for i in range(len(prints)) for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints) <= 3) if i < j])
        got = list(range(len(prints)))
        for a, b in zip(at, root):
            got[a] = int(b)
        assert got == want


# ---------------------------------------------------------------- embeddings and top-k

def odd_vectors(spark):
    r = np.random.default_rng(8)
    base = r.normal(size=(12, 8))
    rows = [(k, [float(x) for x in b], k % 2) for k, b in enumerate(base)]
    rows += [(100 + k, [float(x) for x in b + r.normal(size=8) * 0.05], k % 2) for k, b in enumerate(base)]
    rows += [(200 + k, [float(3 * x) for x in base[0]], 0) for k in range(5)]
    rows += [(300, None, 0), (301, [0.0] * 8, 0), (302, [float("nan")] * 8, 0), (303, [1.0, None], 0), (304, [float("inf")] * 8, 0),
             (305, [float(x) for x in base[0]], None), (306, [float(x) for x in base[0]][:5], 0), (0, [float(x) for x in base[0]], 0),
             (None, [float(x) for x in base[0]], 0), (307, [], 0), (350, [1e30] * 8, 1), (400, [-1e-30] * 8, 1)]
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, label int, node int, copies int"), rows


@pytest.mark.parametrize("tile", [4096, 3])
def test_embedding_links(spark, tile):
    frame, rows = odd_vectors(spark)
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows]

    def usable(v, y):
        return y is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    def cosine(a, b):
        a, b = np.array(a) / max(map(abs, a)), np.array(b) / max(map(abs, b))
        return a @ b / np.sqrt((a @ a) * (b @ b))

    edges = [(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows))
             if usable(*rows[i][1:]) and usable(*rows[j][1:]) and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]) and cosine(rows[i][1], rows[j][1]) >= 0.98]
    root = groups(len(rows), edges)
    links = np.bincount(np.array(edges).ravel(), minlength=len(rows))
    smallest = {}
    for (i, _, _), g in zip(rows, root):
        if i is not None:
            smallest[g] = min(i, smallest.get(g, i))
    want = [(i, int(n), smallest.get(g), i is not None and i == smallest.get(g)) for (i, _, _), n, g in zip(rows, links, root)]
    got = [tuple(r) for r in near_embed.near_duplicates(frame, tile_rows=tile).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert near_embed.near_duplicates(frame.limit(0)).collect() == []


def test_top_k(spark):
    r = np.random.default_rng(9)
    for dims, high in ((3, 4), (40, 2000), (12, 1 << 28), (5, 1 << 24)):
        x = r.integers(-high, high, (400, dims))
        x[50:60] = x[40]
        rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(7, x[7].tolist()), (9, [1])]
        frame = spark.createDataFrame(rows, "vec_id long, v array<long>")
        got = {}
        for a in topk.top_k(frame.where("vec_id % 50 = 0"), frame, k=5, shard_rows=90, query_block=3).orderBy("rank").collect():
            got.setdefault(a["query_id"], []).append((a["score"], a["vec_id"]))
        for q in range(0, 400, 50):
            scores = sorted(((sum(int(a) * int(b) for a, b in zip(x[q], v)), i) for i, v in rows if i != q and len(v) == dims), key=lambda s: (-s[0], s[1]))
            assert got[q] == scores[:5]
        assert topk.top_k(frame.limit(0), frame).collect() == [] == topk.top_k(frame, frame.limit(0)).collect()


def test_integers_leave_out_what_has_none(spark):
    frame, _ = odd_vectors(spark)
    ids = {r["vec_id"] for r in topk.as_integers(frame.where("vec_id < 350")).collect()}
    assert ids.isdisjoint({300, 302, 303, 304, None}) and {301, 305, 306} <= ids
    huge = spark.createDataFrame([(1, [1e30, -1.5]), (2, [0.3, 1e300]), (3, [1.7e308, 0.0])], "vec_id long, embedding array<double>")
    assert sorted((r["vec_id"], r["v"]) for r in topk.as_integers(huge).collect()) == [(1, [256e30, -384.0]), (2, [76.0, 256e300])]


def test_large_components_are_exact_or_an_error(spark):
    rows = [(0, [1e7, 0.0]), (1, [1e7, 1.0]), (2, [1e30, 0.0]), (3, [0.0, 2.5]), (4, [-1e30, 0.0])]
    frame = topk.as_integers(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    by_id = {r["vec_id"]: r["v"] for r in frame.collect()}
    few = frame.where("vec_id < 2 or vec_id = 3")
    got = [(r["query_id"], r["vec_id"], r["score"]) for r in topk.top_k(few, few).orderBy("query_id", "rank").collect()]
    exact = {(q, v): sum(int(a) * int(b) for a, b in zip(by_id[q], by_id[v])) for q in (0, 1, 3) for v in (0, 1, 3) if q != v}
    assert got == [(q, v, s) for q in (0, 1, 3) for (_, v), s in sorted(((k, s) for k, s in exact.items() if k[0] == q), key=lambda x: (-x[1], x[0]))]
    # a row whose huge score is not among the k highest does no harm, one that is is an error
    assert [r["vec_id"] for r in topk.top_k(frame.where("vec_id = 0"), frame.where("vec_id <> 2"), k=2).orderBy("rank").collect()] == [1, 3]
    with pytest.raises(Exception, match="does not fit 64 bits"):
        topk.top_k(frame.where("vec_id = 0"), frame, k=2).collect()


def test_max_score_needs_fewer_terms_as_the_threshold_rises():
    r = np.random.default_rng(4)
    rows = np.floor(256 * r.normal(size=(9000, 48)) / np.arange(1, 49))
    rows[:3000, 0] += 3000  # chunks that a query may pass over
    ids = r.permutation(9000)
    shard = topk.Shard(rows[np.argsort(ids)], np.sort(ids), chunk=1024)
    by_row = rows[np.argsort(ids)]
    passed = 0
    for q in range(0, 9000, 500):
        essential = []
        row, score = shard.best(by_row[q], q, 5, essential)
        exact = by_row @ by_row[q]
        exact[q] = -np.inf
        want = np.lexsort((np.arange(9000), -exact))[:5]
        assert row.tolist() == want.tolist() and score.tolist() == exact[want].tolist()
        assert essential[0] == 48 and min(essential) < 24
        passed += len(essential) < len(shard.starts)
    assert passed


@pytest.mark.parametrize("name", ["op1_warc", "op7_embedding_dedup", "op9_maxscore"])
def test_oracle(spark, name):
    want = duck(SF01).execute(ORACLE_SQL[name]).df()
    assert canon(QUERIES[name](spark, SF01).toPandas(), 9) == canon(want, 9)


# ---------------------------------------------------------------- mixing

def test_rake_meets_targets(spark):
    rows = [(s, x, t, 1 + 37 * (i * 7 + j * 3 + k) % 90) for i, s in enumerate("abc") for j, x in enumerate(["en", "de"]) for k, t in enumerate("uvw")]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, tokens long")
    targets = {"source": {"a": 0.5, "b": 0.3, "c": 0.2}, "lang": {"en": 0.4, "de": 0.6}, "topic": {"u": 0.2, "v": 0.2, "w": 0.6}}
    factors = mixing.rake(cells, targets, tolerance=1e-6)
    weight = {(s, x, t): n * factors["source"][s] * factors["lang"][x] * factors["topic"][t] for s, x, t, n in rows}
    whole = sum(weight.values())
    for d, name in enumerate(targets):
        for c, share in targets[name].items():
            assert sum(w for k, w in weight.items() if k[d] == c) / whole == pytest.approx(share, abs=1e-5)
    with pytest.raises(ValueError, match="categories"):
        mixing.marginals(cells, F.col("tokens"), ("source",), 2)


def test_mixing_query(spark):
    rows = QUERIES["op6_mixing"](spark, SF01).collect()
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF01, "documents").collect()}
    assert len(rows) == len(texts) and all(r["tokens"] == len((texts[r["doc_id"]] or "").split()) for r in rows)
    whole = sum(r["tokens"] for r in rows)
    for d in mixing.DIMENSIONS:
        size, mixed = {}, {}
        for r in rows:
            if r["tokens"]:
                size[r[d]] = size.get(r[d], 0) + r["tokens"]
                mixed[r[d]] = mixed.get(r[d], 0) + r["tokens"] * r["weight"]
        root = sum(v ** 0.5 for v in size.values())
        for c in size:
            assert mixed[c] / whole == pytest.approx(size[c] ** 0.5 / root, abs=2e-4)
    assert sum(r["tokens"] * r["probability"] for r in rows) == pytest.approx(0.6 * whole, rel=1e-3)
    assert sum(r["tokens"] for r in rows if r["kept"]) == pytest.approx(0.6 * whole, rel=0.1)


def test_mixing_of_odd_rows(spark):
    docs = spark.createDataFrame(
        [(None, None, None, None, 1, 2), (1, "", None, "s", 1, 2), (1, "a b", None, "s", 2, 2), (1, "a b", None, "s", 2, 2), (2, "c " * 50_000, "en", None, 3, 3)],
        "doc_id long, text string, lang string, source string, tokens int, draw int")
    rows = mixing.mix(docs, keep_share=1.0).collect()
    assert len(rows) == 5 and {r["kept"] for r in rows if r["tokens"] == 0} == {False}
    assert all(r["kept"] == (r["tokens"] > 0) for r in rows)
    kept = mixing.sampled(docs, keep_share=1.0)
    assert kept.columns == docs.columns and kept.count() == 3
    assert mixing.mix(docs.limit(0)).collect() == [] == mixing.sampled(docs.limit(0)).collect()
    given = mixing.mix(docs, targets={"source": {"s": 0.25, mixing.MISSING: 0.75, "absent": 0.5}}).collect()
    assert len(given) == 5


def test_scale_meets_budget_at_any_spread_of_ratios(spark):
    rows = [(1000, 1e-40), (700, 3e-25), (500, 2e-9), (300, 0.4), (200, 1.0), (1, 5.0)]
    cells = spark.createDataFrame(rows, "tokens long, ratio double")
    for share in (1e-4, 0.1, 0.2, 0.5, 0.6, 0.9, 0.9999):
        budget = share * sum(t for t, _ in rows)
        k = mixing.scale_for(cells, budget)
        assert sum(t * min(1.0, k * r) for t, r in rows) == pytest.approx(budget, rel=1e-6)
    k = mixing.scale_for(cells, 2701.0)
    assert all(k * r >= 1 for _, r in rows)
    assert mixing.scale_for(cells, 0.0) == 0.0 == mixing.scale_for(cells.limit(0), 5.0)


def test_mixing_meets_budget_where_targets_cannot_be_met(spark, monkeypatch):
    texts = [(i, f"s{i % 4}", "fr" if i % 8 == 0 else "en", f"w{i} w{i + 1} a b c") for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id long, source string, lang string, text string")
    far = lambda cells, targets, **_: {d: {c: 1e-33 if c in ("en", "s1") else 1.0 for c in targets[d]} for d in targets}
    monkeypatch.setattr(mixing, "rake", far)
    rows = mixing.mix(docs).collect()
    assert sum(r["tokens"] * r["probability"] for r in rows) == pytest.approx(0.6 * 2000, rel=1e-6)
    assert 200 < sum(r["kept"] for r in rows) < 280
