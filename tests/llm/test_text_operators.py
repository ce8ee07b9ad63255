"""BPE, quality, PII and toxicity against brute force, the library itself and held-out labels."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bookdemand.llm import bpe, pii, quality, toxicity
from bookdemand.llm.base import remainder_of_crc, table, training_sample
from bookdemand.llm.queries import QUERIES, tokenizer_path

from conftest import SF001, SF01

ODD_TEXTS = [
    None, "", " \t\n ", "a", "é", "Hi <|endoftext|> ΣΑΣ İ é é K <|ENDOFTEXT|>", "it's A.B. c's 12 'S", "<|startoftext|><|endoftext|>",
    "x" * 50_000, "日本語 text 한국어 ​ z", "\x1c\x1d a\x85b\xa0c", "nul\x00nul", "🙂🙂 ok", "1234 ٣ Ⅷ ½", "a" * 3 + " " + "b " * 20_000,
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, t, "map", 1) for k, t in enumerate(ODD_TEXTS)] + [(None, "null id", "x", 2), (3, "a", "map", 1), (3, "a", "map", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, word string, score int")


def library(text):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    return ids, tokenizer.decode(ids, skip_special_tokens=False)


def test_bpe_equals_the_library_on_odd_texts(odd):
    got = [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), r["decoded"]) for r in bpe.encode(odd, tokenizer_path()).collect()]
    want = [(r["doc_id"], *library(r["text"])) for r in odd.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_bpe_in_small_blocks_and_empty(odd):
    one = sorted(bpe.encode(odd, tokenizer_path()).collect(), key=repr)
    assert sorted(bpe.encode(odd, tokenizer_path(), block_chars=10).collect(), key=repr) == one
    assert bpe.encode(odd.limit(0), tokenizer_path()).collect() == []


def test_bpe_query_equals_the_library(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF001, "documents").collect()}
    rows = QUERIES["op2_bpe"](spark, SF001).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids, text = library(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_decode_joins_pieces_and_rejects_unknown_ids(spark):
    pieces = spark.createDataFrame([(1, "a"), (2, "b</w>")], "id int, piece string")
    rows = spark.createDataFrame([("x", [1, 2, 1]), ("y", []), ("z", None)], "word string, ids array<int>")
    assert {r["word"]: r["text"] for r in bpe.decode(rows, pieces).collect()} == {"x": "a b</w> a", "y": "", "z": ""}
    with pytest.raises(Exception, match="no piece for id 9"):
        bpe.decode(spark.createDataFrame([("x", [9])], "word string, ids array<int>"), pieces).collect()


def test_pack_round_trip():
    for n in (0, 1, 7, 1000):
        x = np.random.default_rng(n).integers(0, 1 << 32, n)
        assert np.array_equal(bpe.unpack(bpe.pack(x)), x)


# ---------------------------------------------------------------- quality and toxicity

def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    good = label == 1
    return (rank[good].mean() - (good.sum() - 1) / 2) / (~good).sum()


@pytest.mark.parametrize("name, label, modulus, held, floor", [("op3_quality", "quality", 5, 0, 0.99), ("op10_toxicity", "toxic", 3, 1, 0.93)])
def test_held_out_labels(spark, name, label, modulus, held, floor):
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in QUERIES[name](spark, sf).collect()}
    labels = pq.read_table(f"{sf}/labels.parquet").to_pydict()
    assert len(rows) == pq.read_metadata(f"{sf}/documents.parquet").num_rows
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % modulus == held) for i, r in rows.items())
    pairs = [(rows[i], y) for i, y in zip(labels["doc_id"], labels[label]) if rows[i]["held_out"]]
    truth = np.array([y for _, y in pairs])
    assert auc(np.array([r["score"] for r, _ in pairs]), truth) > floor
    assert np.mean([r["predicted"] for r, _ in pairs] == truth) > 0.97


def test_scores_of_odd_texts(spark, odd):
    net = quality.train([("good words here. And more of them.", 1), ("BAD!! BAD!! BAD!!", 0)] * 8, epochs=2)
    grammar = toxicity.learn([])
    for scored in (quality.score(odd, net), toxicity.score(odd, grammar)):
        rows = scored.collect()
        assert len(rows) == odd.count() and scored.columns == odd.columns
        assert all(0 <= r["score"] <= 1 for r in rows)
        by_text = {}
        for r in rows:
            assert by_text.setdefault(r["text"] or "", r["score"]) == r["score"]
        assert scored.limit(0).collect() == []


def test_network_sees_the_whole_text():
    net = quality.Network.new(4, 1)
    long = "a" * 600_000
    assert quality.probability(net, quality.padded(long)) != quality.probability(net, quality.padded(long + "zq#!x"))
    data = quality.padded("some text, " * 100)
    slow, _ = quality.chunks_of(quality.steps_of(net, data)[0])
    assert np.allclose(quality.features(net, data), np.maximum(slow + net.bias, 0), atol=1e-4)


def test_training_sample_reads_allowed_rows_only(spark):
    docs = table(spark, SF001, "documents")
    labels = table(spark, SF001, "labels")
    rows = training_sample(docs, labels, "quality", remainder_of_crc("doc_id", 5) != 0, 20, 5000)
    held = {r["text"] for r in docs.where(remainder_of_crc("doc_id", 5) == 0).collect()}
    assert 0 < len(rows) <= 20 and all(len(t) <= 5000 for t, _ in rows)
    assert not {t for t, _ in rows} & (held - {r["text"] for r in docs.where(remainder_of_crc("doc_id", 5) != 0).collect()})
    assert quality.train(training_sample(docs, labels.limit(0), "quality", F.lit(True), 20, 5000)).offset == 0.0


def test_clause_grammar():
    g = toxicity.learn([])
    plain, aimed = g.clause_score("what an idiot"), g.clause_score("you are an idiot")
    assert aimed > plain > g.clause_score("he said what an idiot") > 0
    assert plain > g.clause_score("this is not an idiot") > 0
    assert g.clause_score("I will kill you") > 0 == g.clause_score("kill the process")
    assert g.features("A fine day. You idiot! Bye.", g.finder())[1] == g.clause_score("you idiot!")


# ---------------------------------------------------------------- personal data

def plain_spans(text):
    """The contract's patterns as they stand."""
    text, out = text or "", []
    out += [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_base_spans_equal_the_plain_patterns():
    r = random.Random(7)
    for _ in range(30_000):
        text = "".join(r.choice("ab.@@-1234+ ()é0%") for _ in range(r.randrange(60)))
        assert pii.base_spans(text) == plain_spans(text)
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


def test_base_spans_of_long_runs_are_quick():
    for text in ("a" * 300_000, "1" * 300_000, "a@" * 100_000, "1." * 100_000, "+1(" * 100_000, "a@b" * 100_000):
        base = pii.base_spans(text)
        for a, b in pii.candidates(text, base):
            pii.words_around(text, a, b)


def test_numbers_of_any_length_are_compared():
    for digits in ("0" * 5000 + "1.1.1.1", "1" * 5000 + ".1.1.1", "0.0.0.0", "00256.1.1.1", "000255.0.0.255"):
        assert [s[0] for s in pii.base_spans("x " + digits) if s[0] == "ip"] == ([] if digits[:3] in ("111", "002") else ["ip"])


def test_pii_query(spark):
    texts = {r["doc_id"]: r["text"] for r in table(spark, SF001, "documents").collect()}
    rows = QUERIES["op5_pii"](spark, SF001).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = plain_spans(texts[r["doc_id"]])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        assert r["spans"].startswith(joined)


def patterns(contexts):
    return {r["pattern"] for r in contexts.collect()}


def plain_contexts(texts, min_seeds, rounds, hidden):
    """Contexts and their trust by loops over whole words; ``hidden`` tells masked seeds."""
    words = [[w for w in t.replace("=", "= ").lower().split()] if t else [] for t in texts]

    def around(ws, i):
        left = ws[i - 1] if i else "^"
        out = [f"L {ws[i - 2]} {left}" if i > 1 else f"L {left}", f"M {left} {ws[i + 1] if i + 1 < len(ws) else '$'}"]
        return out + [f"W {left}"] if any(c.isalpha() for c in left) else out

    totals, graph = Counter(), Counter()
    seeds = set()
    for text, ws in zip(texts, words):
        for i in range(len(ws)):
            totals.update(around(ws, i))
        base = plain_spans(text)
        places = [(a, b, True) for _, a, b in base] + [(a, b, bool(pii.HEX_DIGEST.fullmatch(text, a, b))) for a, b in pii.candidates(text or "", base)]
        for a, b, seed in places:
            i = len((text[:a] + "x").replace("=", "= ").split()) - 1
            n = len(text[a:b].replace("=", "= ").split())
            value = text[a:b].lower()
            if seed:
                seeds.add(value)
            ctx = around(ws, i)
            right = f"M {ws[i - 1] if i else '^'} {ws[i + n] if i + n < len(ws) else '$'}"
            for p in [ctx[0], right, *ctx[2:]]:
                graph[p, value] += 1
    shown, masked = Counter(), Counter()
    for p, v in graph:
        if v in seeds:
            (masked if hidden(v) else shown)[p] += 1
    keep = {p for p in shown if shown[p] >= min_seeds}
    score = {v: float(v in seeds and not hidden(v)) for _, v in graph}
    trust = {}
    for _ in range(rounds):
        trust = {p: min(1.0, sum(n * score[v] for (q, v), n in graph.items() if q == p) / max(totals[p], sum(n for (q, _), n in graph.items() if q == p))) for p in keep}
        fresh = {}
        for p, v in graph:
            if p in keep:
                fresh.setdefault(v, []).append(min(trust[p], 1 - 1e-9))
        score = {v: 1.0 if v in seeds and not hidden(v) else 1 - float(np.prod([1 - t for t in ts])) for v, ts in fresh.items()} | {
            v: 0.0 for v in score if v not in fresh}
    return {p: (trust[p], shown[p], masked[p]) for p in keep}


def test_scores_equal_a_plain_version(spark):
    r = random.Random(5)
    word = lambda: r.choice(["der", "la", "of", "in", "kind,", "=", "ab=cd"])
    rows = [" ".join(word() for _ in range(r.randrange(4)))
            + r.choice([" mail: {}", " key = \"{}\"", " see {}", "{}", " ({}) end"]).format(
                r.choice([f"u{k % 37}@mail.example.com", f"{k:032x}ab"[-32:], f"10.0.{k % 9}.{k % 7}", f"zz-{k}7743", "plainword"])) + r.choice(["", " of", " in la"])
            for k in range(400)] + [None, "", " "]
    docs = spark.createDataFrame([(t,) for t in rows], "text string")
    values = {v.lower() for t in rows if t for _, a, b in plain_spans(t) for v in [t[a:b]]} | {t[a:b].lower() for t in rows if t for a, b in pii.candidates(t, plain_spans(t))}
    flags = {x["v"]: x["m"] for x in spark.createDataFrame([(v,) for v in values], "v string").select("v", pii.masked(F.col("v")).alias("m")).collect()}
    want = plain_contexts(rows, 3, 3, flags.__getitem__)
    got = {x["pattern"]: (x["trust"], x["shown"], x["hidden"]) for x in pii.scored_contexts(docs)[0].collect()}
    assert set(got) == set(want) and len(want) > 8
    for p, (trust, *counts) in want.items():
        assert got[p][0] == pytest.approx(trust) and list(got[p][1:]) == counts, p


def test_contexts_find_unseen_identifiers(spark):
    r = random.Random(3)
    word = lambda: "".join(r.choice("aeioubcdfg") for _ in range(5))
    rows = [f"{word()} my contact mail: user{k}@mail.example.com {word()} the version {k}.0 {word()}" for k in range(40)]
    rows += [f"{word()} my contact mail: zz-{k}77431 {word()} order {k}55667 {word()}" for k in range(5)]
    docs = spark.createDataFrame([(k, t, "x", "y") for k, t in enumerate(rows)], "doc_id long, text string, digest string, added string")
    contexts = pii.learn_contexts(docs)
    assert {"L contact mail:", "W mail:"} <= patterns(contexts)
    found = {x["doc_id"]: x["spans"] for x in pii.find(docs, contexts).collect()}
    for k in range(40, 45):
        start = rows[k].index("zz-")
        assert found[k] == f"id:{start}:{start + len(f'zz-{k - 40}77431')}"
    assert all("id:" not in found[k] for k in range(40))
    out = pii.redact(docs, contexts)
    assert out.columns == docs.columns
    hidden = {x["doc_id"]: x["text"] for x in out.collect()}
    assert "[EMAIL]" in hidden[0] and "@" not in hidden[0] and "[ID]" in hidden[44] and "order 455667" in hidden[44]
    assert patterns(pii.learn_contexts(docs.limit(0))) == set()


def test_rare_contexts_are_scored_in_a_large_corpus(spark):
    rows = [f"kontakt adresse: user{k}@mail.example.com ende" for k in range(12)]
    rows += [f"kontakt adresse: zz-{k}77431 ende" for k in range(2)]
    rows += [f"see p{k} q{k} u{k}@mail.example.com r{k}" for k in range(9000)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "doc_id long, text string")
    contexts = pii.learn_contexts(docs)
    assert {"L kontakt adresse:", "M adresse: ende", "W adresse:"} <= patterns(contexts)
    assert "id:" in pii.find(docs.where("doc_id = 12"), contexts).first()["spans"]


def test_planted_tokens_are_found_and_clean_documents_left_alone(spark):
    docs = table(spark, SF01, "documents")
    contexts = pii.learn_contexts(docs).cache()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    planted = {d: [m.span(1) for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', t or "")] for d, t in texts.items()}
    got = {}
    for r in pii.find(docs, contexts).collect():
        got[r["doc_id"]] = [tuple(map(int, s.split(":")[1:])) for s in r["spans"].split(",") if s.startswith("id:")]
    assert got == planted and sum(map(len, planted.values())) > 5
    found, known = pii.masked_recall(docs)
    assert known > 0 and found >= 0.9 * known


def test_context_totals_are_exact(spark):
    texts = ["a b c a b", "b", "x a b = c", "", None, "a c a c", "w" * 300 + " a b"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    long = pii.split_words("w" * 300)[0]
    wanted = spark.createDataFrame([(p,) for p in ("L a b", "M a c", "M ^ $", "L ^", "M c $", "L never seen", "W a", "L a", f"L {long} a", f"W {long}")], "pattern string")
    got = {r["pattern"]: r["total"] for r in pii._frequencies(docs, wanted).collect()}
    assert got == {"L a b": 2, "M a c": 1, "M ^ $": 1, "L ^": 5, "W a": 6, "L a": 2, f"L {long} a": 1, f"W {long}": 1}


def test_long_identifiers_and_words_are_taken_whole():
    key = "k" * 70 + "4711" + "x" * 80 + "0815" + "y" * 90 + "99"
    for text in (f"my api key: {key} end", f"my api key: ({key}), end", f"my api key: {key}"):
        (a, b), = pii.candidates(text, [])
        assert text[a:b] == key and "L api key:" in pii.words_around(text, a, b)
        assert pii.hide(text, [("id", a, b)]) == text.replace(key, "[ID]")
    assert list(pii.candidates("token=" + "z" * 100 + " 12 a=12345678", [])) == [(112, 120)]
    long = "w" * 300
    assert pii.words_around(f"a {long} 12345678 b", 303, 311)[0] == f"L a {pii.split_words(long)[0]}"


def test_pii_of_odd_texts(odd):
    assert len(pii.find(odd).collect()) == odd.count()
    assert pii.redact(odd).columns == odd.columns
    assert sorted(pii.redact(odd).collect(), key=repr) == sorted(odd.collect(), key=repr)


def test_hide_merges_overlaps():
    assert pii.hide("abcdef", [("card", 1, 4), ("ip", 2, 5)]) == "a[CARD]f"
    assert pii.hide(None, []) is None
