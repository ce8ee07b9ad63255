"""Every stage of the pipeline against a plain version of itself, and the whole."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from bookdemand.llm import mixing, pii, quality
from bookdemand.llm.base import remainder_of_crc, stored, table
from bookdemand.llm.queries import tokenizer_path

from conftest import SF001
from tests.llm.test_group_operators import groups, plain_fingerprint
from tests.llm.test_text_operators import plain_spans


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage, as lists of rows."""
    docs, found = table(spark, SF001, "documents"), []
    for _, stage in P.STAGES:
        out = stored(stage(spark, docs, SF001), "stage")
        found.append((docs, docs.collect(), out, out.collect()))
        docs = out
    return found


def test_columns(spark, stages):
    for docs, _, out, _ in stages[:-1]:
        assert out.dtypes == table(spark, SF001, "documents").dtypes


def test_quality_stage(spark, stages):
    docs, before, _, after = stages[0]
    net = quality.fit(docs, table(spark, SF001, "labels"), allowed=remainder_of_crc("doc_id", 5) != 0)
    want = [r for r in before if quality.probability(net, quality.padded(r["text"])) >= 0.3]
    assert sorted(want) == sorted(after) and 0 < len(after) < len(before)


def test_near_duplicate_stage(stages):
    _, before, _, after = stages[1]
    prints = np.array([plain_fingerprint(r["text"]) for r in before], np.uint64)
    root = groups(len(before), [(i, int(j)) for i in range(len(before)) for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints) <= 3) if i < j])
    keep = {min(before[k]["doc_id"] for k in range(len(before)) if root[k] == g) for g in set(root)}
    assert sorted(r for r in before if r["doc_id"] in keep) == sorted(after)


def test_personal_data_stage(stages):
    docs, before, _, after = stages[2]
    marked = {}
    for r in pii.find(docs, pii.learn_contexts(docs)).collect():
        marked.setdefault(r["doc_id"], []).extend(("id", *map(int, s.split(":")[1:])) for s in r["spans"].split(",") if s.startswith("id:"))
    new = {r["doc_id"]: r for r in after}
    assert len(after) == len(before)
    for r in before:
        spans = plain_spans(r["text"])
        spans += marked[r["doc_id"]]
        assert new[r["doc_id"]]["text"] == pii.hide(r["text"], spans)
        assert new[r["doc_id"]]["n_chars"] == len(new[r["doc_id"]]["text"])
        assert not plain_spans(new[r["doc_id"]]["text"])


def test_mixture_stage(stages):
    docs, before, _, after = stages[3]
    kept = {r["doc_id"] for r in mixing.mix(docs).where("kept").collect()}
    assert sorted(r for r in before if r["doc_id"] in kept) == sorted(after) and 0 < len(after) < len(before)


def test_token_stage(stages):
    _, before, _, after = stages[4]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = {r["doc_id"]: r["text"] for r in before}
    assert sorted(texts) == sorted(r["doc_id"] for r in after)
    for r in after:
        assert np.frombuffer(r["ids"], "<u4").tolist() == tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids


def test_run_is_the_stages_in_order(spark, stages):
    assert sorted(map(tuple, P.run(spark, SF001).collect())) == sorted(map(tuple, stages[-1][3]))


def test_stages_on_odd_rows(spark):
    """Nulls, empties, repeats, a clashing extra column; and no rows at all."""
    schema = table(spark, SF001, "documents").select("doc_id", "text", "lang", "source", "n_chars").schema.simpleString()[7:-1].replace(":", " ")
    rows = [(None, None, None, None, None, 1), (1, None, None, "s", 0, 1), (2, "", "en", None, 0, 1), (3, "a few words here.", "en", "s", 17, 1),
            (3, "a few words here.", "en", "s", 17, 1), (3, "other text, same id.", "en", "s", 20, 1), (4, "call +1 (988) 555-2485 now", "en", "s", 26, 1), (5, "word " * 60_000, "en", "s", 300_000, 1)]
    docs = spark.createDataFrame(rows, schema + ", score int")
    for frame in (docs, docs.limit(0)):
        for name, stage in P.STAGES:
            out = stage(spark, frame, SF001)
            if name != "tokens":
                assert out.columns == frame.columns
            assert len(out.collect()) <= frame.count()
    hidden = P.hide_personal_data(spark, docs, SF001).where(F.col("doc_id") == 4).first()
    assert hidden["text"] == "call [PHONE] now" and hidden["n_chars"] == 16
