"""Cross-tokenizer alignment against the libraries and plain loops."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bookdemand.llm import alignment
from bookdemand.llm.base import table
from bookdemand.llm.queries import QUERIES

from conftest import SF001

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOK, SP = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
TOK.encode_special_tokens = True
ALPHABET = alignment.byte_alphabet()
FIELDS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]

ODD_TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a  b ", "\n", "a\n b\t c", "<|endoftext|> x<|endoftext|>y", "<s></s><unk><0x41>", "▁", "a▁b", "é é ﬁ",
    "日本語のテキスト 한국어 ​ z", "nul\x00nul", "🙂🙂 ok 👩‍👩‍👧", "1234 ٣ Ⅷ ½", "aaaaaaaaaaaaaaaaaaaaaaaaa", "\x1c\x1d a\x85 b\xa0 c\u180e  d\u2028 e",
    "x" * 3000, "it's they'll  I'd", "b " * 3000, "\r\n\r\n  if x:\n        return 1\n", "\u3000 \u3000a", "q3Rt/9+Zk" * 200,
]


def plain_tokens(text):
    if not text:
        return [], []
    a, b = TOK.encode(" " + text, add_special_tokens=False), SP.encode(text)
    a_bytes = [bytes(ALPHABET[c] for c in t) for t in a.tokens]
    b_bytes = [bytes([int(SP.id_to_piece(k)[3:-1], 16)]) if SP.is_byte(k) else SP.id_to_piece(k).replace("▁", " ").encode() for k in b]
    whole = (" " + text).encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return [], []
    return list(zip(a.ids, np.cumsum([len(x) for x in a_bytes]).tolist())), list(zip(b, np.cumsum([len(x) for x in b_bytes]).tolist()))


def plain_groups(a, b):
    out, shared, i, j = [], sorted({e for _, e in a} & {e for _, e in b}), 0, 0
    for end in shared:
        xs, ys = [], []
        while i < len(a) and a[i][1] <= end:
            xs, i = xs + [a[i][0]], i + 1
        while j < len(b) and b[j][1] <= end:
            ys, j = ys + [b[j][0]], j + 1
        out.append((xs, ys))
    return out


def plain(rows):
    each = [(doc_id, *(t := plain_tokens(text)), plain_groups(*t)) for doc_id, text in rows]
    docs, top = Counter(), defaultdict(int)
    for *_, found in each:
        docs.update({(x, y) for xs, ys in found for x in xs for y in ys})
    for (x, _), n in docs.items():
        top[x] = max(top[x], n)
    out = []
    for doc_id, a, b, found in each:
        linked = [(x, y) for xs, ys in found for x in xs for y in ys]
        text = ";".join(",".join(map(str, xs)) + "|" + ",".join(map(str, ys)) for xs, ys in found)
        out.append((doc_id, len(a), len(b), len(found), len(linked), sum(docs[p] == top[p[0]] for p in linked), sum(docs[p] for p in linked),
                    hashlib.sha256(text.encode()).hexdigest() if found else "", text))
    return out


def same(got, want):
    assert sorted((tuple(r[f] for f in FIELDS) for r in got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("block_chars", [8 << 20, 300])
def test_odd_texts_equal_the_plain_version(spark, block_chars):
    rows = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(None, "null id"), (4, "a"), (4, "a")]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, block string, a int")
    same(alignment.align(docs, A, B, block_chars, keep_groups=True).collect(), plain(rows))
    assert alignment.align(docs.limit(0), A, B).collect() == []


def test_query_equals_the_plain_version(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF001, "documents").select("doc_id", "text").collect()]
    got = QUERIES["op11_alignment"](spark, SF001)
    assert got.columns == FIELDS[:-1]
    assert sorted(map(tuple, got.collect())) == sorted(r[:-1] for r in plain(rows))


def test_ranked_encoders_equal_the_libraries(spark):
    pair, pick, chunks = alignment.Pair(A, B), random.Random(1), set()
    assert pair.fast and pair.fast_b and pair.cuts
    for r in table(spark, SF001, "documents").where("text is not null").select("text").collect():
        chunks.update(pair.chunks(r["text"]))
    letters = "abcde  '\n\t\x00\x7fABthin0123.,<>|é"
    for _ in range(20_000):
        chunks.add(pick.choice([" ", "\n", "  "]) + "".join(pick.choice(letters) for _ in range(pick.randrange(25))))
    chunks = sorted(chunks)
    quick = pair.encode(chunks)
    pair.fast = pair.fast_b = None
    assert pair.encode(chunks) == quick


def test_long_texts_in_parts(spark, monkeypatch):
    pick = random.Random(3)
    text = " ".join(pick.choice([t for t in ODD_TEXTS[4:] if "▁" not in t]) for _ in range(60))
    pair, whole = alignment.Pair(A, B), []
    for size in (1 << 20, 500):
        monkeypatch.setattr(alignment, "PART_CHARS", size)
        block = alignment.Block(alignment.Chunks(pair), True)
        block.add(1, text)
        block.add(2, "a " + text)
        block.align()
        whole.append([(d.n_a, d.n_links, b"".join(d.text), [x.tolist() for x in alignment.summed(np.concatenate(d.codes), np.concatenate(d.times))]) for d in block.docs])
    assert whole[0] == whole[1]
    assert whole[0][0][2].decode() == plain([(1, text)])[0][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(1, 4), min_size=1, max_size=12), st.integers(0, 1 << 30)), min_size=1, max_size=5), st.integers(0, 3))
def test_groups_and_links_equal_loops(intervals, wide):
    a, b, a_first, b_first = [], [], [], []
    for a_len, seed in intervals:
        pick, left = random.Random(seed), sum(a_len)
        a_first.append(len(a))
        b_first.append(len(b))
        a += a_len
        while left:
            b.append(min(left, pick.randint(1, 5)))
            left -= b[-1]
    a_ends, b_ends = np.cumsum(a), np.cumsum(b)
    a_start, b_start = alignment.groups(a_ends, b_ends, np.array(a_first), np.array(b_first))
    shared = sorted(set(a_ends.tolist()) & set(b_ends.tolist()))
    assert a_start.tolist() == [0, *(int(np.searchsorted(a_ends, e)) + 1 for e in shared[:-1])]
    assert b_start.tolist() == [0, *(int(np.searchsorted(b_ends, e)) + 1 for e in shared[:-1])]
    before, alignment.WIDE = alignment.WIDE, wide
    try:
        group, code, times = alignment.links(np.array(a), np.array(b), a_start, b_start, 10)
    finally:
        alignment.WIDE = before
    found = Counter()
    for g, c, n in zip(group.tolist(), code.tolist(), times.tolist()):
        found[g, c] += n
    want = Counter()
    for g, (s, t) in enumerate(zip(a_start, b_start)):
        for x in a[s:(np.append(a_start, len(a))[g + 1])]:
            for y in b[t:(np.append(b_start, len(b))[g + 1])]:
                want[g, x * 10 + y] += 1
    assert found == want
