"""WARC round trips and main-text extraction."""

import gzip
import hashlib
import os
import time

import pytest

from bookdemand.llm import html_crf, warc
from bookdemand.llm.base import table
from bookdemand.llm.queries import QUERIES

from conftest import SF01

PAGES = [
    (1, "http://a.b/x?q", "y" * 1500), (2, "http://a.b/y", "y" * 1500), (2, "http://a.b/y", "y" * 1500), (None, None, "y" * 1500),
    (5, "u\r\nX-Evil: 1", None), (6, "", "WARC/1.1\r\n\r\nWARC/1.1\r\nWARC-Type: x\r\nContent-Length: 3\r\n\r\né"), (7, "q", "z"), (8, "q", "z"),
    (9, "q", "w" * 1000), (None, "q", "v" * 2000), (None, "r", "v" * 2000), (10, "big", "é" * 700_000), (11, "nul", "a\0b"),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*p, "extra", "x") for p in PAGES], "page_id long, url string, html string, record_id string, value string")


def test_round_trip_keeps_every_byte(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(pages.repartition(3), path)
    rows = warc.assemble(warc.read_archives(spark, path)).collect()
    got = sorted((r["metadata"]["fields"].get("page_id"), r["response"]["warc_type"], r["copies"], bytes(r["response"]["payload"] or b""))
                 for r in rows if r["metadata"]["fields"].get("page_id"))
    want = sorted({(str(i), "revisit" if i == 1 else "response", 2 if i == 2 else 1, b"" if i == 1 else (h or "").encode()) for i, _, h in PAGES if i is not None})
    assert got == want
    assert all(r["request"] is not None and r["response"]["payload_sha1"] in (None, r["response"]["header_digest"][5:]) for r in rows)
    kinds = sorted(r["response"]["warc_type"] for r in rows if "page_id" not in r["metadata"]["fields"])
    assert kinds == ["response", "response", "revisit"]  # all of v's rows lack an id; y's one revisits page 2
    named = {r["record_id"]: r["metadata"]["fields"].get("page_id") for r in rows}
    assert {named[r["response"]["refers_to"]] for r in rows if r["response"]["warc_type"] == "revisit"} == {"2"}


def test_archives_are_plain_warc(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_archives(pages.where("page_id = 7").coalesce(1), path)
    [name] = [f for f in os.listdir(path) if f.startswith("part-")]
    data = gzip.open(f"{path}/{name}").read()
    records = list(warc.parse(data, True))
    assert [r["warc_type"] for r in records] == ["request", "response", "metadata"]
    assert data.endswith(b"\r\n\r\n") and records[1]["payload"] == b"z"
    assert list(warc.parse(gzip.compress(data[:0]) + gzip.compress(data) + gzip.compress(data), True)) == records * 2
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.parse(data[:-30], True))
    with pytest.raises(ValueError, match="no record"):
        list(warc.parse(b"hello\r\n", True))


def test_empty_pages(spark, pages, tmp_path):
    warc.write_archives(pages.limit(0), str(tmp_path / "w"))
    assert warc.assemble(warc.read_archives(spark, str(tmp_path / "w"))).collect() == []


def test_copies_of_a_large_payload(spark, tmp_path):
    """One payload in a third of all rows: one response, all others revisit it."""
    rows = [(k, f"http://h/{k}", "c" * 5000 if k % 3 == 0 else f"{k}" * 400) for k in range(600)]
    path = str(tmp_path / "w")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    got = warc.read_archives(spark, path, keep_payload=False)
    counts = {r["warc_type"]: r["count"] for r in got.groupBy("warc_type").count().collect()}
    assert counts == {"request": 600, "metadata": 600, "response": 401, "revisit": 199}
    assert got.where("payload is not null").count() == 0
    assert got.where("warc_type = 'response'").select("payload_sha1").distinct().count() == len({hashlib.sha1(h.encode()).hexdigest() for _, _, h in rows})


# ---------------------------------------------------------------- main text

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x = "</p><p>no</p>";</script></head><body>
<header><p>Site name</p></header><nav><ul><li><a href=/>Home</a><li><a href=/b>News</a></ul></nav><!-- <p>gone</p> -->
<div class="ad"><p>Buy now. It is cheap.</p></div><article><h1>A  title &amp; more</h1><p><b>First&nbsp;one
is   here. It goes on.<br>still the same<p>Second &lt;one&gt; follows. It ends.</p><ul><li>An item.</ul></article>
<aside><h3>Related</h3><ul><li><a href=1>Other story</a></ul></aside><section id="comments"><h2>Comments</h2><div class="comment"><p>Nice one. Thanks a lot.</p></div></section>
<form><label>Mail</label><input><button>Go</button></form><footer>&copy; 2020 Site</footer></body></html>"""


@pytest.fixture(scope="module")
def crf():
    return html_crf.default_field()


def test_article_only(crf):
    assert html_crf.main_text(PAGE, crf).split("\n\n") == [
        "A title & more", "First one is here. It goes on. still the same", "Second <one> follows. It ends.", "An item."]


def test_odd_pages(spark, crf):
    odd = [(k, None if k == 3 else f"u{k}", h, "x") for k, h in enumerate(
        [None, "", "<", "<p", "text alone", "<p>a<p>b", "<!-- x", "<script>if(a<b)</scr", "<a title='x>y'>z</a>", PAGE, PAGE])] + [(None, None, None, "x")]
    frame = spark.createDataFrame(odd, "page_id long, url string, html string, text string")
    rows = html_crf.extract(frame, crf).collect()
    assert len(rows) == len(odd) and html_crf.extract(frame.limit(0), crf).collect() == []
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert sum(r["text"].startswith("A title") for r in rows) == 2


def test_hostile_pages_take_linear_time():
    for page in ("<" * 200_000, "<a" * 200_000, '"<a' * 100_000 + ">", "<a x='" * 50_000, "<p>" * 200_000, "<div>" * 200_000 + "<td>" * 50_000, "</p>" * 200_000, "&" * 200_000):
        began = time.process_time()
        html_crf.blocks(page)
        assert time.process_time() - began < 10


def test_viterbi_and_marginals_against_enumeration():
    import itertools
    import math

    crf = html_crf.Field(start=0.3, pair=[[0.5, -0.2], [0.1, 0.9]])
    unary = [0.4, -1.2, 0.7, 0.2]

    def worth(y):
        return sum(u * k for u, k in zip(unary, y)) + crf.start * y[0] + sum(crf.pair[a][b] for a, b in zip(y, y[1:]))

    all_y = list(itertools.product((0, 1), repeat=4))
    assert crf.viterbi(unary) == list(max(all_y, key=worth))
    whole = sum(math.exp(worth(y)) for y in all_y)
    on, pairs = crf.expected(unary)
    for k in range(4):
        assert on[k] == pytest.approx(sum(math.exp(worth(y)) for y in all_y if y[k]) / whole)
    assert pairs[1][0] == pytest.approx(sum(math.exp(worth(y)) * sum(a == 1 and b == 0 for a, b in zip(y, y[1:])) for y in all_y) / whole)
    assert crf.viterbi([]) == []


def test_held_out_layouts(crf):
    wrong = total = 0
    for seed in range(10_000_000, 10_000_150):
        found, labels = html_crf.labelled_page(seed)
        got = crf.viterbi(crf.unary(html_crf.page_features(found)))
        wrong += sum(a != b for a, b in zip(got, labels))
        total += len(labels)
    assert wrong / total < 0.02


def test_pages_hold_their_documents(spark):
    """The paragraphs of the document that a page's address names, after the title."""
    import re

    texts = {r["doc_id"]: r["text"] for r in table(spark, SF01, "documents").collect()}
    rows = QUERIES["op8_html_crf"](spark, SF01).collect()
    assert len(rows) == 250
    for r in rows:
        paragraphs = [" ".join(p.split()) for p in texts[int(re.search(r"/([0-9]+)", r["url"])[1])].split("\n") if p.strip()]
        assert r["text"].split("\n\n")[1:] == paragraphs
