"""Personal data: fixed patterns as seeds, contexts learned from them by bootstrapping.

Seeds are what the four fixed patterns find, and digests (32, 40 or 64 hex digits), which
are no personal data by themselves but show where identifiers are written.  The words
around seeds are candidate contexts; a graph of contexts and identifier-like values is
scored over all documents in rounds (a context is as good as the values it holds, a value
as good as the contexts that hold it).  Three seeds in ten are masked while contexts are
scored; a context is kept if it nearly always holds an identifier and finds masked seeds
again.  Kept contexts are a table; the values that they mark are found by a join.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bookdemand.llm.base import free_name, stored

KINDS = ("email", "ip", "card", "phone")
FOUND = "id"  # kind of the spans that contexts add

# The domain, address, card and phone patterns of the contract.  The
# leading look-behinds only skip starts that cannot match.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
ADDRESS = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DIGIT = re.compile(r"[0-9]")
MARK = re.compile(r"[0-9@]+")
EDGE = re.compile(r"[\s=]")
WORD = re.compile(r"\S+")
QUOTES = "\"'"
TRIM = "\"'()[]{}<>.,;:!?"
HEX_DIGEST = re.compile(r"(?=[0-9]*[A-Fa-f])(?=[A-Fa-f]*[0-9])(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{64})")
LONGEST_NAME = 64  # of a value or word in the graph; a digest stands for longer ones
MASKED = 30  # of a hundred seeds, by the hash of the value


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def octet(digits: str) -> bool:
    """Is a number of any length at most 255?"""
    value = digits.lstrip("0")
    return len(value) < 4 and int(value or 0) <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches: an address starts where its run of local characters does."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    if not text:
        return []
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    if not DIGIT.search(text):
        return out
    out += [("ip", *m.span()) for m in ADDRESS.finditer(text) if all(octet(p) for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(DIGIT.findall(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def _name(value: str) -> str:
    """What stands for a word or value in the graph: itself, or a digest if it is long."""
    value = value.lower()
    return value if len(value) <= LONGEST_NAME else hashlib.sha256(value.encode("utf-8", "surrogatepass")).hexdigest()


def split_words(text: str) -> list[str]:
    """Lower-case words as contexts hold them; a sign of assignment ends a word."""
    return [w if len(w) <= LONGEST_NAME else _name(w) for w in text.replace("=", "= ").lower().split()]


def _reach(text: str, start: int, words: int) -> int:
    """Where the ``words`` whole words before ``start`` begin."""
    for _ in range(words):
        while start > 0 and text[start - 1].isspace():
            start -= 1
        start -= start > 0
        while start > 0 and not text[start - 1].isspace() and text[start - 1] != "=":
            start -= 1
    return start


def patterns_of(before: str, left: str, after: str) -> list[str]:
    """L: the two words before; M: the word on either side; W: the word before, with a letter."""
    out = [f"L {before} {left}" if before else f"L {left}", f"M {left} {after}"]
    return out + [f"W {left}"] if any(c.isalpha() for c in left) else out


def words_around(text: str, start: int, end: int) -> list[str]:
    """The context patterns of the value at ``start``; words are whole, whatever their length."""
    while start > 0 and not text[start - 1].isspace() and text[start - 1] != "=":
        start -= 1  # punctuation before the value is part of its word
    before = ["", "", *split_words(text[_reach(text, start, 2):start])]
    edge = EDGE.search(text, end)
    found = WORD.search(text, edge.end()) if edge and edge[0] != "=" else None
    after = split_words(found[0])[0] if found else "=" if edge and edge[0] == "=" else "$"
    return patterns_of(before[-2], before[-1] or "^", after)


def candidates(text: str, taken: list[tuple[str, int, int]]) -> Iterator[tuple[int, int]]:
    """Identifier-like values outside the spans in ``taken``: a whole word of at least 6
    characters with at least three digits or an @, edge punctuation left off; of a quoted
    word what is in the quotes."""
    spans = sorted((a, b) for _, a, b in taken)
    last, k, n = 0, 0, len(text)
    for m in MARK.finditer(text):
        if m.start() < last:
            continue
        start = m.start()
        while start > last and not EDGE.match(text[start - 1]):
            start -= 1
        edge = EDGE.search(text, m.end())
        last = end = edge.start() if edge else n
        word = text[start:end]
        if word[0] in QUOTES and (closed := word.find(word[0], 1)) > 0:
            start, end, word = start + 1, start + closed, word[1:closed]
        start, end = start + len(word) - len(word.lstrip(TRIM)), end - (len(word) - len(word.rstrip(TRIM)))
        value = text[start:end]
        if len(value) < 6 or not ("@" in value or len(DIGIT.findall(value)) >= 3):
            continue
        while k < len(spans) and spans[k][1] <= start:
            k += 1
        if not any(a < end and start < b for a, b in spans[k:k + 4]):
            yield start, end


def _slim(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("text").cast("string").alias("text"))


def _occurrences(docs: DataFrame) -> DataFrame:
    """(pattern, value, seed, n): how often each context holds each value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: Counter = Counter()
            for text in batch.column(0):
                if not (value := text.as_py()):
                    continue
                base = base_spans(value)
                places = [(a, b, True) for _, a, b in base]
                places += [(a, b, HEX_DIGEST.fullmatch(value, a, b) is not None) for a, b in candidates(value, base)]
                for a, b, seed in places:
                    name = _name(value[a:b])
                    for pattern in words_around(value, a, b):
                        seen[pattern, name, seed] += 1
            rows = list(seen.items())
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0] for k, _ in rows], pa.string()), pa.array([k[1] for k, _ in rows], pa.string()),
                 pa.array([k[2] for k, _ in rows], pa.bool_()), pa.array([n for _, n in rows], pa.int64())],
                names=["pattern", "value", "seed", "n"])

    return _slim(docs).mapInArrow(run, "pattern string, value string, seed boolean, n long").groupBy("pattern", "value").agg(
        F.max("seed").alias("seed"), F.sum("n").alias("n"))


def sieve_bits(patterns: int) -> int:
    """Logarithm of the sieve's bits: at most one in 32 is set, 1 MB at least, 1 GB at most."""
    return min(33, max(23, (32 * patterns).bit_length()))


def _hashes(words: list[str]) -> np.ndarray:
    return np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) for w in words), np.uint64, len(words))


def _slots(left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
    """The bit of the sieve for each pair of word hashes."""
    return ((left * np.uint64(0x9E3779B97F4A7C15) + right * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - bits)).astype(np.int64)


def _sieve(patterns: DataFrame, bits: int) -> np.ndarray:
    """A bit map in which the bit of every context is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [(p, w[0], w[-1] if len(w) == 2 else "") for p in batch.column(0).to_pylist() if (w := p[2:].split(" "))]
            at = _slots(_hashes([w[1] for w in split]), _hashes([w[2] for w in split]), bits)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 5), pa.array(np.int64(1) << (at & 31))], names=["at", "bits"])

    found = patterns.select("pattern").mapInArrow(run, "at long, bits long").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    words = np.zeros(1 << (bits - 5), np.uint32)
    words[found.column("at").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return words


def _frequencies(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, total): how often each context of ``patterns`` occurs around any word at all.

    A sieve sized to the number of contexts leaves out nearly all that is no context; what
    passes is counted in Spark, and the join with ``patterns`` drops the rest.
    """
    bits = sieve_bits(patterns.count())
    shared = docs.sparkSession.sparkContext.broadcast(_sieve(patterns, bits))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve, nothing = shared.value, _hashes([""])

        def hits(left: np.ndarray, right: np.ndarray) -> list[int]:
            at = _slots(left, right, bits)
            return np.flatnonzero(sieve[at >> 5] >> (at & 31).astype(np.uint32) & 1).tolist()

        for batch in batches:
            two, around, one, texts = Counter(), Counter(), Counter(), 0
            for text in batch.column(0):
                words = ["^", *split_words(text.as_py() or ""), "$"]
                n, at = len(words) - 2, words.__getitem__
                if not n:
                    continue
                texts += 1
                marks = _hashes(words)
                # before the word at k + 3, around the word at k + 1, before the word at k + 2
                two.update((at(k + 1), at(k + 2)) for k in hits(marks[1:n - 1], marks[2:n]))
                if n > 1 and hits(marks[1:2], nothing):
                    two["", words[1]] += 1
                around.update((at(k), at(k + 2)) for k in hits(marks[:n], marks[2:]))
                one.update(at(k + 1) for k in hits(marks[1:n], nothing))
            rows = {f"L {x} {y}" if x else f"L {y}": c for (x, y), c in two.items()} | {f"M {x} {y}": c for (x, y), c in around.items()}
            rows |= {f"W {x}": c for x, c in one.items()} | {"L ^": texts}
            yield pa.RecordBatch.from_arrays([pa.array(list(rows), pa.string()), pa.array(list(rows.values()), pa.int64())], names=["pattern", "total"])

    passed = _slim(docs).mapInArrow(run, "pattern string, total long").groupBy("pattern").agg(F.sum("total").alias("total"))
    return passed.join(patterns.select("pattern"), "pattern", "left_semi")


def masked(value: Column) -> Column:
    """Is a seed hidden from scoring?  By the hash of its value, so every copy of it is."""
    return F.pmod(F.xxhash64(value), F.lit(100)) < MASKED


def scored_contexts(docs: DataFrame, min_seeds: int = 3, rounds: int = 3) -> tuple[DataFrame, DataFrame]:
    """Contexts (pattern, trust, shown, hidden) and the graph they were scored on (pattern,
    value, seed, hidden, n).

    ``shown`` and ``hidden`` are the numbers of different visible and masked seeds that a
    context holds.  A context of at least ``min_seeds`` visible seeds is scored, at every size
    of the corpus.  In each round a context's trust is the share of its occurrences around any
    word at all that hold an identifier, each value counted with its score (a visible seed 1,
    any other 1 - product of (1 - trust) of its contexts, 0 at first).  A masked value has no
    score of its own: only its contexts can give it one.
    """
    graph = stored(_occurrences(docs).withColumn("hidden", F.col("seed") & masked(F.col("value"))), "contexts")
    visible = F.col("seed") & ~F.col("hidden")
    induced = stored(graph.groupBy("pattern").agg(
        F.count(F.when(visible, 1)).alias("shown"), F.count(F.when(F.col("hidden"), 1)).alias("hidden")).where(F.col("shown") >= min_seeds), "induced_contexts")
    totals = stored(_frequencies(docs, induced), "context_totals")
    edges = stored(graph.join(totals, "pattern"), "context_edges")
    score = edges.groupBy("value").agg(F.max(visible.cast("double")).alias("score"))
    found = induced.select("pattern", F.lit(0.0).alias("trust"))
    for _ in range(rounds):
        held = edges.join(stored(score, "value_scores"), "value")
        found = stored(held.groupBy("pattern").agg(
            F.least(F.lit(1.0), F.sum(F.col("n") * F.col("score")) / F.greatest(F.max("total"), F.sum("n"))).alias("trust")), "context_trust")
        trusted = edges.join(found, "pattern")
        score = trusted.groupBy("value").agg(F.when(F.max(visible), 1.0).otherwise(
            1 - F.exp(F.sum(F.log1p(-F.least(F.col("trust"), F.lit(1 - 1e-9)))))).alias("score"))
    return stored(found.join(induced, "pattern"), "scored_contexts"), graph


def _kept(confidence: float) -> Column:
    return (F.col("trust") >= confidence) & (F.col("hidden") > 0)


def learn_contexts(docs: DataFrame, min_seeds: int = 3, rounds: int = 3, confidence: float = 0.5) -> DataFrame:
    """(pattern, trust) of the contexts that hold an identifier at least ``confidence`` of the
    times they occur and that find masked seeds again.  All counts are over all rows; no
    seeds or an empty table give no contexts.  The contexts are a table, whatever their number."""
    return scored_contexts(docs, min_seeds, rounds)[0].where(_kept(confidence)).select("pattern", "trust")


def masked_recall(docs: DataFrame, min_seeds: int = 3, rounds: int = 3, confidence: float = 0.5) -> tuple[int, int]:
    """(found, all): masked seeds, of those that stand in a context of at least ``min_seeds``
    visible seeds and half as much trust as a kept one needs, that a kept context finds again."""
    contexts, graph = scored_contexts(docs, min_seeds, rounds)
    near = contexts.where(F.col("trust") >= confidence / 2).select("pattern", _kept(confidence).alias("kept"))
    held = graph.where("hidden").select("pattern", "value").join(near, "pattern")
    row = held.groupBy("value").agg(F.max("kept").alias("kept")).agg(F.count(F.when(F.col("kept"), 1)), F.count(F.lit(1))).first()
    return row[0], row[1]


def _join(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _marked(candidates_of: DataFrame, contexts: DataFrame) -> DataFrame:
    """(digest, added): for each text, by its SHA-256, the values that a context marks, as
    start:end joined by commas in order.  ``candidates_of``: digest, start, end, patterns."""
    each = candidates_of.select("digest", "start", "end", F.explode("patterns").alias("pattern"))
    found = each.join(contexts.select("pattern"), "pattern", "left_semi").select("digest", "start", "end").distinct()
    spans = F.transform(F.array_sort(F.collect_list(F.struct("start", "end"))), lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string")))
    return stored(found.groupBy("digest").agg(F.array_join(spans, ",").alias("added")), "marked")


def _near(df: DataFrame, digest: str = "digest", added: str = "added", limit: int = 8 << 20) -> DataFrame:
    """``df`` (a digest, added spans) under these names, to be broadcast if its measured text
    is below ``limit`` bytes."""
    size = df.agg(F.sum(F.octet_length("added") + F.lit(100))).first()[0] or 0
    named = df.select(F.col("digest").alias(digest), F.col("added").alias(added))
    return F.broadcast(named) if size <= limit else named


CANDIDATES = "array<struct<start:int,end:int,patterns:array<string>>>"


def _candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, counts, base_spans, digest, found): the base spans, and the candidates with
    their contexts; the text's SHA-256 only where there are any.  Texts stay behind."""
    counts = [f"n_{k}" for k in KINDS]
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in counts), ("base_spans", pa.string()), ("digest", pa.string()),
                        ("found", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("patterns", pa.list_(pa.string()))])))])

    def row(doc_id, text: str | None) -> dict:
        base = base_spans(text)
        found = [{"start": a, "end": b, "patterns": words_around(text, a, b)} for a, b in candidates(text, base)] if text else []
        return {"doc_id": doc_id, **{f"n_{k}": sum(s[0] == k for s in base) for k in KINDS}, "base_spans": _join(base),
                "digest": hashlib.sha256(text.encode()).hexdigest() if found else None, "found": found}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([row(d, t.as_py()) for d, t in zip(batch.column(0).to_pylist(), batch.column(1))], schema)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(slim.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in counts) + f", base_spans string, digest string, found {CANDIDATES}"), "candidates")


def _added(rows: DataFrame, contexts: DataFrame) -> DataFrame:
    """What :func:`_marked` gives for the candidates in ``rows``; copies of a text count once."""
    each = rows.where("digest is not null").select("digest", F.explode("found").alias("x"))
    return _marked(each.select("digest", "x.*").dropDuplicates(["digest", "start"]), contexts)


def find(docs: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """One row for each row of ``docs``: doc_id, the number of base spans of each kind
    (n_email, n_ip, n_card, n_phone), base_spans and spans, both kind:start:end joined
    by commas in code points: base spans, then those of kind 'id' that ``contexts`` (a column
    ``pattern``) mark, which never touch a base span.  Null and empty texts have none;
    repeated rows and null ids come out as they came in; other columns are not read."""
    rows = _candidates(docs)
    if contexts is None:
        return rows.drop("digest", "found").withColumn("spans", F.col("base_spans"))
    marked = F.transform(F.split("added", ","), lambda x: F.concat(F.lit(f"{FOUND}:"), x))
    none = F.array().cast("array<string>")
    both = F.concat(F.when(F.col("base_spans") != "", F.array("base_spans")).otherwise(none), F.coalesce(marked, none))
    return (rows.drop("found").join(_near(_added(rows, contexts)), "digest", "left")
            .withColumn("spans", F.array_join(both, ",")).drop("digest", "added"))


def hide(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with every span replaced by its kind in brackets; of spans that overlap,
    the union goes, under the kind of the first."""
    if text is None or not spans:
        return text
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """``docs`` with all spans in ``text`` replaced; ``n_chars`` follows if there is one.
    Null texts stay null; every row and column stays, whatever the columns are called."""
    digest, added = free_name("digest", docs.columns), free_name("added", docs.columns)

    @F.pandas_udf("string")
    def run(texts: pd.Series, marks: pd.Series) -> pd.Series:
        def spans(text: str | None, marked: str | None) -> list[tuple[str, int, int]]:
            return base_spans(text) + [(FOUND, *map(int, m.split(":"))) for m in (marked or "").split(",") if m]

        return pd.Series([hide(t, spans(t, m)) for t, m in zip(texts, marks)], dtype=object)

    text = F.col("text").cast("string")
    if contexts is None:
        out = docs.withColumn(added, F.lit(None).cast("string"))
    else:
        marks = _added(_candidates(docs.select(F.lit(None).alias("doc_id"), text.alias("text"))), contexts)
        out = docs.withColumn(digest, F.sha2(text.cast("binary"), 256)).join(_near(marks, digest, added), digest, "left").drop(digest)
    out = out.withColumn("text", run(text, F.col(added)))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
