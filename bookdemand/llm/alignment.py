"""Alignment of two tokenizers' tokens over the same bytes.

Both tokenizers cut a text's bytes into tokens.  Where an A token and a B token end at
the same byte the text can be cut without cutting a token.  The cuts are found by divide
and conquer: bisect for a common end near the middle of an interval, go on with both
halves, until an interval holds no common end inside; such an interval is a group.  All
intervals of one depth are split together, over many texts at once.

Every A token of a group is linked with every B token of it.  Spark counts, over all
documents, how many hold an id pair linked, and gives every link its pair's count back
through blocks of documents that list each of their pairs once.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from bookdemand.llm.base import stored
from bookdemand.llm.bpe import pack, ragged, unpack

CUT = re.compile(r"(?<=\S)(?=[ \n])")
# A's word pattern (a fixed value of byte-level tokenizers), and the characters whose letter,
# number and white-space classes are the same in every Unicode version the libraries carry.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SETTLED = re.compile("[\\x00-\u024f]*")
SHORT = 200  # longer chunks go to B itself, whose time grows more slowly with their length
CHUNKS_KEPT = 400_000  # of one task, from block to block
PART_CHARS = 1 << 20  # characters that are aligned together
WIDE = 1 << 16  # links from which a group's equal tokens are counted before they are paired
DOC_ROWS, PAIR_ROWS = 256, 100_000


def byte_alphabet() -> dict[str, int]:
    """Byte of each character of byte-level vocabularies: printable bytes stand for
    themselves, the others follow from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """Tokenizer files A (byte-level BPE) and B (sentencepiece with byte fallback), and the
    bytes of their tokens."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        alphabet = byte_alphabet()
        names = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, k in names.items():
            self.a_bytes[k] = bytes(alphabet.get(c, 63) for c in name)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(k) for k in range(n)]
        self.b_bytes = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # decimal ids with the mark that follows them: inside a list, and at its end
        self.a_text, self.b_text = (np.array([b"%d%s" % (k, end) for end in (b",", last) for k in range(len(t))], object)
                                    for t, last in ((self.a_bytes, b"|"), (self.b_bytes, b";")))
        steps = json.loads(self.a.to_str())
        plain = steps["pre_tokenizer"] or {}
        bytewise = (steps["normalizer"] is None and plain.get("type") == "ByteLevel" and plain.get("use_regex") and not plain.get("add_prefix_space")
                    and set(alphabet) <= set(names))
        # A text may be cut before a blank or line end that follows no white space if A splits
        # words there and B has no piece that goes across; else texts stay whole.
        self.cuts = bytewise and not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
        self.blank = self.b.encode("a ")[len(self.b.encode("a")):]
        self.fast = self._ranked(steps["model"]) if bytewise else None
        self.fast_b = self._scored(pieces) if self.cuts else None

    def _ranked(self, model: dict) -> tiktoken.Encoding | None:
        """A as an encoder by ranks, if its merges stand in the order of their ids."""
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        ids = [model["vocab"]["".join(m)] for m in merges]
        single = [model["vocab"][c] for c in byte_alphabet()]
        if ids != sorted(set(ids)) or max(single) >= ids[0]:
            return None
        ranks = {self.a_bytes[k]: k for k in [*single, *ids]}
        return tiktoken.Encoding("a", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def _scored(self, pieces: list[str]) -> tiktoken.Encoding | None:
        """B as an encoder by ranks for texts of single-byte characters and single blanks, if its
        scores fall with its ids.  B merges characters where the ranked encoder merges bytes, and
        runs of blanks out of turn, so the two agree only there."""
        plain = [k for k in range(len(pieces)) if not (self.b.is_byte(k) or self.b.is_control(k) or self.b.is_unknown(k) or pieces[k].startswith("▁▁"))]
        scores = [self.b.get_score(k) for k in plain if len(pieces[k]) > 1]
        if any(self.b.is_unused(k) for k in plain) or any(x <= y for x, y in zip(scores, scores[1:])) or self.blank != [self.b.piece_to_id("▁")]:
            return None
        ranks = {self.b_bytes[k]: k for k in range(len(pieces)) if self.b.is_byte(k)} | {self.b_bytes[k]: k for k in plain}
        return tiktoken.Encoding("b", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})

    def chunks(self, text: str) -> list[str]:
        """Parts of blank + text, each starting with a blank or line end; both tokenizers cut between them."""
        return CUT.split(" " + text) if self.cuts else [" " + text]

    def encode(self, chunks: list[str]) -> tuple[list[list[int]], list[list[int]], list[str]]:
        """A's ids, B's ids of each chunk, and the chunks that do not join to their bytes again."""
        if self.fast is not None:
            settled, run = SETTLED.fullmatch, self.fast.encode_ordinary
            a = [run(c) if settled(c) else None for c in chunks]
            rest = [k for k, ids in enumerate(a) if ids is None]
        else:
            a, rest = [None] * len(chunks), list(range(len(chunks)))
        for k, e in zip(rest, self.a.encode_batch_fast([chunks[k] for k in rest], add_special_tokens=False)):
            a[k] = e.ids
        if self.fast_b is not None:
            run = self.fast_b.encode_ordinary
            b = [run(c) if c.isascii() and len(c) <= SHORT and "  " not in c else None for c in chunks]
            rest = [k for k, ids in enumerate(b) if ids is None]
        else:
            b, rest = [None] * len(chunks), list(range(len(chunks)))
        for k, ids in zip(rest, self.b.encode([c[1:] if c[0] == " " else c for c in map(chunks.__getitem__, rest)], num_threads=1)):
            # the blank that B adds stands alone before a line end
            b[k] = ids[1:] if chunks[k][0] == "\n" else self.blank if chunks[k] == " " else ids
        piece, token = self.b_bytes.__getitem__, self.a_bytes.__getitem__
        wrong = [c for c, x, y in zip(chunks, a, b) if (data := c.encode()) != b"".join(map(piece, y)) or self.fast is None and data != b"".join(map(token, x))]
        return a, b, wrong


class Lists:
    """Growing lists of small integers, one after another."""

    def __init__(self) -> None:
        self.flat, self.size = array("i"), array("i")

    def add(self, lists: list[list[int]]) -> None:
        self.flat.extend(chain.from_iterable(lists))
        self.size.extend(map(len, lists))

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists numbered ``at`` one after another, and their sizes."""
        size = np.array(self.size, np.int64)
        return ragged(np.array(self.flat, np.int64), np.cumsum(size) - size, size, at), size[at]


class Chunks:
    """Chunks that a task has met: each is encoded once, until there are many."""

    def __init__(self, pair: Pair) -> None:
        self.pair, self.number = pair, {}
        self.a, self.b = Lists(), Lists()
        self.unsound: set[str] = set()

    def numbers(self, chunks: list[str]) -> np.ndarray | None:
        """The chunks' numbers, or None if one of them does not keep its bytes."""
        fresh = [c for c in dict.fromkeys(chunks) if c not in self.number]
        if fresh:
            a, b, wrong = self.pair.encode(fresh)
            self.number.update(zip(fresh, range(len(self.number), len(self.number) + len(fresh))))
            self.a.add(a)
            self.b.add(b)
            self.unsound.update(wrong)
        if self.unsound and not self.unsound.isdisjoint(chunks):
            return None
        return np.fromiter(map(self.number.__getitem__, chunks), np.int64, len(chunks))


def groups(a_ends: np.ndarray, b_ends: np.ndarray, a_first: np.ndarray, b_first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where groups start, in A's and in B's tokens.

    ``a_ends`` and ``b_ends`` are rising byte offsets at which tokens end; token number
    ``a_first[k]`` (``b_first[k]``) starts the k-th interval, and the intervals' ends are common."""
    ended = np.zeros(int(a_ends[-1]) + 1 if len(a_ends) else 1, np.int32)
    ended[b_ends] = 1
    places, common = np.arange(len(a_ends)), ended[a_ends] == 1
    at = np.cumsum(ended, dtype=np.int64)[a_ends] - 1  # B's token that ends there, where the end is common
    before = np.maximum.accumulate(np.where(common, places, -1))
    after = np.minimum.accumulate(np.where(common, places, len(places))[::-1])[::-1]
    lo, hi, start = a_first, np.append(a_first[1:], len(a_ends)), b_first
    done_a, done_b = [], []
    while len(lo):
        middle = (np.where(lo > 0, a_ends[lo - 1], 0) + a_ends[hi - 1]) // 2
        probe = np.clip(np.searchsorted(a_ends, middle), lo, np.maximum(hi - 2, lo))
        left, right = before[probe], after[probe]
        left_in, right_in = (left >= lo) & (left < hi - 1), right < hi - 1
        near_left = left_in & (~right_in | (middle - a_ends[left] <= a_ends[np.minimum(right, len(places) - 1)] - middle))
        whole = ~(left_in | right_in)
        done_a.append(lo[whole])
        done_b.append(start[whole])
        cut = np.where(near_left, left, right)[~whole]
        lo, hi, start = lo[~whole], hi[~whole], start[~whole]
        # both halves side by side: intervals stay in order, which the next bisection likes
        lo, hi, start = np.stack([lo, cut + 1], 1).ravel(), np.stack([cut + 1, hi], 1).ravel(), np.stack([start, at[cut] + 1], 1).ravel()
    a_start = np.concatenate(done_a) if done_a else a_first
    order = np.argsort(a_start)
    return a_start[order], np.concatenate(done_b)[order] if done_b else b_first


def links(a: np.ndarray, b: np.ndarray, a_start: np.ndarray, b_start: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, a * base + b, how often) of the links of all groups; a pair may come again."""
    n_a, n_b = np.diff(np.append(a_start, len(a))), np.diff(np.append(b_start, len(b)))
    wide = n_a * n_b > WIDE
    each = np.where(wide, 0, n_b)
    group = np.repeat(np.arange(len(a_start)), n_a)
    times = each[group]
    first = np.repeat(b_start[group] - (np.cumsum(times) - times), times)
    out = [(np.repeat(group, times), np.repeat(a, times) * base + b[first + np.arange(len(first))], np.ones(len(first), np.int64))]
    for g in np.flatnonzero(wide):
        (x, nx), (y, ny) = (np.unique(t[s[g]:s[g] + n[g]], return_counts=True) for t, s, n in ((a, a_start, n_a), (b, b_start, n_b)))
        codes = np.add.outer(x * base, y).ravel()
        out.append((np.full(len(codes), g), codes, np.multiply.outer(nx, ny).ravel()))
    return tuple(np.concatenate(c) for c in zip(*out))


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, rising, and the sum of the values of each."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1)) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.add.reduceat(values, first) if len(first) else values


class Document:
    """What is known of one document while its parts are aligned."""

    def __init__(self, doc_id, keep: bool) -> None:
        self.doc_id, self.n_a, self.n_b, self.n_groups, self.n_links = doc_id, 0, 0, 0, 0
        self.hash, self.text = hashlib.sha256(), [] if keep else None
        self.codes: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def write(self, data: bytes) -> None:
        data = b";" + data if self.n_groups else data
        self.hash.update(data)
        if self.text is not None:
            self.text.append(data)


class Block:
    """Documents of one partition until about ``limit`` characters are together."""

    def __init__(self, known: Chunks, keep: bool) -> None:
        self.known, self.keep, pair = known, keep, known.pair
        self.docs: list[Document] = []
        self.parts: list[tuple[Document, np.ndarray]] = []
        self.chars = self.waiting = 0
        self.base, self.a_size, self.b_size, self.a_text, self.b_text = len(pair.b_bytes), pair.a_size, pair.b_size, pair.a_text, pair.b_text

    def add(self, doc_id, text: str | None) -> None:
        doc = Document(doc_id, self.keep)
        self.docs.append(doc)
        self.chars += len(text or "") + 200
        if not text:
            return
        chunks = self.known.pair.chunks(text)
        at = self.known.numbers(chunks)
        if at is None:
            return
        length = np.cumsum([len(c) for c in chunks])
        for piece in np.split(at, np.searchsorted(length, np.arange(PART_CHARS, length[-1], PART_CHARS))):
            if len(piece):
                self.parts.append((doc, piece))
                self.waiting += min(len(text), PART_CHARS)
            if self.waiting >= PART_CHARS:
                self.align()

    def align(self) -> None:
        """Groups and links of the waiting parts; a part starts and ends at a cut."""
        if not self.parts:
            return
        docs, pieces = zip(*self.parts)
        self.parts, self.waiting = [], 0
        at, piece_ends = np.concatenate(pieces), np.cumsum([len(p) for p in pieces])
        (a, a_n), (b, b_n) = self.known.a.take(at), self.known.b.take(at)
        a_first, b_first = (np.concatenate([[0], np.cumsum(n)[piece_ends - 1]]) for n in (a_n, b_n))
        a_start, b_start = groups(np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b]), a_first[:-1], b_first[:-1])
        a_group, b_group = (np.repeat(np.arange(len(s)), np.diff(np.append(s, len(t)))) for s, t in ((a_start, a), (b_start, b)))
        a_last, b_last = (np.append(np.diff(g) > 0, True) for g in (a_group, b_group))
        text = np.empty(len(a) + len(b), object)
        text[np.arange(len(a)) + b_start[a_group]] = self.a_text[a + a_last * len(self.a_size)]
        text[np.arange(len(b)) + np.append(a_start[1:], len(a))[b_group]] = self.b_text[b + b_last * self.base]
        of_part = np.searchsorted(a_first, a_start, side="right") - 1
        group, code, times = links(a, b, a_start, b_start, self.base)
        key, times = summed(of_part[group] * (len(self.a_size) * self.base) + code, times)
        part, code = np.divmod(key, len(self.a_size) * self.base)
        key_ends = np.searchsorted(part, np.arange(len(docs) + 1))
        n_groups = np.bincount(of_part, minlength=len(docs))
        for k, doc in enumerate(docs):
            (s, e), (t, f), (x, y) = a_first[k:k + 2], b_first[k:k + 2], key_ends[k:k + 2]
            doc.write(b"".join(text[s + t:e + f].tolist())[:-1])
            doc.n_a, doc.n_b, doc.n_groups = doc.n_a + int(e - s), doc.n_b + int(f - t), doc.n_groups + int(n_groups[k])
            doc.n_links += int(times[x:y].sum())
            doc.codes.append(code[x:y])
            doc.times.append(times[x:y])

    def close(self, key: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Rows of the documents, then rows of the block's id pairs."""
        self.align()
        found = [summed(np.concatenate(d.codes), np.concatenate(d.times)) if d.codes else (np.empty(0, np.int64),) * 2 for d in self.docs]
        code, place, count = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True, return_counts=True)
        ends = np.cumsum([0, *(len(c) for c, _ in found)])
        for start in range(0, len(self.docs), DOC_ROWS):
            yield pa.RecordBatch.from_pylist([{
                "block": key, "doc_id": d.doc_id, "n_a": d.n_a, "n_b": d.n_b, "n_groups": d.n_groups, "n_links": d.n_links,
                "groups_sha256": d.hash.hexdigest() if d.n_groups else "", "groups": None if d.text is None else b"".join(d.text).decode(),
                "places": pack(np.diff(place[ends[k]:ends[k + 1]], prepend=0)), "times": pack(found[k][1]), "pairs": len(code),
            } for k, d in enumerate(self.docs[start:start + DOC_ROWS], start)], schema)
        a, b = np.divmod(code, self.base)
        for start in range(0, len(code), PAIR_ROWS):
            part = slice(start, start + PAIR_ROWS)
            own = {"block": np.full(len(a[part]), key), "a": a[part].astype(np.int32), "b": b[part].astype(np.int32),
                   "place": np.arange(start, start + len(a[part]), dtype=np.int32), "n": count[part].astype(np.int32)}
            yield pa.RecordBatch.from_arrays([pa.array(own[f.name], f.type) if f.name in own else pa.nulls(len(a[part]), f.type) for f in schema], schema=schema)


def _whole(table: pa.Table, column: str) -> np.ndarray:
    return table.column(column).to_numpy()


def aligned_blocks(docs: DataFrame, a_path: str, b_path: str, block_chars: int = 8 << 20, keep_groups: bool = False) -> DataFrame:
    """Documents (``a`` null) and, for each block of them, its id pairs with the number of
    the block's documents that hold them.  Needs one pass over the texts."""
    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                        ("groups_sha256", pa.string()), ("groups", pa.string()), ("places", pa.binary()), ("times", pa.binary()), ("pairs", pa.int64()),
                        *((c, pa.int32()) for c in ("a", "b", "place", "n"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, turn, block = Chunks(Pair(a_path, b_path)), TaskContext.get().partitionId() << 32, None
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block = block or Block(known, keep_groups)
                block.add(doc_id, text.as_py())
                if block.chars >= block_chars:
                    yield from block.close(turn, schema)
                    turn, block = turn + 1, None
                    if len(known.number) > CHUNKS_KEPT:
                        known = Chunks(known.pair)
        if block:
            yield from block.close(turn, schema)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return stored(slim.mapInArrow(run, "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string, "
                                       "places binary, times binary, pairs long, a int, b int, place int, n int"), "aligned-blocks")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """Each block's pairs (block, place, a, b) with ``docs``: how many documents of the whole
    corpus hold the pair linked.  A pair comes once a block, so no pair is a hot key."""
    pairs = blocks.where("a is not null").select("block", "place", "a", "b", "n")
    return stored(pairs.select("block", "place", "a", "b", F.sum("n").over(Window.partitionBy("a", "b")).alias("docs")), "pair-counts")


def align(docs: DataFrame, a_path: str, b_path: str, block_chars: int = 8 << 20, keep_groups: bool = False) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best (links
    whose pair count is the highest of their A id), count_sum (pair counts over links),
    groups_sha256 and, with ``keep_groups``, groups (``a1,a2|b1;a3|b2``; else null).

    A encodes blank + text, B the text, to which it adds the blank.  Null and empty texts,
    and texts that one of the two does not keep byte by byte, have no tokens: zeros and
    empty groups.  Repeated rows count and come out as often as they came in; null ids
    stay; other columns are not read.
    """
    blocks = aligned_blocks(docs, a_path, b_path, block_chars, keep_groups)
    counts = pair_counts(blocks)
    top = counts.groupBy("a").agg(F.max("docs").alias("top"))  # no more rows than A has ids
    known = counts.join(F.broadcast(top), "a").select("block", "place", "docs", (F.col("docs") == F.col("top")).alias("best"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")),
                            ("groups_sha256", pa.string()), ("groups", pa.string())])
        place = _whole(right, "place")
        docs_of, best = np.empty(len(place), np.int64), np.empty(len(place), bool)
        docs_of[place], best[place] = _whole(right, "docs"), _whole(right, "best")
        rows = []
        for r in left.to_pylist():
            if r["pairs"] != len(place):
                raise RuntimeError(f"block {r['block']} has {len(place)} pairs, not {r['pairs']}")
            at, times = np.cumsum(unpack(r["places"]).astype(np.int64)), unpack(r["times"]).astype(np.int64)
            rows.append({k: r[k] for k in schema.names if k in r} | {"n_best": int(times[best[at]].sum()), "count_sum": int((times * docs_of[at]).sum())})
        return pa.Table.from_pylist(rows, schema)

    texts = blocks.where("a is null").drop("a", "b", "place", "n")
    return (texts.groupBy("block").cogroup(known.groupBy("block"))
            .applyInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, groups string"))
