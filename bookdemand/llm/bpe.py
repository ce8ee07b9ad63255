"""BPE encoding and decoding through a table of distinct words.

Texts are split in blocks; a block carries each of its words once, documents keep
positions into the block's word list.  Over all blocks a table of distinct words is
made, each word is encoded once, its ids are joined with the id-to-piece table, and
the result is joined back to the blocks, where ids fall into place by position.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, pre_tokenizers

# The tokenizer's own word pattern and special tokens (fixed values of its file).
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Characters on which the `regex` module and the tokenizer agree, and which are
# unchanged by NFC next to each other; other texts take the tokenizer's own steps.
PLAIN_TEXT = r"[\x01-\x1b\x20-˿‐-⁯₠-₿　-鿿가-힣]*"
CHUNK_DOCS = 256
BUNDLE_ROWS = 200_000


class Splitter:
    """Words of a text, normalized as the tokenizer does; special tokens stay whole.

    No word holds white space, so a text is cut there first (``chunks``), and a caller
    that meets a chunk again need not cut it again (``words``)."""

    def __init__(self, tokenizer_path: str) -> None:
        tokenizer = Tokenizer.from_file(tokenizer_path)
        self.specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")") if self.specials else None
        self.plain, self.pattern = re.compile(PLAIN_TEXT), regex.compile(WORD_PATTERN)
        self.slow = pre_tokenizers.Split(Regex(WORD_PATTERN), "removed", invert=True)
        self.normalizer = tokenizer.normalizer

    def chunks(self, text: str) -> list[str]:
        """Parts of the text in order; a part that is a word already starts with a NUL."""
        special = self.special is not None and any(s in text for s in self.specials)
        if not special and self.plain.fullmatch(text):
            return (text if text.isascii() else unicodedata.normalize("NFC", text)).lower().split()
        out = []
        for k, part in enumerate(self.special.split(text) if special else [text]):
            out += ["\0" + part] if k % 2 else ["\0" + w for w, _ in self.slow.pre_tokenize_str(self.normalizer.normalize_str(part))]
        return out

    def words(self, chunk: str) -> list[str]:
        return [chunk[1:]] if chunk[0] == "\0" else self.pattern.findall(chunk)


def word_encoder(tokenizer_path: str) -> Callable[[list[str]], list[list[int]]]:
    """Ids of single words as the splitter gives them."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    whole = Tokenizer.from_file(tokenizer_path)
    specials = {t.content: i for i, t in whole.get_added_tokens_decoder().items()}
    bare = Tokenizer(whole.model)
    bare.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def encode(words: list[str]) -> list[list[int]]:
        found = bare.encode_batch(words, add_special_tokens=False)
        return [[specials[w]] if w in specials else e.ids for w, e in zip(words, found)]

    return encode


def pack(numbers: np.ndarray) -> bytes:
    """Non-negative integers below 2**32, byte planes apart, compressed."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


class Block:
    """Documents of one partition until about ``limit`` characters are together."""

    def __init__(self) -> None:
        self.number: dict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.ids: list = []
        self.places: list[np.ndarray] = []
        self.chars = 0

    def add(self, doc_id, text: str, chunks: list[str]) -> None:
        self.ids.append(doc_id)
        self.places.append(np.fromiter(map(self.number.__getitem__, chunks), np.int32, len(chunks)))
        self.chars += len(text) + 100

    def close(self, where: str, splitter: Splitter) -> tuple[int, list[str]]:
        """Block key; its words by falling frequency.  ``take`` then gives documents' places.

        The key hashes the words too, so that two readings of a partition that do not
        agree cannot be matched with each other unnoticed."""
        number: dict[str, int] = defaultdict()
        number.default_factory = number.__len__
        flat, size = array("i"), array("i")
        for chunk in self.number:
            words = splitter.words(chunk)
            size.append(len(words))
            flat.extend([number[w] for w in words])
        self.size = np.frombuffer(size, np.int32) if size else np.empty(0, np.int32)
        self.first = np.cumsum(self.size, dtype=np.int64) - self.size
        seen = np.zeros(len(self.size), np.int64)
        for start in range(0, len(self.places), CHUNK_DOCS):
            seen += np.bincount(np.concatenate(self.places[start:start + CHUNK_DOCS]), minlength=len(seen))
        flat = np.frombuffer(flat, np.int32) if flat else np.empty(0, np.int32)
        counts = np.bincount(flat, np.repeat(seen, self.size), len(number))
        words = list(number)
        falling = np.argsort(-counts, kind="stable")
        moved = np.empty(len(words), np.int32)
        moved[falling] = np.arange(len(words), dtype=np.int32)
        self.flat = moved[flat]
        ordered = [words[k] for k in falling]
        digest = xxhash.xxh64(where.encode())
        for w in ordered:
            digest.update(b"\n" + w.encode("utf-8", "surrogatepass"))
        return digest.intdigest() - (1 << 63), ordered

    def take(self, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """For the documents from ``start`` to ``end``: words in each, and all their places."""
        part = self.places[start:end]
        chunk = np.concatenate(part)
        ends = np.concatenate([[0], np.cumsum(self.size[chunk])])[np.cumsum([0, *map(len, part)])]
        return np.diff(ends), ragged(self.flat, self.first, self.size, chunk)


def ragged(flat: np.ndarray, first: np.ndarray, size: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The lists numbered ``at`` of ``flat`` (list k: ``size[k]`` items from ``first[k]``), one after another."""
    n = size[at]
    before = np.cumsum(n) - n
    return flat[np.repeat(first[at] - before, n) + np.arange(int(n.sum()))]


def _blocks(batches: Iterator[pa.RecordBatch], path: str, limit: int) -> Iterator[tuple]:
    """(block, key, words) of each block of a partition."""
    splitter = Splitter(path)
    task, turn, block = TaskContext.get().partitionId(), 0, Block()
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            value = text.as_py() or ""
            block.add(doc_id, value, splitter.chunks(value))
            if block.chars >= limit:
                yield block, *block.close(f"{task}:{turn}", splitter)
                turn, block = turn + 1, Block()
    if block.ids:
        yield block, *block.close(f"{task}:{turn}", splitter)


def _whole(column: pa.ChunkedArray, kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays([c.cast(kind) for c in column.chunks]) if column.num_chunks else pa.array([], kind)


def pieces(spark: SparkSession, tokenizer_path: str) -> DataFrame:
    """The id-to-piece table (id, piece): as many rows as the vocabulary file has."""
    vocabulary = Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=True)
    return spark.createDataFrame([(i, p) for p, i in vocabulary.items()], "id int, piece string")


def decode(encoded: DataFrame, spark_pieces: DataFrame, key: str = "word", ids: str = "ids") -> DataFrame:
    """(key, ids, text) of rows (key, ids array<int>), keys distinct: pieces joined by id
    and put in order with a blank between, as the tokenizer, which has no decoder, does.
    Null or empty ids give an empty text; an id that the table lacks is an error."""
    each = encoded.select(key, F.posexplode_outer(ids).alias("at", "id")).join(F.broadcast(spark_pieces), "id", "left")
    checked = F.when(F.col("id").isNotNull() & F.col("piece").isNull(),
                     F.raise_error(F.format_string("no piece for id %d", "id"))).otherwise(F.col("piece"))
    found = each.groupBy(key).agg(F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "id", checked.alias("piece"))))).alias("all"))
    return found.select(key, F.col("all.id").alias("ids"), F.array_join(F.col("all.piece"), " ").alias("text"))


def encode(docs: DataFrame, tokenizer_path: str, block_chars: int = 32 << 20) -> DataFrame:
    """One row for each row of ``docs``: doc_id, ids (binary, little-endian unsigned 32-bit)
    and decoded (the ids' text), as tokenizers' encode(add_special_tokens=False) and
    decode(skip_special_tokens=False) give them for the whole text.

    Null and empty texts have no ids and an empty text.  Repeated rows and null ids come
    out as they came in; other columns are not read.  ``docs`` is read twice and must
    give the same partitions each time, as a table does; if it does not, this raises.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("block", pa.int64()), ("words", pa.int64()), ("ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("data", pa.binary())])
        for block, key, words in _blocks(batches, tokenizer_path, block_chars):
            for start in range(0, len(block.ids), CHUNK_DOCS):
                counts, places = block.take(start, start + CHUNK_DOCS)
                yield pa.RecordBatch.from_pylist([{
                    "block": key, "words": len(words), "ids": block.ids[start:start + CHUNK_DOCS], "counts": counts.tolist(), "data": pack(places)}], schema)

    def words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, key, words in _blocks(batches, tokenizer_path, block_chars):
            for start in range(0, len(words), 20_000):
                part = words[start:start + 20_000]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.string()), pa.array(np.full(len(part), key)), pa.array(np.arange(start, start + len(part), dtype=np.int32))], names=["word", "block", "place"])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = word_encoder(tokenizer_path)
        for batch in batches:
            found = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(run(found), pa.list_(pa.int32()))], names=["word", "ids"])

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What goes to one block, in few rows: places, number of ids, ids and texts, packed."""
        schema = pa.schema([("block", pa.int64()), ("places", pa.binary()), ("sizes", pa.binary()), ("ids", pa.binary()), ("texts", pa.binary())])

        def put(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            some = pa.Table.from_batches(held).sort_by([("block", "ascending"), ("place", "ascending")])
            keys, starts = np.unique(some.column("block").to_numpy(), return_index=True)
            rows = []
            for key, start, end in zip(keys, starts, [*starts[1:], some.num_rows]):
                part = some.slice(start, end - start)
                ids = _whole(part.column("ids"), pa.list_(pa.int32()))
                texts = "\0".join(_whole(part.column("text"), pa.string()).to_pylist())
                rows.append({"block": key, "places": pack(np.diff(part.column("place").to_numpy(), prepend=0)),
                             "sizes": pack(pc.list_value_length(ids).to_numpy(zero_copy_only=False)),
                             "ids": pack(ids.flatten().to_numpy(zero_copy_only=False)),
                             "texts": zstandard.ZstdCompressor(level=3).compress(texts.encode("utf-8", "surrogatepass"))})
            return pa.RecordBatch.from_pylist(rows, schema)

        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= BUNDLE_ROWS:
                yield put(held)
                held, count = [], 0
        if count:
            yield put(held)

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])
        bundles = right.to_pylist()
        place = np.concatenate([np.cumsum(unpack(r["places"]).astype(np.int64)) for r in bundles] or [np.empty(0, np.int64)])
        if left.num_rows == 0 or left.column("words")[0].as_py() != len(place):
            raise RuntimeError("the documents changed between two readings; store them first")
        where = np.empty(len(place), np.int64)
        where[place] = np.arange(len(place))
        size = np.concatenate([unpack(r["sizes"]).astype(np.int64) for r in bundles] or [place])
        flat = np.concatenate([unpack(r["ids"]) for r in bundles] or [np.empty(0, np.uint32)])
        first = np.cumsum(size) - size
        unzip = zstandard.ZstdDecompressor()
        texts = pa.array([t for r in bundles for t in unzip.decompress(r["texts"]).decode("utf-8", "surrogatepass").split("\0")], pa.string())
        out = []
        for row in left.to_pylist():
            at = where[unpack(row["data"]).astype(np.int64)]
            tokens = ragged(flat, first, size, at).astype("<u4")
            ends = np.cumsum([0, *row["counts"]])
            token_ends = np.concatenate([[0], np.cumsum(size[at])])[ends]
            packed = pa.Array.from_buffers(pa.binary(), len(row["ids"]), [None, pa.py_buffer((4 * token_ends).astype(np.int32)), pa.py_buffer(tokens)])
            decoded = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), texts.take(pa.array(at))), " ")
            out.append(pa.RecordBatch.from_arrays([pa.array(row["ids"], pa.int64()), packed, decoded.cast(pa.string())], schema=schema))
        return pa.Table.from_batches(out, schema)

    by_block = slim.mapInArrow(documents, "block long, words long, ids array<long>, counts array<long>, data binary")
    places = slim.mapInArrow(words_of, "word string, block long, place int").where("word is not null").repartition("word")
    # every column goes along, so that both uses of the places share one shuffled copy
    distinct = places.groupBy("word").agg(F.max("block").alias("block"), F.max("place").alias("place"))
    table = decode(distinct.mapInArrow(encoded, "word string, ids array<int>"), pieces(spark, tokenizer_path))
    back = places.join(table.hint("merge"), "word").select("block", "place", "ids", "text").mapInArrow(
        bundled, "block long, places binary, sizes binary, ids binary, texts binary")
    return (by_block.groupBy("block").cogroup(back.groupBy("block"))
            .applyInArrow(assemble, "doc_id long, ids binary, decoded string"))
