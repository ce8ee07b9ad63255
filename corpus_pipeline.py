"""The corpus pipeline: documents in, token ids out, in five stages.

Every stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and
returns a DataFrame; ``run`` writes each result as Parquet to the shared scratch folder
and reads it back for the next.  All stages but the last return the columns of
documents.  SQL cannot express a trained network or the tokenizer, so there is no
ORACLE_SQL; tests/llm compares every stage with a plain version of itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookdemand.llm import bpe, mixing, pii, quality, simhash
from bookdemand.llm.base import free_name, remainder_of_crc, stored, table
from bookdemand.llm.queries import tokenizer_path

QUALITY_THRESHOLD = 0.3
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose quality score is at least 0.3; a null text counts as empty."""
    net = quality.fit(docs, table(spark, sf_dir, "labels"), allowed=remainder_of_crc("doc_id", 5) != 0)
    score = free_name("score", docs.columns)
    return quality.score(docs, net, score).where(F.col(score) >= QUALITY_THRESHOLD).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: the smallest doc_id, null ids last."""
    return simhash.one_of_each(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with personal data in ``text`` replaced by its kind; n_chars follows."""
    return pii.redact(docs, pii.learn_contexts(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens meet the target shares of sources, languages and topics."""
    return mixing.sampled(docs)


def encode_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit) and the SHA-256 of the decoded text."""
    done = bpe.encode(docs, tokenizer_path())
    return done.select("doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), "ids",
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", hide_personal_data),
    ("mixture", mix_sources),
    ("tokens", encode_text),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
