"""The registered queries of this package: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bookdemand.llm import alignment, bpe, html_crf, merkle, mixing, near_embed, pii, quality, secrets, simhash, topk, toxicity, warc
from bookdemand.llm.base import remainder_of_crc, stored, table
from bookdemand.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    captures = warc.assemble(warc.read_archives(spark, path, keep_payload=False).drop("payload", "http_head"))
    flat = stored(captures.select(
        "record_id", "copies", F.col("metadata.fields")["page_id"].cast("long").alias("page_id"),
        F.coalesce("response.payload_bytes", F.col("response.fields")["content-length"].cast("long")).alias("payload_bytes"),
        F.coalesce("response.payload_sha1", F.substring_index("response.header_digest", ":", -1)).alias("payload_digest"),
        F.col("response.warc_type").alias("record_type"), F.col("response.refers_to").alias("answer_id")), "captures")
    answers = flat.where("record_type = 'response'").select(F.col("record_id").alias("answer_id"), F.col("page_id").alias("refers_to"))
    each = flat.join(answers, "answer_id", "left").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE_SQL["op1_warc"] = """
WITH rows AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), roles AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM rows
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM roles"""


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = bpe.encode(table(spark, sf_dir, "documents"), tokenizer_path())
    return done.select("doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    net = quality.fit(docs, labels, allowed=remainder_of_crc("doc_id", 5) != 0)
    held_out = remainder_of_crc("doc_id", 5) == 0
    return quality.score(docs.select("doc_id", "text"), net).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.learn_contexts(docs))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base_spans", 256).alias("base_sha256"), "spans")


@query
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("draw")


@query
def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_embed.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE_SQL["op7_embedding_dedup"] = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.vec_id, l.b FROM reach r JOIN links l ON r.other = l.a
), smallest AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT s.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, s.component_id, s.vec_id = s.component_id AS kept
FROM smallest s LEFT JOIN degree d ON s.vec_id = d.a"""


@query
def op8_html_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_crf.extract(table(spark, sf_dir, "pages"), html_crf.default_field())


@query
def op9_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = topk.as_integers(table(spark, sf_dir, "embeddings"))
    return topk.top_k(rows.where("vec_id % 50 = 0"), rows)


ORACLE_SQL["op9_maxscore"] = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_inner_product(q.v, r.v)::BIGINT AS score
  FROM rows q JOIN rows r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    grammar = toxicity.fit(docs, labels, allowed=remainder_of_crc("doc_id", 3) != 1)
    held_out = remainder_of_crc("doc_id", 3) == 1
    return toxicity.score(docs.select("doc_id", "text"), grammar).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.align(table(spark, sf_dir, "documents"), a, b).drop("groups")


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.col("doc_id").isNotNull() & (remainder_of_crc("doc_id", 2) == 0)
    shown = F.when(tampered, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    manifest = merkle.document_manifest(docs, shown)
    found = merkle.proofs(manifest, manifest.leaves)
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.path_text(F.col("path")), 256).alias("proof_sha256"),
                        merkle.folded(F.col("shown"), F.col("path")).alias("folded_root")).withColumn(
                            "verified", F.col("folded_root") == F.col("root"))


def _merkle_levels(prefix: str, nodes: str, leaves: str, levels: int) -> str:
    """CTEs that hash ``nodes`` (tree, idx, n, digest) level by level and fold ``leaves``
    (key, tree, idx, cur, proof) along; the last are {prefix}n{levels} and {prefix}w{levels}."""
    out, n, w = [], nodes, leaves
    for k in range(1, levels + 1):
        out.append(f"""{prefix}n{k} AS MATERIALIZED (
  SELECT tree, idx // 3 AS idx, (max(n) + 2) // 3 AS n, CASE WHEN max(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY idx)) ELSE min(digest) END AS digest
  FROM {n} GROUP BY tree, idx // 3
), {prefix}w{k} AS MATERIALIZED (
  SELECT w.key, w.tree, w.idx // 3 AS idx,
         CASE WHEN max(s.n) > 1 THEN sha256(coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx < w.idx), '') || w.cur
              || coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx > w.idx), '')) ELSE w.cur END AS cur,
         w.proof || coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx <> w.idx), '') AS proof
  FROM {w} w JOIN {n} s ON w.tree = s.tree AND w.idx // 3 = s.idx // 3 GROUP BY w.key, w.tree, w.idx, w.cur, w.proof
)""")
        n, w = f"{prefix}n{k}", f"{prefix}w{k}"
    return ",\n".join(out)


_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)))"""


def _leaf_sql(text: str) -> str:
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values) + ")"


# levels for up to 3^14 documents of a source and 3^9 sources
ORACLE_SQL["op12_merkle"] = f"""
WITH leaves AS MATERIALIZED (
  SELECT doc_id, coalesce('=' || source, '') AS tree, {_leaf_sql("text")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {_CRC32} % 2 = 0 THEN {_leaf_sql("replace(text, chr(10), '')")} ELSE {_leaf_sql("text")} END AS shown
  FROM documents
), l0 AS MATERIALIZED (
  SELECT row_number() OVER () AS key, *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM leaves
), sn0 AS (SELECT tree, idx, n, leaf AS digest FROM l0), sw0 AS (SELECT key, tree, idx, shown AS cur, '' AS proof FROM l0),
{_merkle_levels("s", "sn0", "sw0", 14)}, t0 AS MATERIALIZED (
  SELECT tree AS source_tree, '' AS tree, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n, digest FROM sn14
), tw0 AS (SELECT w.key, t.tree, t.idx, w.cur, w.proof FROM sw14 w JOIN t0 t ON w.tree = t.source_tree),
{_merkle_levels("t", "t0", "tw0", 9)}
SELECT l.doc_id, l.leaf, t0.digest AS subroot, r.digest AS root, sha256(w.proof) AS proof_sha256, w.cur AS folded_root, w.cur = r.digest AS verified
FROM l0 l JOIN t0 ON l.tree = t0.source_tree JOIN tw9 w USING (key) CROSS JOIN tn9 r"""


@query
def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base_spans", 256).alias("base_sha256"), "spans", "n_confirmed")
