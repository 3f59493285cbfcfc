"""The opN_<name> queries: thin digests of the operators over their whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, html, lattice, lm, packing, pii, rollup, sharding, simhash, toxicity
from .base import shared_dir, stored, table


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


#: Of the conversations' sequences: tokens, conversations and loss-bearing tokens.
CONVERSATIONS = packing.Limits(8192, 9, 6656)


def conversation_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole conversations in sequences under all three limits."""
    sizes = stored(packing.conversation_sizes(table(spark, sf_dir, "conversations")), "sizes")
    return packing.pack_examples(sizes, CONVERSATIONS, "conv_id", "tokens", "loss").withColumnRenamed("key", "conv_id")


def op3_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents arrive in batches with estimated counts and are revised to exact ones; those of one
    batch are withdrawn and come back, those of fewer than 16 tokens go for good; a snapshot is taken on
    the way and batches are replayed before and after it.
    """
    counts = stored(rollup.token_counts(table(spark, sf_dir, "documents")).withColumn("guess", F.ceil(F.col("n_bytes") / 4)).withColumn("b", F.pmod(F.xxhash64("doc_id"), F.lit(4))), "counts")
    ledger = rollup.Ledger(spark, f"{shared_dir(spark)}/benthos-ledger-{uuid.uuid4().hex}")
    for b in range(4):
        part = counts.where(F.col("b") == b)
        ledger.commit(f"insert-{b}", rollup.changes(part, "insert", n="guess"))
        ledger.commit(f"revise-{b}", rollup.changes(part, "revise", n="n_tokens", old="guess"))
    ledger.commit("revise-3", rollup.changes(counts, "delete", old="n_tokens"))
    ledger.compact()
    ledger.commit("insert-0", rollup.changes(counts, "insert", n="guess"))
    ledger.commit("withdraw-2", rollup.changes(counts.where("b = 2"), "delete", old="n_tokens"))
    ledger.commit("return-2", rollup.changes(counts.where("b = 2"), "insert", n="n_tokens"))
    ledger.commit("short", rollup.changes(counts.where("n_tokens < 16"), "delete", old="n_tokens"))
    out = stored(ledger.totals(), "rollup")
    ledger.drop()
    return out


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return lm.score(docs, good)


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


def op9_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = sharding.assign(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_packing": op1_packing,
    "op2_simhash": op2_simhash,
    "op3_rollup": op3_rollup,
    "op4_html": op4_html,
    "op5_toxicity": op5_toxicity,
    "op6_sharding": op6_sharding,
    "op7_pii": op7_pii,
    "op8_lm": op8_lm,
    "op9_lattice": op9_lattice,
    "op10_decontam": op10_decontam,
    "conversation_packing": conversation_packing,
}

ORACLE_SQL: dict[str, str] = {
    "op10_decontam": r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS t
  FROM i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(s) WHERE len(w) > 0
), runs AS (
  SELECT r, s, n, array_to_string(w[s:s + n - 1], ' ') AS t FROM d JOIN (SELECT DISTINCT n FROM win) AS x ON len(w) >= n, unnest(range(1, len(w) - n + 2)) AS u(s)
), hits AS (
  SELECT r, s, n, item_id FROM runs JOIN win USING (n, t)
), cov AS (
  SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT r, s, n FROM hits) AS h, unnest(range(s, s + n)) AS u(p) GROUP BY r
), items AS (
  SELECT r, count(*) AS n_items, sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256 FROM (SELECT DISTINCT r, item_id FROM hits) AS h GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN cov USING (r) LEFT JOIN items USING (r)
""",
    "op9_lattice": """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings
), ok AS (
  SELECT r, e FROM v WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.r AS x, b.r AS y FROM ok a JOIN ok b ON a.r <> b.r AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT r AS x, r AS y FROM v UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x
), comp AS (SELECT reach.x AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.y GROUP BY 1
), n AS (SELECT x AS r, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, CASE WHEN vec_id IS NOT NULL THEN component_id END AS component_id, vec_id = component_id AS kept
FROM v JOIN comp USING (r) LEFT JOIN n USING (r)
""",
}
