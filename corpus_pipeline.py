"""The corpus pipeline: reject toxic documents, keep one of each near-duplicate group, drop documents
that hold benchmark passages, mask personal data, and pack what is left.

Every stage works on all that its predecessor kept; the first four return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from benthos.llm import decontam, packing, pii, simhash_copies, toxicity
from benthos.llm.base import Stored, keyed, stored, table, text_hash


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on the labelled ones, doesn't reject."""
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group stays, the least doc_id, null last: SimHash finds near copies, five-word similarity of 0.8 decides."""
    key = ["doc_id", "text_hash"]
    found = stored(simhash_copies.near_duplicates(docs), "dedup")
    rows = stored(found.groupBy("group_id", *key).count(), "deduprows")
    kept = stored(rows.groupBy("group_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), *key, "count")).alias("k")).select("k.doc_id", "k.text_hash", "k.count"), "dedupkept")
    k = kept.toDF("_id", "_hash", "_n")
    left = keyed(docs, rows.join(k, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left_anti").select(*key), "left_anti")
    again = kept.where("count > 1").select(*key)
    if again.isEmpty():
        return left
    twice = keyed(left, again, "left_semi").withColumn("__key", text_hash()).dropDuplicates(["doc_id", "__key"]).drop("__key")
    return keyed(left, again, "left_anti").unionByName(twice)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    found = decontam.of_rows(docs, table(spark, sf_dir, "benchmark"))
    return keyed(docs, found.where("contaminated").select("doc_id", "text_hash"), "left_anti")


def mask_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and n_chars following the text."""
    return pii.mask(docs, pii.fit(docs)).withColumn("n_chars", F.length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, with their ids."""
    return packing.pack_documents(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("toxicity", reject_toxic), ("near_dedup", near_dedup), ("decontamination", decontaminate), ("pii", mask_pii), ("packing", pack)]
#: SQL can't express the stages; tests/llm/test_pipeline.py holds each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = Stored(stage(spark, docs, sf_dir), f"stage-{name}").read()
    return docs
