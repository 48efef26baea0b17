"""The corpus pipeline: language ID, exact dedup, near-dedup, secret masking, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
Rows with a null doc_id go in the first stage, as no decision could be told to them; a null text is undetermined
and goes there too. Rows that share an id share their fate, but of rows with the same id and text one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierweave.llm import exact_dedup, language_id, near_text, packing, secrets
from tierweave.llm.common import small_batches, staged, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of no determined language, or unlike every learned one. Profiles are learned from all labelled rows."""
    small_batches(spark)
    known = language_id.profiles(docs.where(~language_id.held_out(F.col("doc_id"))))
    found = language_id.language(F.col("text"), known)
    judged = docs.where("doc_id IS NOT NULL").withColumn("_found", found)
    stays = (F.col("_found.lang_pred") != language_id.UNDETERMINED) & (F.col("_found.score") >= language_id.LEAST_SIMILARITY)
    return judged.where(stays).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal normalised texts the document with the smallest id stays."""
    keys = ["doc_id", "_sha"]
    kept = exact_dedup.exact_dedup(docs).where("kept").select("doc_id", F.col("text_sha256").alias("_sha"))
    marked = docs.withColumn("_sha", F.sha2(exact_dedup.normalised(F.col("text")), 256))
    return marked.join(kept, keys, "left_semi").dropDuplicates(keys).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts linked by a five-word Jaccard similarity of 0.8 or more the document with the smallest id stays."""
    kept = near_text.near_copies(docs).where("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks each secret whose value is not a widely copied example; n_chars follows the text. No document goes."""
    found = secrets.scan_secrets(docs).where(F.size("own_spans") > 0)
    found = found.select("doc_id", F.col("text_hash").alias("_hash"), F.col("own_spans").alias("_spans")).dropDuplicates(["doc_id", "_hash"])
    joined = docs.withColumn("_hash", F.xxhash64("text")).join(found, ["doc_id", "_hash"], "left")
    text = F.when(F.col("_spans").isNotNull(), secrets.masked(F.col("text"), F.col("_spans"))).otherwise(F.col("text"))
    masked = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.when(F.col("_spans").isNotNull(), F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return masked.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, placed in sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]

#: Profiles, fingerprints and token ids have no SQL form; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; what lies between two stages is staged in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if (name, stage) != STAGES[-1]:
            docs = staged(docs)
    return docs
