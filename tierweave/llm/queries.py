"""The registered queries op1 to op13: each applies its operator to a whole table and derives the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierweave.llm import byte_pairs, exact_dedup, html_text, language_id, merkle, outliers, packing, secrets, segmentation, simhash, token_counts, toxicity, whitening
from tierweave.llm.common import table


def op1_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outliers.robust_outliers(table(spark, sf_dir, "documents"))


def op2_gumbel_segmentations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sample with its pieces, their digest, the text they decode to, and whether that is the document's."""
    return segmentation.sample_segmentations(table(spark, sf_dir, "documents"), with_digests=True, with_texts=True)


def op3_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op4_rank_order_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    known = language_id.profiles(docs.where(~language_id.held_out(F.col("doc_id"))))
    return language_id.identify(docs, known).select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_content_sort_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op7_block_tree_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op8_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        F.sha2(secrets.spelled(F.col("base")), 256).alias("base_sha256"),
        secrets.spelled(F.col("spans")).alias("spans"),
        "n_live", "n_copied",
    )


def op9_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op10_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, toxicity.severity_labels(table(spark, sf_dir, "labels")))
    return toxicity.score_toxicity(docs, model)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.document_proofs(table(spark, sf_dir, "documents"))


def op12_linked_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_pairs.digests(byte_pairs.encode_texts(table(spark, sf_dir, "documents")))


def op13_shifted_choleskyqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_robust_outliers, op2_gumbel_segmentations, op3_vector_packing, op4_rank_order_profiles, op5_golay_simhash, op6_content_sort_dedup, op7_block_tree_text, op8_secret_ownership, op9_token_lengths, op10_ordinal_toxicity, op11_merkle_manifest, op12_linked_byte_pairs, op13_shifted_choleskyqr)}

ORACLE = {"op6_content_sort_dedup": exact_dedup.SQL, "op8_secret_ownership": secrets.sql(), "op11_merkle_manifest": merkle.SQL}
