"""Exact duplicates by content sort: range partitions from sampled splitters, external sort, neighbour comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierweave.llm.common import WHITE, staged

#: A group of equal texts beyond MIN_HOT rows and 1 / HOT_GROUPS of all rows is split; so at most HOT_GROUPS are.
MIN_HOT = 256
HOT_GROUPS = 50_000
#: Leading characters of the sort key. Only these and a hash are sampled for splitters, however long the texts are.
PREFIX_CHARS = 32


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{WHITE}]+", " ")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_hot: int = MIN_HOT) -> DataFrame:
    """Per row of docs: doc_id, keep_id, group_size, kept, text_sha256.

    Rows are range-partitioned by the first characters of the normalised text and a hash of all of it (equal
    texts share both, so they share a range), sorted by the whole text, and runs of equal neighbours keep the
    smallest id. Ranges are cut at sampled splitters of bounded size. A group of more than a small share of all
    rows gets salted keys, is reduced to one representative per salt, and the representatives are sorted again.

    Null text counts as empty; a null id sorts last, so keep_id is null only if all ids of the group are.
    Of rows that share text and id exactly one is kept. An empty table gives an empty result. Other columns of
    docs are never read.
    """
    rows = docs.select(F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("body"))
    rows = rows.withColumn("hash", F.xxhash64("body"))
    most = max(min_hot, docs.count() // HOT_GROUPS)
    # At most HOT_GROUPS rows of 16 bytes pass this filter: their sizes add up to no more than all rows.
    hot = rows.groupBy("hash").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > most)
    salts = F.ceil(F.col("rows") / most).cast("long")
    keyed = (
        rows.join(F.broadcast(hot), "hash", "left")
        .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id"), salts), F.lit(-1)))
        .withColumn("prefix", F.substring("body", 1, PREFIX_CHARS))
        .drop("rows")
    )
    runs = _runs(keyed.repartitionByRange("prefix", "hash", "salt"), "prefix", "hash", "salt")
    hot_rows = (F.col("salt") >= 0) & (F.col("place") == 1)
    local = staged(
        runs.select(
            "id", "hash", "salt", "keep", "size", "place",
            F.sha2("body", 256).alias("sha"),
            F.when(hot_rows, F.col("body")).alias("body"),
        )
    )
    cold = local.where("salt < 0").select("id", "keep", F.col("size").alias("total"), (F.col("place") == 1).alias("kept"), "sha")
    heads = local.where(hot_rows).withColumn("prefix", F.substring("body", 1, PREFIX_CHARS))
    over = Window.partitionBy("prefix", "hash", "body").orderBy(F.col("keep").asc_nulls_last(), "salt")
    whole = over.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.repartitionByRange("prefix", "hash").select(
        "hash", "salt", "sha",
        F.first("keep").over(whole).alias("first"),
        F.sum("size").over(whole).alias("total"),
        (F.row_number().over(over) == 1).alias("leads"),
    )
    split = local.where("salt >= 0").drop("body").join(heads, ["hash", "salt", "sha"])
    split = split.select("id", F.col("first").alias("keep"), "total", (F.col("leads") & (F.col("place") == 1)).alias("kept"), "sha")
    return cold.unionByName(split).select(
        F.col("id").alias("doc_id"),
        F.col("keep").alias("keep_id"),
        F.col("total").cast("long").alias("group_size"),
        "kept",
        F.col("sha").alias("text_sha256"),
    )


def _runs(ranges: DataFrame, *keys: str) -> DataFrame:
    """Neighbours with equal keys and equal whole body form a run; adds its first id, its size and the place in it."""
    run = Window.partitionBy(*keys, "body").orderBy(F.col("id").asc_nulls_last())
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return ranges.select(
        "*",
        F.first("id").over(whole).alias("keep"),
        F.count(F.lit(1)).over(whole).alias("size"),
        F.row_number().over(run).alias("place"),
    )


#: The same rows in DuckDB.
SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body FROM documents
), g AS (
  SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY body
)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.body) AS text_sha256
FROM n JOIN g ON n.body = g.body
"""
