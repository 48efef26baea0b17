"""Small helpers that the operators of this package share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the operators' contracts, as a regular-expression class body and as plain characters.
WHITE = r"\x20\x09-\x0D"
WHITE_CHARS = " \t\n\x0b\x0c\r"

#: Rows of an Arrow batch: a batch holds at most this many whole texts, so a task's memory follows the text lengths only.
ARROW_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small; a lower setting of the session stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    given = int(spark.conf.get(name))
    if given <= 0 or given > ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


def staged(df: DataFrame) -> DataFrame:
    """The frame computed once, in the folder that spark.checkpoint.dir names, with its lineage cut.

    In local mode, where none may be set, one beside the warehouse is taken; on a cluster that is an error.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared and not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors reach")
        spark.sparkContext.setCheckpointDir(shared or spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints")
    return df.checkpoint()


def let(value: Column, body) -> Column:
    """body(value) with value computed once a row, also where body uses it inside further lambdas."""
    return F.transform(F.array(value), body)[0]


def broadcast_below(df: DataFrame, most: int) -> DataFrame:
    """A staged frame with a broadcast hint if it has at most so many (narrow) rows; else left to a shuffled join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
