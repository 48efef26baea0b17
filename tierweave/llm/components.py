"""Connected components of a graph given by its edges, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierweave.llm.common import staged


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of an edge: root is the smallest node reachable. Edges are (a, b) of one sortable type.

    Each round hangs neighbours onto smaller ones with two groupings and two joins; the number of rounds grows with the logarithm of a
    component's size. Rounds are checkpointed in the shared folder, so a lost executor costs one round at most. The
    hub of a large component is a skewed join key that adaptive execution splits. Loops and null ends are ignored.
    """
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a) != F.col(b)).distinct()
    now, before = staged(now), None
    while True:
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v")).distinct()
        before = tuple(state)
        now = staged(_small_star(_large_star(now)))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are hung onto its smallest neighbour or itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are hung onto the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    hung = edges.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
