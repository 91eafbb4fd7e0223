"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import written

MAX_ROUNDS = 60


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step over (u, v) with u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
    large = (both.join(least, F.col("u") == F.col("k")).where((F.col("v") > F.col("u")) & (F.col("v") > F.col("m")))
             .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
    least = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "k")
    joined = large.join(least, F.col("u") == F.col("k"))
    small = joined.where(F.col("v") > F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return small.unionByName(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b) that is not its component's least node.

    Each round is written to the shared folder, so lineage does not grow and lost executors
    cost one round at most. Rounds grow with the logarithm of a component's longest chain.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    state = None
    for _ in range(MAX_ROUNDS):
        now = written(now if state is None else _stars(now), "stars")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == new or not new[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = new
    raise RuntimeError("components did not settle")
