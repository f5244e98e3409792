"""Connected components of an edge table by alternating star contraction.

Each round hangs every node's neighbours below the smallest neighbour (large
star, then small star); the number of rounds grows with the logarithm of the
longest path. Neighbour lists are never gathered: a round is a grouped minimum
and an equi-join, whose hot side adaptive execution can split. Every round is
checkpointed to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.session import cut_lineage


def _shape(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, root) of every node of an edge but the roots themselves, where
    root is the smallest node reachable. Self links, repeated and reversed
    edges and nulls are harmless; no edges give no rows."""
    now = cut_lineage(edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v"))
                      .where("u > v").distinct())
    shape = _shape(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u > v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = (large.join(small, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                .unionByName(small.withColumnRenamed("m", "v")).where("u > v").distinct())
        now, before = cut_lineage(hung), shape
        shape = _shape(now)
        if shape == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
