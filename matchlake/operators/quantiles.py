"""Exact interpolated percentiles without a one-task value map.

Values are counted (map-side combined) and ranked inside value buckets only; a
table with a row per bucket carries the counts below. So a group with a third
of all rows, or a column with a value per row, is ranked by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from matchlake.operators.curves import score_bucket


def percentiles(df: DataFrame, col: str, qs: list[float], by=()) -> DataFrame:
    """A row per group: ``by`` and ``q``, the array of the percentiles ``qs`` of
    its non-null values, linearly interpolated; a group without values has nulls
    there. Without ``by`` there is always one row."""
    x = F.col(col).cast("double")
    counts = (df.groupBy(*by, x.alias("_x")).agg(F.count(x).alias("_c"))
              .withColumn("_bucket", score_bucket(F.col("_x"))))
    group = Window.partitionBy(*by)  # over the bucket table only
    below = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.groupBy(*by, "_bucket").agg(F.sum("_c").alias("_in")).select(
        *[F.col(k).alias(f"_by_{i}") for i, k in enumerate(by)], F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_in").over(below), F.lit(0)).alias("_below"), F.sum("_in").over(group).alias("_n"))
    same = F.col("_bucket") == F.col("_b")
    for i, k in enumerate(by):
        same = same & F.col(k).eqNullSafe(F.col(f"_by_{i}"))
    inside = Window.partitionBy(*by, "_bucket").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.join(buckets, same).select(
        *by, "_x", "_n", (F.col("_below") + F.sum("_c").over(inside)).alias("_upto"))
    found, out = [], []
    for i, q in enumerate(qs):
        at = F.lit(float(q)) * (F.col("_n") - 1)
        found += [F.min(F.when(F.col("_upto") > F.floor(at), F.col("_x"))).alias(f"_lo{i}"),
                  F.min(F.when(F.col("_upto") > F.ceil(at), F.col("_x"))).alias(f"_hi{i}")]
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append(F.when(lo == hi, lo).otherwise((F.ceil(at) - at) * lo + (at - F.floor(at)) * hi))
    return ranked.groupBy(*by).agg(F.max("_n").alias("_n"), *found).select(*by, F.array(*out).alias("q"))


def medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """(name, q): the exact median of each column, in one pass over the rows."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("x"))
                                         for c in cols])).alias("v")).select("v.*")
    return percentiles(long, "x", [0.5], ["name"])
