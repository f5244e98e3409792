"""Parquet table scans of the test-data layout (``{sf_dir}/{name}.parquet``).

Reads are lazy; Catalyst prunes columns and pushes filters into the scan, so
callers simply select what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose every table as a temp view (for ``spark.sql`` users)."""
    for n in names:
        table(spark, sf_dir, n).createOrReplaceTempView(n)
