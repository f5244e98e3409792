"""File sources and sinks (A1, A3, A4, A5).

Writes go to caller-given paths (on a cluster: the shared storage); reads use
an explicit schema so no inference pass runs over the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A1: header CSV with a declared schema."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A3: table sink as header CSV (no index column), overwrite."""
    df.write.mode("overwrite").option("header", True).csv(path)


def stamp(df: DataFrame, run: dict) -> DataFrame:
    """A4: run metadata (dataset, sizes, version ...) as constant columns plus
    a UTC timestamp."""
    cols = [F.lit(v).alias(k) for k, v in run.items()]
    ts = F.lit(dt.datetime.now(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")).alias("generated_at")
    return df.select("*", *cols, ts)


def write_report(reports: dict[str, DataFrame], base: str, run: dict) -> None:
    """A4: several named metric tables, each stamped, written as JSON."""
    for name, df in reports.items():
        stamp(df, run).write.mode("overwrite").json(f"{base.rstrip('/')}/{name}")


def write_vectors(df: DataFrame, path: str) -> None:
    """A5: embedding sink, Parquet with ``array<float>`` columns."""
    df.write.mode("overwrite").parquet(path)
