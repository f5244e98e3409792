"""Segment, fairness and model-pair slices."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.operators.metrics import LABEL, PRED, binary_rates, confusion_aggs, ratio
from matchlake.operators.quantiles import percentiles


def error_rows(df: DataFrame, label: str = LABEL, pred: str = PRED) -> DataFrame:
    """False positives and false negatives, tagged."""
    return df.filter(F.col(label) != F.col(pred)).withColumn(
        "error_type", F.when(F.col(label) == 0, "false_positive").otherwise("false_negative"))


def segment_by_median(df: DataFrame, col: str, label: str = LABEL, pred: str = PRED) -> DataFrame:
    """Split at the exact median (<= is 'freshers'), metrics per side."""
    med = percentiles(df, col, [0.5]).select(F.col("q")[0]).scalar()
    seg = F.when(F.col(col) <= med, "freshers").otherwise("experienced")
    return binary_rates(df.withColumn("segment", seg), ["segment"], label, pred)


def fairness_gap(df: DataFrame, segment: str, threshold: float = 0.2, label: str = LABEL,
                 pred: str = PRED) -> DataFrame:
    """F1 per segment (no positives and no predicted positives -> 1.0),
    gap = max - min, flagged above ``threshold``."""
    per = df.groupBy(segment).agg(*confusion_aggs(label, pred))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    f1 = F.when((tp + fn == 0) & (tp + fp == 0), F.lit(1.0)).otherwise(ratio(2 * tp, 2 * tp + fp + fn))
    return per.select(f1.alias("f1")).agg(
        (F.max("f1") - F.min("f1")).alias("fairness_gap"),
        ((F.max("f1") - F.min("f1")) > threshold).alias("flagged"),
        F.min("f1").alias("min_f1"), F.max("f1").alias("max_f1"), F.count(F.lit(1)).alias("n_segments"))


def pairwise_disagreement(wide: DataFrame, models: list[str], prefix: str = "y_") -> DataFrame:
    """C7 + D16: share of rows where two models' decisions differ, for every
    pair i < j, from one wide row per item (generated pair expressions, no
    self-join)."""
    pairs = list(combinations(models, 2))
    a = wide.agg(*[F.avg((F.col(prefix + x) != F.col(prefix + y)).cast("double")).alias(f"{x}__{y}")
                   for x, y in pairs])
    rows = F.array(*[F.struct(F.lit(x).alias("model_a"), F.lit(y).alias("model_b"),
                              F.col(f"{x}__{y}").alias("disagreement")) for x, y in pairs])
    return a.select(F.inline(rows))
