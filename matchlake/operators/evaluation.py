"""Fold metrics, fold summaries, model ranking and comparison tables
(D17, D30-D32, F2, F7, G4, T10, N10, N20, N23)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.operators import curves as CU
from matchlake.operators import metrics as ME

METRIC_COLS = ["accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc"]


def binary_metrics(df: DataFrame, by=()) -> DataFrame:
    """D2 + D4 + D5 per group: the six-metric row of every fold / model."""
    rates = ME.binary_rates(df, by).select(*by, "accuracy", "precision", "recall", "f1")
    areas = CU.rank_areas(df, by)
    if by:
        return rates.join(areas, list(by))
    return rates.select("*", areas.select("roc_auc").scalar().alias("roc_auc"), areas.select("pr_auc").scalar().alias("pr_auc"))


def metrics_of_counts(counts: DataFrame, by) -> DataFrame:
    """The six metrics per group of a table of (group, score, prediction, pos, neg):
    rows are counted once, and all metrics read the counts."""
    y1, y0, p = F.col("pos"), F.col("neg"), F.col("prediction")
    sums = {"tn": F.when(p == 0, y0), "fp": F.when(p == 1, y0), "fn": F.when(p == 0, y1), "tp": F.when(p == 1, y1)}
    rates = counts.groupBy(*by).agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(k) for k, v in sums.items()])
    rates = rates.select(*by, *[v.alias(k) for k, v in ME.rate_columns().items()])
    per_score = counts.groupBy(*by, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    return rates.join(CU.areas_of(per_score, by), list(by))


def fold_summary(folds: DataFrame, by=("model", "k")) -> DataFrame:
    """mean/std accuracy; mean/std/var/max/min AUC; mean F1, precision,
    recall, PR-AUC (sample statistics)."""
    return folds.groupBy(*by).agg(
        F.avg("accuracy").alias("mean_accuracy"), F.stddev_samp("accuracy").alias("std_accuracy"),
        F.avg("roc_auc").alias("mean_auc"), F.stddev_samp("roc_auc").alias("std_auc"),
        F.var_samp("roc_auc").alias("var_auc"), F.max("roc_auc").alias("max_auc"), F.min("roc_auc").alias("min_auc"),
        F.avg("f1").alias("mean_f1"), F.avg("precision").alias("mean_precision"),
        F.avg("recall").alias("mean_recall"), F.avg("pr_auc").alias("mean_pr_auc"))


def rank_models(summary: DataFrame, k: int = 10) -> DataFrame:
    """at the given k, highest mean AUC then lowest variance, first row."""
    return (summary.filter(F.col("k") == k)
                   .orderBy(F.col("mean_auc").desc(), F.col("var_auc").asc(), F.col("model")).limit(1))


def generalization_report(summary: DataFrame, k: int = 10) -> DataFrame:
    """Winner with its mean / variance / best / worst AUC."""
    return rank_models(summary, k).select(
        F.col("model").alias("winner"), F.col("mean_auc"), F.col("var_auc"),
        F.col("max_auc").alias("best_auc"), F.col("min_auc").alias("worst_auc"))


def lift(metrics: DataFrame, base: str, other: str, cols=("accuracy", "roc_auc")) -> DataFrame:
    """Other - base in percentage points, per metric (pivot of two rows)."""
    p = metrics.groupBy().pivot("model", [base, other]).agg(*[F.first(c).alias(c) for c in cols])
    return p.select(*[((F.col(f"{other}_{c}") - F.col(f"{base}_{c}")) * 100).alias(f"lift_{c}_pp") for c in cols])


def generalization_gap(metrics_by_split: DataFrame, cols=("accuracy", "roc_auc")) -> DataFrame:
    """Train minus test per metric."""
    p = metrics_by_split.groupBy().pivot("split", ["train", "test"]).agg(*[F.first(c).alias(c) for c in cols])
    return p.select(*[(F.col(f"train_{c}") - F.col(f"test_{c}")).alias(f"gap_{c}") for c in cols])


def majority_baseline(df: DataFrame, label: str = "label") -> DataFrame:
    """Predict the most frequent class (ties -> smaller label); accuracy
    and macro F1 of that constant prediction."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    mode = counts.agg(F.max_by(label, F.struct(F.col("n"), -F.col(label))).alias("m")).select("m").scalar()
    pred = df.select(F.col(label).alias("label"), mode.cast(df.schema[label].dataType).alias("prediction"))
    rep = ME.classification_report(pred)
    return rep.filter(F.col("class").isin("accuracy", "macro avg")).groupBy().pivot(
        "class", ["accuracy", "macro avg"]).agg(F.first("f1")).select(
        F.col("accuracy").alias("accuracy"), F.col("macro avg").alias("macro_f1"))


def top_confident_errors(df: DataFrame, key: str, k: int = 5, label: str = "label",
                         pred: str = "prediction", prob: str = "probability") -> DataFrame:
    """Wrong predictions with the highest confidence (ties by key)."""
    conf = F.abs(F.col(prob) - 0.5) * 2
    return (df.filter(F.col(label) != F.col(pred)).select(key, label, pred, prob, conf.alias("confidence"))
              .orderBy(F.col("confidence").desc(), F.col(key)).limit(k))
