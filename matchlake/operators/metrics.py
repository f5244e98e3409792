"""Binary-classification metrics as single-pass aggregates.

Every function takes ``(label, prediction[, probability])`` columns plus
optional group columns ``by`` (fold, model, segment ...), so each metric is
available per group for free and is computed with partial (map-side)
aggregation: one shuffle of at most (#groups x #partitions) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LABEL, PRED, PROB = "label", "prediction", "probability"


def ratio(num: Column, den: Column) -> Column:
    """num / den as double, 0 when the denominator is 0 (zero_division=0)."""
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def confusion_aggs(label: str = LABEL, pred: str = PRED) -> list[Column]:
    y, p = F.col(label), F.col(pred)
    return [F.count_if((y == 0) & (p == 0)).alias("tn"),
            F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 1) & (p == 0)).alias("fn"),
            F.count_if((y == 1) & (p == 1)).alias("tp")]


def confusion(df: DataFrame, by=(), label: str = LABEL, pred: str = PRED) -> DataFrame:
    """Tn / fp / fn / tp."""
    return df.groupBy(*by).agg(*confusion_aggs(label, pred))


def rate_columns(tn="tn", fp="fp", fn="fn", tp="tp") -> dict[str, Column]:
    """D2 from confusion counts; zero denominators give 0."""
    tn, fp, fn, tp = F.col(tn), F.col(fp), F.col(fn), F.col(tp)
    return {"accuracy": ratio(tp + tn, tp + tn + fp + fn),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1": ratio(2 * tp, 2 * tp + fp + fn)}


def binary_rates(df: DataFrame, by=(), label: str = LABEL, pred: str = PRED) -> DataFrame:
    """Accuracy, precision, recall, F1 (+ the counts)."""
    rc = rate_columns()
    return confusion(df, by, label, pred).select("*", *[v.alias(k) for k, v in rc.items()])


def brier(df: DataFrame, by=(), label: str = LABEL, prob: str = PROB) -> DataFrame:
    """Mean squared error of the probability."""
    return df.groupBy(*by).agg(
        F.avg(F.pow(F.col(prob) - F.col(label), 2)).alias("brier_score"))


def expected_cost(df: DataFrame, by=(), cost_fp: float = 500.0, cost_fn: float = 2000.0,
                  label: str = LABEL, pred: str = PRED) -> DataFrame:
    """Fp * cost_fp + fn * cost_fn (weights are parameters)."""
    c = confusion(df, by, label, pred)
    return c.select("*", (F.col("fp") * F.lit(float(cost_fp))
                          + F.col("fn") * F.lit(float(cost_fn))).alias("expected_cost"))


def classification_report(df: DataFrame, by=(), label: str = LABEL, pred: str = PRED) -> DataFrame:
    """D3: per-class precision / recall / F1 / support, accuracy, macro and
    weighted averages, from one confusion aggregate (unpivoted, no rescan)."""
    c = confusion(df, by, label, pred)
    tn, fp, fn, tp = (F.col(x) for x in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    cls = {
        "0": (ratio(tn, tn + fn), ratio(tn, tn + fp), tn + fp),
        "1": (ratio(tp, tp + fp), ratio(tp, tp + fn), fn + tp),
    }
    f1 = {k: F.when((p + r) == 0, F.lit(0.0)).otherwise(2 * p * r / (p + r))
          for k, (p, r, _) in cls.items()}
    rows = []
    for k, (p, r, s) in cls.items():
        rows.append(F.struct(F.lit(k).alias("class"), p.alias("precision"), r.alias("recall"),
                             f1[k].alias("f1"), s.cast("double").alias("support")))
    acc = ratio(tp + tn, n)
    rows.append(F.struct(F.lit("accuracy").alias("class"), acc.alias("precision"),
                         acc.alias("recall"), acc.alias("f1"), n.cast("double").alias("support")))
    rows.append(F.struct(
        F.lit("macro avg").alias("class"),
        ((cls["0"][0] + cls["1"][0]) / 2).alias("precision"),
        ((cls["0"][1] + cls["1"][1]) / 2).alias("recall"),
        ((f1["0"] + f1["1"]) / 2).alias("f1"), n.cast("double").alias("support")))
    s0, s1 = cls["0"][2].cast("double"), cls["1"][2].cast("double")
    wavg = lambda a, b: ratio(a * s0 + b * s1, n)
    rows.append(F.struct(
        F.lit("weighted avg").alias("class"),
        wavg(cls["0"][0], cls["1"][0]).alias("precision"),
        wavg(cls["0"][1], cls["1"][1]).alias("recall"),
        wavg(f1["0"], f1["1"]).alias("f1"), n.cast("double").alias("support")))
    return c.select(*by, F.inline(F.array(*rows)))


def batch_summary(df: DataFrame, by=(), pred: str = PRED) -> DataFrame:
    """Batch size and positive count."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("batch_size"),
                               F.coalesce(F.sum(pred), F.lit(0)).cast("long").alias("positives"))


def quality_gates(metrics: DataFrame, auc_min: float = 0.75, acc_min: float = 0.65) -> DataFrame:
    """Boolean gates on a metric row."""
    return metrics.select("*", (F.col("roc_auc") > auc_min).alias("auc_gate"),
                          (F.col("accuracy") > acc_min).alias("accuracy_gate")).select(
        "*", (F.col("auc_gate") & F.col("accuracy_gate")).alias("all_passed"))
