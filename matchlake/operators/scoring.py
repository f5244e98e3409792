"""Fixed-coefficient linear scorer (N15), batch scoring (N16) and decisions.

The stored-weights scorer is a sigmoid of a dot product written as column
arithmetic: it needs no model object, runs inside codegen, and makes every
downstream metric value-checkable against SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions.features import gap_columns
from matchlake.functions.numeric import round_half_away
from matchlake.functions.rules import confidence, decide

# The default stored weights (intercept + one weight per model feature).
DEFAULT_WEIGHTS = {
    "intercept": -1.2,
    "diff_experience": 0.8,
    "diff_python": 0.02,
    "diff_ml": 0.02,
    "diff_sql": 0.02,
    "diff_stats": 0.02,
    "diff_js": 0.02,
    "diff_ds": 0.02,
}
PROB_DECIMALS = 6


def linear_margin(cols: dict[str, Column], weights: dict) -> Column:
    z = F.lit(float(weights.get("intercept", 0.0)))
    for name, w in weights.items():
        if name != "intercept":
            z = z + F.lit(float(w)) * cols[name]
    return z


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def score_linear(df: DataFrame, weights: dict | None = None, threshold: float = 0.5,
                 keep: list[str] | None = None, decimals: int = PROB_DECIMALS) -> DataFrame:
    """N15 + B17 + B18: probability (rounded, bounding the number of distinct
    scores), decision at ``threshold`` and confidence, from raw rows."""
    w = weights or DEFAULT_WEIGHTS
    cols = gap_columns(df)
    prob = round_half_away(sigmoid(linear_margin(cols, w)), decimals)
    out = df.select(*(keep or df.columns), prob.alias("probability"))
    return out.select("*", decide(F.col("probability"), threshold).alias("prediction"),
                      F.lit(float(threshold)).alias("threshold"))


def scored_applications(modelling: DataFrame, weights: dict | None = None,
                        threshold: float = 0.5) -> DataFrame:
    """label / prediction / probability per application, the common input of
    every metric operator."""
    s = score_linear(modelling, weights, threshold,
                     keep=["application_id", "is_good_match", "education_level",
                           "years_experience"])
    return s.withColumnRenamed("is_good_match", "label")


def score_model(df: DataFrame, model, threshold: float = 0.5, prob_col: str = "probability",
                keep: list[str] | None = None) -> DataFrame:
    """Score with a fitted MLlib ``PipelineModel``; positive-class
    probability, decision at ``threshold``, confidence (B18)."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(df)
    p = vector_to_array(F.col(prob_col))[1]
    base = [c for c in (keep or df.columns)]
    return out.select(*base, p.alias("probability")).select(
        "*", decide(F.col("probability"), threshold).alias("prediction"),
        F.lit(float(threshold)).alias("threshold"),
        confidence(F.col("probability")).alias("confidence"))
