"""Supervised models on MLlib, plus the closed-form ones.

The gap features live inside the saved ``PipelineModel`` through a small
``GapTransformer`` (J4), so a stored pipeline scores raw modelling rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC,
                                       LogisticRegression, RandomForestClassifier)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions.features import MODEL_FEATURES, gap_columns
from matchlake.operators.small import num, one_row


class GapTransformer(Transformer, HasOutputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Appends the engineered gap features (default: the 7 model features)."""

    @keyword_only
    def __init__(self, outputCols=None):
        super().__init__()
        self._setDefault(outputCols=list(MODEL_FEATURES))
        kwargs = self._input_kwargs
        self._set(**kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = gap_columns(df)
        return df.select("*", *[cols[c].alias(c) for c in self.getOutputCols()])


ESTIMATORS = {
    "logistic": lambda: LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight",
                                           standardization=False, elasticNetParam=0.0, maxIter=100),
    "random_forest": lambda: RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=100,
                                                    maxDepth=8, seed=42),
    "decision_tree": lambda: DecisionTreeClassifier(featuresCol="features", labelCol="label", maxDepth=6,
                                                    minInstancesPerNode=10, seed=42),
    "linear_svc": lambda: LinearSVC(featuresCol="features", labelCol="label", weightCol="weight", maxIter=100),
}


def balanced_weight(df: DataFrame, label: str = "label") -> tuple[Column, float]:
    """M6 weights (n / (2 n_c)) as literals from one small aggregate, and the
    sum of weights (= n)."""
    r = one_row(df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos")))
    n, pos = r["n"], r["pos"] or 0
    w1 = n / (2.0 * pos) if pos else 0.0
    w0 = n / (2.0 * (n - pos)) if n - pos else 0.0
    return F.when(F.col(label) == 1, num(w1)).otherwise(num(w0)), float(n)


def with_balanced_weight(df: DataFrame, label: str = "label") -> tuple[DataFrame, float]:
    """The frame with its ``balanced_weight``, and the sum of weights."""
    weight, n = balanced_weight(df, label)
    return df.withColumn("weight", weight), n


def estimator(kind: str, n_weighted: float | None = None, **params):
    """The estimator of a kind, for scaled ``features``, ``label`` and ``weight``."""
    est = ESTIMATORS[kind]()
    if kind in ("logistic", "linear_svc") and n_weighted:
        est = est.setRegParam(1.0 / n_weighted)  # S10: unaveraged C=1 penalty
    for k, v in params.items():
        est.set(est.getParam(k), v)
    return est


def _scaler() -> StandardScaler:
    return StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)


def pipeline(kind: str, n_weighted: float | None = None, features=MODEL_FEATURES, gaps: bool = True, **params) -> Pipeline:
    """GapTransformer -> VectorAssembler -> StandardScaler -> estimator. Without ``gaps``
    the rows have been through the GapTransformer."""
    return Pipeline(stages=([GapTransformer(outputCols=list(features))] if gaps else []) + [
        VectorAssembler(inputCols=list(features), outputCol="raw_features"), _scaler(), estimator(kind, n_weighted, **params)])


def assembled(df: DataFrame, keep: list[str], features=MODEL_FEATURES, label: str = "label") -> DataFrame:
    """``keep``, the label and the vector of the gap features: all that a search reads."""
    gaps = GapTransformer(outputCols=list(features)).transform(df)
    x = VectorAssembler(inputCols=list(features), outputCol="raw_features").transform(gaps)
    return x.select(*keep, F.col(label).alias("label"), "raw_features")


@dataclass
class FoldFrames:
    """The rows of a fold, weighted and scaled by its training side, ready for any estimator."""

    both: DataFrame  # is_val: held out
    n: float  # sum of the training weights
    scaler: object = None  # fitted on the training side

    @property
    def val(self) -> DataFrame:
        return self.both.filter("is_val").select("label", "features")

    def fit(self, kind: str, **params):
        return estimator(kind, self.n, **params).fit(self.both.filter("not is_val"))


def fold_frames(x: DataFrame, held: Column) -> FoldFrames:
    """Of ``assembled`` rows: those that are ``held`` out, and the others to train on."""
    train = x.filter(~held)
    weight, n = balanced_weight(train)
    scaler = _scaler().fit(train)
    rows = scaler.transform(x)
    return FoldFrames(rows.select("label", weight.alias("weight"), "features", held.alias("is_val")), n, scaler)


def fit(df: DataFrame, kind: str, label: str = "label", **params) -> PipelineModel:
    w, n = with_balanced_weight(df, label)
    return pipeline(kind, n, **params).fit(w)


def positive_probability(df: DataFrame, model, raw_for_svc: bool = False) -> DataFrame:
    """Scores with a fitted pipeline; ``probability`` = P(class 1). LinearSVC
    has no probability: its margin goes through a logistic squash."""
    out = model.transform(df)
    if "probability" in out.columns and not raw_for_svc:
        return out.withColumn("probability", vector_to_array("probability")[1])
    m = vector_to_array("rawPrediction")[1]
    return out.withColumn("probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-m)))


def feature_importance(model, features=MODEL_FEATURES):
    """Tree importances or absolute coefficients of a pipeline or of a
    ``levelled.Forest``, normalised to sum 1."""
    est = model.stages[-1] if hasattr(model, "stages") else model
    if hasattr(est, "featureImportances"):
        vals = list(est.featureImportances.toArray())
    elif hasattr(est, "importances"):
        vals = list(est.importances(len(features)))
    else:
        vals = [abs(v) for v in est.coefficients.toArray()]
    tot = sum(vals) or 1.0
    return [(f, float(v / tot)) for f, v in zip(features, vals)]


def save(model: PipelineModel, path: str) -> None:
    """Persist a fitted pipeline (overwrite)."""
    model.write().overwrite().save(path)


def save_metadata(spark, path: str, name: str, version: str, model: PipelineModel, features: list[str], rows: int, metrics: dict,
                  dataset: str, seed: int) -> None:
    """The metadata row of a saved pipeline, as JSON beside it."""
    last = model.stages[-1]
    params = {p.name: str(v) for p, v in last.extractParamMap().items()}
    row = (name, version, dataset, rows, features, " -> ".join(type(s).__name__ for s in model.stages),
           dict(sorted(params.items())), {k: float(v) for k, v in metrics.items()}, spark.version, seed)
    spark.createDataFrame([row], METADATA).withColumn("saved_at", F.current_timestamp()).coalesce(1).write.mode(
        "overwrite").json(f"{path}-metadata")


METADATA = ("model_name string, model_version string, dataset_name string, n_training_samples long, "
            "selected_features array<string>, model_type string, hyperparameters map<string,string>, "
            "training_metrics map<string,double>, spark_version string, random_seed int")


def load_metadata(spark, path: str) -> DataFrame:
    return spark.read.schema(METADATA + ", saved_at timestamp").json(f"{path}-metadata")


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def round_trip_check(df: DataFrame, model: PipelineModel, path: str, key: str,
                     tol: float = 1e-6) -> DataFrame:
    """Save, load, re-score; PASS when max |p1 - p2| < tol."""
    save(model, path)
    again = load(path)
    p1 = positive_probability(df, model).select(key, F.col("probability").alias("p1"))
    p2 = positive_probability(df, again).select(key, F.col("probability").alias("p2"))
    d = p1.join(p2, key).agg(F.max(F.abs(F.col("p1") - F.col("p2"))).alias("max_abs_diff"),
                             F.count(F.lit(1)).alias("rows"))
    return d.select("*", F.when(F.col("max_abs_diff") < tol, "PASS").otherwise("FAIL").alias("status"))
