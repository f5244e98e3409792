"""Percentiles, grid means and fold scores against plain computations."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.operators import explain as EX
from matchlake.operators import margins as MA
from matchlake.operators import models as MO
from matchlake.operators import sampling as SA
from matchlake.operators import tuning as TU
from matchlake.operators.curves import roc_auc
from matchlake.operators.quantiles import medians, percentiles
from matchlake.sources.adapter import modelling_table


def test_percentiles_per_group_ties_nulls_and_signs(spark):
    rng = np.random.default_rng(3)
    groups = {"a": rng.normal(0, 1e6, 401), "b": np.repeat([-2.5, 0.0, 7.0], [1, 5, 4]), "c": np.array([3.0])}
    rows = [(g, float(x)) for g, xs in groups.items() for x in xs] + [("a", None), ("d", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    qs = [0.0, 0.05, 1 / 3, 0.5, 1.0]
    got = {r["g"]: r["q"] for r in percentiles(df, "x", qs, ["g"]).collect()}
    for g, xs in groups.items():
        assert got[g] == pytest.approx(np.quantile(xs, qs).tolist(), rel=1e-12, abs=1e-12)
    assert got["d"] == [None] * 5
    assert percentiles(df.limit(0), "x", [0.5]).collect()[0]["q"] == [None]
    both = {r["name"]: r["q"][0] for r in medians(df.withColumn("y", F.lit(None).cast("int")), ["x", "y"]).collect()}
    assert both == {"x": pytest.approx(np.median(np.concatenate(list(groups.values())))), "y": None}


@pytest.mark.parametrize("as_function", [False, True])
def test_grid_means_equal_row_by_row_scores(spark, as_function):
    rows = [(1.0, 2.0, 3.0), (1.0, 2.0, 3.0), (4.0, 2.0, 3.0), (0.5, -1.0, 0.1), (2.0, None, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    weights = {"intercept": -0.3, "a": 0.7, "b": -0.2, "c": 0.05}
    linear = EX.linear_scorer(weights)
    scorer = (lambda cols: linear(cols)) if as_function else linear

    def mean(value):
        p = [round(1 / (1 + math.exp(-(-0.3 + 0.7 * value - 0.2 * b + 0.05 * c))), 6) for _, b, c in rows if b is not None]
        return sum(p) / len(p)

    got = EX.partial_dependence(df, ["a", "b", "c"], scorer, "a", [0.0, 2.0], grid_decimals=6).collect()
    assert {r["grid_index"]: r["n_rows"] for r in got} == {0: 5, 1: 5}
    for r in got:
        assert r["mean_probability"] == pytest.approx(mean(r["grid_value"]), abs=1e-12)


@pytest.fixture(scope="module")
def folds(spark, sf):
    m = modelling_table(spark, sf).withColumnRenamed("is_good_match", "label")
    return TU.search_frame(SA.kfold(m, "application_id", 3, 42, "label"), "fold")


@pytest.mark.parametrize("kind", ["decision_tree", "linear_svc"])
def test_one_pass_scores_every_model_as_alone(folds, kind):
    rows = MO.fold_frames(folds, F.col("fold") == 0)
    param = "maxDepth" if kind == "decision_tree" else "maxIter"
    models = {t: rows.fit(kind, **{param: t}) for t in (1, 3)}
    auc, accuracy = TU.fold_scores(models, rows.val), TU.fold_scores(models, rows.val, "accuracy")
    for t, m in models.items():
        alone = MO.positive_probability(rows.val, m, raw_for_svc=kind == "linear_svc")
        assert auc[t] == roc_auc(alone.select("label", "probability")).first()[0]
        assert accuracy[t] == alone.agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]


def test_margin_machines_together_as_mllib_alone(folds, monkeypatch):
    rows, penalty = MA.FoldRows(folds, "fold"), [1e-4, 0.02, 0.7]
    passes = []
    monkeypatch.setattr(MA.FoldRows, "totals", lambda self, *a, plain=MA.FoldRows.totals: passes.append(1) or plain(self, *a))
    models = rows.fit(penalty)
    assert set(models) == {(d, f) for d in range(3) for f in range(3)} and len(passes) < 400
    accuracy = rows.accuracies(models)
    frames = MO.fold_frames(folds, F.col("fold") == 1)
    alone = {d: frames.fit("linear_svc", regParam=p) for d, p in enumerate(penalty)}
    for d, score in TU.fold_scores(alone, frames.val, "accuracy").items():
        assert accuracy[d, 1] == pytest.approx(score, abs=0.01)
    of_mllib = {}
    for d, m in alone.items():  # weights of features scaled by the plain deviation, about the plain mean
        w = m.coefficients.toArray() / frames.scaler.std.toArray()
        base = m.intercept - w @ frames.scaler.mean.toArray()
        of_mllib[d, 1] = np.append(w / rows.sides.scale[1], base + w @ rows.sides.mean[1])
    theirs = rows.losses(of_mllib, penalty)
    ours = rows.losses({(d, 1): models[d, 1] for d in range(3)}, penalty)
    for d, m in alone.items():
        assert theirs[d, 1][0] == pytest.approx(min(m.summary().objectiveHistory), rel=1e-3)  # the same objective
        assert ours[d, 1][0] <= theirs[d, 1][0] * (1 + 1e-3)
