"""Registered queries: MLlib models, calibration, stacking, tuning,
persistence (N1-N4, N7, N9-N13, N16, N17, N22, T1-T9, F7, A6, A7).

These are iterative fits without a SQL twin (rows-only checks); their
invariants are covered by tests. The prepared table is checkpointed once into
the shared checkpoint folder, so repeated fits neither recompute the joins
nor depend on executors that may be lost.
"""

from __future__ import annotations

import itertools
import json
import random
import statistics
import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from matchlake.functions import text as TX
from matchlake.functions.features import MODEL_FEATURES, model_features
from matchlake.functions.numeric import round_half_away
from matchlake.operators import boosting as BO
from matchlake.operators import calibration as CA

from matchlake.operators import curves as CU
from matchlake.operators import evaluation as EV
from matchlake.operators import forest as FO
from matchlake.operators import levelled as LF
from matchlake.operators import members as ME
from matchlake.operators import metrics as MT
from matchlake.operators import models as MO
from matchlake.operators import sampling as SA
from matchlake.operators import slices as SL
from matchlake.operators import text_vectors as TV
from matchlake.operators import tfidf as TF
from matchlake.operators import tuning as TU
from matchlake.operators.binned import binned_rows
from matchlake.operators.small import num, one_row, small_rows
from matchlake.plans import q_text as QT
from matchlake.plans.registry import query
from matchlake.session import cut_lineage, shared_path
from matchlake.sources.adapter import modelling_table
from matchlake.sources.tables import table

KEY = "application_id"


def base(spark, sf):
    """Modelling rows + label, three-way split (M2) and CV folds (M3)."""
    return SA.split_and_folds(modelling_table(spark, sf).withColumnRenamed("is_good_match", "label"), KEY, "label", 5)


def _holdout_scores(spark, sf, kind):
    b = base(spark, sf)
    train, test = b.filter(F.col("split") != "test"), b.filter(F.col("split") == "test")
    m = MO.fit(train, kind)
    return MO.positive_probability(test, m, raw_for_svc=(kind == "linear_svc")).select(
        KEY, "label", "probability", F.col("prediction").cast("int").alias("prediction"))


for qid, kind in [("n01_logistic_balanced", "logistic"), ("n04_decision_tree", "decision_tree")]:
    query(qid)(lambda s, d, k=kind: _holdout_scores(s, d, k))


def _coded(spark, sf, k=None):
    """Model features, label and a code: the fold of the rows to train on, 200 for test rows."""
    fold = SA.kfold(model_frame(spark, sf), KEY, k, 42, "label") if k else model_frame(spark, sf).withColumn("fold", F.lit(0))
    return fold.withColumn("code", F.when(F.col("split") == "test", TEST).otherwise(F.col("fold")))


TEST = 200


def model_frame(spark, sf):
    """The seven features, label and three-way split (M2) of every application."""
    m = model_features(modelling_table(spark, sf), [KEY, "is_good_match"]).withColumnRenamed("is_good_match", "label")
    return cut_lineage(SA.three_way_split(m, KEY, "label"))


def _holdout_trees(spark, sf, kind):
    """A forest of 100 unbounded trees, or 100 rounds of leaf-wise boosting, scored on the holdout."""
    members = ME.Members(_coded(spark, sf), KEY, "label", "code", MODEL_FEATURES)
    return members.scores([kind], [ME.Split((TEST,), (TEST,))]).select(F.col("id").alias(KEY), "label", "probability", "prediction")


query("n02_random_forest")(lambda s, d: _holdout_trees(s, d, "random_forest"))
query("n03_gradient_boosted_trees")(lambda s, d: _holdout_trees(s, d, "boosting"))


def _batch(spark, sf):
    b = base(spark, sf)
    m = MO.fit(b.filter(F.col("split") == "train"), "logistic")
    return MO.positive_probability(b, m).select(
        KEY, "probability", (F.col("probability") >= 0.45).cast("int").alias("decision"),
        F.lit(0.45).alias("threshold"))


query("n16_batch_scoring")(_batch)


def _importance(spark, sf):
    """N17 on the rows of ``base`` with the gap features only, which are worked out once. The
    forest is that of ``MO.ESTIMATORS``, grown level by level over packed rows."""
    m = MO.GapTransformer().transform(modelling_table(spark, sf).withColumnRenamed("is_good_match", "label"))
    rows = cut_lineage(m.select(KEY, "label", *MODEL_FEATURES))
    b = cut_lineage(SA.split_and_folds(rows, KEY, "label", 5).filter(F.col("split") == "train").select(*rows.columns))
    models = {"random_forest": LF.fit(b, KEY, "label", MODEL_FEATURES), "logistic": MO.fit(b, "logistic", gaps=False)}
    rows = [(kind, f, v) for kind, m in models.items() for f, v in MO.feature_importance(m)]
    return spark.createDataFrame(rows, "model string, feature string, importance double")


query("n17_feature_importance")(_importance)


CV_KINDS = ["logistic", "random_forest", "linear_svc", "boosting"]
BASE_KINDS = ["logistic", "decision_tree", "knn", "naive_bayes"]
CV_FOLDS = (5, 10)


def _cv(spark, sf):
    """Six metrics of four models on every fold of 5- and 10-fold validation."""
    rows = SA.kfold(model_frame(spark, sf), KEY, 10, 42, "label", name="code")
    members = ME.Members(rows, KEY, "label", "code", MODEL_FEATURES)
    splits = [(k, f, s) for k in CV_FOLDS for f, s in enumerate(ME.folds_of(k, 10))]
    scores = cut_lineage(members.scores(CV_KINDS, [s for _, _, s in splits], ids=False))
    which = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(f).alias("fold")) for k, f, _ in splits])
    found = EV.binary_metrics(scores, ["model", "split"]).withColumn("at", F.element_at(which, F.col("split") + 1))
    return found.select("model", "at.k", "at.fold", *EV.METRIC_COLS)


query("t01_cv_fold_metrics")(_cv)


def _base_members(spark, sf):
    """The four base models of the ensemble on five plain folds of the training
    rows (out of fold) and, fitted on all of them, on the holdout."""
    m = model_frame(spark, sf)
    train = SA.kfold(m.where("split <> 'test'"), KEY, 5, 42, name="code")
    rows = train.unionByName(m.where("split = 'test'").withColumn("code", F.lit(TEST)))
    members = ME.Members(rows, KEY, "label", "code", MODEL_FEATURES)
    splits = [ME.Split((f, TEST), (f,)) for f in range(5)] + [ME.Split((TEST,), (TEST,))]
    return cut_lineage(members.scores(BASE_KINDS, splits))


def _mean_fold_auc(scores):
    folds = EV.CU.roc_auc(scores.where("split < 5"), ["model", "split"])
    return folds.groupBy("model").agg(F.avg("roc_auc").alias("mean_auc"))


def _best(spark, sf):
    """The base model with the best mean AUC over the folds (the first of the list, if tied)."""
    means = cut_lineage(_mean_fold_auc(_base_members(spark, sf)))
    best, _ = TU.best_by_mean(means, "mean_auc", BASE_KINDS)
    return means.withColumn("is_best", F.col("model") == F.lit(best))


query("f07_best_model_by_cv")(_best)

FOREST_GRID = {"trees": [50, 100, 200, 300], "max_depth": [None, 10, 20, 30], "min_split": [2, 5, 10]}
NESTED_GRID = {"trees": [50, 100], "max_depth": [None, 10], "min_split": [2, 5]}
SVC_SPACE = {"regParam": ("loguniform", 1e-4, 1.0)}
TRIALS, PATIENCE = 50, 20
#: ``booster`` is drawn for the ledger: without a drop rate, both kinds fit the same trees.
BOOST_SPACE = {"booster": ("choice", ["gbtree", "dart"]), "l2": ("loguniform", 1e-8, 1.0), "l1": ("loguniform", 1e-8, 1.0),
               "subsample": ("uniform", 0.5, 1.0), "column_share": ("uniform", 0.5, 1.0), "step": ("loguniform", 1e-3, 0.3),
               "rounds": ("int", 50, 300), "max_depth": ("int", 3, 9), "min_child_weight": ("int", 1, 7)}


def grid_draws(grid, n, seed):
    """``n`` different points of a grid, drawn by seed."""
    points = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    return random.Random(seed).sample(points, n)


def boost_spec(params):
    return BO.BoostSpec(**{k: v for k, v in params.items() if k != "booster"}, max_leaves=None, min_rows=1, patience=PATIENCE)


def _forest_search(spark, sf):
    """15 draws of the forest's grid by mean AUC over three folds, all 45 forests at once."""
    m = model_frame(spark, sf).where("split <> 'test'")
    rows = binned_rows(SA.kfold(m, KEY, 3, 7, "label"), KEY, "label", MODEL_FEATURES, "fold")
    draws = grid_draws(FOREST_GRID, 15, 42)
    found = FO.search_forests(rows, draws, [((f,), (f,)) for f in range(3)], len(MODEL_FEATURES))
    return spark.createDataFrame(
        [(d, json.dumps(p, sort_keys=True), statistics.fmean(found[d, f] for f in range(3))) for d, p in enumerate(draws)],
        "draw int, params string, mean_score double")


query("t02_random_search")(_forest_search)
INNER, OUTER = 3, 5


def _nested(spark, sf):
    """Five draws of a forest on three inner folds of each of five outer
    folds, all 75 forests at once; the best of each outer fold is fitted on the other
    four and gets six metrics on it."""
    m = SA.kfold(model_frame(spark, sf), KEY, OUTER, 42, "label", name="outer")
    m = SA.kfold(m, KEY, INNER, 11, "label", name="inner").withColumn("code", F.col("outer") * INNER + F.col("inner"))
    rows = binned_rows(m, KEY, "label", MODEL_FEATURES, "code")
    draws = grid_draws(NESTED_GRID, 5, 42)
    fold = lambda o: tuple(range(o * INNER, o * INNER + INNER))
    inner = lambda o, i: tuple(c for c in range(OUTER * INNER) if c // INNER != o and c % INNER == i)
    parts = [(o, i) for o in range(OUTER) for i in range(INNER)]
    found = FO.search_forests(rows, draws, [((*fold(o), *inner(o, i)), inner(o, i)) for o, i in parts], len(MODEL_FEATURES))
    best = []
    for o in range(OUTER):
        means = [statistics.fmean(found[d, parts.index((o, i))] for i in range(INNER)) for d in range(len(draws))]
        best.append(draws[means.index(max(means))])
    specs = [FO.ForestSpec(held=fold(o), **best[o]) for o in range(OUTER)]
    scores = FO.forest_ratings(rows, specs, [fold(o) for o in range(OUTER)], len(MODEL_FEATURES)).select(
        F.col("forest").alias("outer_fold"), F.col("y").alias("label"), "probability",
        (F.col("probability") > 0.5).cast("int").alias("prediction"))
    params = F.element_at(F.array(*[F.lit(json.dumps(b, sort_keys=True)) for b in best]), F.col("outer_fold") + 1)
    return EV.binary_metrics(cut_lineage(scores), ["outer_fold"]).select("outer_fold", params.alias("best_params"), *EV.METRIC_COLS)


query("t03_nested_cv")(_nested)


def trial_ledger(spark, rows):
    """50 trials of boosting on the five folds 0 to 4 of binned rows."""
    rng = random.Random(42)
    draws = [TU.sample_params(BOOST_SPACE, rng) for _ in range(TRIALS)]
    ledger = BO.trial_search(rows, [boost_spec(p) for p in draws], list(range(5)), len(MODEL_FEATURES))
    return spark.createDataFrame(
        [(r["trial"], r["status"], r["score"], r["rounds"], r["stopped"], round(r["seconds"], 3),
          json.dumps(draws[r["trial"]], sort_keys=True)) for r in ledger],
        "trial int, status string, score double, rounds int, stopped_at int, time_sec double, params string")


def _trial_rows(spark, sf):
    return binned_rows(_coded(spark, sf, 5), KEY, "label", MODEL_FEATURES, "code")


query("t04_t05_t06_trial_search")(lambda s, d: trial_ledger(s, _trial_rows(s, d).where(F.col("fold") != TEST)))


def _early_stop(spark, sf):
    """Boosting that stops once the calibration rows' loss has not fallen for
    20 rounds: the loss of every round, and whether the model keeps it."""
    m = model_frame(spark, sf).where("split <> 'test'").withColumn("code", (F.col("split") == "calib").cast("int"))
    rows = binned_rows(m, KEY, "label", MODEL_FEATURES, "code")
    spec = BO.BoostSpec(rounds=300, step=0.3, max_depth=6, max_leaves=None, l2=1.0, min_child_weight=1.0, min_rows=1, held=(1,),
                        patience=PATIENCE)
    model = BO.fit_boosting(rows, spec, len(MODEL_FEATURES))
    return spark.createDataFrame([(i + 1, v, i < model.rounds) for i, v in enumerate(model.losses)],
                                 "round int, validation_loss double, kept boolean")


query("t07_early_stopping")(_early_stop)


def _refit(spark, rows):
    """The best trial of the search, refitted on all training rows for as many
    rounds as its folds kept, scored on the holdout."""
    best = trial_ledger(spark, rows.where(F.col("fold") != TEST)).where("status = 'COMPLETE'").orderBy(
        F.col("score").desc(), "trial").first()
    params = json.loads(best["params"]) | {"rounds": best["rounds"]}
    model = BO.fit_boosting(rows, replace(boost_spec(params), held=(TEST,), patience=0), len(MODEL_FEATURES))
    scores = model.scores(rows.where(F.col("fold") == TEST)).select(
        F.col("y").alias("label"), "probability", (F.col("probability") >= 0.5).cast("int").alias("prediction"))
    return EV.binary_metrics(cut_lineage(scores)).withColumn("params", F.lit(json.dumps(params, sort_keys=True)))


query("t08_refit_best_on_holdout")(lambda s, d: _refit(s, _trial_rows(s, d)))
query("t09_svc_search_by_accuracy")(
    lambda s, d: TU.svc_search(base(s, d).filter(F.col("split") != "test"), SVC_SPACE, 30))


def _fitted_margins(spark, sf, kind, k, seed):
    """Rows with code (training fold, 100: calibration, 200: test) and the margins ``m0``.. of
    the models fitted without fold 0.., and ``m`` of that fitted on all folds."""
    m = model_frame(spark, sf)
    code = F.when(F.col("split") == "test", TEST).otherwise(CALIB)
    rows = SA.kfold(m.where("split = 'train'"), KEY, k, seed, "label", name="code").unionByName(
        m.where("split <> 'train'").withColumn("code", code))
    members = ME.Members(rows, KEY, "label", "code", MODEL_FEATURES)
    splits = [ME.Split((f, CALIB, TEST), ()) for f in range(k)] + [ME.Split((CALIB, TEST), ())]
    names = [f"m{f}" for f in range(k)] + ["m"]
    margins = [members.margin(m) for m in members.linear_models(kind, splits)]
    return cut_lineage(members.rows.select(
        F.col("id").alias(KEY), "label", "code", *MODEL_FEATURES, *[c.alias(n) for c, n in zip(margins, names)]))


CALIB = 100


def fitted_calibrator(rows, method, margin):
    """A function from a margin column to a probability."""
    if method == "sigmoid":
        fitted = CA.platt_fit(rows, margin)
        return lambda m: CA.platt(m, fitted)
    return CA.isotonic_fit(rows, margin)


def averaged(rows, method, k=3):
    """The mean over the folds of each fold's model, calibrated on its fold."""
    maps = TU.pmap(lambda f: fitted_calibrator(rows.where(F.col("code") == f), method, f"m{f}"), range(k))
    return sum(c(F.col(f"m{f}")) for f, c in enumerate(maps)) / k


def _calibration(spark, sf, method):
    rows = _fitted_margins(spark, sf, "logistic", 3, 5)
    return rows.where(F.col("code") == TEST).select(KEY, "label", averaged(rows, method).alias("probability"))


query("n11_sigmoid_calibration_cv3")(lambda s, d: _calibration(s, d, "sigmoid"))
query("n12_isotonic_calibration_cv3")(lambda s, d: _calibration(s, d, "isotonic"))


def _svc(spark, sf):
    """A linear margin machine, its probability a sigmoid fitted on the
    margins that five models give the folds they were not fitted on."""
    rows = _fitted_margins(spark, sf, "linear_svc", 5, 5)
    apart = F.coalesce(*[F.when(F.col("code") == f, F.col(f"m{f}")) for f in range(5)])
    fitted = CA.platt_fit(rows.where(F.col("code") < 5).select("label", apart.alias("margin")))
    return rows.where(F.col("code") == TEST).select(KEY, "label", CA.platt(F.col("m"), fitted).alias("probability"),
                                                    (F.col("m") > 0).cast("int").alias("prediction"))


query("n07_linear_svc_platt")(_svc)


def choose_method(rows, eval_rows, methods, apply):
    """(method, Brier scores): the least Brier score on ``eval_rows``, the first method if tied."""
    row = one_row(eval_rows.select("label", *[apply(m).alias(m) for m in methods]).agg(
        *[CA.brier_score(F.col(m), F.col("label")).alias(m) for m in methods]))
    return min(methods, key=lambda m: (row[m], methods.index(m))), row


def _calibrate_fitted(spark, sf):
    """Calibrate an already fitted model on held-out rows; method chosen
    by Brier on a 60/40 sub-split (isotonic first), then refit on all."""
    rows = _fitted_margins(spark, sf, "logistic", 3, 5)
    cal = cut_lineage(SA.stratified_holdout(rows.where(F.col("code") == CALIB), KEY, "label", 0.4, 99, "is_eval"))
    maps = {m: fitted_calibrator(cal.where("not is_eval"), m, "m") for m in ("isotonic", "sigmoid")}
    chosen, _ = choose_method(cal, cal.where("is_eval"), list(maps), lambda m: maps[m](F.col("m")))
    final = fitted_calibrator(cal, chosen, "m")
    return rows.where(F.col("code") == TEST).select(KEY, "label", final(F.col("m")).alias("probability"),
                                                    F.lit(chosen).alias("method"))


query("n13_calibrate_fitted_model")(_calibrate_fitted)


def _choose_fitted(spark, sf):
    """N14 on fitted models: Brier score on the holdout of the raw model and of both
    three-fold calibrations, and the choice (sigmoid only if strictly lower)."""
    rows = _fitted_margins(spark, sf, "logistic", 3, 5)
    p = {"raw": F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("m")))} | {m: averaged(rows, m) for m in ("sigmoid", "isotonic")}
    test = rows.where(F.col("code") == TEST).select("label", *[c.alias(m) for m, c in p.items()])
    return test.agg(*[CA.brier_score(F.col(m), F.col("label")).alias(f"brier_{m}") for m in p]).select(
        "*", F.when(F.col("brier_sigmoid") < F.col("brier_isotonic"), "sigmoid").otherwise("isotonic").alias("selected_method"))


query("n14_fitted_calibration_choice")(_choose_fitted)


def _release(spark, sf):
    """One release on a fitted model: three-fold calibration by the better Brier
    score, threshold of the best F1 on the calibration rows, then metrics, errors and
    cost on the holdout, for all rows and on both sides of the median experience."""
    rows = _fitted_margins(spark, sf, "logistic", 3, 5)
    maps = {m: averaged(rows, m) for m in ("isotonic", "sigmoid")}
    scored = cut_lineage(rows.where(F.col("code") >= CALIB).select(KEY, "code", "label", *[c.alias(m) for m, c in maps.items()]))
    method, brier = choose_method(None, scored.where(F.col("code") == TEST), list(maps), F.col)
    scored = scored.withColumnRenamed(method, "probability")
    grid = CU.arange_grid(0.1, 0.9, 0.05)
    threshold = one_row(CU.best_f1_threshold(CU.threshold_sweep(scored.where(F.col("code") == CALIB), grid)))["best_threshold"]
    years = modelling_table(spark, sf).select(KEY, "years_experience")
    test = cut_lineage(scored.where(F.col("code") == TEST).join(years, KEY).select(
        "label", "probability", "years_experience", (F.col("probability") >= num(threshold)).cast("int").alias("prediction")))
    both = MT.expected_cost(test).select("*", F.lit("all").alias("slice"), *[v.alias(k) for k, v in MT.rate_columns().items()])
    parts = SL.segment_by_median(test, "years_experience").withColumn("expected_cost", F.lit(None).cast("double")) \
        .withColumnRenamed("segment", "slice")
    cols = ["slice", "tn", "fp", "fn", "tp", "accuracy", "precision", "recall", "f1", "expected_cost"]
    return both.select(*cols).unionByName(parts.select(*cols)).select(
        "*", F.lit(method).alias("method"), num(threshold).alias("threshold"), num(brier[method]).alias("brier_score"))


query("n16_release_flow")(_release)


def _baseline_vs_tuned(spark, sf):
    """D32 on fitted models: boosting with the library's defaults (100 rounds, step 0.3,
    depth 6) and T8's tuned model on the holdout, and the tuned model's gain in AUC."""
    rows = _trial_rows(spark, sf)
    tuned = _refit(spark, rows).withColumn("model", F.lit("tuned"))
    spec = BO.BoostSpec(rounds=100, step=0.3, max_depth=6, max_leaves=None, l2=1.0, min_child_weight=1.0, min_rows=1, held=(TEST,))
    scores = BO.fit_boosting(rows, spec, len(MODEL_FEATURES)).scores(rows.where(F.col("fold") == TEST)).select(
        F.col("y").alias("label"), "probability", (F.col("probability") >= 0.5).cast("int").alias("prediction"))
    base = EV.binary_metrics(cut_lineage(scores)).withColumn("model", F.lit("baseline"))
    both = cut_lineage(base.unionByName(tuned.select(*base.columns)))
    auc = {r["model"]: r["roc_auc"] for r in small_rows(both, 2)}
    return both.select("model", *EV.METRIC_COLS, F.when(F.col("model") == "tuned", num(auc["tuned"] - auc["baseline"])).alias("auc_gain"))


query("d32_fitted_baseline_vs_tuned")(_baseline_vs_tuned)


def _generalization(spark, sf):
    """T10 on fitted models: the model with the best mean AUC over ten folds, its
    spread, and the mean AUC of the nested forest search."""
    report = EV.generalization_report(EV.fold_summary(_cv(spark, sf)))
    nested = one_row(_nested(spark, sf).agg(F.avg("roc_auc").alias("m")))["m"]
    return report.withColumn("nested_mean_auc", num(nested))


query("t10_generalization_of_fitted_models")(_generalization)


def _stacking_table(spark, sf):
    """N9 + N10: the best base model, soft voting and stacking on the holdout;
    the meta-model learns from out-of-fold scores of the four base models."""
    scores = _base_members(spark, sf)
    best, _ = TU.best_by_mean(_mean_fold_auc(scores), "mean_auc", BASE_KINDS)
    wide = cut_lineage(scores.groupBy("id", "label", (F.col("split") == 5).alias("test")).pivot("model", BASE_KINDS).agg(
        F.first("probability")))
    stacked = TU.stacking_scores(wide.where("not test"), wide.where("test"), BASE_KINDS)
    test = wide.where("test")
    vote = test.select(F.lit("voting").alias("model"), "id", "label", (sum(F.col(k) for k in BASE_KINDS) / len(BASE_KINDS))
                       .alias("probability"))
    single = test.select(F.lit(best).alias("model"), "id", "label", F.col(best).alias("probability"))
    table = single.unionByName(vote).unionByName(stacked.withColumn("model", F.lit("stacking")).select(*vote.columns))
    return EV.binary_metrics(table.withColumn("prediction", (F.col("probability") > 0.5).cast("int")), ["model"])


query("n09_n10_stacking_vs_voting")(_stacking_table)


def _roundtrip(spark, sf):
    b = base(spark, sf)
    m = MO.fit(b.filter(F.col("split") == "train"), "logistic")
    path = shared_path(spark, f"models/logistic-{uuid.uuid4().hex[:12]}")
    return MO.round_trip_check(b.filter(F.col("split") == "test"), m, path, KEY)


query("a06_a07_model_save_load_roundtrip")(_roundtrip)


def _metadata(spark, sf):
    """A pipeline saved with its metadata row, read back."""
    b = base(spark, sf)
    train = b.filter(F.col("split") == "train")
    m = MO.fit(train, "logistic")
    path = shared_path(spark, f"models/logistic-{uuid.uuid4().hex[:12]}")
    MO.save(m, path)
    scored = MO.positive_probability(train, m).select("label", "probability", F.col("prediction").cast("int").alias("prediction"))
    metrics = one_row(EV.binary_metrics(cut_lineage(scored))).asDict()
    MO.save_metadata(spark, path, "match-logistic", "1.0", m, list(MODEL_FEATURES), train.count(), metrics, "modelling_table", 42)
    return MO.load_metadata(spark, path).drop("saved_at")


query("a06_model_metadata")(_metadata)


def _text_classifier(spark, sf):
    """TF-IDF (5000 terms) + balanced multinomial logistic on the labelled
    documents (quality), scored on a stratified holdout."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import (CountVectorizer, ElementwiseProduct, IDF, Normalizer, RegexTokenizer,
                                    StopWordsRemover)
    from pyspark.ml.linalg import Vectors
    from matchlake.functions.text import STOP_WORDS
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").withColumnRenamed(
        "quality", "label")
    split = SA.stratified_holdout(docs, "doc_id", "label", 0.2, 42, "is_test")
    w, n = MO.with_balanced_weight(split.filter(~F.col("is_test")))
    words = Pipeline(stages=[
        RegexTokenizer(inputCol="text", outputCol="tok", pattern=r"\p{L}{2,}", gaps=False, toLowercase=True),
        StopWordsRemover(inputCol="tok", outputCol="tok2", stopWords=STOP_WORDS),
        CountVectorizer(inputCol="tok2", outputCol="tf", vocabSize=5000)]).fit(w)
    counted = words.transform(w)
    idf = IDF(inputCol="tf", outputCol="unused").fit(counted).idf.toArray() + 1.0  # smoothed, plus one
    rest = Pipeline(stages=[
        ElementwiseProduct(inputCol="tf", outputCol="tfidf", scalingVec=Vectors.dense(idf)),
        Normalizer(inputCol="tfidf", outputCol="features", p=2.0),
        LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", family="multinomial",
                           regParam=1.0 / n)])
    fitted = rest.fit(counted)
    from pyspark.ml.functions import vector_to_array
    return fitted.transform(words.transform(split.filter(F.col("is_test")))).select(
        "doc_id", "label", F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias("probability"))


query("n22_text_classifier")(_text_classifier)


# ------------------------------------------------------------ J3, H10, D26 on trained vectors
def _encode(spark, sf):
    """Word vectors trained on all documents, and the vector of every document."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    words = TV.train(docs)
    return docs.select("doc_id", TV.text_vector(F.col("text"), words).alias("embedding"))


query("j03_encoder_plugin_documents")(_encode)


def trained_similarity(spark, sf, a=None, tokens=None):
    """Applications with the cosine of their resume's and job's vectors, both
    from word vectors trained on all resumes and jobs. The joins carry packed texts."""
    a = a if a is not None else cut_lineage(QT.apps(spark, sf))
    rtok, jtok = tokens or (QT.side_tokens(QT.resumes(spark, sf)), QT.side_tokens(QT.jds(spark, sf)))
    words = TV.train_tokens(rtok.select("tokens").unionByName(jtok.select("tokens")))
    rv, jv = (t.select("doc", TV.packed_text(F.col("tokens"), words).alias("vector")) for t in (rtok, jtok))
    pairs = TF.pair_cosine(a, rv, jv, "candidate_id", "job_id", "vector_similarity", dot=TV.packed_dots(words), how="inner")
    return pairs.withColumn("vector_similarity", round_half_away(F.col("vector_similarity"), 6))


query("h10_trained_vector_similarity")(lambda s, d: trained_similarity(s, d).select(KEY, "vector_similarity"))


def _representation(spark, sf):
    """The AUC of trained vectors and of TF-IDF as matchers, and the better of the two.
    Both read the same applications and tokens, written once."""
    a = cut_lineage(QT.apps(spark, sf))
    tokens = QT.side_tokens(QT.resumes(spark, sf)), QT.side_tokens(QT.jds(spark, sf))
    v = trained_similarity(spark, sf, a, tokens).withColumnRenamed("is_good_match", "label")
    t = QT.tfidf_similarity(spark, sf, a, tokens).withColumnRenamed("is_good_match", "label")
    va = one_row(CU.roc_auc(v, score="vector_similarity"))["roc_auc"]
    ta = one_row(CU.roc_auc(t.withColumn("s", round_half_away(F.col("tfidf_similarity"), 6)), score="s"))["roc_auc"]
    return spark.createDataFrame([(va, ta, "vectors" if va > ta else "tfidf")],
                                 "vector_auc double, tfidf_auc double, best_representation string")


query("d26_trained_vectors_vs_tfidf")(_representation)
