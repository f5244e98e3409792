"""Registered queries: value-checkable model operators on stored-weight
scorers (N5, N8, N14, N18-N21, N23, N24, D17, D30-D32, F2, G4, T10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake.functions.features import MODEL_FEATURES
from matchlake.functions.numeric import grid_mean_sql
from matchlake.operators import evaluation as EV
from matchlake.operators import explain as EX
from matchlake.operators import sampling as SA
from matchlake.operators.quantiles import percentiles
from matchlake.plans.oracle_base import with_ctes
from matchlake.plans.q_metrics import (CONF_SQL, LONG_CTE, MODELS, MULTI_CTE, SCORED_CTE, S, _rn_sql,
                                       auc_sql, long_models, multi, prauc_sql, rates_sql)
from matchlake.plans.registry import query, r
from matchlake.session import cut_lineage
from matchlake.sources.adapter import modelling_table
from matchlake.functions.features import model_features


# ------------------------------------------------------------ N5 Gaussian naive Bayes (closed form)


def _nb(spark, sf):
    m = model_features(modelling_table(spark, sf), ["application_id", "is_good_match"]).withColumnRenamed(
        "is_good_match", "label")
    model = EX.gaussian_nb_fit(m, MODEL_FEATURES)
    p = EX.gaussian_nb_score(m, model, MODEL_FEATURES)
    return m.select("application_id", "label", p.alias("probability")).select(
        "*", (F.col("probability") >= 0.5).cast("int").alias("prediction"))


def _nb_sql():
    eps = "(SELECT 1e-9 * greatest(" + ", ".join(f"var_pop({f})" for f in MODEL_FEATURES) + ") FROM feat)"
    stats = ("SELECT is_good_match AS c, count(*) / (SELECT count(*) FROM feat)::DOUBLE AS prior, "
             + ", ".join(f"avg({f}) AS mu_{f}, var_pop({f}) + {eps} AS var_{f}" for f in MODEL_FEATURES)
             + " FROM feat GROUP BY 1")

    def jll(alias):
        t = f"ln({alias}.prior)"
        for f in MODEL_FEATURES:
            t = (f"({t} - 0.5 * ln(2 * pi() * {alias}.var_{f}) - ({f} - {alias}.mu_{f}) * ({f} - {alias}.mu_{f}) "
                 f"/ (2 * {alias}.var_{f}))")
        return t
    return with_ctes(f"""SELECT application_id, label, probability, CAST(probability >= 0.5 AS INTEGER) AS prediction FROM (
      SELECT application_id, is_good_match AS label, round(1.0 / (1.0 + exp({jll('s0')} - {jll('s1')})), 6) AS probability
      FROM feat, (SELECT * FROM nbstats WHERE c = 0) s0, (SELECT * FROM nbstats WHERE c = 1) s1)""",
                     [("nbstats", stats)])


query("n05_gaussian_naive_bayes", _nb_sql())(_nb)

# ------------------------------------------------------------ N8 soft voting, N14 calibration choice
VOTE = " + ".join(f"p_{m}" for m in MODELS)
query("n08_soft_voting", with_ctes(
    f"SELECT application_id, label, ({VOTE}) / {len(MODELS)} AS probability, "
    f"CAST(({VOTE}) / {len(MODELS)} >= 0.5 AS INTEGER) AS prediction FROM multi", [MULTI_CTE]))(
    lambda s, d: (lambda w: w.select("application_id", "label", (sum(F.col(f"p_{m}") for m in MODELS) / len(MODELS))
                                     .alias("probability")).select(
        "*", (F.col("probability") >= 0.5).cast("int").alias("prediction")))(multi(s, d)))
query("n14_choose_calibration_by_brier", with_ctes(
    """SELECT round(b_sig, 9) AS brier_sigmoid, round(b_iso, 9) AS brier_isotonic,
         CASE WHEN b_sig < b_iso THEN 'sigmoid' ELSE 'isotonic' END AS selected_method FROM
       (SELECT avg(pow(p_linear_b - label, 2)) AS b_sig, avg(pow(p_linear_c - label, 2)) AS b_iso FROM multi)""",
    [MULTI_CTE]))(
    lambda s, d: multi(s, d).agg(F.avg(F.pow(F.col("p_linear_b") - F.col("label"), 2)).alias("bs"),
                                 F.avg(F.pow(F.col("p_linear_c") - F.col("label"), 2)).alias("bi")).select(
        r(F.col("bs")).alias("brier_sigmoid"), r(F.col("bi")).alias("brier_isotonic"),
        F.when(F.col("bs") < F.col("bi"), "sigmoid").otherwise("isotonic").alias("selected_method")))

# ------------------------------------------------------------ N18, N19, N24 with the stored-weight scorer
SCORER = EX.linear_scorer(MODELS["linear_a"])
PD_FEATURES = ["diff_experience", "diff_python", "diff_sql"]


def _pd1(spark, sf):
    m = model_features(modelling_table(spark, sf))
    out = None
    for f in PD_FEATURES:
        g = EX.percentile_grid(m, f, 50)
        pdf = EX.partial_dependence(m, MODEL_FEATURES, SCORER, f, g, grid_decimals=6).select(
            F.lit(f).alias("feature"), "grid_index", r(F.col("grid_value")).alias("grid_value"), "mean_probability")
        out = pdf if out is None else out.unionByName(pdf)
    return out


def _grid_cte(f, n, name):
    return (name, f"""SELECT i, CASE WHEN i = {n - 1} THEN hi ELSE i * ((hi - lo) / {n - 1}) + lo END AS v FROM range({n}) t(i),
        (SELECT quantile_cont({f}, 0.05) AS lo, quantile_cont({f}, 0.95) AS hi FROM feat)""")


def _prob_expr(override: dict) -> str:
    w = MODELS["linear_a"]
    z = f"{float(w['intercept'])!r}::DOUBLE"
    for f in MODEL_FEATURES:
        z = f"({z} + {float(w[f])!r}::DOUBLE * {override.get(f, f)})"
    return f"round(1.0::DOUBLE / (1.0::DOUBLE + exp(-({z}))), 6)"


query("n18_partial_dependence_1d", with_ctes(" UNION ALL ".join(
    f"""SELECT '{f}' AS feature, g.i AS grid_index, round(g.v, 9) AS grid_value, {grid_mean_sql(_prob_expr({f: 'g.v'}))}
        AS mean_probability FROM feat, grid_{f} g GROUP BY g.i, g.v""" for f in PD_FEATURES),
    [_grid_cte(f, 50, f"grid_{f}") for f in PD_FEATURES]))(_pd1)


def _pd2(spark, sf):
    m = model_features(modelling_table(spark, sf))
    ga, gb = EX.percentile_grid(m, "diff_experience", 30), EX.percentile_grid(m, "diff_python", 30)
    return EX.partial_dependence_2d(m, MODEL_FEATURES, SCORER, "diff_experience", ga, "diff_python", gb,
                                    grid_decimals=6).select(
        "i", "j", r(F.col("value_a")).alias("value_a"), r(F.col("value_b")).alias("value_b"), "mean_probability")


query("n19_partial_dependence_2d", with_ctes(
    f"""SELECT a.i AS i, b.i AS j, round(a.v, 9) AS value_a, round(b.v, 9) AS value_b,
        {grid_mean_sql(_prob_expr({'diff_experience': 'a.v', 'diff_python': 'b.v'}))} AS mean_probability
        FROM feat, ga a, gb b GROUP BY a.i, b.i, a.v, b.v""",
    [_grid_cte("diff_experience", 30, "ga"), _grid_cte("diff_python", 30, "gb")]))(_pd2)

# Fixed values (parameters): what-if scenarios, each overriding some features.
SCENARIOS = [{}, {"diff_python": -20.0}, {"diff_experience": 3.0, "diff_python": 10.0}]


def _what_if(spark, sf):
    m = model_features(modelling_table(spark, sf), ["application_id"])
    return EX.what_if(m, MODEL_FEATURES, SCORER, SCENARIOS, "application_id")


query("n24_what_if_scenarios", with_ctes(" UNION ALL ".join(
    f"""SELECT application_id, {i} AS scenario, {_prob_expr({k: f'{v!r}::DOUBLE' for k, v in sc.items()})} AS probability,
        CAST({_prob_expr({k: f'{v!r}::DOUBLE' for k, v in sc.items()})} >= 0.5 AS INTEGER) AS prediction FROM feat"""
    for i, sc in enumerate(SCENARIOS))))(_what_if)

# ------------------------------------------------------------ N20, N21, N23
query("n20_majority_baseline", with_ctes(
    """SELECT acc AS accuracy, (f0 + f1) / 2 AS macro_f1 FROM (
      SELECT CAST(sum(CASE WHEN label = m THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS acc,
             CASE WHEN m = 0 THEN 2 * (CAST(sum(1 - label) AS DOUBLE) / count(*)) / (CAST(sum(1 - label) AS DOUBLE) / count(*) + 1)
                  ELSE 0.0 END AS f0,
             CASE WHEN m = 1 THEN 2 * (CAST(sum(label) AS DOUBLE) / count(*)) / (CAST(sum(label) AS DOUBLE) / count(*) + 1)
                  ELSE 0.0 END AS f1
      FROM scored, (SELECT first(label ORDER BY n DESC, label) AS m FROM (SELECT label, count(*) AS n FROM scored GROUP BY 1))
      GROUP BY m)""",
    [SCORED_CTE]))(lambda s, d: EV.majority_baseline(S(s, d)))


def _terciles(spark, sf):
    from matchlake.sources.tables import table
    docs = table(spark, sf, "documents").select("doc_id", "n_chars")
    q = percentiles(docs, "n_chars", [1 / 3, 2 / 3]).select("q").scalar()
    lab = F.when(F.col("n_chars") <= q[0], "Easy").when(F.col("n_chars") <= q[1], "Medium").otherwise("Hard")
    return docs.select("doc_id", lab.alias("difficulty"))


query("n21_tercile_labels", f"""SELECT doc_id, CASE WHEN n_chars <= (SELECT quantile_cont(n_chars, {1 / 3!r}) FROM documents) THEN 'Easy'
    WHEN n_chars <= (SELECT quantile_cont(n_chars, {2 / 3!r}) FROM documents) THEN 'Medium' ELSE 'Hard' END AS difficulty
    FROM documents""")(_terciles)
query("n23_top_confident_errors", with_ctes(
    """SELECT application_id, label, prediction, probability, abs(probability - 0.5) * 2 AS confidence FROM scored
       WHERE label <> prediction ORDER BY confidence DESC, application_id LIMIT 5""", [SCORED_CTE]))(
    lambda s, d: EV.top_confident_errors(S(s, d), "application_id"))

# ------------------------------------------------------------ D17, F2, G4, T10 over folds
KS = (5, 10)


def _fold_rows(spark, sf):
    """Metric rows per (model, k, fold) for every k at once. The row number
    within its class is a column of the wide row, each k's fold is (rn - 1) mod k;
    rows are counted at once per (model, k, fold, score, prediction), and only the counts go on."""
    wide = SA.exact_row_number(multi(spark, sf), "application_id", 42, ["label"])
    each = [F.struct(F.lit(m).alias("model"), F.lit(k).alias("k"), F.pmod(F.col("rn") - 1, F.lit(k)).cast("int").alias("fold"),
                     F.col(f"p_{m}").alias("score"), F.col(f"y_{m}").alias("prediction")) for m in MODELS for k in KS]
    y = F.col("label").cast("long")
    counts = wide.select("label", F.inline(F.array(*each))).groupBy("model", "k", "fold", "score", "prediction").agg(
        F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    return EV.metrics_of_counts(cut_lineage(counts), ["model", "k", "fold"])


FOLDS_CTE = ("fm", " UNION ALL ".join(
    f"SELECT l.*, {k} AS k, f.fold FROM long_models l JOIN (SELECT application_id, "
    f"CAST(({_rn_sql(42)} - 1) % {k} AS INTEGER) AS fold FROM multi) f USING (application_id)" for k in KS))
BY = "model, k, fold"
FOLD_METRICS_CTE = ("fold_metrics", f"""SELECT * FROM
    (SELECT {BY}, {rates_sql()} FROM (SELECT {BY}, {CONF_SQL} FROM fm GROUP BY ALL))
    JOIN ({auc_sql('fm', by=BY)}) USING (model, k, fold) JOIN ({prauc_sql('fm', by=BY, decimals=None)}) USING (model, k, fold)""")
FOLD_CTES = [MULTI_CTE, LONG_CTE, FOLDS_CTE, FOLD_METRICS_CTE]
R9 = lambda c: f"round({c}, 9) AS {c}"
query("g04_fold_metric_rows", with_ctes(
    "SELECT model, k, fold, " + ", ".join(R9(c) for c in EV.METRIC_COLS) + " FROM fold_metrics", FOLD_CTES))(
    lambda s, d: _fold_rows(s, d).select("model", "k", "fold", *[r(F.col(c)).alias(c) for c in EV.METRIC_COLS]))

SUMMARY_SQL = """SELECT model, k, avg(accuracy) AS mean_accuracy, stddev_samp(accuracy) AS std_accuracy,
    avg(roc_auc) AS mean_auc, stddev_samp(roc_auc) AS std_auc, var_samp(roc_auc) AS var_auc, max(roc_auc) AS max_auc,
    min(roc_auc) AS min_auc, avg(f1) AS mean_f1, avg(precision) AS mean_precision, avg(recall) AS mean_recall,
    avg(pr_auc) AS mean_pr_auc FROM fold_metrics GROUP BY model, k"""
SUM_COLS = ["mean_accuracy", "std_accuracy", "mean_auc", "std_auc", "var_auc", "max_auc", "min_auc", "mean_f1",
            "mean_precision", "mean_recall", "mean_pr_auc"]
query("d17_fold_summary", with_ctes(
    "SELECT model, k, " + ", ".join(R9(c) for c in SUM_COLS) + f" FROM ({SUMMARY_SQL})", FOLD_CTES))(
    lambda s, d: EV.fold_summary(_fold_rows(s, d)).select("model", "k", *[r(F.col(c)).alias(c) for c in SUM_COLS]))
query("f02_rank_models", with_ctes(
    f"SELECT model, k, round(mean_auc, 9) AS mean_auc FROM ({SUMMARY_SQL}) WHERE k = 10 "
    "ORDER BY mean_auc DESC, var_auc ASC, model LIMIT 1", FOLD_CTES))(
    lambda s, d: EV.rank_models(EV.fold_summary(_fold_rows(s, d))).select("model", "k", r(F.col("mean_auc")).alias("mean_auc")))
query("t10_generalization_report", with_ctes(
    f"""SELECT model AS winner, round(mean_auc, 9) AS mean_auc, round(var_auc, 9) AS var_auc, round(max_auc, 9) AS best_auc,
        round(min_auc, 9) AS worst_auc FROM ({SUMMARY_SQL}) WHERE k = 10 ORDER BY mean_auc DESC, var_auc ASC, model LIMIT 1""",
    FOLD_CTES))(
    lambda s, d: EV.generalization_report(EV.fold_summary(_fold_rows(s, d))).select(
        "winner", *[r(F.col(c)).alias(c) for c in ["mean_auc", "var_auc", "best_auc", "worst_auc"]]))

# ------------------------------------------------------------ D30-D32
MODEL_METRICS_CTE = ("mm", f"""SELECT * FROM (SELECT model, {rates_sql()} FROM (SELECT model, {CONF_SQL} FROM long_models GROUP BY 1))
    JOIN ({auc_sql('long_models', by='model')}) USING (model) JOIN ({prauc_sql('long_models', by='model', decimals=None)}) USING (model)""")
query("d30_lift_pp", with_ctes(
    """SELECT round((o.accuracy - b.accuracy) * 100, 9) AS lift_accuracy_pp, round((o.roc_auc - b.roc_auc) * 100, 9) AS lift_roc_auc_pp
       FROM (SELECT * FROM mm WHERE model = 'linear_a') b, (SELECT * FROM mm WHERE model = 'linear_b') o""",
    [MULTI_CTE, LONG_CTE, MODEL_METRICS_CTE]))(
    lambda s, d: EV.lift(EV.binary_metrics(long_models(s, d), ["model"]), "linear_a", "linear_b").select(
        r(F.col("lift_accuracy_pp")).alias("lift_accuracy_pp"), r(F.col("lift_roc_auc_pp")).alias("lift_roc_auc_pp")))


def _gap(spark, sf):
    sc = S(spark, sf)
    h = SA.stratified_holdout(sc, "application_id", "label").withColumn(
        "split", F.when(F.col("is_test"), "test").otherwise("train"))
    return EV.generalization_gap(EV.binary_metrics(h, ["split"])).select(
        r(F.col("gap_accuracy")).alias("gap_accuracy"), r(F.col("gap_roc_auc")).alias("gap_roc_auc"))


SPLIT_METRICS = ("sm", f"""SELECT * FROM (SELECT split, {rates_sql()} FROM (SELECT split, {CONF_SQL} FROM sp GROUP BY 1))
    JOIN ({auc_sql('sp', by='split')}) USING (split)""")
SP_CTE = ("sp", f"""SELECT *, CASE WHEN {_rn_sql(42)} <= round(0.15 * count(*) OVER (PARTITION BY label)) THEN 'test' ELSE 'train' END
    AS split FROM scored""")
query("d31_generalization_gap", with_ctes(
    """SELECT round(t.accuracy - s.accuracy, 9) AS gap_accuracy, round(t.roc_auc - s.roc_auc, 9) AS gap_roc_auc
       FROM (SELECT * FROM sm WHERE split = 'train') t, (SELECT * FROM sm WHERE split = 'test') s""",
    [SCORED_CTE, SP_CTE, SPLIT_METRICS]))(_gap)


def _compare(spark, sf):
    m = EV.binary_metrics(long_models(spark, sf).filter(F.col("model").isin("linear_b", "linear_a")), ["model"])
    base_auc = m.filter(F.col("model") == "linear_b").select("roc_auc").scalar()
    return m.select(F.when(F.col("model") == "linear_b", "baseline").otherwise("tuned").alias("variant"),
                    *[r(F.col(c)).alias(c) for c in EV.METRIC_COLS],
                    r(F.col("roc_auc") - base_auc).alias("auc_improvement"))


query("d32_baseline_vs_tuned", with_ctes(
    "SELECT CASE WHEN model = 'linear_b' THEN 'baseline' ELSE 'tuned' END AS variant, "
    + ", ".join(R9(c) for c in EV.METRIC_COLS)
    + ", round(roc_auc - (SELECT roc_auc FROM mm WHERE model = 'linear_b'), 9) AS auc_improvement "
      "FROM mm WHERE model IN ('linear_a', 'linear_b')", [MULTI_CTE, LONG_CTE, MODEL_METRICS_CTE]))(_compare)
query("d02_metrics_by_model", with_ctes(
    "SELECT model, " + ", ".join(R9(c) for c in EV.METRIC_COLS) + " FROM mm", [MULTI_CTE, LONG_CTE, MODEL_METRICS_CTE]))(
    lambda s, d: EV.binary_metrics(long_models(s, d), ["model"]).select(
        "model", *[r(F.col(c)).alias(c) for c in EV.METRIC_COLS]))


def _expansion(spark, sf):
    """Every row x each grid value, counted and averaged per grid point."""
    m = model_features(modelling_table(spark, sf))
    g = EX.percentile_grid(m, "diff_experience", 50)
    return EX.partial_dependence(m, MODEL_FEATURES, SCORER, "diff_experience", g, grid_decimals=6).drop("grid_value")


query("c05_row_grid_expansion", with_ctes(
    f"""SELECT g.i AS grid_index, count(*) AS n_rows, {grid_mean_sql(_prob_expr({'diff_experience': 'g.v'}))}
        AS mean_probability FROM feat, grid_e g GROUP BY g.i""", [_grid_cte("diff_experience", 50, "grid_e")]))(_expansion)
