"""Registered queries: scorer, splits, metrics, curves, sweeps, slices
(N15, B17-B19, B22, M1-M6, D1-D17, D29-D32, C6, C7, F2, F3, F5, G4, N8, N14, T10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake.functions.features import MODEL_FEATURES
from matchlake.functions.rules import confidence
from matchlake.operators import curves as CU
from matchlake.operators import metrics as ME
from matchlake.operators import sampling as SA
from matchlake.operators import slices as SL
from matchlake.functions.features import gap_columns
from matchlake.functions.numeric import grid_mean_sql, round_half_away
from matchlake.operators.scoring import (DEFAULT_WEIGHTS, linear_margin, score_linear,
                                       scored_applications, sigmoid)
from matchlake.plans.oracle_base import with_ctes
from matchlake.plans.registry import query, r
from matchlake.sources.adapter import modelling_table

# Alternative stored-weight models used for comparisons.
MODELS = {
    "linear_a": DEFAULT_WEIGHTS,
    "linear_b": {"intercept": -0.5, "diff_experience": 0.6, "diff_python": 0.03, "diff_ml": 0.01,
                 "diff_sql": 0.03, "diff_stats": 0.0, "diff_js": 0.0, "diff_ds": 0.01},
    "linear_c": {"intercept": -2.0, "diff_experience": 1.0, "diff_python": 0.01, "diff_ml": 0.01,
                 "diff_sql": 0.01, "diff_stats": 0.01, "diff_js": 0.01, "diff_ds": 0.01},
}


def _z_sql(w: dict) -> str:
    z = f"{float(w['intercept'])!r}::DOUBLE"
    for f in MODEL_FEATURES:
        z = f"({z} + {float(w[f])!r}::DOUBLE * {f})"
    return z


def prob_sql(w: dict) -> str:
    return f"round(1.0::DOUBLE / (1.0::DOUBLE + exp(-({_z_sql(w)}))), 6)"


SCORED_CTE = ("scored", f"""SELECT application_id, is_good_match AS label, education_level, years_experience,
    {prob_sql(DEFAULT_WEIGHTS)} AS probability,
    CAST({prob_sql(DEFAULT_WEIGHTS)} >= 0.5 AS INTEGER) AS prediction, 0.5::DOUBLE AS threshold FROM feat""")
MULTI_CTE = ("multi", "SELECT application_id, is_good_match AS label, education_level, " + ", ".join(
    f"{prob_sql(w)} AS p_{m}, CAST({prob_sql(w)} >= 0.5 AS INTEGER) AS y_{m}" for m, w in MODELS.items())
    + " FROM feat")


def S(spark, sf):
    return scored_applications(modelling_table(spark, sf))


def multi(spark, sf):
    """One row per application with a probability and decision per model."""
    m = modelling_table(spark, sf)
    g = gap_columns(m)
    cols = []
    for name, w in MODELS.items():
        p = round_half_away(sigmoid(linear_margin(g, w)), 6)
        cols += [p.alias(f"p_{name}"), (p >= 0.5).cast("int").alias(f"y_{name}")]
    return m.select("application_id", F.col("is_good_match").alias("label"), "education_level", *cols)


def long_models(spark, sf):
    """Stack of per-model rows (G4): model, label, probability, prediction."""
    rows = F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"p_{m}").alias("probability"),
                              F.col(f"y_{m}").alias("prediction")) for m in MODELS])
    return multi(spark, sf).select("application_id", "label", F.inline(rows))


LONG_CTE = ("long_models", " UNION ALL ".join(
    f"SELECT application_id, label, '{m}' AS model, p_{m} AS probability, y_{m} AS prediction FROM multi"
    for m in MODELS))

# ------------------------------------------------------------ scorer and decisions
query("n15_fixed_linear_scorer", with_ctes(
    "SELECT application_id, label, probability, prediction, threshold FROM scored", [SCORED_CTE]))(
    lambda s, d: S(s, d).select("application_id", "label", "probability", "prediction", "threshold"))
query("b17_decision_at_threshold", with_ctes(
    "SELECT application_id, probability, CAST(probability >= 0.45 AS INTEGER) AS prediction, "
    "0.45::DOUBLE AS threshold FROM scored", [SCORED_CTE]))(
    lambda s, d: score_linear(modelling_table(s, d), threshold=0.45, keep=["application_id"]))
query("b18_confidence", with_ctes(
    "SELECT application_id, abs(probability - 0.5) * 2 AS confidence FROM scored", [SCORED_CTE]))(
    lambda s, d: S(s, d).select("application_id", confidence(F.col("probability")).alias("confidence")))
query("b19_error_rows", with_ctes(
    "SELECT application_id, CASE WHEN label = 0 THEN 'false_positive' ELSE 'false_negative' END AS error_type, "
    "probability FROM scored WHERE label <> prediction", [SCORED_CTE]))(
    lambda s, d: SL.error_rows(S(s, d)).select("application_id", "error_type", "probability"))

# ------------------------------------------------------------ splits
HASH = "md5(CAST(application_id AS VARCHAR) || '-{seed}')"


def _rn_sql(seed, by="label"):
    part = f"PARTITION BY {by} " if by else ""
    return f"row_number() OVER ({part}ORDER BY {HASH.format(seed=seed)}, application_id)"


SPLIT_CTE = ("split1", f"""SELECT *, {_rn_sql(42)} AS rn, count(*) OVER (PARTITION BY label) AS n_cls FROM scored""")
query("m01_stratified_holdout", with_ctes(
    "SELECT application_id, label, rn <= round(0.15 * n_cls) AS is_test FROM split1", [SCORED_CTE, SPLIT_CTE]))(
    lambda s, d: SA.stratified_holdout(S(s, d).select("application_id", "label"), "application_id", "label"))
query("m01_holdout_class_counts", with_ctes(
    "SELECT label, count(*) FILTER (WHERE rn <= round(0.15 * n_cls)) AS n_test, "
    "count(*) FILTER (WHERE rn > round(0.15 * n_cls)) AS n_train FROM split1 GROUP BY label",
    [SCORED_CTE, SPLIT_CTE]))(
    lambda s, d: SA.stratified_holdout(S(s, d).select("application_id", "label"), "application_id", "label")
    .groupBy("label").agg(F.count_if("is_test").alias("n_test"), F.count_if(~F.col("is_test")).alias("n_train")))

THREE_CTE = ("split3", f"""SELECT application_id, label, CASE WHEN rn <= round(0.15 * n_cls) THEN 'test'
      WHEN rn2 <= round(0.1764 * n2) THEN 'calib' ELSE 'train' END AS split
  FROM (SELECT *, CASE WHEN rn > round(0.15 * n_cls) THEN row_number() OVER (
                 PARTITION BY label, rn > round(0.15 * n_cls) ORDER BY {HASH.format(seed='42b')}, application_id) END AS rn2,
               count(*) FILTER (WHERE rn > round(0.15 * n_cls)) OVER (PARTITION BY label) AS n2 FROM split1)""")
query("m02_three_way_split", with_ctes("SELECT * FROM split3", [SCORED_CTE, SPLIT_CTE, THREE_CTE]))(
    lambda s, d: SA.three_way_split(S(s, d).select("application_id", "label"), "application_id", "label"))
query("m03_stratified_kfold", with_ctes(
    f"SELECT application_id, label, CAST(({_rn_sql(42)} - 1) % 5 AS INTEGER) AS fold FROM scored", [SCORED_CTE]))(
    lambda s, d: SA.kfold(S(s, d).select("application_id", "label"), "application_id", 5, 42, "label"))
query("m04_plain_kfold", with_ctes(
    f"SELECT application_id, label, CAST(({_rn_sql(7, None)} - 1) % 5 AS INTEGER) AS fold FROM scored",
    [SCORED_CTE]))(
    lambda s, d: SA.kfold(S(s, d).select("application_id", "label"), "application_id", 5, 7))
FOLD_CTE = ("folds", f"SELECT *, CAST(({_rn_sql(42)} - 1) % 5 AS INTEGER) AS fold FROM scored")
query("m05_fold_class_check", with_ctes(
    "SELECT fold, count(*) AS val_rows, count(DISTINCT label) AS val_classes, "
    "CAST(sum(label) < (SELECT sum(label) FROM folds) AS INTEGER) + CAST(count(*) - sum(label) < "
    "(SELECT count(*) - sum(label) FROM folds) AS INTEGER) AS train_classes, "
    "count(DISTINCT label) = 2 AND CAST(sum(label) < (SELECT sum(label) FROM folds) AS INTEGER) + "
    "CAST(count(*) - sum(label) < (SELECT count(*) - sum(label) FROM folds) AS INTEGER) = 2 AS both_classes "
    "FROM folds GROUP BY fold", [SCORED_CTE, FOLD_CTE]))(
    lambda s, d: SA.fold_class_check(SA.kfold(S(s, d), "application_id", 5, 42, "label")))
query("m06_balanced_weights", with_ctes(
    "SELECT application_id, label, (SELECT count(*) FROM scored) / (2.0::DOUBLE * count(*) OVER (PARTITION BY label)) "
    "AS weight FROM scored", [SCORED_CTE]))(
    lambda s, d: SA.balanced_weights(S(s, d).select("application_id", "label")))

# ------------------------------------------------------------ D1-D3, D6, D13, D29, B22
CONF_SQL = ("count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, "
            "count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp, "
            "count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, "
            "count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp")


def rates_sql(tn="tn", fp="fp", fn="fn", tp="tp"):
    d = lambda a, b: f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"
    return (f"{d(f'{tp} + {tn}', f'{tp} + {tn} + {fp} + {fn}')} AS accuracy, {d(tp, f'{tp} + {fp}')} AS precision, "
            f"{d(tp, f'{tp} + {fn}')} AS recall, {d(f'2 * {tp}', f'2 * {tp} + {fp} + {fn}')} AS f1")


query("d01_confusion_counts", with_ctes(f"SELECT {CONF_SQL} FROM scored", [SCORED_CTE]))(
    lambda s, d: ME.confusion(S(s, d)))
query("d02_binary_rates", with_ctes(
    f"SELECT *, {rates_sql()} FROM (SELECT {CONF_SQL} FROM scored)", [SCORED_CTE]))(
    lambda s, d: ME.binary_rates(S(s, d)))
query("d02_rates_by_education", with_ctes(
    f"SELECT *, {rates_sql()} FROM (SELECT education_level, {CONF_SQL} FROM scored GROUP BY 1)", [SCORED_CTE]))(
    lambda s, d: ME.binary_rates(S(s, d), ["education_level"]))


def _report_sql():
    d = lambda a, b: f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) END"
    p0, r0 = d("tn", "tn + fn"), d("tn", "tn + fp")
    p1, r1 = d("tp", "tp + fp"), d("tp", "tp + fn")
    f = lambda p, r_: f"CASE WHEN ({p}) + ({r_}) = 0 THEN 0.0 ELSE 2 * ({p}) * ({r_}) / (({p}) + ({r_})) END"
    n = "(tn + fp + fn + tp)"
    acc = d("tp + tn", n)
    s0, s1 = "CAST(tn + fp AS DOUBLE)", "CAST(fn + tp AS DOUBLE)"
    w = lambda a, b: d(f"({a}) * {s0} + ({b}) * {s1}", n)
    rows = [f"SELECT '0' AS class, {p0} AS precision, {r0} AS recall, {f(p0, r0)} AS f1, {s0} AS support FROM c",
            f"SELECT '1', {p1}, {r1}, {f(p1, r1)}, {s1} FROM c",
            f"SELECT 'accuracy', {acc}, {acc}, {acc}, CAST({n} AS DOUBLE) FROM c",
            f"SELECT 'macro avg', (({p0}) + ({p1})) / 2, (({r0}) + ({r1})) / 2, ({f(p0, r0)} + {f(p1, r1)}) / 2, "
            f"CAST({n} AS DOUBLE) FROM c",
            f"SELECT 'weighted avg', {w(p0, p1)}, {w(r0, r1)}, {w(f(p0, r0), f(p1, r1))}, CAST({n} AS DOUBLE) FROM c"]
    return " UNION ALL ".join(rows)


query("d03_classification_report", with_ctes(
    _report_sql(), [SCORED_CTE, ("c", f"SELECT {CONF_SQL} FROM scored")]))(
    lambda s, d: ME.classification_report(S(s, d)))
query("d06_brier_score", with_ctes(
    "SELECT round(avg(pow(probability - label, 2)), 9) AS brier_score FROM scored", [SCORED_CTE]))(
    lambda s, d: ME.brier(S(s, d)).select(r(F.col("brier_score")).alias("brier_score")))
query("d13_expected_cost", with_ctes(
    f"SELECT *, fp * 500.0::DOUBLE + fn * 2000.0::DOUBLE AS expected_cost FROM (SELECT {CONF_SQL} FROM scored)", [SCORED_CTE]))(
    lambda s, d: ME.expected_cost(S(s, d)))
query("d29_batch_summary", with_ctes(
    "SELECT count(*) AS batch_size, CAST(coalesce(sum(prediction), 0) AS BIGINT) AS positives FROM scored",
    [SCORED_CTE]))(lambda s, d: ME.batch_summary(S(s, d)))

# ------------------------------------------------------------ D4, D5, D7-D12, C6
AUC_SQL = """SELECT {g}CASE WHEN sum(pos) = 0 OR sum(neg) = 0 THEN NULL ELSE
    CAST(sum(2 * pos * neg_below + pos * neg) AS DOUBLE) / (2.0 * sum(pos) * sum(neg)) END AS {name}
  FROM (SELECT *, coalesce(sum(neg) OVER (PARTITION BY {p} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
        FROM (SELECT {g}{score} AS score, sum(label) AS pos, sum(1 - label) AS neg FROM {src} GROUP BY ALL)) {grp}"""


def auc_sql(src, score="probability", by=None, name="roc_auc"):
    g = f"{by}, " if by else ""
    return AUC_SQL.format(g=g, p=by or "NULL", score=score, src=src, name=name,
                          grp=f"GROUP BY {by}" if by else "")


query("d04_roc_auc", with_ctes(auc_sql("scored"), [SCORED_CTE]))(lambda s, d: CU.roc_auc(S(s, d)))
query("d04_roc_auc_by_model", with_ctes(auc_sql("long_models", by="model"), [MULTI_CTE, LONG_CTE]))(
    lambda s, d: CU.roc_auc(long_models(s, d), ["model"]))

CUM_SQL = """SELECT {g}score, pos, neg,
    sum(pos) OVER (PARTITION BY {p} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
    sum(neg) OVER (PARTITION BY {p} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp,
    sum(pos) OVER (PARTITION BY {p}) AS "P", sum(neg) OVER (PARTITION BY {p}) AS "N"
  FROM (SELECT {g}{score} AS score, sum(label) AS pos, sum(1 - label) AS neg FROM {src} GROUP BY ALL)"""


def cum_sql(src, score="probability", by=None):
    return CUM_SQL.format(g=f"{by}, " if by else "", p=by or "NULL", score=score, src=src)


def prauc_sql(src, score="probability", by=None, name="pr_auc", decimals=9):
    g = f"{by}, " if by else ""
    total = "sum((r - r0) * (p + p0) / 2)"
    total = f"round({total}, {decimals})" if decimals is not None else total
    return f"""SELECT {g}{total} AS {name} FROM (
    SELECT *, coalesce(lag(r) OVER (PARTITION BY {by or 'NULL'} ORDER BY score DESC), 0.0) AS r0,
              coalesce(lag(p) OVER (PARTITION BY {by or 'NULL'} ORDER BY score DESC), 1.0) AS p0
    FROM (SELECT {g}score, tp / "P" AS r, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS p
          FROM ({cum_sql(src, score, by)}))) {'GROUP BY ' + by if by else ''}"""


query("d05_pr_auc", with_ctes(prauc_sql("scored"), [SCORED_CTE]))(
    lambda s, d: CU.pr_auc(S(s, d)).select(r(F.col("pr_auc")).alias("pr_auc")))
query("d05_pr_auc_by_model", with_ctes(prauc_sql("long_models", by="model"), [MULTI_CTE, LONG_CTE]))(
    lambda s, d: CU.pr_auc(long_models(s, d), ["model"]).select("model", r(F.col("pr_auc")).alias("pr_auc")))
query("e02_cumulative_counts", with_ctes(
    f"SELECT score, pos, neg, tp, fp FROM ({cum_sql('scored')})", [SCORED_CTE]))(
    lambda s, d: CU.cumulative_counts(S(s, d)).select("score", "pos", "neg", "tp", "fp"))
query("d07_reliability_curve", with_ctes(
    "SELECT least(greatest(CAST(ceil(probability * 10) AS INTEGER) - 1, 0), 9) AS bin, "
    f"{grid_mean_sql('probability')} AS mean_predicted, round(avg(CAST(label AS DOUBLE)), 9) AS fraction_positive, "
    "count(*) AS n FROM scored GROUP BY 1", [SCORED_CTE]))(
    lambda s, d: CU.reliability(S(s, d), grid_decimals=6).select("bin", "mean_predicted",
                                                r(F.col("fraction_positive")).alias("fraction_positive"), "n"))
query("d08_roc_curve", with_ctes(
    """SELECT score AS threshold, fp / "N" AS fpr, tp / "P" AS tpr FROM (
         SELECT *, lead(tp) OVER w - 2 * tp + lag(tp) OVER w AS dtp, lead(fp) OVER w - 2 * fp + lag(fp) OVER w AS dfp,
                lead(tp) OVER w IS NULL OR lag(tp) OVER w IS NULL AS edge
         FROM (""" + cum_sql("scored") + """) WINDOW w AS (ORDER BY score DESC))
       WHERE edge OR dtp <> 0 OR dfp <> 0
       UNION ALL SELECT 'inf'::DOUBLE, 0.0, 0.0""", [SCORED_CTE]))(lambda s, d: CU.roc_points(S(s, d)))
query("d09_pr_curve", with_ctes(
    """SELECT score AS threshold, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
              tp / "P" AS recall FROM (""" + cum_sql("scored") + """)
       UNION ALL SELECT NULL, 1.0, 0.0""", [SCORED_CTE]))(lambda s, d: CU.pr_points(S(s, d)))

GRID_F1 = CU.arange_grid(0.1, 0.9, 0.05)
GRID_COST = CU.linspace_grid(0.01, 0.99, 99)


def grid_sql(grid):
    return "SELECT * FROM (VALUES " + ", ".join(f"({i}, {t!r}::DOUBLE)" for i, t in enumerate(grid)) + ") g(i, threshold)"


def sweep_sql(src, grid, cost_fp=1.0, cost_fn=5.0, by=None):
    g = f"s.{by}, " if by else ""
    gb = f"GROUP BY {by}, " if by else "GROUP BY "
    return f"""SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
        CASE WHEN "P" = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / "P" END AS recall,
        CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1,
        CASE WHEN "P" + "N" = 0 THEN 0.0 ELSE CAST(tp + tn AS DOUBLE) / ("P" + "N") END AS accuracy,
        fp * {cost_fp!r}::DOUBLE + fn * {cost_fn!r}::DOUBLE AS cost FROM (
      SELECT {g}g.i, g.threshold,
             count(*) FILTER (WHERE s.label = 1 AND s.probability >= g.threshold) AS tp,
             count(*) FILTER (WHERE s.label = 0 AND s.probability >= g.threshold) AS fp,
             count(*) FILTER (WHERE s.label = 1 AND s.probability < g.threshold) AS fn,
             count(*) FILTER (WHERE s.label = 0 AND s.probability < g.threshold) AS tn,
             count(*) FILTER (WHERE s.label = 1) AS "P", count(*) FILTER (WHERE s.label = 0) AS "N"
      FROM {src} s, ({grid_sql(grid)}) g {gb}g.i, g.threshold)"""


SWEEP_COLS = ["i", "threshold", "tp", "fp", "fn", "tn", "precision", "recall", "f1", "accuracy", "cost"]
query("c06_threshold_sweep", with_ctes(
    "SELECT " + ", ".join(SWEEP_COLS) + " FROM (" + sweep_sql("scored", GRID_COST) + ")", [SCORED_CTE]))(
    lambda s, d: CU.threshold_sweep(S(s, d), GRID_COST).select(*SWEEP_COLS))
query("d10_best_f1_grid", with_ctes(
    "SELECT CASE WHEN max(f1) > 0 THEN arg_max(threshold, f1 * 1000 - i / 1000.0) ELSE 0.5 END AS best_threshold, "
    "CASE WHEN max(f1) > 0 THEN max(f1) ELSE 0.0 END AS best_f1 FROM (" + sweep_sql("scored", GRID_F1) + ")",
    [SCORED_CTE]).replace("arg_max(threshold, f1 * 1000 - i / 1000.0)",
                          "first(threshold ORDER BY f1 DESC, i)"))(
    lambda s, d: CU.best_f1_threshold(CU.threshold_sweep(S(s, d), GRID_F1)))
query("d12_min_cost_threshold", with_ctes(
    "SELECT first(threshold ORDER BY cost, i) AS best_threshold, min(cost) AS min_cost, "
    "first(fp ORDER BY cost, i) AS fp, first(fn ORDER BY cost, i) AS fn FROM (" + sweep_sql("scored", GRID_COST) + ")",
    [SCORED_CTE]))(lambda s, d: CU.min_cost_threshold(CU.threshold_sweep(S(s, d), GRID_COST)))
query("d11_best_f1_observed", with_ctes(
    """SELECT CASE WHEN max(f1) > 0 THEN first(score ORDER BY f1 DESC, score) ELSE 0.5 END AS best_threshold,
              CASE WHEN max(f1) > 0 THEN max(f1) ELSE 0.0 END AS best_f1
       FROM (SELECT score, CASE WHEN tp + fp + "P" = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (tp + fp + "P") END AS f1
             FROM (""" + cum_sql("scored") + "))", [SCORED_CTE]))(lambda s, d: CU.best_f1_observed(S(s, d)))

# ------------------------------------------------------------ D14-D16, C7
query("d14_segment_metrics", with_ctes(
    f"""SELECT segment, accuracy, f1 FROM (SELECT *, {rates_sql()} FROM (
      SELECT CASE WHEN years_experience <= (SELECT quantile_cont(years_experience, 0.5) FROM scored)
                  THEN 'freshers' ELSE 'experienced' END AS segment, {CONF_SQL}
      FROM scored GROUP BY 1))""", [SCORED_CTE]))(
    lambda s, d: SL.segment_by_median(S(s, d), "years_experience").select("segment", "accuracy", "f1"))
query("d15_fairness_gap", with_ctes(
    """SELECT max(f1) - min(f1) AS fairness_gap, max(f1) - min(f1) > 0.2 AS flagged, min(f1) AS min_f1,
              max(f1) AS max_f1, count(*) AS n_segments FROM (
      SELECT education_level, CASE WHEN sum(label) = 0 AND sum(prediction) = 0 THEN 1.0
          WHEN 2 * count(*) FILTER (WHERE label = 1 AND prediction = 1) + count(*) FILTER (WHERE label <> prediction) = 0 THEN 0.0
          ELSE CAST(2 * count(*) FILTER (WHERE label = 1 AND prediction = 1) AS DOUBLE) /
               (2 * count(*) FILTER (WHERE label = 1 AND prediction = 1) + count(*) FILTER (WHERE label <> prediction)) END AS f1
      FROM scored GROUP BY 1)""", [SCORED_CTE]))(
    lambda s, d: SL.fairness_gap(S(s, d), "education_level"))
_PAIRS = [(a, b) for i, a in enumerate(MODELS) for b in list(MODELS)[i + 1:]]
query("c07_model_pair_disagreement", with_ctes(" UNION ALL ".join(
    f"SELECT '{a}' AS model_a, '{b}' AS model_b, round(avg(CAST(y_{a} <> y_{b} AS DOUBLE)), 9) AS disagreement FROM multi"
    for a, b in _PAIRS), [MULTI_CTE]))(
    lambda s, d: SL.pairwise_disagreement(multi(s, d), list(MODELS)).select(
        "model_a", "model_b", r(F.col("disagreement")).alias("disagreement")))
query("d16_mean_disagreement", with_ctes(
    "SELECT round(avg(disagreement), 9) AS mean_disagreement FROM (" + " UNION ALL ".join(
        f"SELECT avg(CAST(y_{a} <> y_{b} AS DOUBLE)) AS disagreement FROM multi" for a, b in _PAIRS) + ")",
    [MULTI_CTE]))(
    lambda s, d: SL.pairwise_disagreement(multi(s, d), list(MODELS)).agg(
        r(F.avg("disagreement")).alias("mean_disagreement")))
query("b22_quality_gates", with_ctes(
    f"""SELECT a.roc_auc, b.accuracy, a.roc_auc > 0.75 AS auc_gate, b.accuracy > 0.65 AS accuracy_gate,
              a.roc_auc > 0.75 AND b.accuracy > 0.65 AS all_passed
       FROM ({auc_sql('scored')}) a, (SELECT {rates_sql()} FROM (SELECT {CONF_SQL} FROM scored)) b""", [SCORED_CTE]))(
    lambda s, d: ME.quality_gates(ME.binary_rates(S(s, d)).select(
        CU.roc_auc(S(s, d)).select("roc_auc").scalar().alias("roc_auc"), "accuracy")))

# ------------------------------------------------------------ E1, E4, F3, F5, C8
query("e01_fold_row_numbers", with_ctes(
    f"SELECT application_id, label, {_rn_sql(42)} AS rn FROM scored", [SCORED_CTE]))(
    lambda s, d: SA.exact_row_number(S(s, d).select("application_id", "label"), "application_id", 42, ["label"]))


def _step_areas(spark, sf):
    c = CU.cumulative_counts(S(spark, sf))
    tp, fp, tp0, fp0 = (F.col(x) for x in ("tp", "fp", "tp0", "fp0"))
    c = c.select("*", (F.col("tp") - F.col("pos")).alias("tp0"), (F.col("fp") - F.col("neg")).alias("fp0"))
    before = F.when(tp0 + fp0 == 0, F.lit(1.0)).otherwise(ME.ratio(tp0, tp0 + fp0))
    return c.select("score", r((tp / F.col("P") - tp0 / F.col("P")) * (ME.ratio(tp, tp + fp) + before) / 2).alias("step_area"))


query("e04_pr_step_areas", with_ctes(
    f"""SELECT score, round((r - coalesce(lag(r) OVER (ORDER BY score DESC), 0.0)) *
          (p + coalesce(lag(p) OVER (ORDER BY score DESC), 1.0)) / 2, 9) AS step_area FROM (
        SELECT score, tp / "P" AS r, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS p
        FROM ({cum_sql('scored')}))""", [SCORED_CTE]))(_step_areas)
query("f03_first_argmax_f1_on_cost_grid", with_ctes(
    "SELECT first(threshold ORDER BY f1 DESC, i) AS best_threshold, max(f1) AS best_f1 FROM ("
    + sweep_sql("scored", GRID_COST) + ")", [SCORED_CTE]))(
    lambda s, d: CU.threshold_sweep(S(s, d), GRID_COST).agg(
        F.max_by("threshold", F.struct(F.col("f1"), -F.col("i"))).alias("best_threshold"),
        F.max("f1").alias("best_f1")))
query("f05_seeded_sample", with_ctes(
    """SELECT application_id, probability, threshold, prediction AS final_prediction FROM scored
       ORDER BY md5(CAST(application_id AS VARCHAR) || '-42'), application_id LIMIT 10""", [SCORED_CTE]))(
    lambda s, d: S(s, d).orderBy(SA.order_hash("application_id", 42), "application_id").limit(10).select(
        "application_id", "probability", "threshold", F.col("prediction").alias("final_prediction")))


def _attach(spark, sf):
    """Gaps, rule outcomes and the score attached in one projection (no join)."""
    from matchlake.functions.rules import threshold_columns
    m = modelling_table(spark, sf)
    g, rl = gap_columns(m), threshold_columns(m)
    p = round_half_away(sigmoid(linear_margin(g, DEFAULT_WEIGHTS)), 6)
    return m.select("application_id", *[g[f].alias(f) for f in MODEL_FEATURES],
                    *[rl[k].alias(k) for k in ("experience", "python", "sql")], p.alias("probability"))


query("c08_attach_columns", with_ctes(
    f"SELECT application_id, {', '.join(MODEL_FEATURES)}, coalesce(years_experience >= exp_required_years, false) AS experience, "
    "coalesce(python_score >= python_required, false) AS python, coalesce(sql_score >= sql_required, false) AS sql, "
    f"{prob_sql(DEFAULT_WEIGHTS)} AS probability FROM feat"))(_attach)
