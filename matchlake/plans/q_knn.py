"""Registered queries: exact k-NN join and k-NN classifier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.functions.features import MODEL_FEATURES, model_features
from matchlake.operators import knn
from matchlake.operators import sampling as SA
from matchlake.operators.small import num, one_row
from matchlake.plans.oracle_base import with_ctes
from matchlake.plans.registry import query, r
from matchlake.session import cut_lineage
from matchlake.sources.adapter import REQ_COLS, SCORE_COLS, candidates, jobs, modelling_table

K = 15
KEY = "application_id"
Z = [f"z_{f}" for f in MODEL_FEATURES]


def scaled_split(spark, sf) -> DataFrame:
    """Holdout split (M1) of the modelling rows, features scaled by the training
    side's mean and population deviation (to 6 decimals, so that both engines see the same vectors)."""
    m = model_features(modelling_table(spark, sf), [KEY, "is_good_match"]).withColumnRenamed("is_good_match", "label")
    split = cut_lineage(SA.stratified_holdout(m, KEY, "label"))
    train = split.where(~F.col("is_test"))
    s = one_row(train.agg(*[F.avg(f).alias(f"m_{f}") for f in MODEL_FEATURES],
                          *[F.stddev_pop(f).alias(f"s_{f}") for f in MODEL_FEATURES]))
    return split.select(KEY, "label", "is_test", *[
        r((F.col(f) - num(s[f"m_{f}"])) / num(s[f"s_{f}"] or 1.0), 6).alias(z) for f, z in zip(MODEL_FEATURES, Z)])


SPLIT = [
    ("ranked", f"""SELECT *, row_number() OVER (PARTITION BY is_good_match ORDER BY
        md5(concat(application_id, '-42')), application_id) AS rn, count(*) OVER (PARTITION BY is_good_match) AS n_cls FROM feat"""),
    ("halves", "SELECT *, is_good_match AS label, rn <= round(0.15 * n_cls) AS is_test FROM ranked"),
    ("stats", "SELECT " + ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in MODEL_FEATURES)
     + " FROM halves WHERE NOT is_test"),
    ("scaled", "SELECT application_id, label, is_test, " + ", ".join(
        f"round(({f} - m_{f}) / CASE WHEN s_{f} = 0 THEN 1.0 ELSE s_{f} END, 6) AS {z}" for f, z in zip(MODEL_FEATURES, Z))
     + " FROM halves, stats"),
    ("near", f"""SELECT application_id, label, unnest(hits) AS hit, generate_subscripts(hits, 1) AS rank FROM (
        SELECT q.application_id, any_value(q.label) AS label, min(struct_pack(d2 := {' + '.join(
            f'(q.{z} - t.{z}) * (q.{z} - t.{z})' for z in Z)}, id := t.application_id, label := t.label), {K}) AS hits
        FROM scaled q, scaled t WHERE q.is_test AND NOT t.is_test GROUP BY q.application_id)"""),
]


def _halves(spark, sf):
    rows = scaled_split(spark, sf)
    return rows.where("is_test"), rows.where("not is_test")


def _join(spark, sf):
    """Each holdout application's 15 nearest training applications."""
    test, train = _halves(spark, sf)
    found = knn.knn_join(test, KEY, train, KEY, Z, K)
    return found.select(F.col("query").alias(KEY), "rank", "neighbour", r(F.col("distance")).alias("distance"))


query("c04_knn_join", with_ctes(
    "SELECT application_id, rank, hit.id AS neighbour, round(sqrt(hit.d2), 9) AS distance FROM near", SPLIT))(_join)


def _classifier(spark, sf):
    """The share of matches among the 15 nearest training applications."""
    test, train = _halves(spark, sf)
    found = knn.knn_probability(test, KEY, train, KEY, Z, "label", K).withColumnRenamed("query", KEY)
    return test.select(KEY, "label").join(found, KEY).select(
        KEY, "label", "probability", (F.col("probability") > 0.5).cast("int").alias("prediction"))


query("n06_knn_classifier", with_ctes(
    f"""SELECT application_id, label, probability, CAST(probability > 0.5 AS INTEGER) AS prediction FROM (
      SELECT application_id, label, sum(hit.label) / CAST(count(*) AS DOUBLE) AS probability FROM near
      GROUP BY application_id, label)""", SPLIT))(_classifier)

SKILL = [f"skill_{i}" for i in range(len(SCORE_COLS))]


def _candidates_of_jobs(spark, sf):
    """The five candidates whose skill scores lie nearest to each job's requirements."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    asked = jobs(spark, sf).select("job_id", *[zero(c).alias(s) for c, s in zip(REQ_COLS, SKILL)])
    stored = candidates(spark, sf).select("candidate_id", *[zero(c).alias(s) for c, s in zip(SCORE_COLS, SKILL)])
    found = knn.knn_join(asked, "job_id", stored, "candidate_id", SKILL, 5)
    return found.select(F.col("query").alias("job_id"), "rank", F.col("neighbour").alias("candidate_id"),
                        r(F.col("distance")).alias("distance"))


GAP = [f"(coalesce(j.{q}, 0.0) - coalesce(c.{s}, 0.0))" for q, s in zip(REQ_COLS, SCORE_COLS)]
query("e03_nearest_candidates", with_ctes(
    f"""SELECT job_id, rank, candidate_id, round(sqrt(d2), 9) AS distance FROM (
      SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY d2, candidate_id) AS rank FROM (
        SELECT j.job_id, c.candidate_id, {' + '.join(f'{g} * {g}' for g in GAP)} AS d2 FROM jobs j, candidates c))
      WHERE rank <= 5"""))(_candidates_of_jobs)
