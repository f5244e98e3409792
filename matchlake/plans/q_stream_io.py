"""Registered queries: streaming jobs and their batch twins (U1-U3), file
sources and sinks (A1, A3-A5)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from matchlake.operators import metrics as ME
from matchlake.operators import curves as CU
from matchlake.plans.oracle_base import with_ctes
from matchlake.plans.q_features import POSTINGS_CTE, _viol_sql
from matchlake.plans.q_metrics import SCORED_CTE, S
from matchlake.plans.registry import query
from matchlake.session import shared_path
from matchlake.sources import adapter as AD
from matchlake.sources import files as FI
from matchlake.sources.postings import request_log
from matchlake.sources.tables import table
from matchlake.streaming import jobs as ST

# ------------------------------------------------------------ U1-U3 (V)
U01_SQL = """SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start,
    time_bucket(INTERVAL 1 hour, ts) + INTERVAL 1 hour AS window_end, count(*) AS total_requests,
    count(*) FILTER (WHERE event_type = 'error') AS total_errors, coalesce(round(avg(value), 4), 0.0) AS avg_latency
  FROM events GROUP BY 1, 2"""
query("u01_request_metrics_windowed", U01_SQL)(lambda s, d: ST.windowed_request_metrics(request_log(s, d)))
query("u01_request_metrics_stream", U01_SQL)(lambda s, d: ST.run_request_metrics(s, d))
query("u02_posting_ingest_stream", with_ctes("""SELECT url, id, title, published_at FROM (
    SELECT regexp_replace(url, '[?#].*$', '') AS url, id, title, published_at,
           row_number() OVER (PARTITION BY regexp_replace(url, '[?#].*$', '') ORDER BY id) AS rn
    FROM postings) WHERE rn = 1""", [POSTINGS_CTE]))(lambda s, d: ST.run_posting_ingest(s, d))
query("u03_continuous_scoring_stream", with_ctes(
    "SELECT application_id, probability, prediction, threshold FROM scored", [SCORED_CTE]))(
    lambda s, d: ST.run_continuous_scoring(s, d)[0])
query("u03_quarantine_stream", with_ctes(
    f"SELECT application_id, {_viol_sql()} AS violations FROM modelling WHERE {_viol_sql()} <> ''"))(
    lambda s, d: ST.run_continuous_scoring(s, d)[1])



def damaged(rows):
    """Stand-in for bad arrivals: some scores below 0, over 100 or not a number."""
    i = F.col("application_id")
    return rows.withColumn("python_score", F.when(i % 97 == 0, F.lit(101.5)).when(i % 89 == 0, F.lit(-1.0))
                           .otherwise(F.col("python_score"))) \
        .withColumn("sql_score", F.when(i % 83 == 0, F.lit(float("nan"))).otherwise(F.col("sql_score")))


query("u03_quarantine_of_bad_arrivals", with_ctes(
    f"SELECT application_id, {_viol_sql()} AS violations FROM damaged WHERE {_viol_sql()} <> ''",
    [("damaged", """SELECT * REPLACE (
        CASE WHEN application_id % 97 = 0 THEN 101.5 WHEN application_id % 89 = 0 THEN -1.0 ELSE python_score END AS python_score,
        CASE WHEN application_id % 83 = 0 THEN 'NaN'::DOUBLE ELSE sql_score END AS sql_score) FROM modelling""")]))(
    lambda s, d: ST.run_continuous_scoring(s, d, arrive=damaged)[1])

# ------------------------------------------------------------ A1 / A3 round trip (V)
CAND_SCHEMA = ("candidate_id long, name string, education_level string, years_experience int, location string, "
               "python_score double, sql_score double, ml_score double, javascript_score double, "
               "data_structures_score double, statistics_score double, expected_salary_inr long")


def _csv_roundtrip(spark, sf):
    path = shared_path(spark, f"csv/candidates-{uuid.uuid4().hex[:12]}")
    FI.write_csv(AD.candidates(spark, sf), path)
    return FI.read_csv(spark, path, CAND_SCHEMA)


query("a01_a03_csv_roundtrip", with_ctes("SELECT * FROM candidates"))(_csv_roundtrip)


def _report(spark, sf):
    base = shared_path(spark, f"reports/{uuid.uuid4().hex[:12]}")
    sc = S(spark, sf)
    rates = ME.binary_rates(sc).select("accuracy", "precision", "recall", "f1")
    auc = CU.roc_auc(sc)
    run = {"dataset": "modelling_table", "model_name": "linear_a", "model_version": "1"}
    FI.write_report({"binary_metrics": rates, "roc_auc": auc}, base, run)
    back = spark.read.json(f"{base}/binary_metrics")
    return back.select("accuracy", "precision", "recall", "f1", "dataset", "model_name", "model_version")


query("a04_report_sink_readback", with_ctes(
    """SELECT CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn) AS accuracy,
        CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
        CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
        CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) END AS f1,
        'modelling_table' AS dataset, 'linear_a' AS model_name, '1' AS model_version FROM (
      SELECT count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp
      FROM scored)""", [SCORED_CTE]))(_report)


def _vectors(spark, sf):
    path = shared_path(spark, f"vectors/{uuid.uuid4().hex[:12]}")
    e = table(spark, sf, "embeddings")
    n = e.count()
    apps = AD.applications(spark, sf).select("application_id", "candidate_id", "job_id")
    rv = e.select(F.col("vec_id").alias("rid"), F.col("embedding").alias("resume_vector"))
    jv = e.select(F.col("vec_id").alias("jid"), F.col("embedding").alias("job_vector"))
    out = (apps.select("application_id", (F.col("candidate_id") % n).alias("rid"),
                       ((F.col("job_id") * 7 + 3) % n).alias("jid"))
               .join(rv, "rid").join(jv, "jid").select("application_id", "resume_vector", "job_vector"))
    FI.write_vectors(out, path)
    return spark.read.parquet(path)


query("a05_embedding_sink_readback", with_ctes(
    """SELECT a.application_id, r.embedding AS resume_vector, j.embedding AS job_vector FROM modelling a
       JOIN embeddings r ON r.vec_id = a.candidate_id % (SELECT count(*) FROM embeddings)
       JOIN embeddings j ON j.vec_id = (a.job_id * 7 + 3) % (SELECT count(*) FROM embeddings)"""))(_vectors)
