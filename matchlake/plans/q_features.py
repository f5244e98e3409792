"""Registered queries: adapter, joins, gap features, rules, board (A, B, C1-C2, F1, G1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake.functions import features as FE
from matchlake.functions import rules as RU
from matchlake.functions.numeric import grid_mean, grid_mean_sql
from matchlake.operators import board as BO
from matchlake.operators import prep as PR
from matchlake.plans.oracle_base import edu_rank_sql, with_ctes
from matchlake.plans.registry import query, r
from matchlake.sources import adapter as AD
from matchlake.sources.adapter import REQ_COLS, SCORE_COLS
from matchlake.sources.postings import (PUBLISHED_EPOCH_S, PUBLISHED_MULT, PUBLISHED_SPREAD_S, epoch_ntz,
                                        postings, request_log)

M = AD.modelling_table
MODEL_FEATS = ", ".join(FE.MODEL_FEATURES)

# ------------------------------------------------------------ flagship
RULE_SQL = {
    "experience": "coalesce(years_experience >= exp_required_years, false)",
    "education": f"{edu_rank_sql('education_level')} >= {edu_rank_sql('edu_minimum')}",
    "python": "coalesce(python_score >= python_required, false)",
    "sql": "coalesce(sql_score >= sql_required, false)",
    "machine_learning": "coalesce(ml_score >= ml_required, false)",
    "salary": "coalesce(salary_offered_inr >= expected_salary_inr, false)",
    "location": "true",
}
RULES_CTE = ("rules", "SELECT *, " + ", ".join(f"{v} AS {k}" for k, v in RULE_SQL.items()) + " FROM feat")


def title_summary(spark, sf):
    """Per-title pass rate of all competency rules, match rate and mean gaps."""
    m = M(spark, sf)
    cols = FE.gap_columns(m)
    rules = RU.threshold_columns(m)
    all_pass = F.lit(True)
    for c in rules.values():
        all_pass = all_pass & c
    return (m.select("title", "is_good_match", all_pass.alias("all_pass"),
                     *[cols[f].alias(f) for f in FE.MODEL_FEATURES])
             .groupBy("title")
             .agg(F.count(F.lit(1)).alias("n_applications"),
                  r(F.avg("is_good_match")).alias("match_rate"),
                  r(F.avg(F.col("all_pass").cast("int"))).alias("all_rules_pass_rate"),
                  # gaps live on the 0.1 grid: exact integer-sum means
                  *[grid_mean(F.col(f), 1).alias(f"mean_{f}") for f in FE.MODEL_FEATURES]))


query("q00_title_summary", with_ctes(
    "SELECT title, count(*) AS n_applications, round(avg(is_good_match), 9) AS match_rate, "
    "round(avg(CAST(" + " AND ".join(RULE_SQL) + " AS INTEGER)), 9) AS all_rules_pass_rate, "
    + ", ".join(f"{grid_mean_sql(f, 1)} AS mean_{f}" for f in FE.MODEL_FEATURES)
    + " FROM rules GROUP BY title", [RULES_CTE]))(title_summary)

# ------------------------------------------------------------ adapter / joins
query("a02_modelling_table", with_ctes("SELECT * FROM modelling"))(M)
query("c01_application_candidate_job", with_ctes(
    "SELECT application_id, candidate_id, job_id, name, title, company, location_student, "
    "location_job, is_good_match FROM modelling"))(
    lambda s, d: M(s, d).select("application_id", "candidate_id", "job_id", "name", "title",
                                "company", "location_student", "location_job", "is_good_match"))
query("a08_candidates", with_ctes("SELECT * FROM candidates"))(AD.candidates)
query("a08_jobs", with_ctes("SELECT * FROM jobs"))(AD.jobs)

# ------------------------------------------------------------ B: projections
query("b01_drop_leakage", with_ctes(
    "SELECT * EXCLUDE (application_id, candidate_id, job_id, name, application_date) FROM modelling"))(
    lambda s, d: FE.drop_leakage(M(s, d)))
query("b02_split_label", with_ctes("SELECT application_id, is_good_match AS label FROM modelling"))(
    lambda s, d: M(s, d).select("application_id", F.col("is_good_match").alias("label")))


def fill_or_create(spark, sf):
    m = M(spark, sf).drop("javascript_required")  # an absent column is created as 0
    return m.select("application_id", *[FE.filled(m, c).alias(c) for c in SCORE_COLS + REQ_COLS])


query("b03_fill_or_create", with_ctes(
    "SELECT application_id, " + ", ".join(
        f"coalesce({c}, 0.0) AS {c}" if c != "javascript_required" else "0.0::DOUBLE AS javascript_required"
        for c in SCORE_COLS + REQ_COLS) + " FROM modelling"))(fill_or_create)


def _feature_query(names):
    def run(spark, sf):
        return FE.gap_features(M(spark, sf), ["application_id"], names)
    return run


for qid, names in [("b04_diff_experience", ["diff_experience"]),
                   ("b05_skill_gaps", FE.GAP_NAMES),
                   ("b06_diff_salary", ["diff_salary"]),
                   ("b07_diff_education", ["diff_education"]),
                   ("b08_location_match", ["location_match"]),
                   ("b09_domain_match", ["domain_match"]),
                   ("b10_model_features", FE.MODEL_FEATURES),
                   ("b11_all_features", FE.ALL_FEATURES)]:
    query(qid, with_ctes(f"SELECT application_id, {', '.join(names)} FROM feat"))(_feature_query(names))

query("b12_match_vector", with_ctes(
    f"SELECT application_id, {MODEL_FEATS}, diff_salary, diff_education, "
    "CAST(coalesce(location_student = location_job, false) AS INTEGER) AS location_match FROM feat"))(
    lambda s, d: FE.match_vector(M(s, d), ["application_id"]))

query("b13_threshold_rules", with_ctes(
    "SELECT application_id, " + ", ".join(RU.RULES) + " FROM rules", [RULES_CTE]))(
    lambda s, d: RU.validate_thresholds(M(s, d), None, ["application_id"]))

OVR = {"min_python": 75.0, "min_education": "PG", "location_match_required": True}
query("b13_threshold_rules_override", with_ctes(
    "SELECT application_id, "
    "coalesce(years_experience >= exp_required_years, false) AS experience, "
    f"{edu_rank_sql('education_level')} >= 2 AS education, "
    "coalesce(python_score >= 75.0, false) AS python, "
    "coalesce(sql_score >= sql_required, false) AS sql, "
    "coalesce(ml_score >= ml_required, false) AS machine_learning, "
    "coalesce(salary_offered_inr >= expected_salary_inr, false) AS salary, "
    "coalesce(location_student IS NOT DISTINCT FROM location_job, false) AS location FROM modelling"))(
    lambda s, d: RU.validate_thresholds(M(s, d), OVR, ["application_id"]))

_COMP_ROWS = [(g, n, rl) for g, members in RU.GROUPS for n, rl in members]
query("b14_competency_groups", with_ctes(" UNION ALL ".join(
    f"SELECT application_id, '{g}' AS competency_group, '{n}' AS competency, {rl} AS passed FROM rules"
    for g, n, rl in _COMP_ROWS), [RULES_CTE]))(
    lambda s, d: RU.map_competencies(RU.validate_thresholds(M(s, d), None, ["application_id"]),
                                     ["application_id"], long=True))

query("b15_candidate_side", with_ctes(
    "SELECT application_id, " + ", ".join(FE.CANDIDATE_SIDE) + " FROM modelling"))(
    lambda s, d: FE.split_sides(M(s, d))[0])
query("b15_job_side", with_ctes(
    "SELECT application_id, " + ", ".join(FE.JOB_SIDE) + " FROM modelling"))(
    lambda s, d: FE.split_sides(M(s, d))[1])


def _viol_sql():
    parts = [f"CASE WHEN isnan(coalesce(CAST({f} AS DOUBLE), 0.0)) OR coalesce(CAST({f} AS DOUBLE), 0.0) < 0 "
             f"THEN '{f}<0' END" for f in RU.NONNEG_FIELDS]
    parts += [f"CASE WHEN isnan(coalesce({f}, 0.0)) OR coalesce({f}, 0.0) < 0 OR coalesce({f}, 0.0) > 100 "
              f"THEN '{f} not in 0..100' END" for f in RU.PERCENT_FIELDS]
    return "concat_ws(',', " + ", ".join(parts) + ")"


query("b16_domain_validation", with_ctes(
    f"SELECT application_id, {_viol_sql()} AS violations, "
    f"CASE WHEN {_viol_sql()} = '' THEN 'valid' ELSE 'invalid' END AS status FROM modelling"))(
    lambda s, d: RU.validate_domain(M(s, d)).select("application_id", "violations", "status"))

# ------------------------------------------------------------ board
POSTINGS_CTE = ("postings", f"""SELECT page_id AS id,
    regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
    regexp_extract(url, '^https?://([^/?#]+)', 1) AS company,
    regexp_extract(html, '<html lang="([a-z]+)"', 1) AS location,
    html AS description, url, 'pages' AS source,
    make_timestamp(({PUBLISHED_EPOCH_S} + (page_id * {PUBLISHED_MULT}) % {PUBLISHED_SPREAD_S}) * 1000000) AS published_at
  FROM pages""")
query("a08_postings", with_ctes("SELECT id, title, company, location, url, source, published_at FROM postings",
                                [POSTINGS_CTE]))(
    lambda s, d: postings(s, d).drop("description"))
query("f01_newest_page", with_ctes(
    "SELECT id, title, published_at FROM postings ORDER BY published_at DESC, id LIMIT 100 OFFSET 0",
    [POSTINGS_CTE]))(lambda s, d: BO.page(postings(s, d), 0, 100).select("id", "title", "published_at"))
query("f01_second_page", with_ctes(
    "SELECT id, title, published_at FROM postings ORDER BY published_at DESC, id LIMIT 20 OFFSET 20",
    [POSTINGS_CTE]))(lambda s, d: BO.page(postings(s, d), 20, 20).select("id", "title", "published_at"))
query("b21_lookup", with_ctes("SELECT id, title, url FROM postings WHERE id = 7", [POSTINGS_CTE]))(
    lambda s, d: BO.lookup(postings(s, d), 7).select("id", "title", "url"))
query("b21_lookup_missing", with_ctes("SELECT id, title, url FROM postings WHERE id = -1", [POSTINGS_CTE]))(
    lambda s, d: BO.lookup(postings(s, d), -1).select("id", "title", "url"))
query("b20_keyword_search", with_ctes(
    "SELECT id, title, company, location FROM postings WHERE coalesce(contains(lower(title), 'the'), false) "
    "OR coalesce(contains(lower(company), 'the'), false) OR coalesce(contains(lower(location), 'the'), false)",
    [POSTINGS_CTE]))(
    lambda s, d: BO.search(postings(s, d), "The").select("id", "title", "company", "location"))

# The stored table holds what was published before the cutoff; the incoming
# batch is every page keyed by its canonical URL (query string and fragment cut).
CUTOFF = PUBLISHED_EPOCH_S + PUBLISHED_SPREAD_S // 2


def new_postings(spark, sf):
    p = postings(spark, sf).select("id", F.regexp_replace("url", r"[?#].*$", "").alias("url"),
                                   "title", "published_at")
    existing = p.filter(F.col("published_at") < epoch_ntz(CUTOFF))
    return BO.new_postings(p, existing, key="url", order="id")


query("c02_new_postings_by_url", with_ctes(f"""SELECT url, id, title, published_at FROM (
    SELECT regexp_replace(url, '[?#].*$', '') AS url, id, title, published_at,
           row_number() OVER (PARTITION BY regexp_replace(url, '[?#].*$', '') ORDER BY id) AS rn
    FROM postings) x
  WHERE rn = 1 AND url NOT IN (SELECT regexp_replace(url, '[?#].*$', '') FROM postings
                               WHERE published_at < make_timestamp({CUTOFF}::BIGINT * 1000000))""",
                                             [POSTINGS_CTE]))(new_postings)

query("d33_request_metrics", """SELECT count(*) AS total_requests,
    count(*) FILTER (WHERE event_type = 'error') AS total_errors,
    coalesce(round(avg(value), 4), 0.0) AS avg_latency FROM events""")(
    lambda s, d: BO.request_metrics(request_log(s, d)))
query("d33_request_metrics_by_path", """SELECT event_type AS path, count(*) AS total_requests,
    count(*) FILTER (WHERE event_type = 'error') AS total_errors,
    coalesce(round(avg(value), 4), 0.0) AS avg_latency FROM events GROUP BY event_type""")(
    lambda s, d: BO.request_metrics(request_log(s, d), ["path"]))

# ------------------------------------------------------------ G1 / D18-D20 / D23 on candidates
CLUSTER_COLS = SCORE_COLS + ["years_experience", "expected_salary_inr",
                             "exp_required_years", "salary_offered_inr"]


def _imputed(spark, sf):
    return PR.impute_median(M(spark, sf), CLUSTER_COLS)


IMPUTED_CTE = ("imputed", "SELECT " + ", ".join(
    f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont({c}, 0.5) FROM modelling)) AS {c}"
    for c in CLUSTER_COLS) + " FROM modelling")
query("d20_median_impute", with_ctes("SELECT * FROM imputed", [IMPUTED_CTE]))(_imputed)
query("g01_dedup_features", with_ctes("SELECT DISTINCT * FROM imputed", [IMPUTED_CTE]))(
    lambda s, d: PR.dedup(_imputed(s, d), CLUSTER_COLS))
query("d18_dataset_checks", with_ctes(
    "SELECT count(*) AS n_rows, " + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in CLUSTER_COLS)
    + " AS n_null, " + " + ".join(f"count(*) FILTER (WHERE abs({c}) = 'inf'::DOUBLE)" for c in CLUSTER_COLS)
    + " AS n_inf, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM imputed)) AS n_duplicates, "
    "least(" + ", ".join(f"var_samp({c})" for c in CLUSTER_COLS) + ") AS min_variance, "
    + " AND ".join(f"coalesce(min({c}) <> max({c}), false)" for c in CLUSTER_COLS) + " AS all_multi_valued, "
    "(" + " + ".join(f"count(*) FILTER (WHERE {c} IS NULL)" for c in CLUSTER_COLS) + ") = 0 AND "
    "(" + " + ".join(f"count(*) FILTER (WHERE abs({c}) = 'inf'::DOUBLE)" for c in CLUSTER_COLS) + ") = 0 AND "
    "count(*) = (SELECT count(*) FROM (SELECT DISTINCT * FROM imputed)) AND "
    "least(" + ", ".join(f"var_samp({c})" for c in CLUSTER_COLS) + ") > 0 AND "
    + " AND ".join(f"coalesce(min({c}) <> max({c}), false)" for c in CLUSTER_COLS) + " AS passed FROM imputed",
    [IMPUTED_CTE]).replace(") AS min_variance", "), 9) AS min_variance").replace(
        "least(" + ", ".join(f"var_samp({c})" for c in CLUSTER_COLS) + "), 9)",
        "round(least(" + ", ".join(f"var_samp({c})" for c in CLUSTER_COLS) + "), 9)"))(
    lambda s, d: PR.check_dataset(_imputed(s, d), CLUSTER_COLS).withColumn(
        "min_variance", r(F.col("min_variance"))))
query("d19_label_checks", with_ctes(
    "SELECT count(*) AS n_classes, min(n) AS min_class_count, "
    "(SELECT count(*) FILTER (WHERE is_good_match IS NULL OR isnan(CAST(is_good_match AS DOUBLE))) FROM modelling) AS n_invalid, "
    "count(*) >= 2 AS enough_classes, min(n) < 10 AS small_class_warning, "
    "count(*) >= 2 AND (SELECT count(*) FILTER (WHERE is_good_match IS NULL) FROM modelling) = 0 AS passed "
    "FROM (SELECT is_good_match, count(*) AS n FROM modelling GROUP BY 1)"))(
    lambda s, d: PR.check_labels(M(s, d), "is_good_match"))
_pairs = [(a, b) for i, a in enumerate(FE.MODEL_FEATURES) for b in FE.MODEL_FEATURES[i + 1:]]
query("d23_feature_correlations", with_ctes(
    "SELECT feature_a, feature_b, round(corr, 9) AS corr FROM (SELECT unnest([" + ", ".join(
        f"{{'feature_a': '{a}', 'feature_b': '{b}', 'corr': corr({a}, {b})}}" for a, b in _pairs)
    + "], recursive := true) FROM feat)"))(
    lambda s, d: PR.correlations(FE.model_features(M(s, d)), FE.MODEL_FEATURES).select(
        "feature_a", "feature_b", r(F.col("corr")).alias("corr")))


def _gap_transformer(spark, sf):
    """The ML Transformer form of the gap features (used inside saved pipelines)."""
    from matchlake.operators.models import GapTransformer
    return GapTransformer().transform(M(spark, sf)).select("application_id", *FE.MODEL_FEATURES)


query("j04_gap_transformer", with_ctes(f"SELECT application_id, {MODEL_FEATS} FROM feat"))(_gap_transformer)
