"""Candidate/job gap features as column expressions.

All features are plain expressions: they stay inside whole-stage codegen, need
no shuffle and are pruned by Catalyst when a caller selects fewer of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.sources.adapter import REQ_COLS, SCORE_COLS

# Short names of the six skill gaps, in the order of SCORE_COLS.
GAP_NAMES = ["diff_python", "diff_sql", "diff_ml", "diff_js", "diff_ds", "diff_stats"]
# The feature set used by the model (order of the original transformer output).
MODEL_FEATURES = ["diff_experience", "diff_python", "diff_ml", "diff_sql",
                  "diff_stats", "diff_js", "diff_ds"]
ALL_FEATURES = ["domain_match"] + MODEL_FEATURES + ["diff_salary", "diff_education", "location_match"]
# Education ordinal and the title words that mark a data role.
EDU_RANK = {"UG": 1, "PG": 2, "PhD": 3}
DATA_TITLE_WORDS = ["data", "ml", "ai", "machine learning", "analyst"]
# Leakage / key columns removed before modelling (plus the recruiter
# note, which leaks the outcome and is absent from the published modelling table).
LEAKAGE_COLS = ["exam_time_seconds", "self_reported_confidence", "retake_count",
                "application_id", "student_id", "candidate_id", "job_id", "name", "application_date",
                "recruiter_notes_post_decision"]


def col_or(df: DataFrame, name: str, default) -> Column:
    """The column when present, else a literal default (absent -> default)."""
    return F.col(name) if name in df.columns else F.lit(default)


def filled(df: DataFrame, name: str, default=0.0) -> Column:
    """Null -> default, absent -> default."""
    return F.coalesce(col_or(df, name, default), F.lit(default))


def edu_rank(c: Column) -> Column:
    """UG=1, PG=2, PhD=3, anything else or null -> 1."""
    expr = None
    for k, v in EDU_RANK.items():
        expr = F.when(c == k, v) if expr is None else expr.when(c == k, v)
    return expr.otherwise(1)


def is_data_title(title: Column) -> Column:
    t = F.lower(F.coalesce(title, F.lit("")))
    cond = None
    for w in DATA_TITLE_WORDS:
        c = t.contains(w)
        cond = c if cond is None else (cond | c)
    return cond


def gap_columns(df: DataFrame) -> dict[str, Column]:
    """All 11 engineered columns (B4-B9) keyed by name."""
    s = {c: filled(df, c) for c in SCORE_COLS}
    r = {c: filled(df, c) for c in REQ_COLS}
    out: dict[str, Column] = {}
    out["domain_match"] = F.when(
        is_data_title(col_or(df, "title", "")),
        F.greatest(s["python_score"], s["sql_score"], s["ml_score"], s["statistics_score"]),
    ).otherwise(F.greatest(s["javascript_score"], s["data_structures_score"], s["python_score"]))
    out["diff_experience"] = (filled(df, "years_experience", 0)
                              - filled(df, "exp_required_years", 0.0))
    for g, sc, rq in zip(GAP_NAMES, SCORE_COLS, REQ_COLS):
        out[g] = s[sc] - r[rq]
    out["diff_salary"] = (filled(df, "salary_offered_inr", 0)
                          - filled(df, "expected_salary_inr", 0))
    out["diff_education"] = (edu_rank(col_or(df, "education_level", None))
                             - edu_rank(col_or(df, "edu_minimum", None)))
    out["location_match"] = (F.coalesce(col_or(df, "location_student", None), F.lit(""))
                             == F.coalesce(col_or(df, "location_job", None), F.lit(""))).cast("int")
    return out


def gap_features(df: DataFrame, keep: list[str] | None = None,
                 features: list[str] = ALL_FEATURES) -> DataFrame:
    """The 11 engineered features next to ``keep`` columns."""
    cols = gap_columns(df)
    keep = keep if keep is not None else []
    return df.select(*keep, *[cols[f].alias(f) for f in features])


def model_features(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Exactly the 7 model features."""
    return gap_features(df, keep, MODEL_FEATURES)


def drop_leakage(df: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """B1: drop leakage columns that are present (absent names are ignored)."""
    return df.drop(*(LEAKAGE_COLS + list(extra or [])))


def match_vector(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """7 gaps + salary + education + strict location (missing -> 0)."""
    cols = gap_columns(df)
    strict_loc = F.coalesce(col_or(df, "location_student", None)
                            == col_or(df, "location_job", None), F.lit(False)).cast("int")
    return df.select(*(keep or []), *[cols[f].alias(f) for f in MODEL_FEATURES],
                     cols["diff_salary"].alias("diff_salary"),
                     cols["diff_education"].alias("diff_education"),
                     strict_loc.alias("location_match"))


# Candidate / job sides of a combined row.
CANDIDATE_SIDE = (["years_experience"] + SCORE_COLS
                  + ["expected_salary_inr", "education_level", "location_student"])
JOB_SIDE = (["title", "exp_required_years"] + REQ_COLS
            + ["salary_offered_inr", "edu_minimum", "location_job"])


def split_sides(df: DataFrame, key: str = "application_id") -> tuple[DataFrame, DataFrame]:
    """Candidate-side and job-side projections of a combined row."""
    return (df.select(key, *[c for c in CANDIDATE_SIDE if c in df.columns]),
            df.select(key, *[c for c in JOB_SIDE if c in df.columns]))
