"""Competency rules, grouping, domain validation and decisions.

Threshold overrides are columns: a per-row override column named like the
rule (``min_python`` ...) wins when non-null, else a literal override passed
in ``overrides``, else the job/candidate value. Literal overrides are folded
into the expression as constants, so nothing is shipped or joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions.features import col_or, edu_rank
from matchlake.sources.adapter import REQ_COLS, SCORE_COLS

# Override names accepted by the threshold rules.
OVERRIDES = ["min_experience", "min_education", "min_python", "min_sql", "min_ml",
             "min_salary", "location_match_required"]
# Rule names, and their grouping into competencies.
RULES = ["experience", "education", "python", "sql", "machine_learning", "salary", "location"]
GROUPS = [
    ("Technical Skills", [("python", "python"), ("sql", "sql"),
                          ("machine_learning", "machine_learning")]),
    ("Professional Experience", [("experience", "experience")]),
    ("Education", [("degree", "education")]),
    ("Domain Fit", [("salary_expectation", "salary"), ("location", "location")]),
]


def _override(df: DataFrame, overrides: dict, name: str, default: Column) -> Column:
    per_row = F.col(name) if name in df.columns else None
    lit = overrides.get(name)
    parts = [c for c in (per_row, None if lit is None else F.lit(lit)) if c is not None]
    return F.coalesce(*parts, default) if parts else default


def threshold_columns(df: DataFrame, overrides: dict | None = None) -> dict[str, Column]:
    """The seven pass/fail outcomes; a null comparison (missing value) fails."""
    ov = overrides or {}
    g = lambda n, d: col_or(df, n, d)
    out = {}
    out["experience"] = g("years_experience", 0) >= _override(
        df, ov, "min_experience", g("exp_required_years", 0.0))
    out["education"] = edu_rank(g("education_level", "UG")) >= edu_rank(
        _override(df, ov, "min_education", g("edu_minimum", "UG")))
    for rule, ovname, score, req in [("python", "min_python", SCORE_COLS[0], REQ_COLS[0]),
                                     ("sql", "min_sql", SCORE_COLS[1], REQ_COLS[1]),
                                     ("machine_learning", "min_ml", SCORE_COLS[2], REQ_COLS[2])]:
        out[rule] = g(score, 0.0) >= _override(df, ov, ovname, g(req, 0.0))
    out["salary"] = g("salary_offered_inr", 0) >= _override(
        df, ov, "min_salary", g("expected_salary_inr", 0))
    required = F.coalesce(_override(df, ov, "location_match_required", F.lit(False)), F.lit(False))
    out["location"] = F.when(required, g("location_student", "").eqNullSafe(g("location_job", ""))
                             ).otherwise(F.lit(True))
    return {k: F.coalesce(v, F.lit(False)) for k, v in out.items()}


def validate_thresholds(df: DataFrame, overrides: dict | None = None,
                        keep: list[str] | None = None) -> DataFrame:
    cols = threshold_columns(df, overrides)
    return df.select(*(keep or []), *[cols[r].alias(r) for r in RULES])


def map_competencies(df: DataFrame, keep: list[str] | None = None, long: bool = False) -> DataFrame:
    """Group rule outcomes (columns named as RULES) into four competencies.

    Wide form is a struct of structs; long form is one row per
    (group, competency) produced by ``stack`` (no shuffle).
    """
    keep = keep or []
    get = lambda r: F.coalesce(F.col(r), F.lit(False)) if r in df.columns else F.lit(False)
    if not long:
        return df.select(*keep, F.struct(*[
            F.struct(*[get(rule).alias(name) for name, rule in members]).alias(group)
            for group, members in GROUPS]).alias("competencies"))
    pairs = [(group, name, rule) for group, members in GROUPS for name, rule in members]
    args = ", ".join(f"'{g}', '{n}', coalesce(`{r}`, false)" if r in df.columns
                     else f"'{g}', '{n}', false" for g, n, r in pairs)
    return df.selectExpr(*keep, f"stack({len(pairs)}, {args}) AS (competency_group, competency, passed)")


# Domain bounds of the validated request record.
NONNEG_FIELDS = ["years_experience", "exp_required_years", "expected_salary_inr", "salary_offered_inr"]
PERCENT_FIELDS = SCORE_COLS + REQ_COLS


def violation_columns(df: DataFrame) -> list[Column]:
    """One nullable string per rule; NaN always violates."""
    out = []
    for f in NONNEG_FIELDS:
        v = F.coalesce(col_or(df, f, 0.0).cast("double"), F.lit(0.0))
        out.append(F.when(F.isnan(v) | (v < 0), F.lit(f"{f}<0")))
    for f in PERCENT_FIELDS:
        v = F.coalesce(col_or(df, f, 0.0).cast("double"), F.lit(0.0))
        out.append(F.when(F.isnan(v) | (v < 0) | (v > 100), F.lit(f"{f} not in 0..100")))
    return out


def validate_domain(df: DataFrame) -> DataFrame:
    """Adds ``violations`` (comma-joined, '' when valid) and ``status``."""
    v = F.concat_ws(",", *violation_columns(df))
    return (df.withColumn("violations", v)
              .withColumn("status", F.when(F.col("violations") == "", "valid").otherwise("invalid")))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows and the quarantine, from one validated frame."""
    checked = validate_domain(df)
    return (checked.filter(F.col("status") == "valid"),
            checked.filter(F.col("status") != "valid"))


def decide(prob: Column, threshold) -> Column:
    """Positive when p >= threshold."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (prob >= t).cast("int")


def confidence(prob: Column) -> Column:
    """Distance from the 0.5 boundary scaled to [0, 1]."""
    return F.abs(prob - 0.5) * 2
