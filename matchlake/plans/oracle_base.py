"""DuckDB twins of the adapter and of the gap features, as CTE text.

The oracle queries in ``plans/q_*.py`` are ``WITH <ctes> SELECT ...``; these CTEs
are generated from the same fixed values as ``matchlake.sources.adapter`` so
that the two engines compute the same entities.
"""

from __future__ import annotations

from matchlake.functions.features import DATA_TITLE_WORDS, GAP_NAMES
from matchlake.sources.adapter import (REQ_COLS, REQ_MULT, REQ_NULL_MOD, SCORE_COLS,
                                       SCORE_MULT, SCORE_NULL_MOD, TITLES)


def _edu_sql(k: str, mod: int) -> str:
    return f"CASE WHEN {k} % {mod} = 0 THEN 'PhD' WHEN {k} % {mod} < 5 THEN 'PG' ELSE 'UG' END"


def _cand_sql() -> str:
    c = "c_custkey"
    scores = ",\n    ".join(
        f"CASE WHEN {c} % {m} = 0 THEN NULL ELSE CAST(({c} * {k}) % 1001 AS DOUBLE) / 10 END AS {n}"
        for n, m, k in zip(SCORE_COLS, SCORE_NULL_MOD, SCORE_MULT))
    return f"""SELECT {c} AS candidate_id, c_name AS name, {_edu_sql(c, 15)} AS education_level,
    CAST({c} % 7 AS INTEGER) AS years_experience, n_name AS location,
    {scores},
    300000 + ({c} * 7919) % 1620000 AS expected_salary_inr
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""


def _jobs_sql() -> str:
    p = "p_partkey"
    titles = ", ".join(f"'{t}'" for t in TITLES)
    reqs = ",\n    ".join(
        f"CASE WHEN {p} % {m} = 0 THEN NULL ELSE CAST(200 + ({p} * {k}) % 701 AS DOUBLE) / 10 END AS {n}"
        for n, m, k in zip(REQ_COLS, REQ_NULL_MOD, REQ_MULT))
    return f"""SELECT {p} AS job_id, p_brand AS company, [{titles}][CAST({p} % 10 + 1 AS INTEGER)] AS title,
    n_name AS location, CAST(2 + ({p} * 17) % 62 AS DOUBLE) / 10 AS exp_required_years,
    350000 + ({p} * 6151) % 1550000 AS salary_offered_inr,
    {reqs},
    {_edu_sql(p, 13)} AS edu_minimum
  FROM part JOIN nation ON {p} % 25 = n_nationkey"""


def _modelling_sql() -> str:
    gaps = " + ".join(f"(coalesce({s}, 0.0) - coalesce({r}, 0.0))" for s, r in zip(SCORE_COLS, REQ_COLS))
    cand_cols = ", ".join(["c.name", "c.education_level", "c.years_experience",
                           "c.location AS location_student"] + [f"c.{s}" for s in SCORE_COLS]
                          + ["c.expected_salary_inr"])
    job_cols = ", ".join(["j.company", "j.title", "j.location AS location_job", "j.exp_required_years",
                          "j.salary_offered_inr"] + [f"j.{r}" for r in REQ_COLS] + ["j.edu_minimum"])
    return f"""SELECT a.application_id, a.candidate_id, a.job_id, a.application_date, {cand_cols}, {job_cols},
    CASE WHEN {gaps} + 40 * (coalesce(c.years_experience, 0) - coalesce(j.exp_required_years, 0.0))
              + CAST((a.application_id * 7919) % 1000 AS DOUBLE) / 5 - 100 > 60 THEN 1 ELSE 0 END AS is_good_match
  FROM (SELECT o_orderkey AS application_id, o_custkey AS candidate_id,
               (o_orderkey * 31) % (SELECT count(*) FROM part) AS job_id,
               CAST(o_orderdate AS DATE) AS application_date FROM orders) a
  LEFT JOIN candidates c ON a.candidate_id = c.candidate_id
  LEFT JOIN jobs j ON a.job_id = j.job_id"""


def edu_rank_sql(x: str) -> str:
    return f"(CASE WHEN {x} = 'UG' THEN 1 WHEN {x} = 'PG' THEN 2 WHEN {x} = 'PhD' THEN 3 ELSE 1 END)"


def _features_sql() -> str:
    f = lambda c: f"coalesce({c}, 0.0)"
    data_title = " OR ".join(f"contains(lower(coalesce(title, '')), '{w}')" for w in DATA_TITLE_WORDS)
    gaps = ",\n    ".join(f"{f(s)} - {f(r)} AS {g}" for g, s, r in zip(GAP_NAMES, SCORE_COLS, REQ_COLS))
    return f"""SELECT *,
    CASE WHEN {data_title}
         THEN greatest({f('python_score')}, {f('sql_score')}, {f('ml_score')}, {f('statistics_score')})
         ELSE greatest({f('javascript_score')}, {f('data_structures_score')}, {f('python_score')}) END AS domain_match,
    coalesce(years_experience, 0) - coalesce(exp_required_years, 0.0) AS diff_experience,
    {gaps},
    coalesce(salary_offered_inr, 0) - coalesce(expected_salary_inr, 0) AS diff_salary,
    {edu_rank_sql('education_level')} - {edu_rank_sql('edu_minimum')} AS diff_education,
    CAST(coalesce(location_student, '') = coalesce(location_job, '') AS INTEGER) AS location_match
  FROM modelling"""


BASE_CTES = [("candidates", _cand_sql()), ("jobs", _jobs_sql()),
             ("modelling", _modelling_sql()), ("feat", _features_sql())]


def with_ctes(body: str, extra: list[tuple[str, str]] | None = None) -> str:
    ctes = BASE_CTES + list(extra or [])
    head = ",\n".join(f"{n} AS (\n  {s}\n)" for n, s in ctes)
    return f"WITH {head}\n{body}"
