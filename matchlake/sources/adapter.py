"""Matching entities derived from the TPC-H-style test tables.

The test data has no candidates, jobs or applications, so they are derived
with integer arithmetic that is textually the same in Spark and in the DuckDB
oracle (see ``matchlake.plans.oracle_base.BASE_CTES``):

* candidates  <- customer x nation (nation is the 25-row TPC-H dimension)
* jobs        <- part x nation on ``p % 25``
* applications<- orders; the label is a deterministic, learnable function of
  the candidate/job gaps plus a hashed noise term.

Nothing here collects data: the part count used to spread applications over
jobs is a scalar subquery evaluated once by Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.sources.tables import table

# Fixed values of the adapter (must equal the oracle SQL).
SKILLS = ["python", "sql", "ml", "javascript", "data_structures", "statistics"]
SCORE_NULL_MOD = [29, 31, 37, 41, 43, 47]
SCORE_MULT = [37, 53, 71, 97, 113, 131]
REQ_NULL_MOD = [5, 4, 4, 4, 6, 4]
REQ_MULT = [23, 31, 43, 59, 67, 73]
TITLES = ["Junior Data Analyst", "Backend Developer", "ML Engineer", "Data Scientist",
          "Full Stack Developer", "QA Engineer", "Senior ML Engineer", "Data Engineer",
          "Frontend Developer", "Research Intern"]

SCORE_COLS = [f"{s}_score" for s in SKILLS]
REQ_COLS = [f"{s}_required" for s in SKILLS]
CANDIDATE_COLS = (["candidate_id", "name", "education_level", "years_experience", "location"]
                  + SCORE_COLS + ["expected_salary_inr"])
JOB_COLS = (["job_id", "company", "title", "location", "exp_required_years", "salary_offered_inr"]
            + REQ_COLS + ["edu_minimum"])


def _edu(k: Column, mod: int, pg_lt: int = 5) -> Column:
    r = k % mod
    return F.when(r == 0, "PhD").when(r < pg_lt, "PG").otherwise("UG")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col("c_custkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cols = [c.alias("candidate_id"), F.col("c_name").alias("name"),
            _edu(c, 15).alias("education_level"),
            (c % 7).cast("int").alias("years_experience"),
            F.col("n_name").alias("location")]
    for name, m, k in zip(SCORE_COLS, SCORE_NULL_MOD, SCORE_MULT):
        cols.append(F.when(c % m == 0, F.lit(None).cast("double"))
                    .otherwise(((c * k) % 1001).cast("double") / 10).alias(name))
    cols.append((F.lit(300000) + (c * 7919) % 1620000).alias("expected_salary_inr"))
    # nation is the fixed 25-row dimension: a broadcast with a proven bound.
    return (table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
            .join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
            .select(*cols))


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p_partkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    title = F.element_at(F.array(*[F.lit(t) for t in TITLES]), (p % 10 + 1).cast("int"))
    cols = [p.alias("job_id"), F.col("p_brand").alias("company"), title.alias("title"),
            F.col("n_name").alias("location"),
            ((F.lit(2) + (p * 17) % 62).cast("double") / 10).alias("exp_required_years"),
            (F.lit(350000) + (p * 6151) % 1550000).alias("salary_offered_inr")]
    for name, m, k in zip(REQ_COLS, REQ_NULL_MOD, REQ_MULT):
        cols.append(F.when(p % m == 0, F.lit(None).cast("double"))
                    .otherwise((F.lit(200) + (p * k) % 701).cast("double") / 10).alias(name))
    cols.append(_edu(p, 13).alias("edu_minimum"))
    return (table(spark, sf_dir, "part").select("p_partkey", "p_brand")
            .join(F.broadcast(nation), (p % 25) == F.col("n_nationkey"))
            .select(*cols))


def _application_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    n_part = table(spark, sf_dir, "part").select(F.count(F.lit(1))).scalar()
    return table(spark, sf_dir, "orders").select(
        o.alias("application_id"), F.col("o_custkey").alias("candidate_id"),
        ((o * 31) % n_part).alias("job_id"),
        F.to_date("o_orderdate").alias("application_date"))


def _label(o: Column) -> Column:
    gaps = None
    for s, r in zip(SCORE_COLS, REQ_COLS):
        g = F.coalesce(F.col(s), F.lit(0.0)) - F.coalesce(F.col(r), F.lit(0.0))
        gaps = g if gaps is None else gaps + g
    diff_exp = (F.coalesce(F.col("years_experience"), F.lit(0))
                - F.coalesce(F.col("exp_required_years"), F.lit(0.0)))
    z = gaps + 40 * diff_exp + ((o * 7919) % 1000).cast("double") / 5 - 100
    return F.when(z > 60, 1).otherwise(0)


def modelling_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications LEFT JOIN candidates LEFT JOIN jobs.

    Both joins are many-to-one on keys whose dimension grows with the data
    (customers, parts), so no broadcast hint is given: AQE measures the
    build side at runtime and broadcasts only below the configured threshold,
    and its skew-join split handles a hot candidate or job.
    """
    cand = candidates(spark, sf_dir).withColumnRenamed("location", "location_student")
    job = jobs(spark, sf_dir).withColumnRenamed("location", "location_job")
    joined = (_application_keys(spark, sf_dir)
              .join(cand, "candidate_id", "left")
              .join(job, "job_id", "left"))
    ordered = (["application_id", "candidate_id", "job_id", "application_date"]
               + [c if c != "location" else "location_student" for c in CANDIDATE_COLS[1:]]
               + [c if c != "location" else "location_job" for c in JOB_COLS[1:]])
    return joined.select(*ordered, _label(F.col("application_id")).alias("is_good_match"))


def applications(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modelling_table(spark, sf_dir).select(
        "application_id", "candidate_id", "job_id", "application_date", "is_good_match")
