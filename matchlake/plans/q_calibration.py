"""Registered queries: calibrators fitted on the stored-weight scorer's margins
(N11, N12), compared with SQL value by value."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake.operators import calibration as CA
from matchlake.plans.oracle_base import with_ctes
from matchlake.plans.q_metrics import SCORED_CTE, S
from matchlake.plans.registry import query, r
from matchlake.session import cut_lineage

LOW = 1e-6
NEWTON_STEPS = 14


def stored_margins(spark, sf):
    """The scorer's log odds, of probabilities kept off 0 and 1."""
    scored = cut_lineage(S(spark, sf).select("application_id", "label", "probability"))
    p = F.least(F.greatest(F.col("probability"), F.lit(LOW)), F.lit(1 - LOW))
    return scored.select("application_id", "label", F.log(p / (F.lit(1.0) - p)).alias("margin"))


def _platt(spark, sf):
    rows = stored_margins(spark, sf)
    fitted = CA.platt_fit(rows)
    return rows.select("application_id", "label", r(CA.platt(F.col("margin"), fitted), 6).alias("probability"))


def _platt_sql() -> str:
    """Newton steps from the usual start, one CTE each."""
    ctes = [SCORED_CTE,
            ("margins", f"""SELECT application_id, label, ln(p / (1.0::DOUBLE - p)) AS m FROM (
                SELECT *, least(greatest(probability, {LOW!r}::DOUBLE), {1 - LOW!r}::DOUBLE) AS p FROM scored)"""),
            ("grouped", "SELECT m, CAST(sum(label) AS DOUBLE) AS p, CAST(sum(1 - label) AS DOUBLE) AS q FROM margins GROUP BY m"),
            ("targets", "SELECT (sum(p) + 1) / (sum(p) + 2) AS hi, 1 / (sum(q) + 2) AS lo, "
                        "ln((sum(q) + 1) / (sum(p) + 1)) AS b FROM grouped"),
            ("step0", "SELECT 0.0::DOUBLE AS a, b FROM targets")]
    for i in range(NEWTON_STEPS):
        ctes.append((f"step{i + 1}", f"""SELECT a - (hbb * ga - hab * gb) / (haa * hbb - hab * hab) AS a,
              b - (haa * gb - hab * ga) / (haa * hbb - hab * hab) AS b FROM (
            SELECT any_value(a) AS a, any_value(b) AS b, sum(m * slope) AS ga, sum(slope) AS gb, sum(m * m * bend) AS haa,
                   sum(m * bend) AS hab, sum(bend) AS hbb FROM (
              SELECT *, p * (hi - c) + q * (lo - c) AS slope, (p + q) * c * (1 - c) AS bend FROM (
                SELECT g.*, t.hi, t.lo, s.a, s.b, 1 / (1 + exp(s.a * m + s.b)) AS c
                FROM grouped g, targets t, step{i} s)))"""))
    return with_ctes(f"""SELECT application_id, label, round(1 / (1 + exp(a * m + b)), 6) AS probability
        FROM margins, step{NEWTON_STEPS}""", ctes)


query("n11_platt_on_stored_margins", _platt_sql())(_platt)


def _isotonic(spark, sf):
    rows = cut_lineage(S(spark, sf).select("application_id", "label", "probability"))
    rows = cut_lineage(rows.select("application_id", "label", r(F.col("probability"), 3).alias("score")))
    fitted = CA.isotonic_fit(rows, "score")
    return rows.select("application_id", "label", "score", r(fitted(F.col("score"))).alias("probability"))


query("n12_isotonic_on_stored_scores", with_ctes(
    """SELECT application_id, label, s.score, round(v, 9) AS probability FROM rounded s JOIN (
      SELECT k AS score, max(least_from) AS v FROM (
        SELECT j, k, min(mean) OVER (PARTITION BY j ORDER BY k DESC) AS least_from FROM (
          SELECT a.score AS j, b.score AS k, (b.y - a.y0) / (b.n - a.n0) AS mean FROM sums a JOIN sums b ON a.score <= b.score))
      GROUP BY k) f ON s.score = f.score""",
    [SCORED_CTE, ("rounded", "SELECT application_id, label, round(probability, 3) AS score FROM scored"),
     ("sums", """SELECT score, sum(y) OVER w AS y, sum(n) OVER w AS n, sum(y) OVER w - y AS y0, sum(n) OVER w - n AS n0 FROM (
         SELECT score, CAST(sum(label) AS DOUBLE) AS y, CAST(count(*) AS DOUBLE) AS n FROM rounded GROUP BY score)
       WINDOW w AS (ORDER BY score)""")]))(_isotonic)
