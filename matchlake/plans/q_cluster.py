"""Registered queries: segmentation quality, agreement, profiles, naming, and
K-Means, PCA (K1-K12, D21, D22, D28, H12, H13, M7-M9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from matchlake.operators import clustering as CL
from matchlake.operators import kmeans as KM
from matchlake.operators.small import num, small_rows
from matchlake.plans.oracle_base import with_ctes
from matchlake.plans.registry import query, r
from matchlake.session import cut_lineage
from matchlake.sources.adapter import modelling_table

FEATS = CL.CLUSTER_FEATURES
Z = [f"z_{c}" for c in FEATS]
K = 3


def prepared(spark, sf):
    """Imputed, de-duplicated, standardized rows with a rule-based labelling
    (years of experience mod k) and a second labelling for agreement checks;
    written once, since a statistic reads them several times."""
    p = cut_lineage(CL.prepare(modelling_table(spark, sf)))
    return p.select("*", (F.col("years_experience").cast("int") % K).alias("cluster"),
                    ((F.col("python_score") >= 50).cast("int") + (F.col("sql_score") >= 50).cast("int"))
                    .alias("skill_band"))


PREP_CTES = [
    ("imp", "SELECT " + ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont({c}, 0.5) FROM modelling)) AS {c}" for c in FEATS)
     + " FROM modelling"),
    ("dd", "SELECT DISTINCT * FROM imp"),
    ("prep", "SELECT row_number() OVER () AS rid, *, " + ", ".join(
        f"({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 OR stddev_pop({c}) OVER () IS NULL "
        f"THEN 1.0 ELSE stddev_pop({c}) OVER () END AS z_{c}" for c in FEATS)
     + f", CAST(years_experience AS INTEGER) % {K} AS cluster, "
       "CAST(python_score >= 50 AS INTEGER) + CAST(sql_score >= 50 AS INTEGER) AS skill_band FROM dd"),
    ("cent", "SELECT cluster, count(*) AS n, " + ", ".join(f"avg({z}) AS {z}" for z in Z)
     + ", sum(" + " + ".join(f"{z} * {z}" for z in Z) + ") AS q, " + ", ".join(f"sum({z}) AS s_{z}" for z in Z)
     + " FROM prep GROUP BY cluster"),
]
SQDIST = " + ".join(f"(p.{z} - c.{z}) * (p.{z} - c.{z})" for z in Z)

# Per-row z-scores carry the last-bit noise of the engines' mean/std; they are
# compared at 6 decimals (aggregates of them keep 9).
query("m07_standardize_population", with_ctes(
    "SELECT " + ", ".join(f"round({z}, 6) AS {z}" for z in Z) + " FROM prep", PREP_CTES))(
    lambda s, d: prepared(s, d).select(*[r(F.col(z), 6).alias(z) for z in Z]))
query("k11_centroids", with_ctes(
    "SELECT cluster, n, " + ", ".join(f"round({z}, 9) AS {z}" for z in Z) + " FROM cent", PREP_CTES))(
    lambda s, d: CL.centroids(prepared(s, d), Z).select("cluster", "n", *[r(F.col(z)).alias(z) for z in Z]))
query("k03_wcss", with_ctes(
    f"SELECT round(sum({SQDIST}), 6) AS wcss FROM prep p JOIN cent c USING (cluster)", PREP_CTES))(
    lambda s, d: CL.wcss(prepared(s, d), Z).select(r(F.col("wcss"), 6).alias("wcss")))

SIL_SQL = f"""SELECT round(avg(s), 9) AS silhouette FROM (
  SELECT rid, CASE WHEN max(CASE WHEN own THEN n END) <= 1 THEN 0.0 ELSE
      (min(CASE WHEN NOT own THEN t / n END) - max(CASE WHEN own THEN t / (n - 1) END)) /
      greatest(min(CASE WHEN NOT own THEN t / n END), max(CASE WHEN own THEN t / (n - 1) END)) END AS s
  FROM (SELECT p.rid, p.cluster = c.cluster AS own, c.n,
               c.n * ({' + '.join(f'p.{z} * p.{z}' for z in Z)}) - 2 * ({' + '.join(f'p.{z} * c.s_{z}' for z in Z)}) + c.q AS t
        FROM prep p, cent c) GROUP BY rid)"""
query("k04_silhouette_sq", with_ctes(SIL_SQL, PREP_CTES))(
    lambda s, d: CL.silhouette_sq(prepared(s, d), Z).select(r(F.col("silhouette")).alias("silhouette")))
CH_SQL = f"""SELECT round((b / (k - 1)) / (w / (n - k)), 6) AS calinski_harabasz FROM
  (SELECT sum(c.n * ({' + '.join(f'(c.{z} - g.{z}) * (c.{z} - g.{z})' for z in Z)})) AS b, count(*) AS k, sum(c.n) AS n
   FROM cent c, (SELECT {', '.join(f'sum(s_{z}) / sum(n) AS {z}' for z in Z)} FROM cent) g),
  (SELECT sum({SQDIST}) AS w FROM prep p JOIN cent c USING (cluster))"""
query("k05_calinski_harabasz", with_ctes(CH_SQL, PREP_CTES))(
    lambda s, d: CL.calinski_harabasz(prepared(s, d), Z).select(
        r(F.col("calinski_harabasz"), 6).alias("calinski_harabasz")))
DB_SQL = f"""SELECT round(avg(worst), 9) AS davies_bouldin FROM (
  SELECT i.cluster, max((i.s + j.s) / sqrt({' + '.join(f'(i.{z} - j.{z}) * (i.{z} - j.{z})' for z in Z)})) AS worst
  FROM (SELECT c.*, sc.s FROM cent c JOIN (SELECT cluster, avg(sqrt({SQDIST})) AS s FROM prep p JOIN cent c USING (cluster)
        GROUP BY cluster) sc USING (cluster)) i,
       (SELECT c.*, sc.s FROM cent c JOIN (SELECT cluster, avg(sqrt({SQDIST})) AS s FROM prep p JOIN cent c USING (cluster)
        GROUP BY cluster) sc USING (cluster)) j
  WHERE i.cluster <> j.cluster GROUP BY i.cluster)"""
query("k06_davies_bouldin", with_ctes(DB_SQL, PREP_CTES))(
    lambda s, d: CL.davies_bouldin(prepared(s, d), Z).select(r(F.col("davies_bouldin")).alias("davies_bouldin")))

CT = "(SELECT cluster AS a, skill_band AS b, count(*) AS nij FROM prep GROUP BY ALL)"
ARI_SQL = f"""SELECT round(CASE WHEN mx = expected THEN 1.0 ELSE (idx - expected) / (mx - expected) END, 9) AS ari FROM (
  SELECT idx, sa * sb / (n * (n - 1) / 2.0) AS expected, (sa + sb) / 2 AS mx FROM
   (SELECT sum(nij * (nij - 1) / 2.0) AS idx, sum(nij) AS n FROM {CT}),
   (SELECT sum(ai * (ai - 1) / 2.0) AS sa FROM (SELECT a, sum(nij) AS ai FROM {CT} GROUP BY a)),
   (SELECT sum(bj * (bj - 1) / 2.0) AS sb FROM (SELECT b, sum(nij) AS bj FROM {CT} GROUP BY b)))"""
query("k07_adjusted_rand_index", with_ctes(ARI_SQL, PREP_CTES))(
    lambda s, d: CL.adjusted_rand(prepared(s, d), "cluster", "skill_band").select(r(F.col("ari")).alias("ari")))
NMI_SQL = f"""SELECT round(greatest(CASE WHEN ha + hb = 0 THEN 1.0 ELSE mi / ((ha + hb) / 2) END, 0.0), 9) AS nmi FROM
  (SELECT sum(nij / n * ln(n * nij / (ai * bj))) AS mi FROM {CT} t
     JOIN (SELECT a, sum(nij) AS ai FROM {CT} GROUP BY a) USING (a)
     JOIN (SELECT b, sum(nij) AS bj FROM {CT} GROUP BY b) USING (b), (SELECT sum(nij) AS n FROM {CT})),
  (SELECT -sum(ai / n * ln(ai / n)) AS ha FROM (SELECT a, sum(nij) AS ai FROM {CT} GROUP BY a), (SELECT sum(nij) AS n FROM {CT})),
  (SELECT -sum(bj / n * ln(bj / n)) AS hb FROM (SELECT b, sum(nij) AS bj FROM {CT} GROUP BY b), (SELECT sum(nij) AS n FROM {CT}))"""
query("k08_normalized_mutual_info", with_ctes(NMI_SQL, PREP_CTES))(
    lambda s, d: CL.normalized_mutual_info(prepared(s, d), "cluster", "skill_band").select(r(F.col("nmi")).alias("nmi")))


def _nearest(spark, sf):
    p = prepared(spark, sf)
    cents = CL.centroids(p, Z)
    a = CL.assign_nearest(p, cents, Z, out="assigned")
    return a.groupBy("cluster", "assigned").agg(F.count(F.lit(1)).alias("n"))


query("k12_nearest_centroid", with_ctes(
    f"""SELECT cluster, assigned, count(*) AS n FROM (
      SELECT p.rid, p.cluster, arg_min(c.cluster, ({SQDIST}) * 1e6 + c.cluster * 1e-9) AS assigned FROM prep p, cent c
      GROUP BY p.rid, p.cluster) GROUP BY ALL""", PREP_CTES).replace(
        f"arg_min(c.cluster, ({SQDIST}) * 1e6 + c.cluster * 1e-9)", f"first(c.cluster ORDER BY ({SQDIST}), c.cluster)"))(
    _nearest)

RAW_MEANS = ", ".join(f"round(avg({c}), 9) AS mean_{c}" for c in FEATS)
query("d21_cluster_profile", with_ctes(
    f"SELECT cluster, count(*) AS n_samples, {RAW_MEANS} FROM prep GROUP BY cluster", PREP_CTES))(
    lambda s, d: CL.profile(prepared(s, d), FEATS, decimals=9))
NAME_SQL = """CASE WHEN mean_years_experience > 4 THEN 'Senior Technical Experts'
  WHEN mean_expected_salary_inr > 1500000 THEN 'High-Value Candidates'
  WHEN mean_python_score > 7 AND mean_ml_score > 6 THEN 'Specialized Data/ML Talent'
  WHEN mean_years_experience <= 2 THEN 'Junior Entry-Level Talent' ELSE 'Mid-Level Generalists' END"""
REC_SQL = "CASE " + " ".join(f"WHEN contains(business_name, '{k}') THEN '{t}'" for k, t in CL.RECOMMENDATIONS) \
    + f" ELSE '{CL.DEFAULT_RECOMMENDATION}' END"


def _names(spark, sf):
    prof = CL.profile(prepared(spark, sf), FEATS, decimals=9)
    named = prof.select("cluster", "n_samples", CL.business_name(
        F.col("mean_years_experience"), F.col("mean_expected_salary_inr"), F.col("mean_python_score"),
        F.col("mean_ml_score")).alias("business_name"))
    return named.select("*", CL.recommendation(F.col("business_name")).alias("recommendation"))


query("h12_h13_business_names", with_ctes(
    f"""SELECT cluster, n_samples, business_name, {REC_SQL} AS recommendation FROM (
      SELECT cluster, n_samples, {NAME_SQL} AS business_name FROM (
        SELECT cluster, count(*) AS n_samples, {RAW_MEANS} FROM prep GROUP BY cluster))""", PREP_CTES))(_names)
query("d22_cluster_checks", with_ctes(
    f"""SELECT min(n) > 0 AND count(*) = {K} AS no_empty_clusters, min(n) >= (SELECT count(*) FROM prep) * 0.05
      AS cluster_sizes_reasonable, (SELECT count(cluster) FROM prep) = (SELECT count(*) FROM prep) AS all_samples_assigned
      FROM (SELECT cluster, count(*) AS n FROM prep GROUP BY cluster)""", PREP_CTES))(
    lambda s, d: CL.cluster_checks(prepared(s, d), k=K))
query("d28_five_number_summary", with_ctes(
    """SELECT cluster, quantile_cont(expected_salary_inr, 0.0) AS "min", quantile_cont(expected_salary_inr, 0.25) AS q1,
       quantile_cont(expected_salary_inr, 0.5) AS median, quantile_cont(expected_salary_inr, 0.75) AS q3,
       quantile_cont(expected_salary_inr, 1.0) AS "max" FROM prep GROUP BY cluster""", PREP_CTES))(
    lambda s, d: CL.five_numbers(prepared(s, d), "expected_salary_inr"))


def _sweep(spark, sf, ks=range(2, 11)):
    p = cut_lineage(CL.prepare(modelling_table(spark, sf)))
    rows = []
    for k in ks:
        lab = p.select(*Z, (F.col("years_experience").cast("int") % k).alias("cluster"))
        w, sil = CL.wcss_and_silhouette(lab, Z)
        rows.append(F.struct(F.lit(k).alias("k"), r(num(w), 6).alias("wcss"), r(num(sil), 9).alias("silhouette")))
    return spark.range(1).select(F.inline(F.array(*rows)))


def _sweep_sql(ks=range(2, 11)):
    parts = []
    for k in ks:
        lab = f"(SELECT *, CAST(years_experience AS INTEGER) % {k} AS c2 FROM prep)"
        cent = (f"(SELECT c2, count(*) AS n, " + ", ".join(f"avg({z}) AS {z}" for z in Z) + ", sum("
                + " + ".join(f"{z} * {z}" for z in Z) + ") AS q, " + ", ".join(f"sum({z}) AS s_{z}" for z in Z)
                + f" FROM {lab} GROUP BY c2)")
        sq = " + ".join(f"(p.{z} - c.{z}) * (p.{z} - c.{z})" for z in Z)
        wc = f"(SELECT round(sum({sq}), 6) FROM {lab} p JOIN {cent} c USING (c2))"
        sil = (SIL_SQL.replace("p.cluster = c.cluster", "p.c2 = c.c2").replace("FROM prep p, cent c", f"FROM {lab} p, {cent} c"))
        parts.append(f"SELECT {k} AS k, {wc} AS wcss, ({sil}) AS silhouette")
    return " UNION ALL ".join(parts)


query("k10_k_sweep_rule_labels", with_ctes(_sweep_sql(), PREP_CTES))(_sweep)
query("k10_choose_k", with_ctes(
    "SELECT first(k ORDER BY silhouette DESC, k) AS best_k, max(silhouette) AS best_silhouette FROM ("
    + _sweep_sql() + ")", PREP_CTES))(
    lambda s, d: _sweep(s, d).agg(F.max_by("k", F.struct(F.col("silhouette"), -F.col("k"))).alias("best_k"),
                                   F.max("silhouette").alias("best_silhouette")))


# ------------------------------------------------------------ K-Means, PCA (rows-only checks)
RESTARTS = {"k01": 20, "k02": 10, "k09": 10}


def _points(spark, sf):
    """The prepared rows with their vector, and the (h, x) table that K-Means reads."""
    p = cut_lineage(CL.prepare(modelling_table(spark, sf)).withColumn("x", F.array(*Z)))
    return p, KM.point_rows(p, Z)


def _kmeans(spark, sf, k=2):
    """The best of 20 restarts."""
    p, rows = _points(spark, sf)
    best = KM.best_of_restarts(rows, [k], RESTARTS["k01"])[k]
    return p.select(*FEATS, KM.labels(F.col("x"), best.centers).alias("cluster"))


query("k01_kmeans_best_of_seeds")(_kmeans)


def _kmeans_sweep(spark, sf, ks=range(2, 11)):
    """Cost and silhouette of the best of 10 restarts for every k, all 90 models in the same passes."""
    p, rows = _points(spark, sf)
    best = KM.best_of_restarts(rows, list(ks), RESTARTS["k02"])
    lab = cut_lineage(p.select(*Z, *[KM.labels(F.col("x"), m.centers).alias(f"c{k}") for k, m in best.items()]))
    out = [(k, m.cost, CL.silhouette_sq(lab, Z, f"c{k}").first()[0]) for k, m in sorted(best.items())]
    return spark.createDataFrame(out, "k int, wcss double, silhouette double")


query("k02_kmeans_k_sweep")(_kmeans_sweep)


def _stability(spark, sf, k=2, seeds=(42, 52, 62, 72, 82)):
    """Agreement of other seeds' models (best of 10 restarts each) with the first
    seed's, and the change of the silhouette; all labels are columns of one frame."""
    p, rows = _points(spark, sf)
    models = KM.fit_all(rows, [(k, s + 1000 * i) for s in seeds for i in range(RESTARTS["k09"])])
    per = [models[i * RESTARTS["k09"]:(i + 1) * RESTARTS["k09"]] for i in range(len(seeds))]
    best = [min(m, key=lambda v: v.cost) for m in per]
    lab = cut_lineage(p.select(*Z, *[KM.labels(F.col("x"), m.centers).alias(f"s{s}") for s, m in zip(seeds, best)]))
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("seed"), F.col(f"s{s}").alias("other")) for s in seeds[1:]]))
    pairs = lab.select(F.col(f"s{seeds[0]}").alias("base"), each.alias("v")).groupBy("v.seed", "base", "v.other").agg(
        F.count(F.lit(1)).alias("n"))
    counts = {}
    for r in small_rows(pairs, len(seeds) * k * k):
        counts.setdefault(r["seed"], {})[r["base"], r["other"]] = r["n"]
    silhouette = {s: CL.silhouette_sq(lab, Z, f"s{s}").first()[0] for s in seeds}
    out = [(s, *CL.pair_agreement(counts[s]), silhouette[s], silhouette[s] - silhouette[seeds[0]]) for s in seeds[1:]]
    return spark.createDataFrame(out, "seed int, ari double, nmi double, silhouette double, silhouette_change double")


query("k09_stability_over_seeds")(_stability)


def _pca95(spark, sf):
    p = CL.prepare(modelling_table(spark, sf))
    _, shares = CL.pca_fit(p, Z, variance=0.95)
    return spark.range(1).select(F.lit(len(shares)).alias("n_components"), F.lit(sum(shares)).alias("variance_retained"))


query("m08_pca_95_variance")(_pca95)


def _pca2(spark, sf):
    p = cut_lineage(CL.prepare(modelling_table(spark, sf)))
    loadings, _ = CL.pca_fit(p, Z, k=2)
    return p.select(*FEATS, *[c.alias(f"pc{i + 1}") for i, c in enumerate(CL.pca_project(Z, loadings))])


query("m09_pca_2d")(_pca2)
