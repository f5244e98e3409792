"""Segmentation: preparation, cluster quality, agreement, profiles, naming,
PCA (K3-K12, D21, D22, D28, H12, H13, M8, M9); K-Means itself is in ``kmeans``.

Scale design: every quality metric is computed from per-cluster statistics
(k rows, k is a parameter) plus one map-side pass over the rows. The small
per-cluster table (checked bound) reaches the rows as a literal array used by
higher-order functions; no pair of rows is ever formed.
Silhouette therefore uses squared Euclidean distance, whose per-cluster mean
decomposes as n*|x|^2 - 2 x.S + Q (the exact Euclidean form needs all pairs).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.operators import prep as PR
from matchlake.operators.quantiles import percentiles
from matchlake.operators.small import num, one_row, small_rows

# The ten segmentation features, in their published order.
CLUSTER_FEATURES = ["years_experience", "python_score", "sql_score", "ml_score", "statistics_score",
                    "data_structures_score", "javascript_score", "expected_salary_inr",
                    "exp_required_years", "salary_offered_inr"]


def prepare(modelling: DataFrame, cols=CLUSTER_FEATURES) -> DataFrame:
    """Median-impute, de-duplicate, then add ``z_<col>`` standardized columns."""
    imp = PR.dedup(PR.impute_median(modelling, cols), cols)
    z = PR.standardize(imp, cols, keep=cols, suffix="__z")
    return z.select(*cols, *[F.col(f"{c}__z").alias(f"z_{c}") for c in cols])


def _vec(cols) -> Column:
    return F.array(*[F.col(c).cast("double") for c in cols])


def _sq(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _plain_dot(cols, values) -> Column:
    """``_dot`` of columns with columns or numbers, written out (compiled, unlike functions over arrays)."""
    total = F.lit(0.0)
    for c, v in zip(cols, values):
        total = total + F.col(c).cast("double") * (F.col(v).cast("double") if isinstance(v, str) else num(v))
    return total


def _own_sq(cols, stats: list[dict], cluster: str) -> Column:
    """Squared distance of a row to its cluster's mean, written out."""
    out = F.lit(None).cast("double")
    for e in stats:
        total = F.lit(0.0)
        for c, m in zip(cols, e["mu"]):
            step = F.col(c).cast("double") - num(m)
            total = total + step * step
        out = F.when(F.col(cluster) == F.lit(e["c"]), total).otherwise(out)
    return out


def centroids(df: DataFrame, cols, cluster: str = "cluster") -> DataFrame:
    """Size and mean vector per cluster."""
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in cols])


def cluster_stats(df: DataFrame, cols, cluster: str = "cluster", max_k: int = 1000) -> list[dict]:
    """Per-cluster size, coordinate sums, mean and sum of squared norms; one
    aggregate job, at most ``max_k`` rows brought back (checked)."""
    agg = df.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(c).cast("double")).alias(f"s_{i}") for i, c in enumerate(cols)],
        F.sum(_plain_dot(cols, cols)).alias("q"))
    out = []
    for r in sorted(small_rows(agg, max_k), key=lambda r: r[cluster]):
        sums = [r[f"s_{i}"] for i in range(len(cols))]
        out.append({"c": r[cluster], "n": r["n"], "s": sums, "mu": [v / r["n"] for v in sums], "q": r["q"]})
    return out


def _stats_array(stats: list[dict]) -> Column:
    return F.array(*[F.struct(F.lit(e["c"]).alias("c"), F.lit(e["n"]).cast("long").alias("n"),
                              F.array(*[num(v) for v in e["mu"]]).alias("mu"),
                              F.array(*[num(v) for v in e["s"]]).alias("s"), num(e["q"]).alias("q"))
                     for e in stats])


def _own(arr: Column, cluster: str) -> Column:
    return F.filter(arr, lambda e: e["c"] == F.col(cluster))[0]


def wcss(df: DataFrame, cols, cluster: str = "cluster", stats: list[dict] | None = None) -> DataFrame:
    """K3: within-cluster sum of squared distances to the centroid."""
    return df.select(_own_sq(cols, stats or cluster_stats(df, cols, cluster), cluster).alias("d2")).agg(F.sum("d2").alias("wcss"))


def silhouette_sq(df: DataFrame, cols, cluster: str = "cluster", stats: list[dict] | None = None) -> DataFrame:
    """K4 (squared Euclidean): mean over rows of (b - a) / max(a, b);
    a singleton cluster scores 0."""
    return silhouette_rows(df, cols, cluster, stats or cluster_stats(df, cols, cluster)).agg(F.avg("s").alias("silhouette"))


def silhouette_rows(df: DataFrame, cols, cluster: str, stats: list[dict], *keep: Column) -> DataFrame:
    """Each row's silhouette ``s``, next to ``keep``. A row's sum of squared distances to a
    cluster comes from the cluster's sums; one column for each cluster."""
    kept = [c.alias(f"_k{i}") for i, c in enumerate(keep)]
    x = df.select(F.col(cluster).alias("_c"), *[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(cols)],
                  _plain_dot(cols, cols).alias("_xx"), *kept)
    names = [f"_x{i}" for i in range(len(cols))]
    totals = [(F.lit(e["n"]) * F.col("_xx") - 2 * _plain_dot(names, e["s"]) + num(e["q"])).alias(f"_t{j}") for j, e in enumerate(stats)]
    wide = x.select("_c", *totals, *[f"_k{i}" for i in range(len(keep))])
    none = F.lit(None).cast("double")
    own, others, lone = [none], [none, none], F.lit(False)
    for j, e in enumerate(stats):
        same = F.col("_c") == F.lit(e["c"])
        others.append(F.when(~same, F.col(f"_t{j}") / F.lit(e["n"])))
        if e["n"] > 1:
            own.append(F.when(same, F.col(f"_t{j}") / F.lit(e["n"] - 1)))
        else:
            lone = lone | same
    a, b = F.coalesce(*own), F.least(*others)
    far = wide.select(a.alias("_a"), b.alias("_b"), lone.alias("_lone"), *[f"_k{i}" for i in range(len(keep))])
    s = F.when(F.col("_lone"), F.lit(0.0)).otherwise((F.col("_b") - F.col("_a")) / F.greatest("_a", "_b"))
    return far.select(s.alias("s"), *[f"_k{i}" for i in range(len(keep))])


def wcss_and_silhouette(df: DataFrame, cols, cluster: str = "cluster") -> tuple[float, float]:
    """K3 and K4 in one pass after the clusters' sums."""
    stats = cluster_stats(df, cols, cluster)
    row = one_row(silhouette_rows(df, cols, cluster, stats, _own_sq(cols, stats, cluster)).agg(
        F.sum("_k0").alias("wcss"), F.avg("s").alias("silhouette")))
    return row["wcss"], row["silhouette"]


def calinski_harabasz(df: DataFrame, cols, cluster: str = "cluster") -> DataFrame:
    """K5: (between / (k - 1)) / (within / (n - k))."""
    st = cluster_stats(df, cols, cluster)
    k, n = len(st), sum(e["n"] for e in st)
    mean = [sum(e["s"][i] for e in st) / n for i in range(len(cols))]
    between = sum(e["n"] * sum((m - g) ** 2 for m, g in zip(e["mu"], mean)) for e in st)
    return wcss(df, cols, cluster, st).select(
        ((F.lit(between) / (k - 1)) / (F.col("wcss") / (n - k))).alias("calinski_harabasz"))


def davies_bouldin(df: DataFrame, cols, cluster: str = "cluster") -> DataFrame:
    """K6: mean over clusters of the worst (s_i + s_j) / |mu_i - mu_j|."""
    st = cluster_stats(df, cols, cluster)
    own = _own(_stats_array(st), cluster)
    scatter = (df.select(F.col(cluster), F.sqrt(_own_sq(cols, st, cluster)).alias("d"))
                 .groupBy(cluster).agg(F.avg("d").alias("s")))
    sc = {r[cluster]: r["s"] for r in small_rows(scatter, len(st))}
    others = F.array(*[F.struct(F.lit(e["c"]).alias("c"), F.array(*[num(v) for v in e["mu"]]).alias("mu"),
                                num(sc[e["c"]]).alias("s")) for e in st])
    mu_i = own["mu"]
    worst = F.array_max(F.transform(F.filter(others, lambda j: j["c"] != F.col(cluster)),
                                    lambda j: (F.col("s") + j["s"]) / F.sqrt(_sq(mu_i, j["mu"]))))
    return scatter.select(worst.alias("w")).agg(F.avg("w").alias("davies_bouldin"))


def _comb2(c: Column) -> Column:
    return c.cast("double") * (c - 1) / 2


def adjusted_rand(df: DataFrame, a: str, b: str) -> DataFrame:
    """K7: adjusted Rand index from the contingency table (bounded by ka x kb)."""
    ct = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("nij"))
    sa = one_row(ct.groupBy(a).agg(F.sum("nij").alias("ai")).agg(F.sum(_comb2(F.col("ai"))).alias("x")))["x"]
    sb = one_row(ct.groupBy(b).agg(F.sum("nij").alias("bj")).agg(F.sum(_comb2(F.col("bj"))).alias("x")))["x"]
    g = ct.agg(F.sum(_comb2(F.col("nij"))).alias("index"), F.sum("nij").alias("n"))
    expected = F.lit(sa * sb) / _comb2(F.col("n"))
    mx = F.lit((sa + sb) / 2)
    ari = F.when(mx == expected, F.lit(1.0)).otherwise((F.col("index") - expected) / (mx - expected))
    return g.select(ari.alias("ari"))


def normalized_mutual_info(df: DataFrame, a: str, b: str) -> DataFrame:
    """K8: MI / arithmetic mean of the two entropies."""
    ct = df.groupBy(a, b).agg(F.count(F.lit(1)).alias("nij"))
    n = one_row(ct.agg(F.sum("nij").alias("n")))["n"]
    ai = ct.groupBy(a).agg(F.sum("nij").alias("ai"))
    bj = ct.groupBy(b).agg(F.sum("nij").alias("bj"))
    ent = lambda t, c: one_row(t.agg((-F.sum(F.col(c) / n * F.log(F.col(c) / n))).alias("h")))["h"]
    ha, hb = ent(ai, "ai"), ent(bj, "bj")
    mi = (ct.join(ai, a).join(bj, b)
            .agg(F.sum(F.col("nij") / n * F.log(F.lit(n) * F.col("nij") / (F.col("ai") * F.col("bj")))).alias("mi")))
    nmi = F.lit(1.0) if (ha + hb) == 0 else F.col("mi") / F.lit((ha + hb) / 2)
    return mi.select(F.greatest(nmi, F.lit(0.0)).alias("nmi"))


def assign_nearest(df: DataFrame, centers: DataFrame, cols, cluster: str = "cluster",
                   out: str = "cluster", max_k: int = 1000) -> DataFrame:
    """Nearest-centroid assignment; the centroid table (k rows, checked)
    becomes a literal array, ties go to the lower cluster id."""
    rows = sorted(small_rows(centers.select(cluster, *cols), max_k), key=lambda r: r[cluster])
    arr = F.array(*[F.struct(F.lit(r[cluster]).alias("c"), F.array(*[num(r[c]) for c in cols]).alias("mu"))
                    for r in rows])
    x = _vec(cols)
    d = F.transform(arr, lambda e: F.struct(_sq(x, e["mu"]).alias("d"), e["c"].alias("c")))
    return df.select("*", F.array_min(d)["c"].alias(out))


def profile(df: DataFrame, cols, cluster: str = "cluster", decimals: int = 2) -> DataFrame:
    """Size and rounded means per cluster."""
    return df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n_samples"),
                                   *[F.round(F.avg(c), decimals).alias(f"mean_{c}") for c in cols])


def cluster_checks(df: DataFrame, cluster: str = "cluster", min_share: float = 0.05,
                   k: int | None = None) -> DataFrame:
    """No empty cluster, each >= ``min_share`` of rows, all rows assigned."""
    sizes = df.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))
    tot = one_row(df.agg(F.count(F.lit(1)).alias("t"), F.count(cluster).alias("a")))
    total, assigned = tot["t"], tot["a"]
    agg = sizes.agg(F.min("n").alias("min_n"), F.sum("n").alias("sum_n"), F.count(F.lit(1)).alias("k"))
    no_empty = (F.col("min_n") > 0) & (F.col("k") == (F.lit(k) if k else F.col("k")))
    return agg.select(no_empty.alias("no_empty_clusters"),
                      (F.col("min_n") >= F.lit(total * min_share)).alias("cluster_sizes_reasonable"),
                      F.lit(assigned == total).alias("all_samples_assigned"))


def five_numbers(df: DataFrame, col: str, cluster: str = "cluster") -> DataFrame:
    """Min, quartiles, max per cluster (exact, interpolated)."""
    return percentiles(df, col, [0.0, 0.25, 0.5, 0.75, 1.0], [cluster]).select(
        cluster, *[F.col("q")[i].alias(n) for i, n in enumerate(["min", "q1", "median", "q3", "max"])])


# The business names, in rule order, and the name of what no rule takes.
NAMES = ["Senior Technical Experts", "High-Value Candidates", "Specialized Data/ML Talent", "Junior Entry-Level Talent"]
DEFAULT_NAME = "Mid-Level Generalists"
# Recommendation per name keyword, in rule order.
RECOMMENDATIONS = [
    ("Senior", "Fast-track for leadership roles; prioritize direct interviews with senior engineering managers."),
    ("High-Value", "Ensure competitive compensation packages and highlight company culture to win them."),
    ("Data/ML", "Target for specialized AI roles; emphasize challenging technical problems in the offer."),
    ("Junior", "Funnel into graduate programs or bootcamps; focus on high-volume automated assessments."),
]
DEFAULT_RECOMMENDATION = "Standard interview pipeline; evaluate for general software engineering positions."


def business_name(years: Column, salary: Column, python: Column, ml: Column,
                  senior_years: float = 4, high_salary: float = 1500000,
                  python_min: float = 7, ml_min: float = 6, junior_years: float = 2) -> Column:
    """Ordered rule on cluster means (thresholds are parameters)."""
    return (F.when(years > senior_years, NAMES[0])
             .when(salary > high_salary, NAMES[1])
             .when((python > python_min) & (ml > ml_min), NAMES[2])
             .when(years <= junior_years, NAMES[3])
             .otherwise(DEFAULT_NAME))


def recommendation(name: Column) -> Column:
    """Recommendation text from the business name."""
    expr = None
    for key, text in RECOMMENDATIONS:
        expr = F.when(name.contains(key), text) if expr is None else expr.when(name.contains(key), text)
    return expr.otherwise(DEFAULT_RECOMMENDATION)


# ------------------------------------------------------------------ agreement of labellings
def pair_agreement(counts: dict[tuple, int]) -> tuple[float, float]:
    """(adjusted Rand index, normalised mutual information) of a contingency
    table {(label, other label): rows}, for tables of k x k numbers."""
    n = sum(counts.values())
    rows, cols = {}, {}
    for (a, b), c in counts.items():
        rows[a], cols[b] = rows.get(a, 0) + c, cols.get(b, 0) + c
    pairs = lambda values: sum(c * (c - 1) / 2 for c in values)
    sa, sb, both = pairs(rows.values()), pairs(cols.values()), pairs(counts.values())
    expected, most = sa * sb / (n * (n - 1) / 2) if n > 1 else 0.0, (sa + sb) / 2
    ari = 1.0 if most == expected else (both - expected) / (most - expected)
    entropy = lambda values: -sum(c / n * math.log(c / n) for c in values if c)
    mutual = sum(c / n * math.log(n * c / (rows[a] * cols[b])) for (a, b), c in counts.items() if c)
    half = (entropy(rows.values()) + entropy(cols.values())) / 2
    return ari, 1.0 if half == 0 else min(1.0, max(0.0, mutual / half))


# ------------------------------------------------------------------ PCA
def pca_fit(df: DataFrame, cols, k: int | None = None, variance: float = 0.95) -> tuple[list[list[float]], list[float]]:
    """M8 / M9: (loadings, explained variance) of the first ``k`` components, or of
    the fewest that explain ``variance``. The largest loading of a component is
    positive, so its sign does not depend on the solver."""
    from pyspark.ml.feature import PCA, VectorAssembler
    data = VectorAssembler(inputCols=list(cols), outputCol="features").transform(df)
    full = PCA(k=len(cols), inputCol="features", outputCol="pca").fit(data)
    shares = list(full.explainedVariance)
    if k is None:
        total = [sum(shares[:i + 1]) for i in range(len(shares))]
        k = next((i + 1 for i, v in enumerate(total) if v >= variance - 1e-12), len(shares))
    loadings = []
    for c in full.pc.toArray().T[:k]:
        largest = max(c, key=abs)
        loadings.append([float(-v if largest < 0 else v) for v in c])
    return loadings, [float(v) for v in shares[:k]]


def pca_project(cols, loadings: list[list[float]]) -> list[Column]:
    """The component scores of standardized columns."""
    return [sum((num(w) * F.col(c) for w, c in zip(one, cols)), F.lit(0.0)) for one in loadings]
