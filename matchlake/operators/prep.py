"""Preparation: scaling, imputation, data and label checks, dedup,
correlations (M7, D18-D20, D23, G1).

Column statistics are one-row aggregates (bounded by the number of columns)
fetched with a checked bound and applied as literals: one job per statistic
set, and no row-level join is needed to apply them.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.operators.quantiles import medians
from matchlake.operators.small import num, one_row, small_rows


def standardize(df: DataFrame, cols: list[str], keep: list[str] | None = None,
                suffix: str = "") -> DataFrame:
    """M7: (x - mean) / population std; a constant column gets scale 1."""
    st = one_row(df.agg(*[F.avg(c).alias(f"m_{c}") for c in cols],
                        *[F.stddev_pop(c).alias(f"s_{c}") for c in cols]))
    out = []
    for c in cols:
        m, s = st[f"m_{c}"], st[f"s_{c}"]
        scale = 1.0 if (s is None or s == 0) else s
        out.append(((F.col(c) - num(m)) / num(scale)).alias(c + suffix))
    return df.select(*(keep or []), *out)


def impute_median(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """Exact median per column (interpolated, like pandas); absent -> 0.0."""
    present = [c for c in cols if c in df.columns]
    med = {r["name"]: r["q"][0] for r in small_rows(medians(df, present), len(present))} if present else {}
    out = []
    for c in cols:
        if c in df.columns:
            out.append(F.coalesce(F.col(c).cast("double"), num(med.get(c))).alias(c))
        else:
            out.append(F.lit(0.0).alias(c))
    return df.select(*(keep or []), *out)


def check_dataset(df: DataFrame, cols: list[str]) -> DataFrame:
    """Nulls, infinities, duplicate rows, zero variance, single value."""
    aggs = [F.count(F.lit(1)).alias("n_rows"),
            sum((F.count_if(F.col(c).isNull()) for c in cols), F.lit(0)).alias("n_null"),
            sum((F.count_if(F.abs(F.col(c).cast("double")) == float("inf")) for c in cols),
                F.lit(0)).alias("n_inf")]
    aggs += [F.var_samp(c).alias(f"v_{c}") for c in cols]
    aggs += [(F.min(c) != F.max(c)).alias(f"u_{c}") for c in cols]
    a = df.agg(*aggs)
    dup = df.select(*cols).distinct().select(F.count(F.lit(1))).scalar()
    min_var = F.least(*[F.col(f"v_{c}") for c in cols]) if len(cols) > 1 else F.col(f"v_{cols[0]}")
    all_multi = F.lit(True)
    for c in cols:
        all_multi = all_multi & F.coalesce(F.col(f"u_{c}"), F.lit(False))
    return a.select("n_rows", "n_null", "n_inf", (F.col("n_rows") - dup).alias("n_duplicates"),
                    min_var.alias("min_variance"), all_multi.alias("all_multi_valued")).select(
        "*", ((F.col("n_null") == 0) & (F.col("n_inf") == 0) & (F.col("n_duplicates") == 0)
              & (F.col("min_variance") > 0) & F.col("all_multi_valued")).alias("passed"))


def check_labels(df: DataFrame, label: str = "label", min_per_class: int = 10) -> DataFrame:
    """>= 2 classes, warn under ``min_per_class``, reject NaN/Inf/null."""
    y = F.col(label).cast("double")
    per = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    bad = df.agg(F.count_if(y.isNull() | F.isnan(y) | (F.abs(y) == float("inf"))).alias("bad"))
    return per.agg(F.count(F.lit(1)).alias("n_classes"), F.min("n").alias("min_class_count")).select(
        "*", bad.select("bad").scalar().alias("n_invalid")).select(
        "*", (F.col("n_classes") >= 2).alias("enough_classes"),
        (F.col("min_class_count") < min_per_class).alias("small_class_warning"),
        ((F.col("n_classes") >= 2) & (F.col("n_invalid") == 0)).alias("passed"))


def dedup(df: DataFrame, cols: list[str]) -> DataFrame:
    """G1: distinct rows on the given columns."""
    return df.select(*cols).distinct()


def correlations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every column pair, long form, one pass."""
    pairs = list(combinations(cols, 2))
    a = df.agg(*[F.corr(x, y).alias(f"{x}__{y}") for x, y in pairs])
    rows = F.array(*[F.struct(F.lit(x).alias("feature_a"), F.lit(y).alias("feature_b"),
                              F.col(f"{x}__{y}").alias("corr")) for x, y in pairs])
    return a.select(F.inline(rows))
