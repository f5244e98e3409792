"""Deterministic splits, folds and class weights.

Row order inside a stratum is ``md5(id || '-' || seed)`` (the same text in
Spark and SQL). The exact row number in that order is computed without a
single-task window: rows are bucketed by the first 4 hex digits of the hash
(65,536 ordered buckets), bucket sizes are prefix-summed on the small
(strata x 65,536) table, and only the within-bucket rank uses a window whose
partitions are (stratum, bucket) -- uniform by construction of the hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from matchlake.operators.small import small_rows
from matchlake.session import cut_lineage

HEX_DIGITS = 4  # 16^4 = 65,536 ordered buckets
CUT_DIGITS = 3  # buckets that a cut is looked up in


def order_hash(id_col: str, seed) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))


def exact_row_number(df: DataFrame, id_col: str, seed, by=(), name: str = "rn",
                     size: str | None = None) -> DataFrame:
    """Row number 1..n per ``by`` stratum in (hash, id) order, exact; with
    ``size``, also the stratum's number of rows."""
    h = order_hash(id_col, seed)
    bucket = F.conv(F.substring(h, 1, HEX_DIGITS), 16, 10).cast("int")
    t = df.select("*", h.alias("_h"), bucket.alias("_b"))
    sizes = t.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy("_b")
    offsets = sizes.select(*by, "_b", F.coalesce(
        F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
        F.sum("_n").over(Window.partitionBy(*by)).alias("_size"))
    # Join and window share their keys, so the rows are dealt out once. No broadcast hint: callers choose the strata.
    inner = Window.partitionBy(*by, "_b").orderBy("_h", id_col)
    return (t.join(offsets, [*by, "_b"])
             .select(*df.columns, (F.col("_off") + F.row_number().over(inner)).alias(name),
                     *([F.col("_size").alias(size)] if size else [])))


def stratified_holdout(df: DataFrame, id_col: str, label: str, frac: float = 0.15,
                       seed=42, name: str = "is_test") -> DataFrame:
    """M1: the first round(frac * n_class) rows of each class are the test set."""
    out = exact_row_number(df, id_col, seed, by=[label], name="_rn", size="_stratum_n")
    return out.select(*df.columns, (F.col("_rn") <= F.round(F.lit(frac) * F.col("_stratum_n"))).alias(name))


def three_way_split(df: DataFrame, id_col: str, label: str, test_frac: float = 0.15,
                    calib_frac: float = 0.1764, seed=42) -> DataFrame:
    """M2: 'test' first, then 'calib' cut from the rest, else 'train'."""
    first = stratified_holdout(df, id_col, label, test_frac, seed, "_t")
    second = exact_row_number(first, id_col, f"{seed}b", by=[label, "_t"], name="_rn", size="_stratum_n")
    calib = F.col("_rn") <= F.round(F.lit(calib_frac) * F.col("_stratum_n"))
    return second.select(*df.columns, F.when(F.col("_t"), "test").when(calib, "calib").otherwise("train").alias("split"))


def kfold(df: DataFrame, id_col: str, k: int, seed=42, label: str | None = None,
          name: str = "fold") -> DataFrame:
    """M3 (stratified when ``label`` is given) / M4: fold = (rn - 1) mod k."""
    by = [label] if label else []
    rn = exact_row_number(df, id_col, seed, by=by, name="_rn")
    return rn.select(*df.columns, F.pmod(F.col("_rn") - 1, F.lit(k)).cast("int").alias(name))


def last_of_share(df: DataFrame, id_col: str, seed, by: list[str], frac: float, max_strata: int = 1000) -> list[Row]:
    """(``by``, _h, ``id_col``) of the last of the first round(frac * n) rows of each stratum
    in (hash, id) order. Only the rows of the bucket that it lies in are put in order."""
    h = order_hash(id_col, seed)
    bucket = F.substring(h, 1, CUT_DIGITS)
    t = df.select(*by, id_col, h.alias("_h"), bucket.alias("_b"))
    w = Window.partitionBy(*by)
    sizes = t.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n")).select(
        "*", F.sum("_n").over(w.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)).alias("_to"),
        F.round(F.lit(frac) * F.sum("_n").over(w)).cast("long").alias("_want"))
    here = (F.col("_to") - F.col("_n") < F.col("_want")) & (F.col("_want") <= F.col("_to"))
    wanted = F.lit(None).cast("long")
    for r in small_rows(sizes.where(here).select(*by, "_b", (F.col("_want") - F.col("_to") + F.col("_n")).alias("_k")), max_strata):
        same = F.col("_b") == r["_b"]
        for b in by:
            same = same & F.col(b).eqNullSafe(F.lit(r[b]))
        wanted = F.when(same, r["_k"]).otherwise(wanted)
    near = t.withColumn("_k", wanted).where("_k is not null")
    ranked = near.withColumn("_rn", F.row_number().over(w.orderBy("_h", id_col)))
    return small_rows(ranked.where("_rn = _k").select(*by, "_h", id_col), max_strata)


def split_and_folds(df: DataFrame, id_col: str, label: str, k: int, seed=42, test_frac: float = 0.15,
                    calib_frac: float = 0.1764) -> DataFrame:
    """``three_way_split`` and ``kfold`` by one seed: test set and folds follow the same
    order, so rows are dealt out and sorted once, and written; the calibration
    rows are those up to a cut, found without sorting the rows again."""
    rn = exact_row_number(df, id_col, seed, by=[label], name="_rn", size="_stratum_n")
    first = cut_lineage(rn.select(*df.columns, (F.col("_rn") <= F.round(F.lit(test_frac) * F.col("_stratum_n"))).alias("_t"),
                                  F.pmod(F.col("_rn") - 1, F.lit(k)).cast("int").alias("fold")))
    calib, h = F.lit(False), order_hash(id_col, f"{seed}b")
    for r in last_of_share(first.where(~F.col("_t")), id_col, f"{seed}b", [label], calib_frac):
        upto = (h < r["_h"]) | ((h == r["_h"]) & (F.col(id_col) <= F.lit(r[id_col])))
        calib = calib | (F.col(label).eqNullSafe(F.lit(r[label])) & upto)
    split = F.when(F.col("_t"), "test").when(calib, "calib").otherwise("train").alias("split")
    return first.select(*df.columns, split, "fold")


def fold_class_check(df: DataFrame, fold: str = "fold", label: str = "label") -> DataFrame:
    """M5: both classes present in every fold (train and validation side)."""
    per = df.groupBy(fold).agg(F.count_distinct(label).alias("val_classes"),
                               F.count(F.lit(1)).alias("val_rows"),
                               F.sum(F.col(label).cast("long")).alias("val_pos"))
    tot = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("long")).alias("pos"))
    n, pos = tot.select("n").scalar(), tot.select("pos").scalar()
    train_pos = pos - F.col("val_pos")
    train_neg = (n - pos) - (F.col("val_rows") - F.col("val_pos"))
    train_classes = (train_pos > 0).cast("int") + (train_neg > 0).cast("int")
    return per.select(fold, "val_rows", "val_classes", train_classes.alias("train_classes"),
                      ((F.col("val_classes") == 2) & (train_classes == 2)).alias("both_classes"))


def balanced_weights(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """M6: weight n / (2 * n_class), attached per row; labels
    may be many, so the join has no hint."""
    n = df.select(F.count(F.lit(1))).scalar()
    w = df.groupBy(label).agg((n / (F.lit(2.0) * F.count(F.lit(1)))).alias(name))
    return df.join(w, label)
