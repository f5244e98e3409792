"""Rank metrics, curves and threshold sweeps.

Scale design
------------
* Nothing sorts the raw rows in one task. Rows are first aggregated to
  per-distinct-score counts (``score_counts``: partial aggregation, one
  shuffle); cumulative counts (E2) rank scores inside score buckets, and a
  table with a row per bucket carries the sums above. Exact on raw scores.
* Fixed threshold grids never join rows to thresholds: each row gets the
  number of grid points <= its score (an exact arithmetic index), rows are
  counted per index, and the per-threshold confusion counts are a wide
  aggregate over that (#grid+1)-row table, unpivoted afterwards.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.functions.numeric import grid_mean
from matchlake.operators.metrics import LABEL, PROB, ratio
from matchlake.session import cut_lineage

INF = float("inf")


# ---------------------------------------------------------------- grids
def arange_grid(start: float, stop: float, step: float) -> list[float]:
    """Like numpy.arange: start + i*step for i < ceil((stop-start)/step)."""
    n = int(math.ceil((stop - start) / step))
    return [start + i * step for i in range(n)]


def linspace_grid(start: float, stop: float, num: int) -> list[float]:
    """Like numpy.linspace with endpoint: i*step + start, last point = stop."""
    step = (stop - start) / (num - 1)
    return [i * step + start for i in range(num - 1)] + [stop]


def grid_index(p: Column, grid: list[float]) -> Column:
    """Exact number of grid points <= p for an increasing, evenly spaced grid.

    An arithmetic estimate is corrected by comparing with the neighbouring
    grid values, so float error in the division can never move a row across
    a threshold.
    """
    n = len(grid)
    start = grid[0]
    step = (grid[-1] - grid[0]) / (n - 1) if n > 1 else 1.0
    arr = F.array(*[F.lit(float(t)) for t in grid])
    est = F.least(F.greatest(F.floor((p - F.lit(start)) / F.lit(step)).cast("int") + 1, F.lit(0)), F.lit(n))
    up = F.when((est < n) & (F.element_at(arr, F.least(est + 1, F.lit(n))) <= p), est + 1)
    down = F.when((est > 0) & (F.element_at(arr, F.greatest(est, F.lit(1))) > p), est - 1)
    return F.coalesce(up, down, est)


# ---------------------------------------------------------------- counts
def score_counts(df: DataFrame, by=(), score: str = PROB, label: str = LABEL) -> DataFrame:
    """Positives / negatives per distinct score (map-side combined)."""
    y = F.col(label).cast("long")
    return (df.groupBy(*by, F.col(score).alias("score"))
              .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg")))


OCTAVE = 512  # score buckets per factor of two


def score_bucket(score: Column) -> Column:
    """A number that never falls as the score rises, from the score alone:
    logarithmic steps away from 0 on both sides and towards 1, so crowded
    scores near 0 and 1 still spread. At most a few hundred thousand values."""
    def steps(x: Column) -> Column:
        return F.least(F.floor(F.log2(x) * OCTAVE), F.lit(OCTAVE * 1024)).cast("long")

    return (F.when(score.isNull(), F.lit(-10_000_000)).when(F.isnan(score), F.lit(10_000_000))
            .when(score < 0, F.lit(-2_000_000) - steps(-score)).when(score == 0, F.lit(-1_000_000))
            .when(score < 0.5, steps(score)).when(score < 1, -steps(1 - score))
            .otherwise(F.lit(2_000_000) + steps(score)).cast("long"))


def ranked_counts(df: DataFrame, by=(), score: str = PROB, label: str = LABEL) -> DataFrame:
    """Counts per distinct score with tp / fp (counts at this score or above),
    group totals P / N, and the counts of the next lower score (null at the
    lowest). Exact for raw scores: rows are ranked inside score buckets only,
    and a table with a row per bucket carries what lies above. The counts are
    written, so that the scored rows are read once."""
    return ranked(score_counts(df, by, score, label), by)


def ranked(counts: DataFrame, by=()) -> DataFrame:
    """``ranked_counts`` of a table of (score, pos, neg) per group."""
    c = cut_lineage(counts.withColumn("_bucket", score_bucket(F.col("score").cast("double"))))
    order = F.col("score").desc()
    per = c.groupBy(*by, "_bucket").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"),
                                        F.max_by(F.struct("pos", "neg"), F.struct("score")).alias("_top"))
    group = Window.partitionBy(*by)  # over the bucket table only
    down = group.orderBy(F.col("_bucket").desc())
    above = down.rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*[F.col(k).alias(f"_by_{i}") for i, k in enumerate(by)], F.col("_bucket").alias("_b"),
                     F.coalesce(F.sum("_p").over(above), F.lit(0)).alias("_above_p"),
                     F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_above_n"),
                     F.sum("_p").over(group).alias("P"), F.sum("_n").over(group).alias("N"),
                     F.lead("_top").over(down).alias("_below"))
    same = F.col("_bucket") == F.col("_b")
    for i, k in enumerate(by):
        same = same & F.col(k).eqNullSafe(F.col(f"_by_{i}"))
    inside = Window.partitionBy(*by, "_bucket").orderBy(order)
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    return c.join(per, same).select(
        *by, "score", "pos", "neg", (F.col("_above_p") + F.sum("pos").over(upto)).alias("tp"),
        (F.col("_above_n") + F.sum("neg").over(upto)).alias("fp"), "P", "N",
        F.coalesce(F.lead(F.struct("pos", "neg")).over(inside), F.col("_below")).alias("next"))


def cumulative_counts(df: DataFrame, by=(), score: str = PROB, label: str = LABEL) -> DataFrame:
    """For each distinct score s (descending): tp / fp = counts with
    score >= s, plus the group totals P and N."""
    return ranked_counts(df, by, score, label).drop("next")


def _roc_sums() -> list[Column]:
    wide = lambda col: col.cast("decimal(18,0)")
    return [F.sum(wide(F.col("pos")) * wide(2 * (F.col("N") - F.col("fp")) + F.col("neg"))).alias("u2"),
            F.sum("pos").alias("_p"), F.sum("neg").alias("_n")]


def _roc_area() -> Column:
    return F.when((F.col("_p") == 0) | (F.col("_n") == 0), F.lit(None).cast("double")).otherwise(
        F.col("u2").cast("double") / (F.lit(2.0) * F.col("_p") * F.col("_n")))


def roc_auc(df: DataFrame, by=(), score: str = PROB, label: str = LABEL,
            name: str = "roc_auc") -> DataFrame:
    """Mann-Whitney AUC with ties counted half; null when a class is absent.

    Numerator and denominator are whole-number sums, so the value is exact; the
    products of counts are 38-digit decimals, which billions of rows do not overflow.
    """
    return cumulative_counts(df, by, score, label).groupBy(*by).agg(*_roc_sums()).select(*by, _roc_area().alias(name))


def pr_points(df: DataFrame, by=(), score: str = PROB, label: str = LABEL) -> DataFrame:
    """(threshold, precision, recall) per distinct score, descending, plus
    the closing (recall 0, precision 1) point with a null threshold."""
    c = cumulative_counts(df, by, score, label)
    recall = F.when(F.col("P") == 0, F.lit(1.0)).otherwise(F.col("tp") / F.col("P"))
    pts = c.select(*by, F.col("score").alias("threshold"),
                   ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                   recall.alias("recall"))
    groups = pts.select(*by).distinct() if by else None
    anchor_cols = [F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"),
                   F.lit(0.0).alias("recall")]
    anchor = (groups.select(*by, *anchor_cols) if by
              else df.sparkSession.range(1).select(*anchor_cols))
    return pts.unionByName(anchor)


def _step_area() -> Column:
    """The area between a score's point and the one before it."""
    tp, fp = F.col("tp"), F.col("fp")
    tp0, fp0 = tp - F.col("pos"), fp - F.col("neg")  # at the score before
    r0 = F.when(tp0 + fp0 == 0, F.lit(0.0)).otherwise(tp0 / F.col("P"))
    p0 = F.when(tp0 + fp0 == 0, F.lit(1.0)).otherwise(ratio(tp0, tp0 + fp0))
    return (tp / F.col("P") - r0) * (ratio(tp, tp + fp) + p0) / 2


def pr_auc(df: DataFrame, by=(), score: str = PROB, label: str = LABEL,
           name: str = "pr_auc") -> DataFrame:
    """D5 + E4: trapezoid over (recall, precision) in descending-score order,
    starting from the (0, 1) anchor."""
    return cumulative_counts(df, by, score, label).groupBy(*by).agg(F.sum(_step_area()).alias(name))


def rank_areas(df: DataFrame, by=(), score: str = PROB, label: str = LABEL) -> DataFrame:
    """D4 and D5 from the same counts."""
    return areas_of(score_counts(df, by, score, label), by)


def areas_of(counts: DataFrame, by=()) -> DataFrame:
    """D4 and D5 of a table of (score, pos, neg) per group."""
    sums = ranked(counts, by).groupBy(*by).agg(*_roc_sums(), F.sum(_step_area()).alias("pr_auc"))
    return sums.select(*by, _roc_area().alias("roc_auc"), "pr_auc")


def roc_points(df: DataFrame, by=(), score: str = PROB, label: str = LABEL,
               drop_intermediate: bool = True) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, descending, after the
    (0, 0, +inf) origin. With ``drop_intermediate`` collinear points on
    horizontal/vertical runs are removed (second differences zero)."""
    c = ranked_counts(df, by, score, label)
    if drop_intermediate:
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        c = c.filter(F.col("next").isNull() | first | (F.col("next.pos") != F.col("pos"))
                     | (F.col("next.neg") != F.col("neg")))
    pts = c.select(*by, F.col("score").alias("threshold"),
                   F.when(F.col("N") == 0, F.lit(None).cast("double")).otherwise(F.col("fp") / F.col("N")).alias("fpr"),
                   F.when(F.col("P") == 0, F.lit(None).cast("double")).otherwise(F.col("tp") / F.col("P")).alias("tpr"))
    origin_cols = [F.lit(INF).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")]
    origin = (pts.select(*by).distinct().select(*by, *origin_cols) if by
              else df.sparkSession.range(1).select(*origin_cols))
    return pts.unionByName(origin)


def reliability(df: DataFrame, by=(), prob: str = PROB, label: str = LABEL,
                n_bins: int = 10, grid_decimals: int | None = None) -> DataFrame:
    """Equal-width bins, a value on an inner edge goes to the lower bin;
    empty bins are absent. With ``grid_decimals`` (scores already rounded) the
    bin mean is the exact integer-sum mean."""
    b = F.least(F.greatest(F.ceil(F.col(prob) * n_bins).cast("int") - 1, F.lit(0)), F.lit(n_bins - 1))
    mean = grid_mean(F.col(prob), grid_decimals) if grid_decimals is not None else F.avg(prob)
    return df.groupBy(*by, b.alias("bin")).agg(
        mean.alias("mean_predicted"), F.avg(F.col(label).cast("double")).alias("fraction_positive"),
        F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- sweeps
def threshold_sweep(df: DataFrame, grid: list[float], by=(), prob: str = PROB,
                    label: str = LABEL, cost_fp: float = 1.0, cost_fn: float = 5.0) -> DataFrame:
    """Confusion counts, rates and cost at every grid threshold (p >= t)."""
    y = F.col(label).cast("long")
    idx = grid_index(F.col(prob), grid)
    per_idx = df.groupBy(*by, idx.alias("c")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
    n = len(grid)
    aggs = [F.sum("pos").alias("P"), F.sum("neg").alias("N")]
    for i in range(n):
        aggs.append(F.sum(F.when(F.col("c") > i, F.col("pos")).otherwise(0)).alias(f"tp{i}"))
        aggs.append(F.sum(F.when(F.col("c") > i, F.col("neg")).otherwise(0)).alias(f"fp{i}"))
    wide = per_idx.groupBy(*by).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(t)).alias("threshold"),
                              F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"))
                     for i, t in enumerate(grid)])
    long = wide.select(*by, "P", "N", F.inline(rows))
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = F.col("P") - tp, F.col("N") - fp
    return long.select(
        *by, "i", "threshold", tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"),
        ratio(tp, tp + fp).alias("precision"), ratio(tp, F.col("P")).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        ratio(tp + tn, F.col("P") + F.col("N")).alias("accuracy"),
        (fp * F.lit(float(cost_fp)) + fn * F.lit(float(cost_fn))).alias("cost"))


def best_f1_threshold(sweep: DataFrame, by=(), default: float = 0.5) -> DataFrame:
    """First grid point with the maximum F1 (strictly above 0),
    else the default threshold."""
    best = F.max_by(F.struct("threshold", "f1"), F.struct(F.col("f1"), -F.col("i")))
    g = sweep.groupBy(*by).agg(best.alias("b"))
    return g.select(*by, F.when(F.col("b.f1") > 0, F.col("b.threshold")).otherwise(F.lit(default)).alias("best_threshold"),
                    F.when(F.col("b.f1") > 0, F.col("b.f1")).otherwise(F.lit(0.0)).alias("best_f1"))


def min_cost_threshold(sweep: DataFrame, by=()) -> DataFrame:
    """First grid point with the minimum cost."""
    best = F.min_by(F.struct("threshold", "cost", "fp", "fn"), F.struct(F.col("cost"), F.col("i")))
    g = sweep.groupBy(*by).agg(best.alias("b"))
    return g.select(*by, F.col("b.threshold").alias("best_threshold"), F.col("b.cost").alias("min_cost"),
                    F.col("b.fp").alias("fp"), F.col("b.fn").alias("fn"))


def best_f1_observed(df: DataFrame, by=(), score: str = PROB, label: str = LABEL,
                     default: float = 0.5) -> DataFrame:
    """Best F1 over the observed scores as thresholds; ties -> lowest."""
    c = cumulative_counts(df, by, score, label)
    f1 = ratio(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("P"))
    pts = c.select(*by, "score", f1.alias("f1"))
    best = F.max_by(F.struct("score", "f1"), F.struct(F.col("f1"), -F.col("score")))
    g = pts.groupBy(*by).agg(best.alias("b"))
    return g.select(*by, F.when(F.col("b.f1") > 0, F.col("b.score")).otherwise(F.lit(default)).alias("best_threshold"),
                    F.when(F.col("b.f1") > 0, F.col("b.f1")).otherwise(F.lit(0.0)).alias("best_f1"))
