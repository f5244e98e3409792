"""Calibrators of fitted margins.

*Platt.* ``1 / (1 + exp(a * margin + b))`` against smoothed targets, by Newton
steps. Margins are grouped first (a row per distinct margin with its counts of both
labels); a step is one aggregate of the gradient and the Hessian, and one of
the loss at a few step lengths.

*Isotonic.* Pool-adjacent-violators in score ranges: a task merges its sorted
scores into a stack of blocks, and stacks of neighbouring ranges merge again, fewer
ranges each time, so distinct scores never meet in one place. The blocks that
are left are the corners of a convex chain in the lattice of (rows, positives), of which
n rows have no more than about n^(2/3), and in practice a few hundred. Sums are
compared as whole numbers, so the result does not depend on the ranges.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from matchlake.operators.small import num, one_row, small_rows
from matchlake.session import cut_lineage

LENGTHS = [0.5 ** i for i in range(10)]
MOST_BLOCKS, RANGE_BLOCKS = 1_000_000, 50_000


# -- Platt -----------------------------------------------------------------


def grouped_scores(df: DataFrame, score: str, label: str) -> DataFrame:
    """(score, pos, neg): the labels of each distinct score; rows without a score or label count nothing."""
    y = F.col(label).cast("long")
    return df.where(F.col(score).isNotNull() & ~F.isnan(score) & F.col(label).isNotNull()).groupBy(
        F.col(score).cast("double").alias("score")).agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))


def _loss(z: Column, p: Column, n: Column, hi: float, lo: float) -> Column:
    """Loss of ``p`` positives and ``n`` negatives at z = a * margin + b, with smoothed targets."""
    soft = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))  # -log(1 - q) + z is -log q, with q = P(1)
    return p * (soft - num(1 - hi) * z) + n * (soft - num(1 - lo) * z)


def platt_fit(df: DataFrame, score: str = "margin", label: str = "label", steps: int = 100) -> tuple[float, float]:
    """(a, b) of the smoothed-target sigmoid; without rows (0, 0), a half everywhere."""
    groups = cut_lineage(grouped_scores(df, score, label))
    n = one_row(groups.agg(F.coalesce(F.sum("pos"), F.lit(0)).alias("pos"), F.coalesce(F.sum("neg"), F.lit(0)).alias("neg")))
    pos, neg = n["pos"], n["neg"]
    hi, lo = (pos + 1) / (pos + 2), 1 / (neg + 2)
    a, b = 0.0, math.log((neg + 1) / (pos + 1))
    f, p, q = F.col("score"), F.col("pos"), F.col("neg")
    for _ in range(steps):
        z = num(a) * f + num(b)
        chance = F.lit(1.0) / (F.lit(1.0) + F.exp(z))
        slope = p * (num(hi) - chance) + q * (num(lo) - chance)  # d loss / d z
        bend = (p + q) * chance * (F.lit(1.0) - chance)
        r = one_row(groups.agg(*[F.coalesce(F.sum(v), F.lit(0.0)).alias(k) for k, v in (
            ("ga", f * slope), ("gb", slope), ("haa", f * f * bend), ("hab", f * bend), ("hbb", bend))]))
        haa, hbb = r["haa"] + 1e-12, r["hbb"] + 1e-12
        det = haa * hbb - r["hab"] ** 2
        if det <= 0:
            break
        da, db = -(hbb * r["ga"] - r["hab"] * r["gb"]) / det, -(haa * r["gb"] - r["hab"] * r["ga"]) / det
        gain = r["ga"] * da + r["gb"] * db
        if -gain < 1e-18 * (pos + neg + 1) or abs(da) + abs(db) < 1e-13:
            break
        step = F.col("step")
        tried = groups.select("*", F.explode(F.array(*map(num, [0.0, *LENGTHS]))).alias("step")).groupBy("step").agg(
            F.sum(_loss((num(a) + step * num(da)) * f + num(b) + step * num(db), p, q, hi, lo)).alias("loss"))
        loss = {v["step"]: v["loss"] for v in small_rows(tried, len(LENGTHS) + 1)}
        took = next((s for s in LENGTHS if loss[s] <= loss[0.0] + 1e-4 * s * gain + 1e-12 * loss[0.0]), 0)
        if not took:
            break
        a, b = a + took * da, b + took * db
    return a, b


def platt(margin: Column, fitted: tuple[float, float]) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(num(fitted[0]) * margin + num(fitted[1])))


# -- isotonic --------------------------------------------------------------


def pooled(blocks: Iterator[tuple], stack: list[list] | None = None) -> list[list]:
    """Adds blocks (low, high, rows, positives) in score order to a stack, and
    merges neighbours whose share of positives would fall."""
    stack = [] if stack is None else stack
    for low, high, n, y in blocks:
        top = [low, high, int(n), int(y)]
        while stack and stack[-1][3] * top[2] >= top[3] * stack[-1][2]:
            below = stack.pop()
            top = [below[0], top[1], below[2] + top[2], below[3] + top[3]]
        stack.append(top)
    return stack


def merged(blocks: DataFrame, ranges: int) -> DataFrame:
    """The blocks of each of ``ranges`` score ranges, merged."""
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stack: list[list] = []
        for batch in batches:
            pooled(zip(*(batch.column(i).to_pylist() for i in range(4))), stack)
        yield pa.RecordBatch.from_arrays([pa.array([b[i] for b in stack], t) for i, t in enumerate(
            (pa.float64(), pa.float64(), pa.int64(), pa.int64()))], names=["low", "high", "n", "y"])

    return blocks.repartitionByRange(ranges, "low").sortWithinPartitions("low").mapInArrow(
        merge, "low double, high double, n long, y long")


class Isotonic:
    """Blocks in score order; between two blocks the value rises in a straight line."""

    def __init__(self, blocks: list):
        self.blocks = [(b[0], b[1], b[2], b[3]) for b in blocks]
        self.at = np.array([v for b in self.blocks for v in (b[0], b[1])], float)
        self.value = np.array([b[3] / b[2] for b in self.blocks for _ in range(2)], float)

    def __call__(self, score: Column) -> Column:
        at, value = self.at, self.value

        @arrow_udf("double")
        def read(scores: pa.Array) -> pa.Array:
            x = scores.to_numpy(zero_copy_only=False).astype(float)
            out = np.interp(x, at, value) if len(at) else np.full(len(x), 0.5)
            return pa.array(out, mask=np.isnan(x))

        return read(score.cast("double"))


def isotonic_fit(df: DataFrame, score: str = "margin", label: str = "label") -> Isotonic:
    """The non-decreasing step function of least squared error. Without rows, a half everywhere."""
    points = grouped_scores(df, score, label).select(
        F.col("score").alias("low"), F.col("score").alias("high"), (F.col("pos") + F.col("neg")).alias("n"), F.col("pos").alias("y"))
    ranges = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    blocks = cut_lineage(merged(points, ranges))
    while ranges > 1 and one_row(blocks.agg(F.count(F.lit(1)).alias("n")))["n"] > RANGE_BLOCKS:
        ranges = max(1, ranges // 8)
        blocks = cut_lineage(merged(blocks, ranges))
    rows = sorted(small_rows(blocks, MOST_BLOCKS), key=lambda r: r["low"])
    return Isotonic(pooled(tuple(r) for r in rows))


def brier_score(p: Column, label: Column) -> Column:
    """Aggregate: mean squared error of a probability."""
    return F.avg((p - label) * (p - label))
