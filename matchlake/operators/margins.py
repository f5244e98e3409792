"""Linear margin machines, all draws and folds at once.

The objective is that of MLlib's ``LinearSVC`` with balanced weights (M6): the
weighted mean of the hinge loss plus half the penalty times the squared weights, on
features divided by their weighted standard deviation; the intercept is free.

* Rows lie in packed blocks, written once. One aggregate by fold and label gives each
  fold's class weights and its features' weighted means and deviations.
* Every pass is one job: tasks work out the margins of all models that still move as
  one matrix product a fold and return their sums of losses and gradients, a row per task.
  The driver moves each model on by a quasi-Newton step with a backtracking line search.
* The accuracies of all models are one more pass.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.operators.small import one_row, small_rows
from matchlake.session import cut_lineage

ITERATIONS, TOLERANCE, MEMORY, PATIENCE = 100, 1e-6, 10, 10
BLOCK_ROWS = 10_000
PART_BLOCKS = 64  # blocks of rows a task reads
MOST_PARTS = 100_000
BLOCKS = "data binary"


def descent(size: int, iterations: int = ITERATIONS, tolerance: float = TOLERANCE):
    """A generator that minimises a function: it yields points, is sent (value,
    gradient) of each, and returns the best point. It stops after ``iterations``
    steps, or once ``PATIENCE`` steps lowered the value by less than a ``tolerance`` of it."""
    x = np.zeros(size)
    value, gradient = yield x
    pairs: deque = deque(maxlen=MEMORY)
    seen = [value]
    for _ in range(iterations):
        if not np.abs(gradient).max() > 0:
            return x
        found = None
        for plain in ((False, True) if pairs else (True,)):
            if plain:
                pairs.clear()
                step = 1.0 / max(np.sqrt(gradient @ gradient), 1.0)
                toward = -gradient
            else:
                step, toward = 1.0, -turned(gradient, pairs)
            slope = gradient @ toward
            while slope < 0 and step * np.abs(toward).max() > 1e-12:
                there = x + step * toward
                new, its = yield there
                if new <= value + 1e-4 * step * slope:
                    found = there, new, its
                    break
                step /= 2
            if found:
                break
        if not found:
            return x
        s, y = found[0] - x, found[2] - gradient
        if s @ y > 1e-12:
            pairs.append((s, y, 1.0 / (s @ y)))
        x, value, gradient = found
        seen.append(value)
        if len(seen) > PATIENCE and seen[-1 - PATIENCE] - value <= tolerance * max(abs(value), 1e-12):
            return x
    return x


def turned(gradient: np.ndarray, pairs: deque) -> np.ndarray:
    """The gradient times the inverse curvature that the last steps tell."""
    q, told = gradient.copy(), []
    for s, y, r in reversed(pairs):
        a = r * (s @ q)
        told.append(a)
        q -= a * y
    s, y, r = pairs[-1]
    q /= r * (y @ y)
    for (s, y, r), a in zip(pairs, reversed(told)):
        q += s * (a - r * (y @ q))
    return q


def lockstep(searches: dict, evaluate) -> dict:
    """Runs ``descent`` generators together; ``evaluate`` maps {name: point} to {name: (value, gradient)}."""
    asked, found = {name: next(g) for name, g in searches.items()}, {}
    while asked:
        answers, after = evaluate(asked), {}
        for name, answer in answers.items():
            try:
                after[name] = searches[name].send(answer)
            except StopIteration as end:
                found[name] = end.value
        asked = after
    return found


def record(features: int) -> np.dtype:
    return np.dtype([("fold", "<i4"), ("y", "<f8"), ("x", "<f8", (features,))])


class Sides:
    """Each fold's class weights, means and deviations, learned from the rows outside it."""

    def __init__(self, cells: list, features: int):
        self.features = features
        self.folds = sorted({c["fold"] for c in cells})
        self.weight, self.mean, self.scale = {}, {}, {}
        for f in self.folds:
            train = [c for c in cells if c["fold"] != f]
            n = {y: sum(c["n"] for c in train if c["y"] == y) for y in (0.0, 1.0)}
            each = {y: sum(n.values()) / (2.0 * k) if k else 0.0 for y, k in n.items()}
            w = np.array([each[c["y"]] * c["n"] for c in train])
            mean, var = (np.array([c[k] for c in train]).reshape(-1, self.features) for k in ("mean", "var"))
            center = w @ mean / max(w.sum(), 1e-300)
            squares = w @ (var + (mean - center) ** 2)
            freedom = w.sum() - sum(each[c["y"]] ** 2 * c["n"] for c in train) / max(w.sum(), 1e-300)
            spread = np.sqrt(squares / freedom) if freedom > 0 else np.zeros(self.features)
            self.weight[f], self.mean[f] = (each[0.0], each[1.0]), center
            self.scale[f] = np.divide(1.0, spread, out=np.zeros(self.features), where=spread > 0)

    def folds_of(self, data: np.ndarray, names: list[tuple[int, int]]):
        """(fold, which of the names are its models, scaled features and a one) of a block."""
        for f in self.folds:
            mine = [i for i, (_, fold) in enumerate(names) if fold == f]
            if mine:
                yield f, mine, np.column_stack([(data["x"] - self.mean[f]) * self.scale[f], np.ones(len(data))])


class FoldRows:
    """The rows (fold, label, raw_features) of a search in packed blocks."""

    def __init__(self, x: DataFrame, fold: str):
        values = vector_to_array("raw_features")
        rows = x.select(F.col(fold).cast("int").alias("fold"), F.col("label").cast("double").alias("y"), values.alias("x"))
        n = one_row(rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("features")))
        self.features = features = n["features"]
        kind = record(features)

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, BLOCK_ROWS):
                    part = batch.slice(at, BLOCK_ROWS)
                    data = np.empty(part.num_rows, kind)
                    data["fold"], data["y"] = part.column(0).to_numpy(), part.column(1).to_numpy()
                    data["x"] = part.column(2).flatten().to_numpy().reshape(-1, features)
                    yield pa.RecordBatch.from_arrays([pa.array([data.tobytes()], pa.binary())], names=["data"])

        parts = max(x.sparkSession.sparkContext.defaultParallelism, math.ceil(n["n"] / (BLOCK_ROWS * PART_BLOCKS)))
        self.rows = cut_lineage(rows.mapInArrow(packed, BLOCKS).repartition(parts))
        self.sides = Sides(small_rows(rows.groupBy("fold", "y").agg(
            F.count(F.lit(1)).alias("n"), F.array(*[F.avg(F.col("x")[i]) for i in range(features)]).alias("mean"),
            F.array(*[F.var_pop(F.col("x")[i]) for i in range(features)]).alias("var")), 2000), features)
        self.folds = self.sides.folds

    def totals(self, per_block, shape: tuple[int, ...]) -> np.ndarray:
        """The sum of an array over all blocks: a row per task, added up in the tasks' order."""
        kind = record(self.features)

        def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                for raw in batch.column(0):
                    total += per_block(np.frombuffer(raw.as_buffer(), kind))
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int32()),
                                              pa.array([total.tobytes()], pa.binary())], names=["part", "total"])

        found = small_rows(self.rows.mapInArrow(summed, "part int, total binary"), MOST_PARTS)
        return sum((np.frombuffer(r["total"]).reshape(shape) for r in sorted(found, key=lambda r: r["part"])), np.zeros(shape))

    def losses(self, models: dict[tuple[int, int], np.ndarray], penalty: list[float]) -> dict:
        """(objective, gradient) of models by (draw, fold), on the rows outside their fold."""
        names, size, sides = list(models), self.features + 1, self.sides
        points = np.array([models[m] for m in names])

        def block(data: np.ndarray) -> np.ndarray:
            out = np.zeros((len(names), size + 2))
            for f, mine, z in sides.folds_of(data, names):
                train = data["fold"] != f
                z, y = z[train], data["y"][train]
                w, sign = np.where(y == 1, sides.weight[f][1], sides.weight[f][0]), 2 * y - 1
                short = 1.0 - sign[:, None] * (z @ points[mine].T)
                active = short > 0
                out[mine, 0] = w @ np.where(active, short, 0.0)
                out[mine, 1:-1] = -(np.where(active, (w * sign)[:, None], 0.0).T @ z)
                out[mine, -1] = w.sum()
            return out

        total = self.totals(block, (len(names), size + 2))
        out = {}
        for name, p, row in zip(names, points, total):
            lam, n, flat = penalty[name[0]], max(row[-1], 1e-300), np.append(p[:-1], 0.0)
            out[name] = (row[0] / n + lam / 2 * (flat @ flat), row[1:-1] / n + lam * flat)
        return out

    def fit(self, penalty: list[float]) -> dict[tuple[int, int], np.ndarray]:
        """Weights (of scaled features) and intercept of each (draw, fold)."""
        searches = {(d, f): descent(self.features + 1) for d in range(len(penalty)) for f in self.folds}
        return lockstep(searches, lambda asked: self.losses(asked, penalty))

    def accuracies(self, models: dict[tuple[int, int], np.ndarray]) -> dict[tuple[int, int], float]:
        """The share of a fold's rows that its models put on the right side."""
        names, sides = list(models), self.sides
        points = np.array([models[m] for m in names])

        def block(data: np.ndarray) -> np.ndarray:
            out = np.zeros((len(names), 2))
            for f, mine, z in sides.folds_of(data, names):
                held = data["fold"] == f
                right = (z[held] @ points[mine].T > 0) == (data["y"][held] == 1)[:, None]
                out[mine, 0], out[mine, 1] = right.sum(0), held.sum()
            return out

        return {m: float(right / n) for m, (right, n) in zip(names, self.totals(block, (len(names), 2)))}
