"""K-Means for many (k, restart) pairs at once (K1, K2, K9).

Every pass over the rows serves all models: tasks assign each row to the nearest
center of every model that still moves and add up whole-number coordinate sums, so one
aggregate per iteration carries the sums of all models (a row per task and center), and
the driver holds centers only (models x k). The costs are added up once, at the end.
Starting centers are k-means++: the next one is drawn with a probability proportional to
the squared distance, as the row with the smallest ``-log(u) / d2``, where u is a number
from the row's hash; one aggregate per center.

Models with as many centers share one single-precision product a chunk of rows; where its rounding
could matter, distances by differences decide. Sums and draws do not depend on
partitions, so a seed gives the same models. A center without rows keeps its place. Ties
go to the first center.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.operators.binned import mixed
from matchlake.operators.knn import matrix
from matchlake.operators.small import one_row, small_rows
from matchlake.session import cut_lineage

UNIT = 2.0 ** 24
MOST_CENTERS = 100_000
CHUNK = 1024  # rows whose distances to all centers are held at once
SLACK = 1e-12  # of the squared lengths in a product: far more than its rounding
SHORT_SLACK = 2.0 ** -22  # the same for a product of single-precision numbers, for each feature and four more
SHORT_MOST = 1e30  # squared lengths that single precision holds


@dataclass
class KMeans:
    """One model: ``centers`` (k rows), its within-cluster sum of squares and iterations."""

    k: int
    seed: int
    centers: np.ndarray | None = None
    cost: float = np.inf
    iterations: int = 0
    still: bool = False
    size: np.ndarray = field(default_factory=lambda: np.zeros(0))


def point_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """(h, x): a hash of the coordinates, and the coordinates; dealt out evenly
    (a pass is much arithmetic on few bytes) and written once."""
    x = F.array(*[F.col(c).cast("double") for c in cols])
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.select(F.xxhash64(x).alias("h"), x.alias("x")).repartition(parts, "h"))


def squares(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centers, by differences (no cancellation)."""
    out = np.zeros((len(x), len(centers)))
    for f in range(x.shape[1]):
        step = x[:, f, None] - centers[None, :, f]
        out += step * step
    return out


def products(x: np.ndarray, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rounded squared distances (model, center, row) and a bound of their error for
    each row, by one product with the (model, center, feature) centers."""
    g, k, d = centers.shape
    xx, cc = (x * x).sum(1), (centers * centers).sum(2)
    slack = SLACK * (xx + cc.max())
    if max(xx.max(initial=0.0), cc.max()) < SHORT_MOST:  # half the bytes to go through
        slack = SHORT_SLACK * (d + 4) * (xx + cc.max()) + 1e-30
        centers, x, xx, cc = (v.astype(np.float32) for v in (centers, x, xx, cc))
    d2 = ((-2 * centers).reshape(g * k, d) @ x.T).reshape(g, k, len(x))
    d2 += cc[:, :, None]
    d2 += xx
    return d2, slack


def apart(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances of each row to its own (row, center, feature) centers, by differences like ``squares``."""
    out = np.zeros(centers.shape[:2])
    for f in range(x.shape[1]):
        step = x[:, f, None] - centers[:, :, f]
        out += step * step
    return out


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """(model, row): the number of the nearest center, the first if tied."""
    d2, slack = products(x, centers)
    best, second = d2[:, 0].copy(), np.full(d2[:, 0].shape, np.inf, d2.dtype)
    at = np.zeros(d2[:, 0].shape, np.int16 if d2.shape[1] < 1 << 15 else np.int64)
    for j in range(1, d2.shape[1]):
        np.copyto(at, j, where=d2[:, j] < best)
        np.minimum(second, np.maximum(best, d2[:, j]), out=second)
        np.minimum(best, d2[:, j], out=best)
    model, row = np.nonzero(second - best <= 2 * slack)
    if len(row):
        at[model, row] = apart(x[row], centers[model]).argmin(1)
    return at


def by_size(models: list[tuple[int, np.ndarray]]) -> list[tuple[list[int], np.ndarray]]:
    """(numbers, centers as (model, center, feature)) of the models with as many centers."""
    groups: dict[int, list] = {}
    for i, centers in models:
        groups.setdefault(len(centers), []).append((i, centers))
    return [([i for i, _ in g], np.stack([c for _, c in g])) for g in groups.values()]


def row_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, coordinates) of the rows, ``CHUNK`` at most."""
    for batch in batches:
        x, h = matrix(batch.column(1)), batch.column(0).to_numpy().view(np.uint64)
        for a in range(0, len(x), CHUNK):
            yield h[a:a + CHUNK], x[a:a + CHUNK]


def raced(h: np.ndarray, x: np.ndarray, salts: np.ndarray, centers: np.ndarray | None) -> list[tuple[float, list[float]]]:
    """For each model, the least ``-log(u) / d2`` of the rows, and its row (the
    smallest, if all lie on centers). ``1 - u <= -log(u)`` rules most rows out."""
    u = (mixed(h[None] ^ salts[:, None]) >> np.uint64(11)) * 2.0 ** -53
    if centers is None:
        low = 1 - u
    else:
        d2, slack = products(x, centers)
        with np.errstate(divide="ignore"):
            low = (1 - u) / (np.maximum(d2.min(1), 0) + slack)

    def exact(i: int, at: np.ndarray) -> np.ndarray:
        d2 = np.ones(len(at)) if centers is None else squares(x[at], centers[i]).min(1)
        with np.errstate(divide="ignore"):
            return np.where(d2 > 0, -np.log(np.maximum(u[i, at], 1e-300)) / d2, np.inf)

    out = []
    for i, first in enumerate(low.argmin(1)):
        bar = exact(i, np.array([first]))[0]
        at = np.flatnonzero(low[i] <= bar * (1 + 1e-9))
        race = exact(i, at)
        best = at[race.argmin()] if np.isfinite(race.min()) else np.lexsort(x.T[::-1])[0]
        out.append((float(race.min()), x[best].tolist()))
    return out


def seeded(rows: DataFrame, models: list[KMeans]) -> None:
    """k-means++ centers for all models, one pass for each further center."""
    most = max(m.k for m in models)
    for step in range(most):
        now = [i for i, m in enumerate(models) if m.k > step]
        seeds = mixed(np.array([models[i].seed * 1009 + step for i in now])) >> np.uint64(1)
        salts, centers = mixed(seeds), np.stack([models[i].centers for i in now]) if step else None

        def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = None
            for h, x in row_chunks(batches):
                found = raced(h, x, salts, centers)
                best = found if best is None else list(map(min, best, found))
            if best is not None:
                yield pa.RecordBatch.from_arrays([
                    pa.array(now, pa.int32()), pa.array([r for r, _ in best], pa.float64()),
                    pa.array([x for _, x in best], pa.list_(pa.float64()))], names=["model", "race", "x"])

        first = rows.mapInArrow(drawn, "model int, race double, x array<double>").groupBy("model").agg(
            F.min(F.struct("race", "x")).alias("best"))
        for r in small_rows(first, len(models)):
            m, x = models[r["model"]], np.array([r["best"]["x"]])
            m.centers = x if m.centers is None else np.vstack([m.centers, x])


def moved(rows: DataFrame, models: list[KMeans], shift: float) -> None:
    """One iteration of every model that is not still: new centers."""
    now = [(i, m.centers) for i, m in enumerate(models) if not m.still]
    groups = by_size(now)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in row_chunks(batches):
            # A sum of a chunk stays below 2^53, so the product adds whole numbers exactly.
            whole = np.column_stack([np.rint(x * UNIT), np.ones(len(x))])
            if total is None:
                total = [np.zeros((c.shape[0] * c.shape[1], whole.shape[1]), np.int64) for _, c in groups]
            for sums, (_, centers) in zip(total, groups):
                g, k, _ = centers.shape
                at = nearest(x, centers)
                own = (at[:, None] == np.arange(k, dtype=at.dtype)[None, :, None]).reshape(g * k, len(x)).astype(float)
                sums += (own @ whole).astype(np.int64)
        for sums, (numbers, centers) in zip(total or [], groups):
            g, k, _ = centers.shape
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(numbers, k).astype(np.int32)), pa.array(np.tile(np.arange(k, dtype=np.int32), g)),
                pa.array(sums[:, -1]), pa.array(sums[:, :-1].tolist(), pa.list_(pa.int64()))], names=["model", "cluster", "n", "sums"])

    parts = rows.mapInArrow(summed, "model int, cluster int, n long, sums array<long>")
    width = len(models[0].centers[0])
    totals = parts.groupBy("model", "cluster").agg(
        F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[f]) for f in range(width)]).alias("sums"))
    after = {i: c.copy() for i, c in now}
    for r in small_rows(totals, MOST_CENTERS):
        if r["n"]:
            after[r["model"]][r["cluster"]] = np.array(r["sums"], float) / UNIT / r["n"]
    for i, centers in now:
        m = models[i]
        m.still = bool(((after[i] - centers) ** 2).sum() <= shift)
        m.iterations += 1
        if not m.still:
            m.centers = after[i]


def priced(rows: DataFrame, models: list[KMeans]) -> None:
    """The cost and the cluster sizes of every model."""
    groups = by_size([(i, m.centers) for i, m in enumerate(models)])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros((c.shape[0] * c.shape[1], 2), np.int64) for _, c in groups]
        for _, x in row_chunks(batches):
            for sums, (_, centers) in zip(total, groups):
                g, k, _ = centers.shape
                at = nearest(x, centers)
                for i in range(g):
                    d2 = apart(x, centers[i][at[i]][:, None])[:, 0]
                    sums[i * k:i * k + k, 0] += np.bincount(at[i], minlength=k)
                    sums[i * k:i * k + k, 1] += np.bincount(at[i], np.rint(d2 * UNIT), k).astype(np.int64)
        for sums, (numbers, centers) in zip(total, groups):
            g, k, _ = centers.shape
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(numbers, k).astype(np.int32)), pa.array(np.tile(np.arange(k, dtype=np.int32), g)),
                pa.array(sums[:, 0]), pa.array(sums[:, 1])], names=["model", "cluster", "n", "cost"])

    totals = rows.mapInArrow(summed, "model int, cluster int, n long, cost long").groupBy("model", "cluster").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"))
    whole = [0] * len(models)
    for m in models:
        m.size = np.zeros(m.k)
    for r in small_rows(totals, MOST_CENTERS):
        models[r["model"]].size[r["cluster"]] = r["n"]
        whole[r["model"]] += r["cost"]
    for m, cost in zip(models, whole):
        m.cost = cost / UNIT


def fit_all(rows: DataFrame, pairs: list[tuple[int, int]], tolerance: float = 1e-4, most_iterations: int = 300) -> list[KMeans]:
    """A model for every (k, seed). A model is still once its centers move by no
    more than ``tolerance`` times the mean variance of a coordinate."""
    models = [KMeans(k, seed) for k, seed in pairs]
    if one_row(rows.agg(F.count(F.lit(1)).alias("n")))["n"] == 0:
        return []
    width = one_row(rows.select(F.size("x").alias("w")).limit(1))["w"]
    spread = one_row(rows.agg(F.array(*[F.var_pop(F.col("x")[f]) for f in range(width)]).alias("v")))["v"]
    seeded(rows, models)
    for _ in range(most_iterations):
        if all(m.still for m in models):
            break
        moved(rows, models, tolerance * float(np.mean(spread)))
    priced(rows, models)
    return models


def best_of_restarts(rows: DataFrame, ks: list[int], restarts: int, seed: int = 42) -> dict[int, KMeans]:
    """K1 / K2: for each k, the restart with the least cost (the first, if tied)."""
    models = fit_all(rows, [(k, seed + 1000 * i) for k in ks for i in range(restarts)])
    out: dict[int, KMeans] = {}
    for m in models:
        if m.k not in out or m.cost < out[m.k].cost:
            out[m.k] = m
    return out


def labels(x, centers: np.ndarray):
    """Column: the number of the nearest center of an array column."""
    from pyspark.sql.functions import arrow_udf

    @arrow_udf("int")
    def numbered(xs: pa.Array) -> pa.Array:
        rows = matrix(xs)
        return pa.array(squares(rows, centers).argmin(1).astype(np.int32) if len(rows) else np.zeros(0, np.int32))

    return numbered(x)
