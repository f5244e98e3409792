"""Approximate nearest neighbours by balanced posting lists.

Nearness is the largest inner product; a coordinate added to every stored
vector (the root of the largest squared norm less its own) turns that into the
smallest Euclidean distance, in which lists are built and chosen.

* Equal vectors are one point, which keeps its ``TOP + 1`` smallest ids: no
  answer can need more. So copies cost neither lists nor comparisons.
* Centroids come from balanced k-means (a size penalty in the assignment) on a
  bounded sample; their number follows the number of points up to a bound.
* Lists are dealt to shards. A query asks each shard that holds some of its
  lists once, and gets the nearest of all of these lists together; beyond the
  bound on lists, shards are dealt to several parts. A task holds one part at a
  time and streams the part's queries past it in batches, so neither grows with
  the table.
* A point goes to its nearest list and, near a boundary, to others whose
  centroid is at most ``1 + BOUNDARY`` times as far (``REPLICAS`` lists at most).
* A query walks a proximity graph of the centroids held in memory, best first,
  many queries at a time, and visits every list it meets whose centroid is at
  most ``1 + PRUNE`` times as far as the nearest one, ``LEAST`` at least. If these
  lists are home to too few points for an answer, it visits the next ones, too.

Every point is indexed. Vectors that are null, zero, of another than the most
common length, or hold a null or non-finite component take no part, nor do rows
without id. Repeated rows count once; an id with several vectors is several
points and never its own neighbour. Scores are inner products in double
precision; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from matchlake.llm.batches import written

TOP, EVERY = 20, 20
LIST_SIZE, MAX_LISTS, SAMPLE = 256, 2048, 20_000
DEGREE, FAR, ROUNDS, SEED = 16, 4, 8, 11
BOUNDARY, REPLICAS, PRUNE, LEAST = 0.01, 8, 0.18, 8
SALTS = 32
#: Lists are dealt to shards, which one task answers from at a time: so many at least, and points in each at most about this.
SHARDS, SHARD_POINTS = 16, 1 << 16


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that take part; floats stay floats, any
    other numbers are doubles, so scores are those of the original vectors."""
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    finite = (F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
              & F.exists("embedding", lambda x: x != 0))
    good = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind))
            .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(finite))
    sizes = good.groupBy(F.size("embedding").alias("d")).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.desc("n"), F.desc("d")).first()
    return good.where(F.size("embedding") == (sizes["d"] if sizes else 0))


def points(good: DataFrame, top: int = TOP) -> DataFrame:
    """One row per distinct vector: point (its name), embedding, ids (its
    smallest ``top + 1``)."""
    salted = good.distinct().withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)))
    some = Window.partitionBy("embedding", "salt").orderBy("vec_id")
    few = salted.withColumn("n", F.row_number().over(some)).where(F.col("n") <= top + 1)
    ids = few.groupBy("embedding").agg(F.slice(F.sort_array(F.collect_list("vec_id")), 1, top + 1).alias("ids"))
    name = F.concat_ws(":", F.col("ids")[0], F.hex(F.xxhash64("embedding")))
    return ids.select(name.alias("point"), "embedding", "ids")


# -- centroids -------------------------------------------------------------


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def lifted(x: np.ndarray, radius2: float) -> np.ndarray:
    """With the coordinate that makes all stored vectors equally long."""
    return np.column_stack([x, np.sqrt(np.maximum(0.0, radius2 - (x * x).sum(1)))])


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * x @ y.T)


def balanced_centroids(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """k-means whose assignment adds a penalty that grows with a list's size."""
    rng = np.random.default_rng(SEED)
    centres = x[rng.choice(len(x), k, replace=False)]
    load = np.full(k, len(x) / k)
    for _ in range(rounds):
        total, count = np.zeros_like(centres), np.zeros(k)
        for i in range(0, len(x), 4096):
            part = x[i:i + 4096]
            d = squared(part, centres)
            mine = (d + d.min(1).mean() * 0.1 * (load * k / len(x) - 1)).argmin(1)
            np.add.at(total, mine, part)
            count += np.bincount(mine, minlength=k)
        load = 0.5 * load + 0.5 * count
        full = count > 0
        centres[full] = total[full] / count[full, None]
        if not full.all():
            centres[~full] = x[rng.choice(len(x), int((~full).sum()))]
    return centres


@dataclass
class Centroids:
    centres: np.ndarray
    links: np.ndarray  # (k, degree): near centroids and a few far ones, filled up with itself
    radius2: float
    sizes: np.ndarray | None = None  # points whose nearest list it is


    @staticmethod
    def build(x: np.ndarray, k: int, radius2: float) -> Centroids:
        centres = balanced_centroids(lifted(x, radius2), k)
        d = squared(centres, centres)
        near = np.argsort(d, 1, kind="stable")[:, 1:DEGREE + 1]
        far = np.random.default_rng(SEED).integers(0, k, (k, FAR))
        linked = np.zeros((k, k), bool)
        linked[np.arange(k)[:, None], np.concatenate([near, far], 1)] = True
        linked |= linked.T  # both ways, or a centroid far from all others could not be reached
        width = int(linked.sum(1).max())
        order = np.argsort(~linked, 1, kind="stable")[:, :width]
        return Centroids(centres, np.where(np.take_along_axis(linked, order, 1), order, np.arange(k)[:, None]), radius2)

    def walk(self, x: np.ndarray, slack: float) -> np.ndarray:
        """Distances (vector, centroid) met on best-first walks; infinite where
        not met. A walk ends when every centroid met within ``1 + slack`` times
        the nearest has been expanded."""
        k, n = len(self.centres), len(x)
        entry = np.unique(np.linspace(0, k - 1, min(k, 8)).astype(np.int64))
        dist, done = np.full((n, k), np.inf), np.zeros((n, k), bool)
        dist[:, entry] = np.sqrt(squared(x, self.centres[entry]))
        own, norms = (x * x).sum(1), (self.centres ** 2).sum(1)
        active = np.arange(n)
        while len(active):
            open_ = np.where(done[active], np.inf, dist[active])
            pick = open_.argmin(1)
            going = open_[np.arange(len(active)), pick] <= (1 + slack) * dist[active].min(1)
            active, pick = active[going], pick[going]
            done[active, pick] = True
            near = self.links[pick]
            d = own[active][:, None] + norms[near] - 2 * np.einsum("ij,ikj->ik", x[active], self.centres[near])
            dist[active[:, None], near] = np.sqrt(np.maximum(d, 0))
        return dist

    def homes(self, x: np.ndarray) -> list[list[int]]:
        """Lists of each stored vector, nearest first."""
        dist = np.sqrt(squared(x, self.centres))
        order = np.argsort(dist, 1, kind="stable")[:, :REPLICAS]
        ranked = np.take_along_axis(dist, order, 1)
        keep = ranked <= (1 + BOUNDARY) * ranked[:, :1]
        return [row[k].tolist() for row, k in zip(order, keep, strict=True)]

    def probes(self, x: np.ndarray) -> list[list[int]]:
        """Lists that each query visits."""
        dist = self.walk(x, PRUNE)
        bound = (1 + PRUNE) * dist.min(1, keepdims=True)
        near = np.partition(dist, min(LEAST, dist.shape[1]) - 1, 1)[:, min(LEAST, dist.shape[1]) - 1:][:, :1]
        chosen = (dist <= np.maximum(bound, near)) & np.isfinite(dist)
        if self.sizes is not None:
            for i in np.flatnonzero(chosen @ self.sizes < TOP + 1).tolist():
                order = np.argsort(squared(x[i:i + 1], self.centres)[0], kind="stable")
                enough = int(np.searchsorted(np.cumsum(self.sizes[order]), TOP + 1)) + 1
                chosen[i, order[:enough]] = True
        return [np.flatnonzero(row).tolist() for row in chosen]


def fitted(stored: DataFrame, list_size: int = LIST_SIZE,
           sample: int = SAMPLE) -> tuple[Centroids | None, int, int]:
    """(centroids, shards, parts of a shard) for the table of points."""
    norm2 = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, radius2 = stored.agg(F.count(F.lit(1)), F.max(norm2)).first()
    if not n:
        return None, 1, 1
    rate = min(1.0, sample / n)
    drawn = stored.where(F.pmod(F.xxhash64("point"), F.lit(1 << 20)) < rate * (1 << 20))
    x = matrix(drawn.select("point", "embedding").limit(2 * sample).toArrow().sort_by("point")["embedding"]
               if n > 1 else stored.select("embedding").toArrow()["embedding"])
    lists = max(1, min(MAX_LISTS, n // list_size, len(x)))
    shards = max(1, min(lists, max(SHARDS, n // SHARD_POINTS)))
    return Centroids.build(x, lists, float(radius2)), shards, max(1, n // (shards * SHARD_POINTS))


def placed(rows: DataFrame, index: Centroids, shards: int, query: bool) -> DataFrame:
    """``rows`` once per shard with the row's lists there: stored vectors at
    home, queries visiting."""
    @arrow_udf("array<struct<shard:int,lists:array<int>>>")
    def dealt(vectors: pa.Array) -> pa.Array:
        out = []
        step = 1024
        for i in range(0, len(vectors), step):
            x = matrix(vectors.slice(i, step))
            for lists in index.probes(np.column_stack([x, np.zeros(len(x))])) if query \
                    else index.homes(lifted(x, index.radius2)):
                by: dict[int, list[int]] = {}
                for k in lists:
                    by.setdefault(k % shards, []).append(k // shards)
                out.append([{"shard": s, "lists": v} for s, v in by.items()])
        return pa.array(out, pa.list_(pa.struct([("shard", pa.int32()), ("lists", pa.list_(pa.int32()))])))

    return rows.withColumn("at", F.explode(dealt("embedding"))).select(*rows.columns, "at.*")


def membership(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """(row, list) matrix of ones from arrays of lists."""
    lists = column.combine_chunks()
    lists = lists if isinstance(lists, pa.Array) else lists.chunk(0)
    out = np.zeros((len(lists), width), np.float32)
    out[np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy())), lists.flatten().to_numpy()] = 1
    return out


def best_of_shard(stored: pa.Table, asked: pa.Table, top: int) -> pa.Table:
    """The nearest ids of every query among its lists in one shard's part."""
    if not len(stored) or not len(asked):
        return pa.table({"query": pa.array([], pa.string()), "vec_id": pa.array([], pa.int64()),
                         "score": pa.array([], pa.float64())})
    x, q = matrix(stored["embedding"]), matrix(asked["embedding"])
    width = 1 + max(max(v) for side in (stored, asked) for v in side["lists"].to_pylist())
    homes, visits = membership(stored["lists"], width).T, membership(asked["lists"], width)
    ids = stored["ids"].combine_chunks()
    ids = ids if isinstance(ids, pa.Array) else ids.chunk(0)
    edges, flat = ids.offsets.to_numpy() - ids.offsets[0].as_py(), ids.flatten().to_numpy()
    query, found, score = [], [], []
    names = asked["query"].to_pylist()
    step = max(1, min(256, (4 << 20) // len(x)))
    for i in range(0, len(q), step):
        part = q[i:i + step]
        rough = np.where(visits[i:i + step] @ homes > 0, part @ x.T, -np.inf)
        last = np.partition(rough, len(x) - top - 1, 1)[:, len(x) - top - 1] if len(x) > top + 1 \
            else np.full(len(part), -np.inf)
        for k, s in enumerate(rough):
            # Chosen with room for rounding, then scored in one fixed order of additions.
            bound = last[k] - 1e-9 * max(1.0, abs(last[k])) if np.isfinite(last[k]) else -np.finfo(float).max
            near = np.flatnonzero(s >= bound)
            exact = (x[near] * part[k]).sum(1)
            vec = np.concatenate([flat[edges[j]:edges[j + 1]] for j in near.tolist()] or [flat[:0]])
            score_of = np.repeat(exact, edges[near + 1] - edges[near])
            order = np.lexsort((vec, -score_of))[:top + 1]
            query += [names[i + k]] * len(order)
            found.append(vec[order])
            score.append(score_of[order])
    return pa.table({"query": pa.array(query, pa.string()), "vec_id": pa.array(np.concatenate(found), pa.int64()),
                     "score": pa.array(np.concatenate(score), pa.float64())})


def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """((shard, part, asks), rows) of each run of equal keys in a batch."""
    keys = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                            for c in ("shard", "part", "asks")])
    edges = [0, *(1 + np.flatnonzero((keys[1:] != keys[:-1]).any(1))).tolist(), len(keys)]
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b > a:
            yield tuple(keys[a].tolist()), batch.slice(a, b - a)


def best_of_batches(batches: Iterator[pa.RecordBatch], top: int) -> Iterator[pa.RecordBatch]:
    """The nearest ids for rows sorted by shard, part and asks: each part's
    stored vectors, then the queries that visit it."""
    of, held = None, []
    for batch in batches:
        for (shard, part, asks), rows in runs(batch):
            if (shard, part) != of:
                of, held = (shard, part), []
            if not asks:
                held.append(rows)
            elif held:
                stored = pa.Table.from_batches(held)
                if len(held) > 1:
                    stored = stored.combine_chunks()
                    held = stored.to_batches()
                yield from best_of_shard(stored, pa.Table.from_batches([rows]).combine_chunks(), top).to_batches()


def nearest(vectors: DataFrame, top: int = TOP, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by
    ``every``, the ``top`` rows with the largest inner product found."""
    good = usable(vectors)
    stored = written(points(good, top), "points")
    index, shards, parts = fitted(stored)
    asking = good.where(F.pmod("vec_id", F.lit(every)) == 0).distinct()
    if index is None:
        return asking.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id",
                             F.lit(0.0).alias("score")).where("false")
    named = asking.select(F.col("vec_id").alias("query_id"), "embedding", F.hex(F.xxhash64("embedding")).alias("query"))
    # Queries with one vector are asked once. The name is the vector's hash and the join below compares vectors.
    single = named.groupBy("embedding").agg(F.first("query").alias("query"))
    home = written(placed(stored, index, shards, False).withColumn("part", F.pmod(F.xxhash64("point"), F.lit(parts)).cast("int")),
                   "homes")
    # A point's home is counted once, in the shard that comes first; boundary copies add nothing.
    first = home.groupBy("point").agg(F.min(F.struct("shard", F.col("lists")[0].alias("slot"))).alias("at"))
    index.sizes = np.zeros(len(index.centres), np.int64)
    for r in first.groupBy("at.shard", "at.slot").agg(F.count(F.lit(1)).alias("n")).toLocalIterator():  # a row per list
        index.sizes[r["slot"] * shards + r["shard"]] = r["n"]
    visit = placed(single, index, shards, True).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return best_of_batches(batches, top)

    both = (home.select("shard", "part", F.lit(0).alias("asks"), "lists", "embedding", "ids", F.lit("").alias("query"))
            .unionByName(visit.select("shard", "part", F.lit(1).alias("asks"), "lists", "embedding",
                                      F.lit(None).cast(home.schema["ids"].dataType).alias("ids"), "query")))
    hits = (both.repartition("shard", "part").sortWithinPartitions("shard", "part", "asks")
            .mapInArrow(compared, "query string, vec_id long, score double"))
    order = [F.desc("score"), F.asc("vec_id")]
    best = hits.groupBy("query", "vec_id").agg(F.max("score").alias("score")) \
        .withColumn("n", F.row_number().over(Window.partitionBy("query").orderBy(*order))).where(F.col("n") <= top + 1) \
        .groupBy("query").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("far"), "vec_id"))).alias("near"))
    answers = (named.select("query_id", "query").join(best, "query")
               .select("query_id", F.filter("near", lambda x: x["vec_id"] != F.col("query_id")).alias("near"))
               .select("query_id", F.posexplode(F.slice("near", 1, top)).alias("pos", "hit")))
    return answers.select("query_id", (F.col("pos") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"),
                          (-F.col("hit.far")).alias("score"))
