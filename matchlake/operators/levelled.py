"""Random forests of bounded depth over tables that no task holds.

The forest that MLlib grows: Poisson(1) bootstrap, Gini, at most 32 quantile bins a
feature, a random subset of the features at each node, splits whose two leaves
predict the same taken back. Rows lie in packed blocks of a few bytes a row,
written once; a level of all trees is one pass. A task counts the bins of the drawn
features of each node, tree by tree, in arrays whose size does not depend on the
rows; Spark sums them by tree and picks the splits.

A row's count in a tree comes from a hash of its id, a node's features from its
path, and sums are whole numbers, so a forest does not depend on partitions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.operators.binned import BINS, mixed, record
from matchlake.operators.forest import DRAWN, child_keys, drawn_features, purity
from matchlake.operators.small import one_row, small_rows
from matchlake.session import cut_lineage

TREES, DEPTH, CUTS = 100, 8, 32
ACCURACY = 10_000  # rank error of a cut: 1 in this many rows
BLOCK_ROWS = 1 << 15  # rows of a block
PART_BLOCKS = 64  # blocks a task reads
#: How often a row is drawn, for each 16 bits of its hash
DRAWS = np.searchsorted(DRAWN, (np.arange(1 << 16) + 0.5) / (1 << 16), "right").astype(np.uint8)
FOUND = ("feature", "cut", "w", "p", "gain", "lw", "lp")


@dataclass
class Forest:
    """Complete trees, a row each: the children of node i are 2 i + 1 and 2 i + 2. The
    feature of a leaf is -1; ``gain`` is the drop of impurity times the node's rows."""

    feature: np.ndarray
    cut: np.ndarray
    w: np.ndarray
    p: np.ndarray
    gain: np.ndarray

    @classmethod
    def roots(cls, trees: int, depth: int) -> Forest:
        nodes = (2 << depth) - 1
        return cls(np.full((trees, nodes), -1), np.full((trees, nodes), 255), *(np.zeros((trees, nodes)) for _ in range(3)))

    def prune(self) -> None:
        """Take back splits of two leaves with the same prediction, from the bottom."""
        for node in range(self.feature.shape[1] // 2 - 1, -1, -1):
            a, b = 2 * node + 1, 2 * node + 2
            says = 2 * self.p > self.w
            same = (self.feature[:, node] >= 0) & (self.feature[:, a] < 0) & (self.feature[:, b] < 0) & (says[:, a] == says[:, b])
            self.feature[same, node] = -1

    def importances(self, features: int) -> np.ndarray:
        """The mean over the trees of each feature's share of the gain, adding up to 1."""
        each = np.stack([np.where(self.feature == f, self.gain, 0).sum(1) for f in range(features)], 1)
        total = each.sum(1, keepdims=True)
        mean = np.divide(each, total, out=np.zeros_like(each), where=total > 0).sum(0)
        return mean / (mean.sum() or 1.0)


def cuts_of(df: DataFrame, features: list[str]) -> list[np.ndarray]:
    """At most ``CUTS`` - 1 increasing cuts a feature, all from one pass: the distinct ones of
    255 quantiles if they are so few, else every eighth."""
    shares = [i / BINS for i in range(1, BINS)]
    row = one_row(df.agg(*[F.percentile_approx(F.col(f).cast("double"), shares, ACCURACY).alias(f) for f in features]))
    edges = []
    for f in features:
        q = np.array(row[f] or [], float)
        fine = np.unique(q)
        edges.append(fine if len(fine) < CUTS else np.unique(q[BINS // CUTS - 1::BINS // CUTS]))
    return edges


def blocks(df: DataFrame, key: str, label: str, features: list[str]) -> DataFrame:
    """(rows): packed records in blocks, written once and dealt out evenly."""
    edges, kind = cuts_of(df, features), record(len(features))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            out = np.empty(batch.num_rows, kind)
            out["h"] = batch.column(0).to_numpy().view(np.uint64)
            out["y"], out["fold"] = batch.column(1).to_numpy(), 255
            for f, edge in enumerate(edges):
                x = batch.column(2 + f).to_numpy(zero_copy_only=False).astype(float)
                out["x"][:, f] = np.where(np.isnan(x), len(edge), np.searchsorted(edge, x, "left"))
            held.append(out)
            n += len(out)
            if n >= BLOCK_ROWS:
                yield from sealed(held)
                held, n = [], 0
        if n:
            yield from sealed(held)

    def sealed(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        data = np.concatenate(held)
        for begin in range(0, len(data), BLOCK_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array([data[begin:begin + BLOCK_ROWS].tobytes()], pa.binary())], names=["rows"])

    cores = df.sparkSession.sparkContext.defaultParallelism
    n = one_row(df.agg(F.count(F.lit(1)).alias("n")))["n"]
    parts = cores * max(1, math.ceil(n / (cores * PART_BLOCKS * BLOCK_ROWS)))
    packed = df.select(F.xxhash64(F.col(key)), F.col(label).cast("int"), *[F.col(f).cast("double") for f in features])
    return cut_lineage(packed.mapInArrow(binned, "rows binary").repartition(parts))


def draws(h: np.ndarray, trees: int, seed: int) -> Iterator[np.ndarray]:
    """How often each row is drawn, tree by tree; a hash serves four trees."""
    for t in range(trees):
        if t % 4 == 0:
            with np.errstate(over="ignore"):
                sixteen = mixed(h ^ mixed(np.array([seed * 1_000_003 + t]))).view(np.uint16).reshape(-1, 4)
        yield DRAWS[sixteen[:, t % 4]]


def best_cuts(sums: np.ndarray, drawn: np.ndarray) -> np.ndarray:
    """(``FOUND``, node): the best split of each node from its (slot, node, bin, label) counts; feature -1: none."""
    slots, nodes = sums.shape[:2]
    w, p = sums[0].sum((1, 2)), sums[0, :, :, 1].sum(1)
    left = sums.cumsum(2)
    lw, lp = left.sum(3), left[..., 1]
    inner = (lw > 0) & (lw < w[None, :, None])
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(inner, purity(lw, lp, w[None, :, None], p[None, :, None]), -np.inf)
        gain -= ((p * p + (w - p) * (w - p)) / w)[None, :, None]
    gain = gain.transpose(1, 0, 2).reshape(nodes, -1)
    at, node = gain.argmax(1), np.arange(nodes)
    slot, cut = at // sums.shape[2], at % sums.shape[2]
    top = gain[node, at]
    split = top > 1e-9 * np.maximum(w, 1)
    return np.stack([np.where(split, drawn[node, slot], -1), cut, w, p, np.where(split, top, 0), lw[slot, node, cut], lp[slot, node, cut]])


def fit(df: DataFrame, key: str, label: str, features: list[str], trees: int = TREES, max_depth: int = DEPTH, seed: int = 42) -> Forest:
    """A forest on all rows, a pass over them for each level."""
    rows, many = blocks(df, key, label, features), len(features)
    per, kind, forest = math.ceil(many ** 0.5), record(many), Forest.roots(trees, max_depth)
    keys = mixed(np.arange(trees, dtype=np.uint64) + np.uint64(seed))[:, None]
    live = np.ones((trees, 1), bool)
    for depth in range(max_depth):
        nodes = 1 << depth
        drawn = np.sort(np.stack([drawn_features(k, seed, np.ones((nodes, many), bool), per) for k in keys]), 2)
        feature, cut = np.maximum(forest.feature[:, :nodes - 1], 0), forest.cut[:, :nodes - 1]

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((trees, per, nodes * CUTS * 2))
            for batch in batches:
                for raw in batch.column(0):
                    data = np.frombuffer(raw.as_buffer(), kind)
                    x, y = np.ascontiguousarray(data["x"]).ravel(), data["y"].astype(np.int64)
                    for t, count in enumerate(draws(data["h"], trees, seed)):
                        if not live[t].any():
                            continue
                        at = np.flatnonzero(count)
                        base, node = at * many, np.zeros(len(at), np.int64)
                        for _ in range(depth):
                            node = 2 * node + 1 + (x[base + feature[t][node]] > cut[t][node])
                        node -= nodes - 1
                        if not live[t].all():
                            kept = live[t][node]
                            at, base, node = at[kept], base[kept], node[kept]
                        w, start = count[at].astype(float), node * (CUTS * 2) + y[at]
                        for s in range(per):
                            total[t, s] += np.bincount(start + 2 * x[base + drawn[t, :, s][node]].astype(np.int64), w, nodes * CUTS * 2)
            some = [t for t in range(trees) if live[t].any()]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([total[t].tobytes() for t in some], pa.binary())],
                                             names=["tree", "sums"])

        def picked(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(raw) for raw in cells["sums"]).reshape(per, nodes, CUTS, 2)
            return pd.DataFrame({"tree": [int(key[0])], "found": [best_cuts(total, drawn[int(key[0])]).tobytes()]})

        sums = rows.mapInArrow(counted, "tree int, sums binary").groupBy("tree").applyInPandas(picked, "tree int, found binary")
        after = np.zeros((trees, nodes, 2), bool)
        for r in small_rows(sums, trees):
            t, found = r["tree"], dict(zip(FOUND, np.frombuffer(r["found"]).reshape(len(FOUND), nodes)))
            split = live[t] & (found["feature"] >= 0)
            here = nodes - 1 + np.flatnonzero(split)
            for name in ("feature", "cut", "gain"):
                getattr(forest, name)[t, here] = found[name][split]
            if depth == 0:
                forest.w[t, 0], forest.p[t, 0] = found["w"][0], found["p"][0]
            for side, (w, p) in enumerate(((found["lw"], found["lp"]), (found["w"] - found["lw"], found["p"] - found["lp"]))):
                forest.w[t, 2 * here + 1 + side], forest.p[t, 2 * here + 1 + side] = w[split], p[split]
                after[t, split, side] = (p[split] > 0) & (p[split] < w[split])
        if not after.any():
            break
        live, keys = after.reshape(trees, -1), np.stack([child_keys(k).ravel() for k in keys])
    forest.prune()
    return forest
