"""Rows for tree training: features in at most 256 bins, one byte each.

Bin edges are quantiles of the training table (at most 255 a feature, whatever
the rows), so a row is a few bytes, histograms have a fixed size, and a task
may hold ``LOCAL_ROWS`` of them. Below that number of rows whole trees grow
inside tasks; above it, Spark aggregates histograms over all rows. Both give the
same trees: all sums are integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from matchlake.operators.small import one_row, small_rows
from matchlake.session import cut_lineage

BINS = 256
LOCAL_ROWS = 1 << 20
ACCURACY = 50_000  # rank error of an edge: 1 in this many rows
GROUP_NAMES: dict[int, list[int]] = {}


def record(features: int) -> np.dtype:
    """A packed row: hash of its id, label, fold, bins."""
    return np.dtype([("h", "<u8"), ("y", "u1"), ("fold", "u1"), ("x", "u1", (features,))])


def bin_edges(df: DataFrame, features: list[str]) -> list[np.ndarray]:
    """Increasing upper bounds of each feature's bins but the last."""
    shares = [i / BINS for i in range(1, BINS)]
    row = one_row(df.agg(*[F.percentile_approx(F.col(f).cast("double"), shares, ACCURACY).alias(f) for f in features]))
    return [np.unique(np.array(row[f] or [], float)) for f in features]


def bins_of(features: list[str], edges: list[np.ndarray]) -> Column:
    """The row's bins as bytes; nulls and NaN fall into the last bin."""
    @arrow_udf("binary")
    def binned(*columns: pa.Array) -> pa.Array:
        out = np.empty((len(columns[0]), len(columns)), np.uint8)
        for f, column in enumerate(columns):
            x = column.to_numpy(zero_copy_only=False).astype(float)
            out[:, f] = np.where(np.isnan(x), len(edges[f]), np.searchsorted(edges[f], x, "left"))
        return pa.array([row.tobytes() for row in out], pa.binary())

    return binned(*[F.col(f).cast("double") for f in features])


def binned_rows(df: DataFrame, key: str, label: str, features: list[str], fold: str | None = None,
                edges: list[np.ndarray] | None = None) -> DataFrame:
    """(id, h, y, fold, x): the table that tree training reads, written once.
    Without a fold column every row has fold 255."""
    edges = bin_edges(df, features) if edges is None else edges
    number = F.col(fold) if fold else F.lit(255)
    return cut_lineage(df.select(F.col(key).alias("id"), F.xxhash64(F.col(key)).alias("h"), F.col(label).cast("int").alias("y"),
                                 number.cast("int").alias("fold"), bins_of(features, edges).alias("x")))


def packed(batch: pa.RecordBatch, features: int) -> np.ndarray:
    """The records of a batch of (.., h, y, fold, x) rows."""
    out = np.empty(batch.num_rows, record(features))
    col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
    out["h"] = col["h"].to_numpy().view(np.uint64)
    out["y"] = col["y"].to_numpy()
    out["fold"] = col["fold"].to_numpy()
    x = col["x"].cast(pa.large_binary())
    raw = np.frombuffer(x.buffers()[2], np.uint8) if batch.num_rows else np.zeros(0, np.uint8)
    offsets = np.frombuffer(x.buffers()[1], np.int64)[x.offset:x.offset + len(x) + 1]
    out["x"] = raw[offsets[0]:offsets[-1]].reshape(batch.num_rows, features)
    return out


def group_names(spark: SparkSession, groups: int) -> list[int]:
    """One number for each of ``groups`` tasks, such that hashing deals them to different partitions."""
    if groups in GROUP_NAMES:  # they depend on Spark's hash only
        return GROUP_NAMES[groups]
    at = F.pmod(F.hash(F.col("id").cast("int")), F.lit(groups))
    rows = small_rows(spark.range(40 * groups).groupBy(at.alias("p")).agg(F.min("id").alias("id")), groups)
    found = [r["id"] for r in rows]
    GROUP_NAMES[groups] = found + [40 * groups + i for i in range(groups - len(found))]
    return GROUP_NAMES[groups]


def dealt_to_groups(rows: DataFrame, groups: list[int], features: int) -> DataFrame:
    """(g, rows): the packed rows for each of the tasks that train on all of them."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blob = packed(batch, features).tobytes()
            for g in groups:
                yield pa.RecordBatch.from_pydict({"g": pa.array([g], pa.int32()), "rows": pa.array([blob], pa.binary())})

    return rows.select("h", "y", "fold", "x").mapInArrow(spread, "g int, rows binary")


def gathered(blobs: Iterator[bytes], features: int) -> np.ndarray:
    """The records of a group in one order, however they were dealt out."""
    parts = [np.frombuffer(b, record(features)) for b in blobs]
    rows = np.concatenate(parts) if parts else np.zeros(0, record(features))
    rows = rows[np.argsort(rows["h"])]
    if (rows["h"][1:] == rows["h"][:-1]).any():
        rows = rows[np.lexsort((*rows["x"].T, rows["y"], rows["h"]))]
    return rows


def mixed(x: np.ndarray) -> np.ndarray:
    """A scrambled 64-bit number of each number (the finisher of a well-known generator)."""
    with np.errstate(over="ignore"):
        x = np.asarray(x).astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        return x


def uniform(h: np.ndarray, seed: int) -> np.ndarray:
    """A number in [0, 1) for each row hash and seed."""
    return (mixed(h ^ mixed(np.array([seed]))) >> np.uint64(11)) * 2.0 ** -53


def area(y: np.ndarray, score: np.ndarray) -> float:
    """AUC with ties counted half; NaN without both labels."""
    order = np.argsort(score)
    y, score = y[order].astype(float), score[order]
    first = np.append(True, score[1:] != score[:-1])
    group = np.cumsum(first) - 1
    pos, neg = np.bincount(group, y), np.bincount(group, 1 - y)
    if not pos.sum() or not neg.sum():
        return math.nan
    return float((pos * (np.cumsum(neg) - neg / 2)).sum() / (pos.sum() * neg.sum()))


# -- trees -----------------------------------------------------------------


class Tree:
    """Nodes as arrays: a row goes to ``left`` or, if its bin lies above
    ``bin``, to the node after it. A leaf leads to itself."""

    def __init__(self, feature, bin, left, value):  # noqa: A002
        self.feature = np.asarray(feature, np.uint8)
        self.bin = np.asarray(bin, np.uint8)
        self.left = np.asarray(left, np.int32)
        self.value = np.asarray(value, np.float64)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        node, rows = np.zeros(len(x), np.int32), np.arange(len(x))
        while True:
            after = self.left[node] + (x[rows, self.feature[node]] > self.bin[node])
            if np.array_equal(after, node):
                return node
            node = after

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.value[self.leaves(x)]

    def to_bytes(self) -> bytes:
        return b"".join(a.tobytes() for a in (self.value, self.left, self.feature, self.bin))

    @classmethod
    def from_bytes(cls, raw: bytes) -> Tree:
        n = len(raw) // 14
        return cls(np.frombuffer(raw, np.uint8, n, 12 * n), np.frombuffer(raw, np.uint8, n, 13 * n),
                   np.frombuffer(raw, np.int32, n, 8 * n), np.frombuffer(raw, np.float64, n))
