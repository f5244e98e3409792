"""Exact k-nearest-neighbour join and classifier.

Reference rows are dealt to cells, the boxes of a k-d tree whose cuts come from
a sample of them. A query first asks the cell it falls into, which gives an upper
bound of its k-th distance, and then only the cells whose box is within it. Inside
a cell, rows lie in leaves of about ``BLOCK`` rows, again with boxes, so most leaves
are passed over as well. Products pick the candidates of a leaf, exact distances decide.

* No pair table: a task holds the rows of one cell (``BLOCK * GROUP`` in the
  mean), one pack of queries (``PACK``) and each query's k best so far. Rows and
  queries travel as packed records.
* Hot spots: equal vectors keep their ``k`` smallest ids only (no others can be
  an answer), cut per partition before the shuffle; equal queries are asked
  once; a cell that is asked by many gets several packs.
* The driver sees the sample, the boxes and the sizes: at most ``MAX_CELLS`` of each.

Distances are Euclidean, squared distances summed in feature order in double
precision; ties go to the smaller id. Rows whose vector is null or holds a null
or a non-finite value take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchlake.operators.binned import group_names
from matchlake.operators.small import one_row, small_rows
from matchlake.session import cut_lineage

BLOCK, GROUP, PACK = 512, 128, 131_072
MAX_CELLS, MOST_TASKS, SAMPLE, AT_ONCE = 4096, 2000, 64, 16_384
LEAST_TASKS = 32
SLACK = 1e-12  # of the squared lengths in a product: far more than its rounding
NEAR = "array<struct<d2:double,id:long,payload:double>>"
KIND = pa.list_(pa.struct([("d2", pa.float64()), ("id", pa.int64()), ("payload", pa.float64())]))


def matrix(rows: pa.Array) -> np.ndarray:
    """(rows, features) of an array of equally long vectors."""
    if isinstance(rows, pa.ChunkedArray):
        rows = rows.combine_chunks()
    if not len(rows):
        return np.zeros((0, 0))
    return rows.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of ``a`` to all of ``b``, summed in feature order."""
    out = np.zeros((len(a), len(b)))
    for f in range(a.shape[1]):
        step = a[:, f, None] - b[None, :, f]
        out += step * step
    return out


def usable(x: Column) -> Column:
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(math.inf)))
    return x.isNotNull() & ~F.coalesce(bad, F.lit(True))


def distinct_rows(df: DataFrame, k: int) -> DataFrame:
    """Of equal vectors, the ``k`` rows with the smallest ids (limited before the shuffle as well)."""
    order = Window.partitionBy("x").orderBy("id")
    return df.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= k).drop("_rn")


def stored(width: int) -> np.dtype:
    """A packed reference row."""
    return np.dtype([("id", "<i8"), ("payload", "<f8"), ("x", "<f8", (width,))])


def asking(width: int) -> np.dtype:
    """A packed query; ``bound`` is an upper bound of its k-th squared distance."""
    return np.dtype([("id", "<i8"), ("bound", "<f8"), ("x", "<f8", (width,))])


# -- boxes -----------------------------------------------------------------


def halves(x: np.ndarray, least: int) -> list[np.ndarray]:
    """Row numbers of the leaves of a k-d tree: the widest feature is cut at its
    middle row until a leaf has at most ``least`` rows."""
    todo, out = [np.arange(len(x))], []
    while todo:
        at = todo.pop()
        if len(at) <= least:
            out.append(at)
            continue
        own = x[at]
        f = int((own.max(0) - own.min(0)).argmax())
        order = np.argpartition(own[:, f], len(at) // 2)
        todo += [at[order[len(at) // 2:]], at[order[:len(at) // 2]]]
    return out


class Cuts:
    """A k-d tree of cuts: a row goes left if its feature is at most the cut."""

    def __init__(self, sample: np.ndarray, cells: int):
        self.feature, self.cut, self.left, self.cells = [0], [math.inf], [-1], []
        todo = [(0, sample, max(1, cells))]
        while todo:
            node, x, n = todo.pop()
            f = int((x.max(0) - x.min(0)).argmax()) if len(x) else 0
            value = np.sort(x[:, f])[(len(x) - 1) // 2] if len(x) else 0.0
            if n > 1 and len(x) and value == x[:, f].max():
                lower = x[:, f][x[:, f] < value]
                value = lower.max() if len(lower) else value
            if n == 1 or not len(x) or value == x[:, f].max():
                self.feature[node], self.cells = -1 - len(self.cells), self.cells + [node]
                continue
            self.feature[node], self.cut[node], self.left[node] = f, float(value), len(self.left)
            self.feature += [0, 0]
            self.cut += [math.inf] * 2
            self.left += [-1, -1]
            left = x[:, f] <= value
            todo += [(self.left[node], x[left], n - n // 2), (self.left[node] + 1, x[~left], n // 2)]

    def place(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row."""
        feature, cut, left = np.array(self.feature), np.array(self.cut), np.array(self.left)
        node, live = np.zeros(len(x), np.int64), np.arange(len(x))
        while True:
            live = live[left[node[live]] >= 0]
            if not len(live):
                return -1 - feature[node]
            at = node[live]
            node[live] = left[at] + (x[live, feature[at]] > cut[at])


def box_d2(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of rows to boxes. Summed like ``squared``, so no row of a box lies nearer, rounding included."""
    out = np.zeros((len(x), len(low)))
    for f in range(x.shape[1]):
        step = np.maximum(low[None, :, f] - x[:, f, None], x[:, f, None] - high[None, :, f])
        np.maximum(step, 0, out=step)
        out += step * step
    return out


# -- a pack of queries against a cell --------------------------------------


def near_pairs(x: np.ndarray, rows: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, squared distance) of all pairs within the bounds that may be among a query's ``k`` best."""
    center = rows.mean(0)
    with np.errstate(over="ignore", invalid="ignore"):
        a, b = x - center, rows - center
        aa, bb = (a * a).sum(1), (b * b).sum(1)
        most = aa.max() + bb.max()
        if most < 1e200:
            d2 = aa[:, None] + bb[None] - 2 * (a @ b.T)
            slack = SLACK * (aa + bb.max())
        else:
            d2, slack = squared(x, rows), np.zeros(len(x))
        limit = bound + slack
        if len(rows) > k and np.isinf(bound).any():
            limit = np.minimum(limit, np.partition(d2, k - 1, axis=1)[:, k - 1] + 2 * slack)
        i, j = np.nonzero(d2 <= limit[:, None])
        exact = np.zeros(len(i))
        for f in range(x.shape[1]):
            step = x[i, f] - rows[j, f]
            exact += step * step
    hit = (exact <= bound[i]) & (exact < np.inf)
    return i[hit], j[hit], exact[hit]


class Best:
    """The k best (squared distance, id) of some queries, as flat arrays by query."""

    def __init__(self, bound: np.ndarray, k: int):
        self.bound, self.k = bound.copy(), k
        self.of, self.d2 = np.zeros(0, np.int64), np.zeros(0)
        self.id, self.payload = np.zeros(0, np.int64), np.zeros(0)

    def merge(self, parts: list[tuple]) -> None:
        if not parts:
            return
        of, d2, ids, payload = (np.concatenate(c) for c in zip((self.of, self.d2, self.id, self.payload), *parts))
        order = np.lexsort((ids, d2, of))
        of = of[order]
        first = np.searchsorted(of, np.arange(len(self.bound)))
        rank = np.arange(len(of)) - first[of]
        kept = order[rank < self.k]
        last = of[rank == self.k - 1]
        self.bound[last] = np.minimum(self.bound[last], d2[order[rank == self.k - 1]])
        self.of, self.d2, self.id, self.payload = of[rank < self.k], d2[kept], ids[kept], payload[kept]

    def lists(self) -> pa.ListArray:
        """Each query's (d2, id, payload), nearest first."""
        ends = np.searchsorted(self.of, np.arange(len(self.bound) + 1)).astype(np.int32)
        rows = pa.StructArray.from_arrays([pa.array(self.d2), pa.array(self.id), pa.array(self.payload)], fields=list(KIND.value_type))
        return pa.ListArray.from_arrays(pa.array(ends), rows)


class Leaves:
    """The rows of a cell in leaves with their boxes."""

    def __init__(self, data: np.ndarray, block: int):
        self.parts = [data[at] for at in halves(data["x"], block)] if len(data) else []
        width = data["x"].shape[1]
        self.low = np.array([p["x"].min(0) for p in self.parts]).reshape(-1, width)
        self.high = np.array([p["x"].max(0) for p in self.parts]).reshape(-1, width)

    def best(self, x: np.ndarray, bound: np.ndarray, k: int) -> Best:
        """Each query's ``k`` best rows within its bound: the nearest leaf, near leaves, the rest."""
        best = Best(bound, k)
        if not self.parts:
            return best
        lower = box_d2(x, self.low, self.high)
        seen = np.zeros(lower.shape, bool)
        for share in (None, 0.25, 1.0):
            if share is None:
                ask = np.zeros(lower.shape, bool)
                ask[np.arange(len(x)), lower.argmin(1)] = True
                ask &= lower <= best.bound[:, None]
            else:
                ask = ~seen & (lower <= share * best.bound[:, None])
            seen |= ask
            parts = []
            for leaf in np.flatnonzero(ask.any(0)):
                part, at = self.parts[leaf], np.flatnonzero(ask[:, leaf])
                for a in range(0, len(at), 2048):
                    own = at[a:a + 2048]
                    i, j, d2 = near_pairs(x[own], part["x"], best.bound[own], k)
                    parts.append((own[i], d2, part["id"][j], part["payload"][j]))
            best.merge(parts)
        return best


# -- the join --------------------------------------------------------------


def blobs(cell: np.ndarray, data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(cell, records) of each cell of a batch."""
    order = np.argsort(cell, kind="stable")
    names, starts = np.unique(cell[order], return_index=True)
    for c, at in zip(names, np.split(order, starts[1:])):
        yield int(c), data[at]


def placed_rows(rows: DataFrame, cuts: Cuts, width: int) -> DataFrame:
    """(cell, n, low, high, data): the (id, x, payload) rows as packed records by cell."""
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data = np.empty(batch.num_rows, stored(width))
            data["id"], data["x"], data["payload"] = batch.column(0).to_numpy(), matrix(batch.column(1)), batch.column(2).to_numpy()
            out = [(c, len(d), d["x"].min(0).tolist(), d["x"].max(0).tolist(), d.tobytes()) for c, d in blobs(cuts.place(data["x"]), data)]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), (
                pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.binary()))],
                names=["cell", "n", "low", "high", "data"])

    return rows.select("id", "x", "payload").mapInArrow(
        sent, "cell int, n long, low array<double>, high array<double>, data binary")


def sent_queries(queries: DataFrame, cells_of, width: int, counted: bool) -> DataFrame:
    """(cell, n, data): the (id, x, bound) queries as packed records for each cell
    that ``cells_of(x, bound)`` marks; without the records if only ``counted``."""
    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, AT_ONCE):
                part = batch.slice(a, AT_ONCE)
                data = np.empty(part.num_rows, asking(width))
                data["id"], data["x"], data["bound"] = part.column(0).to_numpy(), matrix(part.column(1)), part.column(2).to_numpy()
                at, cell = cells_of(data["x"], data["bound"])
                out = [(c, len(d), None if counted else d.tobytes()) for c, d in blobs(cell, data[at])] if len(at) else []
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate((
                    pa.int32(), pa.int64(), pa.binary()))], names=["cell", "n", "data"])

    return queries.select("id", "x", "bound").mapInArrow(sent, "cell int, n long, data binary")


def asked_cells(queries: DataFrame, cells_of, placed: DataFrame, width: int, k: int) -> DataFrame:
    """(query, x, near): the best rows of each asked cell for each of its queries."""
    spark, block = queries.sparkSession, BLOCK
    sizes = small_rows(sent_queries(queries, cells_of, width, True).groupBy("cell").agg(F.sum("n").alias("n")), MAX_CELLS)
    groups = [(r["cell"], p, math.ceil(r["n"] / PACK)) for r in sizes for p in range(math.ceil(r["n"] / PACK))]
    tasks = max(1, min(len(groups), MOST_TASKS))
    names = group_names(spark, tasks) if len(groups) <= tasks else list(range(len(groups)))
    packs = F.broadcast(spark.createDataFrame([(*g, n) for g, n in zip(groups, names)], "cell int, pack int, packs int, g int"))
    sent = sent_queries(queries, cells_of, width, False).join(packs, "cell").where(
        F.col("pack") == F.pmod(F.xxhash64("data"), F.col("packs"))).select("g", "data").repartition(tasks, "g")
    rows = placed.select("cell", "data").join(packs, "cell").select(F.col("g").alias("to"), "data").repartition(tasks, "to")

    def searched(rows: pa.Table, queries: pa.Table) -> pa.Table:
        data, asked = (np.frombuffer(b"".join(t.column("data").to_pylist()), kind(width))
                       for t, kind in ((rows, stored), (queries, asking)))
        leaves, out = Leaves(data, block), []
        parts = halves(asked["x"], AT_ONCE)
        for at in parts if len(asked) else []:
            own = asked[at]
            near = leaves.best(np.ascontiguousarray(own["x"]), own["bound"], k).lists()
            x = pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * width), pa.array(own["x"].ravel()))
            out.append(pa.table([pa.array(own["id"]), x, near], names=["query", "x", "near"]))
        schema = pa.schema([("query", pa.int64()), ("x", pa.list_(pa.float64())), ("near", KIND)])
        return pa.concat_tables([t.cast(schema) for t in out]) if out else schema.empty_table()

    return rows.groupBy("to").cogroup(sent.groupBy("g")).applyInArrow(searched, f"query long, x array<double>, near {NEAR}")


def nearest_lists(queries: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """(x, near) for every distinct usable query vector: its ``k`` nearest rows
    as (d2, id, payload), nearest first. ``queries`` has an ``x``, ``rows`` have
    (id, x, payload)."""
    rows = cut_lineage(distinct_rows(rows.where(usable(F.col("x"))), k))
    size = one_row(rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("width")))
    n, width = size["n"], size["width"]
    asked = queries.where(usable(F.col("x"))).select("x").distinct()
    if not n:
        return asked.select("x", F.array().cast(NEAR).alias("near"))
    asked = cut_lineage(asked.select(F.monotonically_increasing_id().alias("id"), "x", F.lit(math.inf).alias("bound")))
    cells = min(MAX_CELLS, max(math.ceil(n / (BLOCK * GROUP)), min(LEAST_TASKS, math.ceil(n / (4 * BLOCK)))))
    sample = small_rows(rows.orderBy(F.xxhash64("id"), "id").limit(cells * SAMPLE).select("x"), cells * SAMPLE)
    cuts = Cuts(np.array([r["x"] for r in sample], float).reshape(len(sample), width), cells)
    placed = cut_lineage(placed_rows(rows, cuts, width))
    ends = small_rows(placed.groupBy("cell").agg(
        *[F.min(F.col("low")[f]).alias(f"low{f}") for f in range(width)],
        *[F.max(F.col("high")[f]).alias(f"high{f}") for f in range(width)]), MAX_CELLS)
    low, high = (np.array([[r[f"{side}{f}"] for f in range(width)] for r in ends], float) for side in ("low", "high"))
    number = np.array([r["cell"] for r in ends])

    def home(x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.arange(len(x)), cuts.place(x)

    def others(x: np.ndarray, bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own, found = cuts.place(x), []
        for a in range(0, len(x), 1024):
            reach = box_d2(x[a:a + 1024], low, high) <= bound[a:a + 1024, None]
            i, j = np.nonzero(reach & (number[None] != own[a:a + 1024, None]))
            found.append((i + a, number[j]))
        return tuple(np.concatenate(c) for c in zip(*found))

    first = cut_lineage(asked_cells(asked, home, placed, width, k))
    last = F.when(F.size("near") >= k, F.element_at("near", -1)["d2"]).otherwise(math.inf)
    more = asked_cells(first.select(F.col("query").alias("id"), "x", last.alias("bound")), others, placed, width, k)
    merged = more.where(F.size("near") > 0).groupBy("query").agg(F.flatten(F.collect_list("near")).alias("more"))
    near = F.when(F.col("more").isNull(), F.col("near")).otherwise(F.slice(F.array_sort(F.concat("near", "more")), 1, k))
    return first.join(merged, "query", "left").select("x", near.alias("near"))


def knn_join(queries: DataFrame, query_id: str, rows: DataFrame, row_id: str, features: list[str], k: int = 15,
             payload: str | None = None) -> DataFrame:
    """(query, rank, neighbour, distance, payload) of the ``k`` rows
    nearest to each query; all rows if there are fewer. Ids are longs."""
    x = F.array(*[F.col(f).cast("double") for f in features])
    load = F.col(payload).cast("double") if payload else F.lit(None).cast("double")
    asked = queries.select(F.col(query_id).alias("query"), x.alias("x")).where(usable(F.col("x")))
    stored = rows.select(F.col(row_id).cast("long").alias("id"), x.alias("x"), F.coalesce(load, F.lit(math.nan)).alias("payload"))
    lists = nearest_lists(asked, stored.where(F.col("id").isNotNull()), k)
    return asked.join(lists, "x").select("query", F.posexplode("near").alias("rank", "hit")).select(
        "query", (F.col("rank") + 1).cast("long").alias("rank"), F.col("hit.id").alias("neighbour"),
        F.sqrt("hit.d2").alias("distance"), F.col("hit.payload").alias("payload"))


def knn_probability(queries: DataFrame, query_id: str, train: DataFrame, train_id: str, features: list[str], label: str,
                    k: int = 15) -> DataFrame:
    """(query, probability): the share of label 1 among the ``k`` nearest training rows."""
    x = F.array(*[F.col(f).cast("double") for f in features])
    asked = queries.select(F.col(query_id).alias("query"), x.alias("x")).where(usable(F.col("x")))
    stored = train.select(F.col(train_id).cast("long").alias("id"), x.alias("x"), F.col(label).cast("double").alias("payload"))
    lists = nearest_lists(asked, stored.where(F.col("id").isNotNull() & F.col("payload").isNotNull()), k)
    votes = F.aggregate("near", F.lit(0.0), lambda total, hit: total + hit["payload"])
    return asked.join(lists, "x").select("query", F.when(F.size("near") > 0, votes / F.size("near")).alias("probability"))
