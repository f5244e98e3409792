"""Random forests, many at once: every tree of every draw and fold in the same jobs.

A tree is grown on a Poisson(1) bootstrap of its training rows (each row's
count comes from a hash of its id and the tree, so it needs no coordination),
with the Gini criterion over a random subset of the features at each node, to any depth.

* While a node has more than ``local_rows`` rows, its level is split by one pass
  over the rows for all such nodes of all trees: tasks count (tree, node,
  feature, bin), Spark sums the counts and picks each node's split.
* A node with fewer rows goes to one task, which grows the rest of its subtree.
  Trees whose root is that small are dealt to tasks in sets that share the rows.
* ``kernels`` has the loops of a subtree; a search's trees are scored where they grow, so
  neither trees nor scores of single trees are written.

Sums are whole numbers and a node's feature subset comes from its path, so the
trees do not depend on ``local_rows``, partitions or task order. The trees are a
written table of packed nodes; scoring reads it in chunks of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.operators import kernels as KE
from matchlake.operators.binned import (
    BINS,
    LOCAL_ROWS,
    Tree,
    area,
    dealt_to_groups,
    gathered,
    group_names,
    mixed,
    packed,
    uniform,
)
from matchlake.operators.curves import roc_auc
from matchlake.operators.small import small_rows
from matchlake.session import cut_lineage

CHUNK_BYTES = 64 << 20  # packed trees that a scoring pass holds
MOST_BIG_NODES = 1_000_000
PASS_NODES = 4096  # nodes whose sums a task holds, 43 kB each with seven features
SENT_BYTES = 64 << 20  # rows of nodes that a task holds before it hands them on
SUBTREE_ROWS = 1 << 21  # rows of a big tree's node that a kernel finishes
RUNS_PER_CORE = 12  # runs of trees that a core grows and scores
#: P(a row is drawn at most k times), k = 0, 1, ...
DRAWN = np.cumsum([0.36787944117144233 / f for f in (1, 1, 2, 6, 24, 120, 720, 5040, 40320, 362880, 3628800)])


@dataclass(frozen=True)
class ForestSpec:
    """One forest: rows of the folds ``held`` are not trained on."""

    trees: int = 100
    max_depth: int | None = None
    min_split: int = 2
    min_leaf: int = 1
    held: tuple[int, ...] = ()
    seed: int = 42
    bootstrap: bool = True

    def depth(self) -> int:
        return 1 << 30 if self.max_depth is None else self.max_depth

    def counts(self, rows: np.ndarray, tree: int) -> np.ndarray:
        """How often each row is drawn for a tree."""
        if self.bootstrap:
            n = np.searchsorted(DRAWN, uniform(rows["h"], self.tree_seed(tree)), "right")
        else:
            n = np.ones(len(rows), np.int64)
        return np.where(np.isin(rows["fold"], self.held), 0, n) if self.held else n

    def tree_seed(self, tree: int) -> int:
        return int(mixed(np.array([self.seed * 1_000_003 + tree]))[0] >> np.uint64(1))


def child_keys(keys: np.ndarray) -> np.ndarray:
    """The path numbers of both children of nodes."""
    with np.errstate(over="ignore"):
        return mixed(np.stack([keys * np.uint64(2), keys * np.uint64(2) + np.uint64(1)], 1))


def drawn_features(keys: np.ndarray, seed: int, varies: np.ndarray, m: int) -> np.ndarray:
    """``m`` features for each node in random order, those that vary first."""
    with np.errstate(over="ignore"):
        order = mixed(mixed(keys ^ np.uint64(seed))[:, None] + np.arange(varies.shape[1], dtype=np.uint64)[None])
    order = np.where(varies, order >> np.uint64(1), np.uint64(1 << 63))
    return np.argsort(order, axis=1, kind="stable")[:, :m]


def purity(lw, lp, w, p):
    """Larger is better: the weighted purity of both sides of a split."""
    rw, rp = w - lw, p - lp
    return (lp * lp + (lw - lp) * (lw - lp)) / lw + (rp * rp + (rw - rp) * (rw - rp)) / rw


# -- a subtree inside a task -----------------------------------------------


def grow(x: np.ndarray, y: np.ndarray, count: np.ndarray, spec: ForestSpec, seed: int, m: int, key: int = 1,
         depth: int = 0) -> Tree:
    """The subtree below a node, level by level, all nodes of a level at once."""
    at = np.flatnonzero(count)
    x, w = x[at], count[at].astype(np.float64)
    wy = w * y[at]
    node, keys = np.zeros(len(x), np.int64), np.array([key], np.uint64)
    feature, cut, left, value = [], [], [], []
    made = 0  # nodes of the levels above
    while len(keys):
        n = len(keys)
        total, ones, rows = (np.bincount(node, v, n) for v in (w, wy, np.ones(len(w))))
        value.append(np.divide(ones, total, out=np.zeros(n), where=total > 0))
        may = (ones > 0) & (ones < total) & (rows >= spec.min_split) & (depth < spec.depth())
        best, where, at_bin = best_splits(x, w, wy, node, keys, seed, m, total, ones, may, spec.min_leaf)
        split = may & (best > -np.inf)
        rank = np.cumsum(split) - 1
        feature.append(np.where(split, where, 0))
        cut.append(np.where(split, at_bin, BINS - 1))
        left.append(np.where(split, made + n + 2 * rank, made + np.arange(n)))
        keep = split[node]
        x, w, wy, node = x[keep], w[keep], wy[keep], node[keep]
        node = 2 * rank[node] + (x[np.arange(len(x)), where[node]] > at_bin[node])
        keys = child_keys(keys[split]).ravel()
        made, depth = made + n, depth + 1
    return Tree(*(np.concatenate(v) for v in (feature, cut, left, value)))


def stable_order(node: np.ndarray, bins: np.ndarray | None = None) -> np.ndarray:
    """The stable order by (node, bin), in 16-bit digits: numpy sorts these by counting."""
    order = np.arange(len(node)) if bins is None else np.argsort(bins, kind="stable")
    top, shift = int(node.max()) if len(node) else 0, 0
    while top >> shift:
        order = order[np.argsort((node[order] >> shift).astype(np.uint16), kind="stable")]
        shift += 16
    return order


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, their first places) of sorted values."""
    starts = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[starts], starts


def best_splits(x, w, wy, node, keys, seed, m, total, ones, may, min_leaf=1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(purity, feature, bin) of the best split of each node that may split."""
    n = len(keys)
    best, where, at_bin = np.full(n, -np.inf), np.zeros(n, np.int64), np.zeros(n, np.int64)
    live = may[node]
    if not live.any():
        return best, where, at_bin
    order = np.flatnonzero(live)
    order = order[stable_order(node[order])]
    x, w, wy, node = x[order], w[order], wy[order], node[order]
    present, starts = runs(node)
    varies = np.zeros((n, x.shape[1]), bool)
    varies[present] = np.maximum.reduceat(x, starts, 0) > np.minimum.reduceat(x, starts, 0)
    chosen = drawn_features(keys, seed, varies, m)
    base, stops = node * BINS, np.append(starts[1:], len(x))
    for slot in range(chosen.shape[1]):
        f = chosen[:, slot]
        bins = x[np.arange(len(x)), f[node]]
        key, by = base + bins, stable_order(node, bins)
        key, lw, lp = key[by], np.cumsum(w[by]), np.cumsum(wy[by])
        end = np.flatnonzero((key[1:] != key[:-1]) & (key[1:] // BINS == key[:-1] // BINS))
        at = np.searchsorted(present, key[end] // BINS)
        end = end[(end - starts[at] + 1 >= min_leaf) & (stops[at] - end - 1 >= min_leaf)]
        if not len(end):
            continue
        of = key[end] // BINS
        first = starts[np.searchsorted(present, of)]
        score = purity(lw[end] - np.where(first > 0, lw[first - 1], 0), lp[end] - np.where(first > 0, lp[first - 1], 0),
                       total[of], ones[of])
        group, begin = runs(of)
        top = np.maximum.reduceat(score, begin)
        hit = np.flatnonzero(score == np.repeat(top, np.diff(np.append(begin, len(score)))))
        _, one = runs(of[hit])
        bins = key[end[hit[one]]] % BINS
        better = (top > best[group]) | ((top == best[group]) & (f[group] < where[group]))
        g = group[better]
        best[g], where[g], at_bin[g] = top[better], f[g], bins[better]
    return best, where, at_bin


# -- levels of big nodes over all rows -------------------------------------


@dataclass
class Top:
    """The upper part of a big tree: nodes with their path number, rows, depth."""

    feature: list[int] = field(default_factory=lambda: [0])
    bin: list[int] = field(default_factory=lambda: [BINS - 1])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    key: list[int] = field(default_factory=lambda: [1])
    depth: list[int] = field(default_factory=lambda: [0])
    open: list[int] = field(default_factory=list)  # nodes to split over all rows
    small: list[int] = field(default_factory=list)  # nodes that a task finishes

    def tree(self) -> Tree:
        return Tree(self.feature, self.bin, self.left, self.value)


def chosen_split(table: np.ndarray, key: int, spec: ForestSpec, depth: int, seed: int, m: int) -> dict:
    """The split of one node from its (sum, feature, bin) sums of weights, weights of label 1 and rows."""
    w, p, c = table[:, 0].sum(1)
    out = {"w": w, "p": p, "feature": -1, "bin": 0, "lw": 0.0, "lp": 0.0, "lc": 0.0, "c": c}
    if not 0 < p < w or c < spec.min_split or depth >= spec.depth():
        return out
    varies = (table[0] > 0).sum(1) > 1
    best = -np.inf
    for f in drawn_features(np.array([key], np.uint64), seed, varies[None], m)[0].tolist():
        sums = table[:, f].cumsum(1)
        inner = np.flatnonzero((table[0, f] > 0) & (sums[0] < w) & (sums[2] >= spec.min_leaf) & (c - sums[2] >= spec.min_leaf))
        if not len(inner):
            continue
        score = purity(sums[0, inner], sums[1, inner], w, p)
        i = int(score.argmax())
        if score[i] > best or score[i] == best and f < out["feature"]:
            best = score[i]
            out |= {"feature": f, "bin": int(inner[i]), "lw": sums[0, inner[i]], "lp": sums[1, inner[i]], "lc": sums[2, inner[i]]}
    return out


def passes(now: dict) -> Iterator[dict]:
    """Trees with ``PASS_NODES`` nodes to split in all, or a tree alone."""
    some, nodes = {}, 0
    for k, (tree, open_nodes, keys, depths) in now.items():
        if some and nodes + len(open_nodes) > PASS_NODES:
            yield some
            some, nodes = {}, 0
        some[k] = (tree, open_nodes, keys, depths)
        nodes += len(open_nodes)
    if some:
        yield some


def asked_splits(rows: DataFrame, now: dict, specs: list[ForestSpec], m: int, features: int) -> DataFrame:
    """The split of every open node of the trees ``now``: a task adds up its rows, then hands on a row a node."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, np.ndarray] = {}
        for batch in batches:
            data = packed(batch, features)
            for k, (tree, open_nodes, _, _) in now.items():
                n, place = len(open_nodes), np.full(len(tree.left), -1)
                place[open_nodes] = np.arange(n)
                count = specs[k[0]].counts(data, k[1])
                at = np.where(count > 0, place[tree.leaves(data["x"])], -1)
                hit = np.flatnonzero(at >= 0)
                if not len(hit):
                    continue
                total = held.setdefault(k, np.zeros((n, 3, features, BINS), np.int32))
                x, base, w = data["x"][hit], at[hit] * BINS, count[hit].astype(float)
                for f in range(features):
                    key = base + x[:, f]
                    for i, v in enumerate((w, w * data["y"][hit], None)):
                        total[:, i, f] += np.bincount(key, v, n * BINS).reshape(n, BINS).astype(np.int32)
        for (i, t), total in held.items():
            full = np.flatnonzero(total[:, 2, 0].any(1))
            same = [pa.array(np.full(len(full), v, np.int32)) for v in (i, t)]
            yield pa.RecordBatch.from_arrays([*same, pa.array(np.array(now[i, t][1], np.int32)[full]),
                                              pa.array([total[j].tobytes() for j in full], pa.binary())],
                                             names=["forest", "tree", "node", "sums"])

    def picked(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        i, t, node = (int(v) for v in key)
        _, _, keys, depths = now[i, t]
        table = sum(np.frombuffer(raw, np.int32).astype(float) for raw in cells["sums"]).reshape(3, features, BINS)
        return pd.DataFrame([{"forest": i, "tree": t, "node": node} | chosen_split(
            table, keys[node], specs[i], depths[node], specs[i].tree_seed(t), m)])

    tasks = 2 * rows.sparkSession.sparkContext.defaultParallelism  # what is handed on grows with the tasks, not with the rows
    sums = rows.select("h", "y", "fold", "x").coalesce(tasks).mapInArrow(counted, "forest int, tree int, node int, sums binary")
    return sums.groupBy("forest", "tree", "node").applyInPandas(
        picked, "forest int, tree int, node int, w double, p double, feature int, bin int, lw double, lp double, "
                "lc double, c double")


def grow_tops(rows: DataFrame, specs: list[ForestSpec], sizes: dict[int, int], m: int, features: int,
              local_rows: int) -> dict[tuple[int, int], Top]:
    """The upper parts of the trees whose training rows do not fit a task."""
    tops = {}
    for i, s in enumerate(specs):
        if sum(n for f, n in sizes.items() if f not in s.held) > local_rows:
            tops |= {(i, t): Top(open=[0]) for t in range(s.trees)}
    while any(t.open for t in tops.values()):
        now = {k: (t.tree(), t.open, t.key, t.depth) for k, t in tops.items() if t.open}

        found = []
        for some in passes(now):
            found += small_rows(asked_splits(rows, some, specs, m, features), MOST_BIG_NODES)
        for t in tops.values():
            t.open = []
        for r in sorted(found, key=lambda r: (r["forest"], r["tree"], r["node"])):
            top = tops[r["forest"], r["tree"]]
            top.value[r["node"]] = r["p"] / r["w"]
            if r["feature"] < 0:
                continue
            a = len(top.left)
            top.feature[r["node"]], top.bin[r["node"]], top.left[r["node"]] = r["feature"], r["bin"], a
            keys = child_keys(np.array([top.key[r["node"]]], np.uint64))[0]
            for side, (w, p, c) in enumerate(((r["lw"], r["lp"], r["lc"]), (r["w"] - r["lw"], r["p"] - r["lp"], r["c"] - r["lc"]))):
                top.feature.append(0)
                top.bin.append(BINS - 1)
                top.left.append(a + side)
                top.value.append(p / w)
                top.key.append(int(keys[side]))
                top.depth.append(top.depth[r["node"]] + 1)
                (top.open if c > local_rows else top.small).append(a + side)
    return tops


def finished(rows: DataFrame, specs: list[ForestSpec], tops: dict, m: int, features: int) -> DataFrame:
    """(forest, tree, nodes) of the trees with an upper part: small nodes are
    grown in tasks and hung below it."""
    plain = {k: (t.tree(), t.small, t.key, t.depth) for k, t in tops.items()}

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[bytes]] = {}
        size = 0

        def out() -> pa.RecordBatch:
            keys = [pa.array([k[c] for k in held], pa.int32()) for c in range(3)]
            return pa.RecordBatch.from_arrays([*keys, pa.array([b"".join(v) for v in held.values()], pa.binary())],
                                              names=["forest", "tree", "node", "rows"])

        for batch in batches:
            data = packed(batch, features)
            for (i, t), (tree, small, _, _) in plain.items():
                place = np.zeros(len(tree.left), bool)
                place[small] = True
                leaf = tree.leaves(data["x"])
                hit = np.flatnonzero((specs[i].counts(data, t) > 0) & place[leaf])
                hit = hit[stable_order(leaf[hit])]
                nodes, starts = runs(leaf[hit])
                for node, some in zip(nodes.tolist(), np.split(data[hit], starts[1:])):
                    held.setdefault((i, t, node), []).append(some.tobytes())
                    size += some.nbytes
                if size >= SENT_BYTES:
                    yield out()
                    held, size = {}, 0
        if held:
            yield out()

    def grown(key: tuple, blobs: pd.DataFrame) -> pd.DataFrame:
        i, t, node = (int(v) for v in key)
        data = gathered(blobs["rows"], features)
        _, _, keys, depths = plain[i, t]
        tree = grow(data["x"], data["y"], specs[i].counts(data, t), specs[i], specs[i].tree_seed(t), m, keys[node], depths[node])
        return pd.DataFrame({"forest": [i], "tree": [t], "node": [node], "nodes": [tree.to_bytes()]})

    def hung(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        i, t = (int(v) for v in key)
        top = plain[i, t][0]
        names = ("feature", "bin", "left", "value")
        arrays = [[getattr(top, name).copy()] for name in names]
        size = len(top.left)
        for node, raw in sorted(zip(parts["node"], parts["nodes"])):
            if node < 0:
                continue
            sub = Tree.from_bytes(raw)
            for a, name in zip(arrays, names):
                own = getattr(sub, name)
                own = own + (size - 1) if name == "left" else own  # the subtree's root takes the node's place
                a[0][node] = own[0]
                a.append(own[1:])
            if sub.left[0] == 0:
                arrays[2][0][node] = node
            size += len(sub.left) - 1
        tree = Tree(*(np.concatenate(a) for a in arrays))
        return pd.DataFrame({"forest": [i], "tree": [t], "nodes": [tree.to_bytes()]})

    dealt = rows.select("h", "y", "fold", "x").mapInArrow(sent, "forest int, tree int, node int, rows binary").groupBy(
        "forest", "tree", "node")
    if KE.ready(rows.sparkSession):
        nodes = [(i, t, n, bytearray(kernel_params(specs[i], features, m, t, keys[n] - (keys[n] >> 63 << 64), depths[n])),
                  bytearray(KE.marked(specs[i].held))) for (i, t), (_, small, keys, depths) in plain.items() for n in small]
        params = rows.sparkSession.createDataFrame(nodes, "forest int, tree int, node int, params binary, held binary")
        parts = dealt.agg(F.collect_list("rows").alias("rows")).join(params, ["forest", "tree", "node"]).select(
            "forest", "tree", "node", KE.called("grow", F.col("rows"), F.col("params"), F.col("held")).alias("nodes"))
    else:
        parts = dealt.applyInPandas(grown, "forest int, tree int, node int, nodes binary")
    every = rows.sparkSession.createDataFrame([(i, t, -1, None) for i, t in tops], parts.schema)
    return parts.unionByName(every).groupBy("forest", "tree").applyInPandas(hung, "forest int, tree int, nodes binary")


# -- forests ---------------------------------------------------------------


def fold_sizes(rows: DataFrame) -> dict[int, int]:
    return {r["fold"]: r["n"] for r in small_rows(rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n")), 1000)}


def kernel_params(spec: ForestSpec, features: int, m: int, *rest: int) -> bytes:
    return KE.numbers(features, m, min(spec.depth(), 1 << 40), spec.min_split, spec.min_leaf, spec.seed, int(spec.bootstrap),
                      len(DRAWN), *map(float, DRAWN), *rest)


def forest_votes(rows: DataFrame, specs: list[ForestSpec], scored: list[tuple[int, ...]], features: int,
                 per_split: int | None = None) -> DataFrame:
    """(forest, first, votes): sums over a run of trees, from number ``first`` on, of the rows of the forest's
    ``scored`` folds in the blob's order, with their labels; by kernels."""
    m = per_split or max(1, int(features ** 0.5))
    most = -(-sum(s.trees for s in specs) // (RUNS_PER_CORE * rows.sparkSession.sparkContext.defaultParallelism))
    runs = [(i, t, min(t + most, s.trees)) for i, s in enumerate(specs) for t in range(0, s.trees, most)]
    units = [(i, t, bytearray(kernel_params(specs[i], features, m, t, to)), bytearray(KE.marked(specs[i].held) + KE.marked(scored[i])))
             for i, t, to in sorted(runs, key=lambda r: r[1] - r[2])]  # long runs first
    grown = KE.tasks(KE.one_blob(rows, features), units, "forest int, first int, params binary, folds binary")
    return cut_lineage(grown.select("forest", "first", KE.called("votes", F.col("rows"), F.col("params"), F.col("folds")).alias("votes")))


def summed_votes(runs: pd.DataFrame, trees: int) -> tuple[np.ndarray, np.ndarray]:
    """(labels, probabilities) of a forest's scored rows."""
    total = 0.0
    for raw in runs.sort_values("first")["votes"]:
        n = len(raw) // 9
        total, y = total + np.frombuffer(raw, np.float64, n), np.frombuffer(raw, np.uint8, n, 8 * n)
    return y, total / trees


def forest_ratings(rows: DataFrame, specs: list[ForestSpec], scored: list[tuple[int, ...]], features: int,
                   per_split: int | None = None) -> DataFrame:
    """(forest, y, probability) of forests trained on ``binned_rows``, for the rows of the folds ``scored[forest]``."""
    if not by_kernels(rows):
        trees = train_forests(rows, specs, features, per_split)
        return forest_scores(rows, trees, specs, features, dict(enumerate(scored))).select("forest", "y", "probability")
    trees = [s.trees for s in specs]

    def rated(key: tuple, runs: pd.DataFrame) -> pd.DataFrame:
        y, p = summed_votes(runs, trees[int(key[0])])
        return pd.DataFrame({"forest": np.int32(key[0]), "y": y.astype(np.int32), "probability": p})

    return forest_votes(rows, specs, scored, features, per_split).groupBy("forest").applyInPandas(
        rated, "forest int, y int, probability double")


def by_kernels(rows: DataFrame) -> bool:
    """Whether whole trees grow and score in a task, by kernels."""
    return KE.ready(rows.sparkSession) and sum(fold_sizes(rows).values()) <= KE.KERNEL_ROWS


def train_forests(rows: DataFrame, specs: list[ForestSpec], features: int, per_split: int | None = None,
                  local_rows: int | None = None, sets: int = 48) -> DataFrame:
    """(forest, tree, nodes): all trees of all forests on ``binned_rows``. A
    split looks at ``per_split`` features (the root of their number)."""
    m = per_split or max(1, int(features ** 0.5))
    sizes = fold_sizes(rows)
    kernels = KE.ready(rows.sparkSession)
    if kernels and sum(sizes.values()) <= (local_rows or KE.KERNEL_ROWS):
        units = [(i, t, bytearray(kernel_params(s, features, m, t, 1, 0)), bytearray(KE.marked(s.held)))
                 for i, s in enumerate(specs) for t in range(s.trees)]
        grown = KE.tasks(KE.one_blob(rows, features), units, "forest int, tree int, params binary, held binary")
        return cut_lineage(grown.select("forest", "tree", KE.called("grow", F.col("rows"), F.col("params"), F.col("held")).alias("nodes")))
    local_rows = local_rows or (SUBTREE_ROWS if kernels else LOCAL_ROWS)
    tops = grow_tops(rows, specs, sizes, m, features, local_rows)
    whole = [(i, t) for i, s in enumerate(specs) for t in range(s.trees) if (i, t) not in tops]
    schema = "forest int, tree int, nodes binary"
    out = finished(rows, specs, tops, m, features) if tops else None
    if whole:
        sets = min(sets, len(whole))
        names = group_names(rows.sparkSession, sets)
        share = {g: whole[i::sets] for i, g in enumerate(names)}

        def grown(key: tuple, blobs: pd.DataFrame) -> pd.DataFrame:
            data = gathered(blobs["rows"], features)
            trees = []
            for i, t in share[int(key[0])]:
                tree = grow(data["x"], data["y"], specs[i].counts(data, t), specs[i], specs[i].tree_seed(t), m)
                trees.append({"forest": i, "tree": t, "nodes": tree.to_bytes()})
            return pd.DataFrame(trees)

        # Each task's rows are one group: dealt out evenly, and no larger than local_rows.
        dealt = dealt_to_groups(rows, names, features).repartition(sets, "g")
        small = dealt.groupBy("g").applyInPandas(grown, schema)
        out = small if out is None else out.unionByName(small)
    return cut_lineage(out)


def chunks(trees: DataFrame) -> Iterator[list[tuple[int, bytes]]]:
    """(forest, nodes) of all trees, about ``CHUNK_BYTES`` at a time."""
    held, size = [], 0
    for r in trees.select("forest", "nodes").toLocalIterator():
        held.append((r["forest"], bytes(r["nodes"])))
        size += len(r["nodes"])
        if size >= CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def summed_trees(rows: DataFrame, trees: DataFrame, features: int,
                 folds: dict[int, tuple[int, ...]] | None = None) -> DataFrame:
    """(id, y, forest, total): the sum of a forest's leaf values, for the rows
    of the folds ``folds[forest]`` (None: all rows)."""
    spark = rows.sparkSession
    id_type = rows.schema["id"].dataType.simpleString()
    parts = None
    for chunk in chunks(trees):
        sent = spark.sparkContext.broadcast(chunk)

        def scored(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            held = [(i, Tree.from_bytes(raw)) for i, raw in sent.value]
            for batch in batches:
                data = packed(batch, features)
                sums: dict[int, np.ndarray] = {}
                where = {}
                for i, tree in held:
                    if i not in sums:
                        at = np.arange(len(data)) if folds is None else np.flatnonzero(np.isin(data["fold"], folds[i]))
                        where[i], sums[i] = (at, data["x"][at]), np.zeros(len(at))
                    sums[i] += tree.predict(where[i][1])
                for i, total in sums.items():
                    at = pa.array(where[i][0])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(at), batch.column(2).take(at), pa.array(np.full(len(total), i, np.int32)),
                         pa.array(total)], names=["id", "y", "forest", "total"])

        part = rows.select("id", "h", "y", "fold", "x").mapInArrow(scored, f"id {id_type}, y int, forest int, total double")
        part = cut_lineage(part)  # the chunk is not needed again, whatever executors are lost
        sent.destroy()
        parts = part if parts is None else parts.unionByName(part)
    return parts.groupBy("id", "y", "forest").agg(F.sum("total").alias("total"))


def forest_scores(rows: DataFrame, trees: DataFrame, specs: list[ForestSpec], features: int,
                  folds: dict[int, tuple[int, ...]] | None = None) -> DataFrame:
    """(id, y, forest, probability): the mean share of label 1 over a forest's trees."""
    count = F.element_at(F.create_map(*[v for i, s in enumerate(specs) for v in (F.lit(i), F.lit(float(s.trees)))]), F.col("forest"))
    return summed_trees(rows, trees, features, folds).select("id", "y", "forest", (F.col("total") / count).alias("probability"))


# -- searches --------------------------------------------------------------


def search_forests(rows: DataFrame, draws: list[dict], parts: list[tuple[tuple[int, ...], tuple[int, ...]]], features: int,
                   seed: int = 42) -> dict[tuple[int, int], float]:
    """AUC of every (draw, part): a draw's forest is trained on the rows outside
    the part's first folds and scored on those of its second. One training and
    one scoring for all of them."""
    pairs = [(d, p) for d in range(len(draws)) for p in range(len(parts))]
    specs = [ForestSpec(held=parts[p][0], seed=seed, **draws[d]) for d, p in pairs]
    if by_kernels(rows):
        trees = [s.trees for s in specs]

        def judged(key: tuple, runs: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"forest": np.int32(key[0]), "roc_auc": [area(*summed_votes(runs, trees[int(key[0])]))]})

        votes = forest_votes(rows, specs, [parts[p][1] for _, p in pairs], features)
        found = votes.groupBy("forest").applyInPandas(judged, "forest int, roc_auc double")
        return {pairs[r["forest"]]: r["roc_auc"] for r in small_rows(found, len(pairs))}
    trees = train_forests(rows, specs, features)
    scores = forest_scores(rows, trees, specs, features, {i: parts[p][1] for i, (_, p) in enumerate(pairs)})
    found = small_rows(roc_auc(scores, ["forest"], label="y"), len(pairs))
    return {pairs[r["forest"]]: r["roc_auc"] for r in found}
