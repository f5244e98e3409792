"""Second-order boosted trees on histograms, many fits at once.

Every round fits a tree to the gradients and hessians of the log loss: a node's
split maximises the gain in ``G^2 / (H + l2)`` (with soft threshold ``l1`` on G) over
the histogram of its rows, level by level to ``max_depth`` or, with
``max_leaves``, best leaf first. Rows and columns are sampled per tree by hash.

* Up to ``local_rows`` rows, a fit advances inside a task: one job moves all
  live fits (draws x folds) on by a number of rounds from their written state,
  margins and losses per round, and writes the new state. A lost executor costs the
  rounds of that job; the driver prunes and stops between jobs.
* Above it, each level is one aggregate: tasks count (node, feature, bin), Spark
  sums and picks each node's split, and the margins are written every ``KEEP`` rounds.
  Best leaf first, a pass asks about all leaves that may come next, so it takes about
  as many passes as the tree is deep. Rows lie in packed blocks with their margins.

Gradients are whole numbers of 2^-30, so sums are exact and a seed gives the same
trees either way, whatever the partitions.
"""

from __future__ import annotations

import heapq
import math
import struct
import time
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.operators import kernels as KE
from matchlake.operators.binned import BINS, LOCAL_ROWS, Tree, area, dealt_to_groups, gathered, group_names, mixed, packed, record, uniform
from matchlake.operators.curves import roc_auc
from matchlake.operators.forest import summed_trees
from matchlake.operators.small import one_row, small_rows
from matchlake.session import cut_lineage

UNIT = 2.0 ** 30
LEAST_GAIN = 1e-6
KEEP = 10
MOST_NODES = 100_000
PART_BLOCKS = 64  # blocks of rows a task reads


@dataclass(frozen=True)
class BoostSpec:
    """One boosted model. ``held`` folds are validation rows; with ``patience``,
    it stops once their loss has not fallen for so many rounds."""

    rounds: int = 100
    step: float = 0.1
    max_depth: int | None = None
    max_leaves: int | None = 31
    l1: float = 0.0
    l2: float = 0.0
    min_child_weight: float = 1e-3
    min_rows: int = 20
    subsample: float = 1.0
    column_share: float = 1.0
    held: tuple[int, ...] = ()
    patience: int = 0
    seed: int = 42

    def round_seed(self, number: int) -> int:
        return int(mixed(np.array([self.seed * 1_000_003 + number]))[0] >> np.uint64(1))

    def columns(self, number: int, features: int) -> np.ndarray:
        n = max(1, int(self.column_share * features))
        order = mixed(np.arange(features, dtype=np.uint64) ^ np.uint64(self.round_seed(number)))
        return np.sort(np.argsort(order, kind="stable")[:n])

    def trained(self, rows: np.ndarray, number: int) -> np.ndarray:
        """Which rows the tree of a round is fitted on."""
        use = ~np.isin(rows["fold"], self.held)
        return use & self.drawn(rows["h"], number) if self.subsample < 1 else use

    def drawn(self, h: np.ndarray, number: int) -> np.ndarray:
        """Which training rows, by their hashes, a round draws."""
        return uniform(h, self.round_seed(number) ^ 1) < self.subsample

    def leaf_value(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return -np.sign(g) * np.maximum(np.abs(g) - self.l1, 0) / np.maximum(h + self.l2, 1e-16)

    def merit(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        t = np.abs(g)
        t -= self.l1
        np.maximum(t, 0, out=t)
        t *= t
        weight = h + self.l2
        t /= np.maximum(weight, 1e-16, out=weight)
        return t


#: 1/12!, 1/11!, .., 1/2!, 1, 1
SERIES = (2.08767569878681e-09, 2.505210838544172e-08, 2.755731922398589e-07, 2.7557319223985893e-06, 2.48015873015873e-05,
          0.0001984126984126984, 0.001388888888888889, 0.008333333333333333, 0.041666666666666664, 0.16666666666666666, 0.5, 1.0, 1.0)


def plain_exp(z: np.ndarray) -> np.ndarray:
    """exp by plain arithmetic (relative error below 1e-15), which the kernels repeat bit by bit."""
    k = np.rint(z * 1.4426950408889634)
    r = (z - k * 0.693147180369123816490) - k * 1.90821492927058770002e-10
    p = np.full(len(z), SERIES[0])
    for c in SERIES[1:]:
        p *= r
        p += c
    return np.ldexp(p, k.astype(np.int32))


def sigmoid(m: np.ndarray) -> np.ndarray:
    out = plain_exp(-np.clip(m, -500, 500))
    out += 1.0
    return np.divide(1.0, out, out=out)


def whole_gradients(y: np.ndarray, margin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian in whole units."""
    p = sigmoid(margin)
    return np.rint((p - y) * UNIT), np.rint(np.maximum(p * (1 - p), 1e-16) * UNIT)


def log_loss(y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, np.where(y == 1, -margin, margin))


def histogram(x: np.ndarray, g: np.ndarray, h: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """(node, feature, bin, sum): gradient, hessian and rows of ``n`` nodes; ``place`` is each row's node."""
    out = np.empty((n, x.shape[1], BINS, 3))
    base = place * BINS
    for f in range(x.shape[1]):
        key = base + x[:, f]
        for i, v in enumerate((g, h, None)):
            out[:, f, :, i] = np.bincount(key, v, n * BINS).reshape(n, BINS)
    return out


def best_of(hist: np.ndarray, spec: BoostSpec, columns: np.ndarray) -> np.ndarray:
    """Per node: gain, feature, bin, then left and all sums of gradient, hessian, rows."""
    sums = np.moveaxis(hist[:, columns], 3, 0).copy()
    sums[:2] /= UNIT
    return best_splits(sums, spec, columns)


def best_splits(sums: np.ndarray, spec: BoostSpec, columns: np.ndarray) -> np.ndarray:
    """``best_of`` (sum, node, column, bin) with gradients and hessians in units of 1, a
    column at a time. Without numbers of rows, four hessians stand for the least number."""
    kinds, total = len(sums), sums[:, :, 0].sum(2)
    g, h = total[:2, :, None]
    own, least, row = spec.merit(g, h), max(spec.min_rows, 1), np.arange(sums.shape[1])
    out = np.empty((len(row), 9))
    for i, column in enumerate(columns.tolist()):
        left = sums[:, :, i].cumsum(2)
        gl, hl = left[:2]
        hr = h - hl
        gain = spec.merit(gl, hl)
        gain += spec.merit(g - gl, hr)
        gain -= own
        gain[(hl < spec.min_child_weight) | (hr < spec.min_child_weight)] = -np.inf
        if kinds == 3:
            gain[(left[2] < least) | (left[2] > total[2][:, None] - least)] = -np.inf
        at = gain.argmax(1)
        top = gain[row, at]
        new = row if i == 0 else np.flatnonzero(top > out[:, 0])  # of equals, the first column
        out[new, 0], out[new, 1], out[new, 2] = top[new], column, at[new]
        out[new, 3:3 + kinds] = left[:, new, at[new]].T
    out[:, 6:6 + kinds] = total.T
    if kinds == 2:
        out[:, [5, 8]] = 4 * out[:, [4, 7]]
    out[:, [3, 4, 6, 7]] *= UNIT
    return out


# -- growing a tree from a source of split statistics ----------------------


@dataclass
class Growing:
    """A tree as it grows; leaf values in margin units, before the step."""

    feature: list[int] = field(default_factory=lambda: [0])
    bin: list[int] = field(default_factory=lambda: [BINS - 1])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, found: np.ndarray, spec: BoostSpec) -> int:
        a = len(self.left)
        self.feature[node], self.bin[node], self.left[node] = int(found[1]), int(found[2]), a
        for side, (g, h) in enumerate(((found[3], found[4]), (found[6] - found[3], found[7] - found[4]))):
            self.feature.append(0)
            self.bin.append(BINS - 1)
            self.left.append(a + side)
            self.value.append(float(spec.leaf_value(g / UNIT, h / UNIT)))
        return a

    def split_level(self, nodes: np.ndarray, found: np.ndarray, spec: BoostSpec) -> np.ndarray:
        """``split`` of many nodes; the first child of each."""
        first = len(self.left) + 2 * np.arange(len(nodes))
        for node, f, b, a in zip(nodes.tolist(), found[:, 1].astype(int).tolist(), found[:, 2].astype(int).tolist(), first.tolist()):
            self.feature[node], self.bin[node], self.left[node] = f, b, a
        sides = np.stack([found[:, 3:5], found[:, 6:8] - found[:, 3:5]], 1).reshape(-1, 2) / UNIT
        self.feature += [0] * len(sides)
        self.bin += [BINS - 1] * len(sides)
        self.left += (first[:, None] + np.arange(2)).ravel().tolist()
        self.value += spec.leaf_value(sides[:, 0], sides[:, 1]).tolist()
        return first

    def tree(self) -> Tree:
        return Tree(self.feature, self.bin, self.left, self.value)


def wide_sides(found: np.ndarray, spec: BoostSpec) -> list[int]:
    """The sides of a split that are large enough for two children."""
    out = []
    for side, (_, h, c) in enumerate((found[3:6], found[6:9] - found[3:6])):
        if h / UNIT >= 2 * spec.min_child_weight and c >= 2 * max(spec.min_rows, 1):
            out.append(side)
    return out


def wide_children(first: np.ndarray, found: np.ndarray, spec: BoostSpec) -> np.ndarray:
    """``wide_sides`` of many splits, as nodes."""
    h, c = (np.column_stack([found[:, i], found[:, i + 3] - found[:, i]]) for i in (4, 5))
    wide = (h / UNIT >= 2 * spec.min_child_weight) & (c >= 2 * max(spec.min_rows, 1))
    return (first[:, None] + np.arange(2))[wide]


def grow_ahead(source, spec: BoostSpec, columns: np.ndarray) -> Tree:
    """The tree of ``grow``, best leaf first, in few questions. The known splits are
    replayed; all leaves that the replay wants to go below are split in ``guess`` and
    their children asked about at once, until the replay knows all it needs."""
    guess, deepest = Growing(), math.inf if spec.max_depth is None else spec.max_depth
    known, below = dict(enumerate(source.best(guess, [0], columns))), {}
    while True:
        tree, heap, leaves, wanted = Growing(), [], 1, []
        if known:
            tree.value[0] = float(spec.leaf_value(known[0][6] / UNIT, known[0][7] / UNIT))
            heap = [(-known[0][0], 0, 0, 0)] if deepest > 0 else []
        while heap and leaves < spec.max_leaves and -heap[0][0] > LEAST_GAIN:
            _, node, depth, at = heapq.heappop(heap)
            a = tree.split(node, known[at], spec)
            leaves += 1
            sides = wide_sides(known[at], spec)
            if not sides or depth + 1 >= deepest or leaves >= spec.max_leaves:
                continue
            if at not in below:
                wanted.append((at, sides))
                continue
            for side in sides:
                heapq.heappush(heap, (-known[below[at] + side][0], a + side, depth + 1, below[at] + side))
        if not wanted:
            return tree.tree()
        nodes = []
        for at, sides in wanted:
            below[at] = guess.split(at, known[at], spec)
            nodes += [below[at] + side for side in sides]
        known.update(zip(nodes, source.best(guess, nodes, columns)))


def grow(source, spec: BoostSpec, columns: np.ndarray) -> Tree:
    """The tree of a round. ``source.best(tree, nodes, columns)`` gives the best
    split of nodes; nodes too small for two children are not asked about."""
    tree = Growing()
    deepest = math.inf if spec.max_depth is None else spec.max_depth
    found = source.best(tree, [0], columns)
    if len(found):
        tree.value[0] = float(spec.leaf_value(found[0, 6] / UNIT, found[0, 7] / UNIT))
    if spec.max_leaves is None:
        nodes, depth = np.zeros(len(found), int), 0
        while len(nodes) and depth < deepest:
            if depth:
                found = source.best(tree, nodes, columns)
            good = found[:, 0] > LEAST_GAIN
            found = found[good]
            first = tree.split_level(nodes[good], found, spec)
            nodes, depth = wide_children(first, found, spec), depth + 1
            source.moved(tree)
        return tree.tree()
    heap = [(-s[0], 0, 0, s) for s in found[:1]] if deepest > 0 else []
    leaves = 1
    while heap and leaves < spec.max_leaves and -heap[0][0] > LEAST_GAIN:
        _, node, depth, s = heapq.heappop(heap)
        a = tree.split(node, s, spec)
        source.moved(tree)
        leaves += 1
        nodes = [a + side for side in wide_sides(s, spec)]
        if nodes and depth + 1 < deepest and leaves < spec.max_leaves:
            for n, s in zip(nodes, source.best(tree, nodes, columns)):
                heapq.heappush(heap, (-s[0], n, depth + 1, s))
    return tree.tree()


class Columns:
    """The rows of a task, column by column, for all rounds of all its fits."""

    def __init__(self, rows: np.ndarray):
        self.x = np.ascontiguousarray(rows["x"])
        self.by_feature = np.ascontiguousarray(self.x.T)
        self.flat, self.width = self.x.ravel(), self.x.shape[1]
        self.h, self.y = np.ascontiguousarray(rows["h"]), rows["y"].astype(float)


class LocalRows:
    """The rows of a round inside a task, those of its tree first. Of two children
    the one with fewer rows is counted; the other has the rest of their parent's sums,
    which are whole numbers and therefore exact. All rows descend with the tree."""

    def __init__(self, rows: np.ndarray, margin: np.ndarray, spec: BoostSpec, number: int, table: Columns | None = None,
                 train: np.ndarray | None = None):
        self.table, self.spec = table or Columns(rows), spec
        train = np.flatnonzero(~np.isin(rows["fold"], spec.held)) if train is None else train
        self.use = use = train[spec.drawn(self.table.h[train], number)] if spec.subsample < 1 else train
        other = np.ones(len(rows), bool)
        other[use] = False
        self.order = np.concatenate([use, np.flatnonzero(other)])
        self.weights = [v / UNIT for v in whole_gradients(self.table.y[use], margin[use])]
        self.node = np.zeros(len(rows), np.int64)
        self.cell = self.order * self.table.width
        self.known: dict[int, np.ndarray] = {}

    @property
    def used_x(self) -> np.ndarray:
        return self.table.x[self.use]

    def sums(self, rows: np.ndarray | None, place: np.ndarray, n: int, columns: np.ndarray) -> np.ndarray:
        """(sum, node, column, bin): gradient, hessian and number of the ``rows`` (None: all) of ``n`` nodes.
        A row's hessian is at most 1/4, so the least weight of a child may imply the least number of rows;
        then rows are not counted."""
        at, weights = self.use if rows is None else self.use[rows], [w if rows is None else w[rows] for w in self.weights]
        if max(self.spec.min_rows, 1) > 4 * self.spec.min_child_weight:
            weights.append(None)
        out, base = np.empty((len(weights), n, len(columns), BINS)), place * BINS
        for i, f in enumerate(columns):
            key = base + self.table.by_feature[f].take(at)
            for kind, v in enumerate(weights):
                out[kind, :, i] = np.bincount(key, v, n * BINS).reshape(n, BINS)
        return out

    def best(self, tree: Growing, nodes, columns: np.ndarray) -> np.ndarray:
        nodes, left, node = np.asarray(nodes), np.array(tree.left), self.node[:len(self.use)]
        inner = np.flatnonzero(left != np.arange(len(left)))
        parent, other = np.full(len(left), -1), np.arange(len(left))
        for side in (0, 1):
            parent[left[inner] + side], other[left[inner] + side] = inner, left[inner] + 1 - side
        size, twin = np.bincount(node, minlength=len(left)), other[nodes]
        ranked = (size[nodes] > size[twin]) | ((size[nodes] == size[twin]) & (nodes > twin))
        rest = np.flatnonzero(ranked & np.array([p in self.known for p in parent[nodes].tolist()], bool))
        source = nodes.copy()
        source[rest] = twin[rest]
        counted = np.unique(source)
        place = np.full(len(left), -1)
        place[counted] = np.arange(len(counted))
        at = place.take(node)
        rows = None if len(left) == 1 else np.flatnonzero(at >= 0)
        sums = self.sums(rows, at if rows is None else at[rows], len(counted), columns)[:, place[source]]
        if len(rest):
            whole = np.stack([self.known[p] for p in parent[nodes[rest]].tolist()], 1)
            sums[:, rest] = np.subtract(whole, sums[:, rest], out=whole)
        if self.spec.max_leaves is None:
            self.known = {}  # the next level asks about children of this one only
        self.known |= {n: sums[:, i] for i, n in enumerate(nodes.tolist())}
        return best_splits(sums, self.spec, columns)

    def moved(self, tree: Growing) -> None:
        left, feature, cut = np.array(tree.left), np.array(tree.feature), np.array(tree.bin, np.uint8)
        if self.spec.max_leaves is None:  # most rows move
            right = self.table.flat.take(self.cell + feature.take(self.node)) > cut.take(self.node)
            self.node = left.take(self.node) + right
            return
        after = left.take(self.node)
        rows = np.flatnonzero(after != self.node)
        node = self.node[rows]
        self.node[rows] = after[rows] + (self.table.flat.take(self.cell[rows] + feature.take(node)) > cut.take(node))

    def predictions(self, tree: Tree) -> np.ndarray:
        """The value of each row's leaf, once the tree is grown."""
        out = np.empty(len(self.node))
        out[self.order] = tree.value.take(self.node)
        return out


def base_margin(positives: float, rows: float) -> float:
    """Log odds of the training rows' label (0 without both labels)."""
    return math.log(positives / (rows - positives)) if 0 < positives < rows else 0.0


def kept_rounds(losses: list[float]) -> int:
    """Rounds up to the least validation loss (the first, if tied)."""
    return int(np.argmin(losses)) + 1 if len(losses) else 0


def is_over(losses: list[float], spec: BoostSpec) -> bool:
    done = len(losses)
    return bool(spec.patience) and done - kept_rounds(losses) >= spec.patience


# -- many fits inside tasks, by kernels -------------------------------------

FITS = "unit int, round int, over boolean, seconds double, losses array<double>, aucs array<double>"
HEAD = 280  # bytes of a kernel's state before the rounds


def kernel_params(spec: BoostSpec, features: int, base: float, to: int) -> bytes:
    free = 1 << 40
    return KE.numbers(features, spec.rounds, free if spec.max_depth is None else spec.max_depth, spec.max_leaves or 0, spec.min_rows,
                      spec.patience, spec.seed, max(1, int(spec.column_share * features)), float(spec.step), float(spec.l1),
                      float(spec.l2), float(spec.min_child_weight), float(spec.subsample), float(base), to)


class KernelFits:
    """Fits (``specs``) on the same rows that advance inside tasks, a task a fit. What goes from job to
    job is their trees and losses; a task has the margins from the trees. Without
    ``losses``, those of the held rows are not worked out."""

    def __init__(self, rows: DataFrame, specs: list[BoostSpec], features: int, losses: bool = True):
        counts = small_rows(rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("pos")), 1000)
        self.specs, self.features, self.losses = specs, features, losses
        self.base = [base_margin(*(float(sum(r[c] for r in counts if r["fold"] not in s.held)) for c in ("pos", "n"))) for s in specs]
        self.blob, self.state = KE.one_blob(rows, features), None

    def started(self, unit: int) -> bytearray:
        asked = int(bool(self.losses and self.specs[unit].held))
        return bytearray(KE.marked(self.specs[unit].held) + struct.pack("<iiiid", 0, asked, 0, 0, 0.0))

    def advance(self, units: list[int], to: int) -> dict[int, dict]:
        """Moves the ``units`` on to round ``to``; their FITS values by unit."""
        params = [bytearray(kernel_params(self.specs[u], self.features, self.base[u], to)) for u in units]
        if self.state is None:
            rows = KE.tasks(self.blob, [(u, p, self.started(u)) for u, p in zip(units, params)],
                            "unit int, params binary, state binary")
        else:
            rows = KE.tasks(self.blob, list(zip(units, params)), "unit int, params binary").join(self.state, "unit").repartition(
                len(units), "unit")
        moved = KE.called("boost", F.col("rows"), F.col("params"), F.col("state"))
        self.state = cut_lineage(rows.select("unit", moved.alias("state")))
        return {r["unit"]: r.asDict() for r in small_rows(self.state.mapInArrow(fits_of, FITS), len(units))}

    def trees(self) -> DataFrame:
        """(unit, round, nodes) of all fits that advanced last."""
        return self.state.mapInArrow(trees_of, "unit int, round int, nodes binary")


def rounds_of(raw: memoryview) -> tuple[int, int]:
    """The rounds of a state, and where its trees begin."""
    rounds, asked = struct.unpack_from("<ii", raw, 256)
    return rounds, HEAD + 16 * rounds * asked


def fits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for unit, state in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = memoryview(state.as_buffer())
            rounds, trees = rounds_of(raw)
            over, _, seconds = struct.unpack_from("<iid", raw, 264)
            curves = np.frombuffer(raw[HEAD:trees]).reshape(-1, 2)
            out.append({"unit": unit, "round": rounds, "over": bool(over), "seconds": seconds, "losses": curves[:, 0].tolist(),
                        "aucs": curves[:, 1].tolist()})
        yield pa.RecordBatch.from_pylist(out, pa.schema([
            ("unit", pa.int32()), ("round", pa.int32()), ("over", pa.bool_()), ("seconds", pa.float64()),
            ("losses", pa.list_(pa.float64())), ("aucs", pa.list_(pa.float64()))]))


def trees_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for unit, state in zip(batch.column(0).to_pylist(), batch.column(1)):
            raw = memoryview(state.as_buffer())
            rounds, at = rounds_of(raw)
            nodes = []
            for _ in range(rounds):
                size = struct.unpack_from("<i", raw, at)[0]
                nodes.append(bytes(raw[at + 4:at + 4 + size]))
                at += 4 + size
            yield pa.RecordBatch.from_arrays([pa.array([unit] * rounds, pa.int32()), pa.array(range(rounds), pa.int32()),
                                              pa.array(nodes, pa.binary())], names=["unit", "round", "nodes"])


# -- many fits inside tasks, without kernels ---------------------------------

STATE = "unit int, round int, margin binary, losses array<double>, aucs array<double>, over boolean, seconds double"


def advance(rows: DataFrame, state: DataFrame, specs: list[BoostSpec], units: list[int], to: int, features: int,
            groups: int = 64) -> tuple[DataFrame, DataFrame]:
    """Moves the live ``units`` on to round ``to``: (new state, trees of these
    rounds as (unit, round, nodes)), both written."""
    groups = max(1, min(groups, len(units)))
    names = group_names(rows.sparkSession, groups)
    place = {u: names[i % groups] for i, u in enumerate(units)}
    schema = STATE + ", trees array<binary>"

    def moved(key: tuple, blobs: pd.DataFrame, states: pd.DataFrame) -> pd.DataFrame:
        data = gathered(blobs["rows"], features)
        table, out = Columns(data), []
        for s in states.to_dict("records"):
            began, spec = time.time(), specs[s["unit"]]
            train, y = ~np.isin(data["fold"], spec.held), data["y"]
            in_training, held = np.flatnonzero(train), np.flatnonzero(~train)
            if s["margin"] is None:
                margin = np.full(len(data), base_margin(float(y[train].sum()), float(train.sum())))
            else:
                margin = np.frombuffer(s["margin"]).copy()
            losses, aucs, trees, number = list(s["losses"]), list(s["aucs"]), [], int(s["round"])
            while number < min(to, spec.rounds) and not is_over(losses, spec):
                local = LocalRows(data, margin, spec, number, table, in_training)
                tree = grow(local, spec, spec.columns(number, features))
                margin += spec.step * local.predictions(tree)
                trees.append(tree.to_bytes())
                number += 1
                if spec.held:
                    losses.append(float(log_loss(y[held], margin[held]).mean()) if len(held) else 0.0)
                    aucs.append(area(y[held], margin[held]))
            out.append({"unit": s["unit"], "round": number, "margin": margin.tobytes(), "losses": losses, "aucs": aucs,
                        "over": number >= spec.rounds or is_over(losses, spec),
                        "seconds": s["seconds"] + time.time() - began, "trees": trees})
        return pd.DataFrame(out, columns=["unit", "round", "margin", "losses", "aucs", "over", "seconds", "trees"])

    where = F.element_at(F.create_map(*[v for u, g in place.items() for v in (F.lit(u), F.lit(g))]), F.col("unit"))
    live = state.where(F.col("unit").isin(units)).withColumn("g", where)
    dealt = dealt_to_groups(rows, names, features)
    done = cut_lineage(dealt.repartition(groups, "g").groupBy("g").cogroup(live.repartition(groups, "g").groupBy("g"))
                       .applyInPandas(moved, schema))
    first = F.col("round") - F.size("trees")
    trees = done.select("unit", F.posexplode("trees").alias("n", "nodes"), first.alias("first")).select(
        "unit", (F.col("first") + F.col("n")).alias("round"), "nodes")
    return done.drop("trees"), trees


def started(rows: DataFrame, units: list[int]) -> DataFrame:
    return rows.sparkSession.createDataFrame([(u, 0, None, [], [], False, 0.0) for u in units], STATE)


# -- one fit over rows that no task holds ----------------------------------


class SparkRows:
    """The rows of a fit as a Spark table of packed blocks with their margins; each
    question is one aggregate."""

    def __init__(self, rows: DataFrame, spec: BoostSpec, features: int):
        held = F.col("fold").isin(list(spec.held)) if spec.held else F.lit(False)
        n = one_row(rows.agg(F.count_if(~held).alias("n"), F.coalesce(F.sum(F.when(~held, F.col("y"))), F.lit(0)).alias("pos"),
                             F.count(F.lit(1)).alias("all")))
        self.base = base = base_margin(float(n["pos"]), float(n["n"]))

        def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if batch.num_rows:
                    data = packed(batch, features)
                    yield block(data, np.full(len(data), base))

        context = rows.sparkSession.sparkContext
        parts = max(context.defaultParallelism, math.ceil(n["all"] / (10_000 * PART_BLOCKS)))
        self.rows = cut_lineage(rows.select("h", "y", "fold", "x").mapInArrow(blocks, BLOCKS).repartition(parts))
        self.spec, self.features, self.number = spec, features, 0
        self.recent: list[Tree] = []

    def reader(self):
        """A function from batches to (records, margins after all rounds so far) of each block."""
        kind, step, recent = record(self.features), self.spec.step, list(self.recent)

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in batches:
                for raw, old in zip(batch.column(0), batch.column(1)):
                    data, margin = np.frombuffer(raw.as_buffer(), kind), np.frombuffer(old.as_buffer()).copy()
                    for t in recent:
                        margin += step * t.predict(data["x"])
                    yield data, margin

        return read

    def best(self, tree: Growing, nodes: list[int], columns: np.ndarray) -> np.ndarray:
        spec, features, number, read = self.spec, self.features, self.number, self.reader()
        partial = tree.tree()

        def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            place = np.full(len(partial.left), -1)
            place[nodes] = np.arange(len(nodes))
            total = np.zeros((len(nodes), features, BINS, 3), np.int64)
            for data, margin in read(batches):
                at = np.where(spec.trained(data, number), place[partial.leaves(data["x"])], -1)
                hit = np.flatnonzero(at >= 0)
                g, h = whole_gradients(data["y"][hit], margin[hit])
                total += histogram(data["x"][hit], g, h, at[hit], len(nodes)).astype(np.int64)
            full = np.flatnonzero(total[:, 0, :, 2].any(1))
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array([total[i].tobytes() for i in full], pa.binary())],
                                             names=["node", "sums"])

        def picked(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
            hist = sum(np.frombuffer(raw, np.int64) for raw in cells["sums"]).reshape(1, features, BINS, 3).astype(float)
            return pd.DataFrame([[int(key[0]), best_of(hist, spec, columns)[0].tolist()]], columns=["node", "found"])

        sums = self.rows.mapInArrow(counted, "node int, sums binary")
        found = small_rows(sums.groupBy("node").applyInPandas(picked, "node int, found array<double>"), MOST_NODES)
        out = np.full((len(nodes), 9), -np.inf)
        for r in found:
            out[r["node"]] = r["found"]
        return out if found else out[:0]

    def moved(self, tree: Growing) -> None:
        """The next question descends the tree as it is then."""

    def finish(self, tree: Tree) -> None:
        self.recent.append(tree)
        self.number += 1
        if len(self.recent) >= KEEP:
            read = self.reader()

            def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                for data, margin in read(batches):
                    yield block(data, margin)

            self.rows, self.recent = cut_lineage(self.rows.mapInArrow(added, BLOCKS)), []

    def validation_loss(self) -> float:
        held, read = self.spec.held, self.reader()

        def lost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for data, margin in read(batches):
                at = np.isin(data["fold"], held)
                loss = log_loss(data["y"][at], margin[at]).sum()
                yield pa.RecordBatch.from_arrays([pa.array([float(loss)]), pa.array([int(at.sum())])], names=["loss", "n"])

        row = one_row(self.rows.mapInArrow(lost, "loss double, n long").agg(F.sum("loss").alias("loss"), F.sum("n").alias("n")))
        return row["loss"] / row["n"] if row["n"] else 0.0


BLOCKS = "data binary, margin binary"


def block(data: np.ndarray, margin: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([data.tobytes()], pa.binary()), pa.array([margin.tobytes()], pa.binary())],
                                      names=["data", "margin"])


def fit_over_table(rows: DataFrame, spec: BoostSpec, features: int) -> tuple[DataFrame, list[float]]:
    """(trees, validation losses) of one fit, level by level over all rows."""
    source, trees, losses = SparkRows(rows, spec, features), [], []
    while source.number < spec.rounds and not is_over(losses, spec):
        one_tree = grow if spec.max_leaves is None else grow_ahead
        tree = one_tree(source, spec, spec.columns(source.number, features))
        trees.append((0, source.number, bytearray(tree.to_bytes())))
        source.finish(tree)
        if spec.held:
            losses.append(source.validation_loss())
    return rows.sparkSession.createDataFrame(trees, "unit int, round int, nodes binary"), losses


# -- models ----------------------------------------------------------------


@dataclass
class Boosted:
    """A fitted model: its trees as a written table, margins before the step."""

    trees: DataFrame
    base: float
    spec: BoostSpec
    losses: list[float]
    features: int

    @property
    def rounds(self) -> int:
        return kept_rounds(self.losses) if self.spec.patience else self.spec.rounds

    def scores(self, rows: DataFrame) -> DataFrame:
        """(id, y, probability) of ``binned_rows`` (same edges)."""
        kept = self.trees.where(F.col("round") < self.rounds).orderBy("round").select(F.lit(0).alias("forest"), "nodes")
        margin = F.lit(self.base) + F.lit(self.spec.step) * F.col("total")
        return summed_trees(rows, kept, self.features).select(
            "id", "y", (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))).alias("probability"))


def fit_boosting(rows: DataFrame, spec: BoostSpec, features: int, local_rows: int | None = None) -> Boosted:
    """One model on ``binned_rows``; with ``patience``, it keeps the rounds up to
    the least loss of the ``held`` folds."""
    held = F.col("fold").isin(list(spec.held)) if spec.held else F.lit(False)
    n = one_row(rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(~held).alias("train"),
                         F.coalesce(F.sum(F.when(~held, F.col("y"))), F.lit(0)).alias("pos")))
    base = base_margin(float(n["pos"]), float(n["train"]))
    kernels = KE.ready(rows.sparkSession)
    if n["n"] > (local_rows or (KE.KERNEL_ROWS if kernels else LOCAL_ROWS)):
        trees, losses = fit_over_table(rows, spec, features)
        return Boosted(cut_lineage(trees), base, spec, losses, features)
    if kernels:
        fits = KernelFits(rows, [spec], features)
        losses = fits.advance([0], spec.rounds)[0]["losses"]
        return Boosted(fits.trees(), base, spec, losses, features)
    state, trees = advance(rows, started(rows, [0]), [spec], [0], spec.rounds, features)
    return Boosted(trees, base, spec, list(one_row(state.select("losses"))["losses"]), features)


# -- trial search ----------------------------------------------------------


def trial_search(rows: DataFrame, draws: list[BoostSpec], folds: list[int], features: int, wave: int = 10,
                 startup: int = 5, warmup: int = 5, stops: tuple[int, ...] = (10, 50, 100, 150, 200, 250)) -> list[dict]:
    """Every draw's model on every fold, in waves of ``wave`` draws that
    advance together. Between jobs, a draw is pruned at the first round from
    ``warmup`` on at which its best mean AUC so far lies below the median of the
    mean AUC that the draws finished in earlier waves had at that round (once
    ``startup`` have finished). Folds stop by their spec's patience. The ledger
    does not depend on timing, but for ``seconds``."""
    specs = [BoostSpec(**{**d.__dict__, "held": (f,)}) for d in draws for f in folds]
    curves: dict[int, list[float]] = {}  # mean AUC by round of finished draws
    ledger = []
    together = KernelFits(rows, specs, features) if KE.ready(rows.sparkSession) else None
    for begin in range(0, len(draws), wave):
        alive = list(range(begin, min(begin + wave, len(draws))))
        if together:
            together.state = None
        else:
            state = started(rows, [t * len(folds) + i for t in alive for i in range(len(folds))])
        known: dict[int, dict] = {}
        pruned: dict[int, int] = {}
        bars = {r: float(np.median([c[min(r, len(c)) - 1] for c in curves.values()]))
                for r in range(warmup, max(d.rounds for d in draws) + 1)} if len(curves) >= startup else {}
        # Without bars nothing is pruned between jobs: one job runs the whole wave.
        for to in (*(stops if bars else ()), max(d.rounds for d in draws)):
            units = [u for t in alive for u in range(t * len(folds), (t + 1) * len(folds))
                     if not known.get(u, {"over": False})["over"]]
            if not units:
                break
            if together:
                known |= together.advance(units, to)
            else:
                state, _ = advance(rows, state, specs, units, to, features)
                known |= {r["unit"]: r.asDict() for r in small_rows(state.drop("margin"), len(units))}
            for t in list(alive):
                curve = mean_curve([known[t * len(folds) + i]["aucs"] for i in range(len(folds))])
                best = np.maximum.accumulate(curve)
                low = [r for r, bar in bars.items() if r <= min(to, len(best)) and best[r - 1] < bar]
                if low:
                    pruned[t] = low[0]
                    alive.remove(t)
        for t in range(begin, min(begin + wave, len(draws))):
            fits = [known[t * len(folds) + i] for i in range(len(folds))]
            curve = mean_curve([f["aucs"] for f in fits])
            if t in pruned:
                row = {"status": "PRUNED", "score": float(curve[pruned[t] - 1]), "rounds": pruned[t], "stopped": pruned[t]}
            else:
                curves[t] = curve
                kept = [kept_rounds(f["losses"]) for f in fits]
                row = {"status": "COMPLETE", "score": float(np.mean([f["aucs"][k - 1] for f, k in zip(fits, kept)])),
                       "rounds": round(float(np.mean(kept))), "stopped": max(f["round"] for f in fits)}
            ledger.append({"trial": t, "seconds": sum(f["seconds"] for f in fits)} | row)
    return ledger


def mean_curve(aucs: list[list[float]]) -> list[float]:
    """Mean AUC by round; a fold that has stopped counts with its last."""
    longest = max(map(len, aucs))
    return [float(np.mean([a[min(r, len(a)) - 1] for a in aucs])) for r in range(1, longest + 1)]


def holdout_auc(scores: DataFrame) -> float:
    return one_row(roc_auc(scores, label="y"))["roc_auc"]
