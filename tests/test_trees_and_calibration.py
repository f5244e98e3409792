"""Histogram trees, k-NN, calibrators and the searches on them, against plain loops."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from matchlake.functions.features import MODEL_FEATURES, model_features
from matchlake.operators import binned as BI
from matchlake.operators import boosting as BO
from matchlake.operators import calibration as CA
from matchlake.operators import clustering as CL
from matchlake.operators import forest as FO
from matchlake.operators import kmeans as KM
from matchlake.operators import knn
from matchlake.operators import levelled as LF
from matchlake.operators import models as MO
from matchlake.operators import sampling as SA
from matchlake.sources.adapter import modelling_table

Q = queries()


@pytest.fixture(scope="module")
def rows(spark, sf):
    m = model_features(modelling_table(spark, sf), ["application_id", "is_good_match"]).withColumnRenamed("is_good_match", "label")
    return BI.binned_rows(SA.kfold(m, "application_id", 5, 42, "label"), "application_id", "label", MODEL_FEATURES, "fold")


def trees_of(df, *keys):
    return {tuple(r[k] for k in keys): bytes(r["nodes"]) for r in df.collect()}


def test_bins_keep_order(spark):
    df = spark.createDataFrame([(i, float(i % 700) if i % 50 else None, 0) for i in range(2000)], "k long, v double, y int")
    got = BI.binned_rows(df, "k", "y", ["v"]).join(df, F.col("id") == F.col("k")).collect()
    known = sorted((r["v"], bytes(r["x"])[0]) for r in got if r["v"] is not None)
    assert [b for _, b in known] == sorted(b for _, b in known) and known[-1][1] - known[0][1] > 200
    assert {bytes(r["x"])[0] for r in got if r["v"] is None} == {255}


def plain_tree(x, y, w, spec, depth=0):
    """Leaf probability of every row, by exhaustive search over all features (no feature sampling)."""
    out = np.full(len(y), (w * y).sum() / w.sum())
    rows = w > 0
    if depth >= spec.depth() or rows.sum() < spec.min_split or out[0] in (0, 1):
        return out
    best = None
    for f in range(x.shape[1]):
        for b in np.unique(x[rows, f])[:-1]:
            left = x[:, f] <= b
            if min((rows & left).sum(), (rows & ~left).sum()) < spec.min_leaf:
                continue
            score = FO.purity((w * left).sum(), (w * y * left).sum(), w.sum(), (w * y).sum())
            if best is None or score > best[0]:
                best = (score, f, b)
    if best is None:
        return out
    left = x[:, best[1]] <= best[2]
    out[left] = plain_tree(x[left], y[left], w[left], spec, depth + 1)
    out[~left] = plain_tree(x[~left], y[~left], w[~left], spec, depth + 1)
    return out


def test_tree_equals_exhaustive_search():
    rng = np.random.default_rng(3)
    for trial in range(12):
        x = rng.integers(0, 12, (150, 3)).astype(np.uint8)
        y = (x[:, 0] + rng.integers(0, 8, 150) > 9).astype(np.int64)
        w = rng.poisson(1.0, 150)
        spec = FO.ForestSpec(max_depth=[None, 3][trial % 2], min_split=2 + trial, min_leaf=1 + trial % 3)
        got = FO.grow(x, y, w, spec, 1, 3).predict(x)
        assert np.allclose(got[w > 0], plain_tree(x, y, w, spec)[w > 0])


@pytest.mark.parametrize("local_rows", [60, 400])
def test_forests_do_not_depend_on_where_they_grow(rows, local_rows):
    specs = [FO.ForestSpec(trees=3, held=(0,)), FO.ForestSpec(trees=2, max_depth=4, min_split=9, min_leaf=4, held=(1, 2)),
             FO.ForestSpec(trees=1, bootstrap=False)]
    whole = trees_of(FO.train_forests(rows, specs, 7, local_rows=1 << 20), "forest", "tree")
    split = trees_of(FO.train_forests(rows.repartition(3), specs, 7, local_rows=local_rows), "forest", "tree")
    x = np.stack([np.frombuffer(bytes(r["x"]), np.uint8) for r in rows.select("x").collect()])
    assert whole.keys() == split.keys() and len(whole) == 6
    for k in whole:
        a, b = BI.Tree.from_bytes(whole[k]), BI.Tree.from_bytes(split[k])
        assert len(a.left) == len(b.left) and np.array_equal(a.predict(x), b.predict(x))


def test_forest_scores_are_mean_leaf_shares(rows):
    specs = [FO.ForestSpec(trees=4, max_depth=5, held=(3,))]
    trees = FO.train_forests(rows, specs, 7)
    got = {r["id"]: r["probability"] for r in FO.forest_scores(rows, trees, specs, 7, {0: (3,)}).collect()}
    held = rows.where("fold = 3").collect()
    x = np.stack([np.frombuffer(bytes(r["x"]), np.uint8) for r in held])
    want = np.mean([BI.Tree.from_bytes(t).predict(x) for t in trees_of(trees, "tree").values()], axis=0)
    assert len(got) == len(held)
    for r, p in zip(held, want):
        assert got[r["id"]] == pytest.approx(p, abs=1e-12)


def test_poisson_bootstrap():
    data = np.zeros(200_000, BI.record(1))
    data["h"] = BI.mixed(np.arange(len(data)))
    n = FO.ForestSpec().counts(data, 0)
    assert abs(n.mean() - 1) < 0.01 and abs(n.var() - 1) < 0.02
    assert (n != FO.ForestSpec().counts(data, 1)).mean() > 0.4


DEEP = BO.BoostSpec(rounds=22, max_depth=2, max_leaves=None, step=0.3, l1=0.1, l2=1.0, min_child_weight=1, min_rows=1, subsample=0.8,
                    column_share=0.7, held=(0,))


@pytest.mark.parametrize("spec", [BO.BoostSpec(rounds=3, max_leaves=6, held=(0,)), DEEP])
def test_boosting_does_not_depend_on_where_it_runs(rows, spec):
    local = BO.fit_boosting(rows, spec, 7)
    table = BO.fit_boosting(rows.repartition(3), spec, 7, local_rows=10)
    assert trees_of(local.trees, "round") == trees_of(table.trees, "round")
    assert local.losses == pytest.approx(table.losses, abs=1e-9)


def test_tree_order_is_by_node_and_bin():
    rng = np.random.default_rng(9)
    for nodes in (1, 300, 200_000):
        node, bins = rng.integers(0, nodes, 5000), rng.integers(0, 256, 5000).astype(np.uint8)
        assert np.array_equal(FO.stable_order(node, bins), np.argsort(node * 256 + bins, kind="stable"))
        assert np.array_equal(FO.stable_order(node), np.argsort(node, kind="stable"))
        for got, want in zip(FO.runs(np.sort(node)), np.unique(np.sort(node), return_index=True)):
            assert np.array_equal(got, want)
    assert not len(FO.stable_order(node[:0], bins[:0]))


@pytest.mark.parametrize("limit", [{}, {"max_depth": 4}, {"max_leaves": 2}, {"min_rows": 300}])
def test_best_leaf_first_needs_few_passes(limit):
    rng = np.random.default_rng(8)
    rows = np.zeros(4000, BO.record(5))
    rows["x"], rows["h"] = rng.integers(0, 256, (4000, 5)), rng.integers(0, 2 ** 62, 4000)
    rows["y"] = rng.random(4000) < 1 / (1 + np.exp(-(rows["x"][:, 0] / 40.0 - 3) * (rows["x"][:, 1] / 64.0 - 2)))
    spec, asked = BO.BoostSpec(**limit), []

    class Counted(BO.LocalRows):
        def best(self, tree, nodes, columns):
            asked.append(nodes)
            self.node = tree.tree().leaves(self.used_x)
            return super().best(tree, nodes, columns)

    columns = np.arange(5)
    plain = BO.grow(BO.LocalRows(rows, np.zeros(4000), spec, 0), spec, columns)
    ahead = BO.grow_ahead(Counted(rows, np.zeros(4000), spec, 0), spec, columns)
    assert plain.to_bytes() == ahead.to_bytes() and len(asked) <= 12
    pure = rows.copy()
    pure["y"] = 1
    assert len(BO.grow_ahead(Counted(pure, np.full(4000, 30.0), spec, 0), spec, columns).left) == 1


@pytest.mark.parametrize("limit", [{"max_depth": 7, "max_leaves": None, "min_rows": 1, "min_child_weight": 2, "subsample": 0.7},
                                   {"max_depth": 5, "max_leaves": None, "min_rows": 40, "column_share": 0.5}, {}])
def test_rounds_count_the_smaller_children_only(limit):
    rng = np.random.default_rng(3)
    rows = np.zeros(3000, BO.record(4))
    rows["x"], rows["h"], rows["fold"] = rng.integers(0, 90, (3000, 4)), rng.integers(0, 2 ** 62, 3000), rng.integers(0, 3, 3000)
    rows["y"] = rng.random(3000) < 1 / (1 + np.exp(-(rows["x"][:, 0] / 20.0 - 2) * (rows["x"][:, 1] / 30.0 - 1)))
    spec, margin, counted = BO.BoostSpec(held=(1,), l1=0.05, l2=0.5, **limit), rng.standard_normal(3000), []
    use = np.flatnonzero(spec.trained(rows, 4))
    g, h = BO.whole_gradients(rows["y"], margin)

    class Plain:
        """Every node's own sums, over all rows."""

        def best(self, tree, nodes, columns):
            at = tree.tree().leaves(rows["x"][use])
            place = np.full(len(tree.left), -1)
            place[nodes] = np.arange(len(nodes))
            hit = use[place[at] >= 0]
            found = BO.best_of(BO.histogram(rows["x"][hit], g[hit], h[hit], place[at][place[at] >= 0], len(nodes)), spec, columns)
            return found

        def moved(self, tree):
            pass

    class Counted(BO.LocalRows):
        def sums(self, some, place, n, columns):
            counted.append(len(place))
            return super().sums(some, place, n, columns)

    columns = spec.columns(4, 4)
    local = Counted(rows, margin, spec, 4)
    tree = BO.grow(local, spec, columns)
    assert tree.to_bytes() == BO.grow(Plain(), spec, columns).to_bytes() and len(tree.left) > 20
    assert np.array_equal(local.predictions(tree), tree.predict(rows["x"]))
    assert counted[0] == len(use) and all(n <= len(use) / 2 for n in counted[1:])


def test_boosting_resumes_where_it_stopped(rows):
    straight, all_trees = BO.advance(rows, BO.started(rows, [0]), [DEEP], [0], 9, 7)
    half, first = BO.advance(rows, BO.started(rows, [0]), [DEEP], [0], 4, 7)
    rest, second = BO.advance(rows, half, [DEEP], [0], 9, 7)
    assert trees_of(first.unionByName(second), "round") == trees_of(all_trees, "round")
    assert rest.first()["losses"] == straight.first()["losses"]


def test_first_split_has_the_largest_gain():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 20, (300, 2)).astype(np.uint8)
    y = (x[:, 1] > 8).astype(float)
    spec = BO.BoostSpec(max_depth=1, max_leaves=None, l1=0.5, l2=2.0, min_rows=5)
    g, h = BO.whole_gradients(y, np.zeros(300))
    found = BO.best_of(BO.histogram(x, g, h, np.zeros(300, int), 1), spec, np.arange(2))[0]

    def merit(rows):
        t = max(abs(g[rows].sum() / BO.UNIT) - 0.5, 0)
        return t * t / (h[rows].sum() / BO.UNIT + 2)

    best = max((merit(x[:, f] <= b) + merit(x[:, f] > b) - merit(np.ones(300, bool)), -f, -b)
               for f in range(2) for b in range(20) if 5 <= (x[:, f] <= b).sum() <= 295)
    assert (found[0], -found[1], -found[2]) == pytest.approx(best)


def test_small_steps_keep_all_rounds_that_lower_the_loss(rows):
    slow = BO.fit_boosting(rows, BO.BoostSpec(rounds=60, step=0.003, max_depth=4, max_leaves=None, held=(0,), patience=20), 7)
    assert slow.rounds == 60 and slow.losses == sorted(slow.losses, reverse=True)
    fast = BO.fit_boosting(rows, BO.BoostSpec(rounds=300, step=0.5, max_depth=6, max_leaves=None, held=(0,), patience=20), 7)
    assert fast.rounds + 20 == len(fast.losses) < 300
    assert min(fast.losses) == fast.losses[fast.rounds - 1]


def test_ledger_is_the_same_twice_and_prunes(rows):
    draws = [BO.BoostSpec(rounds=12, step=0.3 if t % 2 else 0.001, max_depth=1 + t % 4, max_leaves=None, patience=20, seed=t)
             for t in range(9)]
    runs = [BO.trial_search(rows, draws, [0, 1], 7, wave=3, startup=3, stops=(6,)) for _ in range(2)]
    assert [{k: v for k, v in r.items() if k != "seconds"} for r in runs[0]] == [
        {k: v for k, v in r.items() if k != "seconds"} for r in runs[1]]
    assert {r["status"] for r in runs[0]} == {"COMPLETE", "PRUNED"}
    assert all(r["rounds"] == 12 for r in runs[0] if r["status"] == "COMPLETE")


def test_searches_have_the_full_sizes(spark, sf):
    found = [json.loads(r["params"]) for r in Q["t02_random_search"](spark, sf).collect()]
    assert len(found) == 15 and {p["trees"] for p in found} == {50, 100, 200, 300} and None in {p["max_depth"] for p in found}
    nested = Q["t03_nested_cv"](spark, sf).collect()
    assert len(nested) == 5 and all(r["roc_auc"] > 0.8 for r in nested)
    cv = Q["t01_cv_fold_metrics"](spark, sf).groupBy("model", "k").count().collect()
    assert {(r["model"], r["k"], r["count"]) for r in cv} == {
        (m, k, k) for m in ("logistic", "random_forest", "linear_svc", "boosting") for k in (5, 10)}


# -- k-NN ------------------------------------------------------------------


def nearest(q, stored, k):
    hits = []
    for i, x in stored:
        d2 = 0.0
        for a, b in zip(q, x):
            d2 += (a - b) * (a - b)
        hits.append((d2, i))
    return sorted(hits)[:k]


@pytest.mark.parametrize("crowd", [0.0, 0.5])
def test_knn_join_equals_brute_force(spark, monkeypatch, crowd):
    monkeypatch.setattr(knn, "BLOCK", 16)
    monkeypatch.setattr(knn, "PACK", 8)
    monkeypatch.setattr(knn, "GROUP", 2)
    rng = random.Random(int(crowd * 10))
    point = lambda: (1.0, 2.0, 3.0) if rng.random() < crowd else tuple(
        float(rng.randint(-3, 3)) + rng.choice([0, 0, 5.5]) for _ in range(3))
    stored = [(rng.randint(0, 10 ** 9), *point()) for _ in range(600)]
    asked = [(i, *point()) for i in range(90)]
    odd = [(None, 1.0, 2.0, 3.0), (7, None, 1.0, 1.0), (8, math.nan, 0.0, 0.0), (9, math.inf, 0.0, 0.0)]
    types = "id long, a double, b double, c double"
    rows, queries_ = spark.createDataFrame(stored + odd, types), spark.createDataFrame(asked + odd[1:], types)
    for k in (1, 7, 700):
        got = {}
        for r in knn.knn_join(queries_, "id", rows, "id", ["a", "b", "c"], k).collect():
            got.setdefault(r["query"], []).append((r["rank"], r["distance"], r["neighbour"]))
        assert sorted(got) == [q[0] for q in asked]
        for q in asked:
            want = nearest(q[1:], [(s[0], s[1:]) for s in stored], k)
            assert sorted(got[q[0]]) == [(n + 1, math.sqrt(d2), i) for n, (d2, i) in enumerate(want)]
    assert knn.knn_join(queries_, "id", rows.limit(0), "id", ["a", "b", "c"], 3).count() == 0
    assert knn.knn_join(queries_.limit(0), "id", rows, "id", ["a", "b", "c"], 3).count() == 0


def test_knn_multiplies_few_rows_and_is_exact(monkeypatch):
    rng = np.random.default_rng(5)
    data = np.zeros(30_000, knn.stored(4))
    data["x"], data["id"] = np.rint(rng.normal(size=(30_000, 4)) * 64) / 64, rng.permutation(30_000)
    x = np.vstack([data["x"][:300], np.full((1, 4), 9.0)])
    pairs, plain = [], knn.near_pairs
    monkeypatch.setattr(knn, "near_pairs", lambda a, b, *rest: pairs.append(len(a) * len(b)) or plain(a, b, *rest))
    best = knn.Leaves(data, 256).best(x, np.full(len(x), np.inf), 15)
    assert sum(pairs) < 0.2 * len(x) * len(data)
    d2 = knn.squared(x, data["x"])
    for q, near in enumerate(best.lists().to_pylist()):
        order = np.lexsort((data["id"], d2[q]))[:15]
        assert [(h["d2"], h["id"]) for h in near] == list(zip(d2[q][order], data["id"][order]))


def test_knn_queries_go_to_few_cells(spark):
    rng = np.random.default_rng(6)
    cuts = knn.Cuts(rng.normal(size=(2000, 3)), 32)
    cells = cuts.place(rng.normal(size=(32_000, 3)))
    assert sorted(set(cells)) == list(range(32)) and np.bincount(cells).max() < 3000
    assert set(knn.Cuts(np.ones((50, 3)), 8).place(np.ones((5, 3)))) == {0}


def test_knn_plan_has_no_cross_join(spark, sf):
    plan = Q["c04_knn_join"](spark, sf)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


# -- calibrators -----------------------------------------------------------


def test_platt_minimises_the_smoothed_loss(spark):
    rng = random.Random(1)
    data = [(m := rng.gauss(0, 2), int(rng.random() < 1 / (1 + math.exp(-1.3 * m - 0.4)))) for _ in range(500)]
    a, b = CA.platt_fit(spark.createDataFrame(data + [(None, 1), (1.0, None)], "margin double, label int"))
    pos = sum(y for _, y in data)
    hi, lo = (pos + 1) / (pos + 2), 1 / (len(data) - pos + 2)

    def loss(a, b):
        return sum(math.log1p(math.exp(-abs(z))) + max(z, 0) - (1 - (hi if y else lo)) * z for m, y in data for z in [a * m + b])

    assert all(loss(a, b) <= loss(a + da, b + db) + 1e-9 for da in (-1e-4, 0, 1e-4) for db in (-1e-4, 0, 1e-4))
    assert a == pytest.approx(-1.3, abs=0.4)
    assert CA.platt_fit(spark.createDataFrame([], "margin double, label int")) == (0.0, 0.0)
    one = CA.platt_fit(spark.createDataFrame([(1.0, 1), (2.0, 1)], "margin double, label int"))
    assert all(map(math.isfinite, one))


def test_isotonic_does_not_depend_on_ranges(spark, monkeypatch):
    rng = random.Random(2)
    data = [(round(s := rng.random(), 2), int(rng.random() < s * s)) for _ in range(900)]
    blocks = CA.pooled((s, s, sum(1 for t, _ in data if t == s), sum(y for t, y in data if t == s)) for s in sorted({s for s, _ in data}))
    want = [tuple(b) for b in blocks]
    df = spark.createDataFrame(data, "margin double, label int")
    assert CA.isotonic_fit(df).blocks == want
    monkeypatch.setattr(CA, "RANGE_BLOCKS", 3)
    fitted = CA.isotonic_fit(df.repartition(7))
    assert fitted.blocks == want
    shares = [y / n for _, _, n, y in want]
    assert shares == sorted(shares) and len(set(shares)) == len(shares)
    got = spark.createDataFrame([(-1.0,), (2.0,), (want[3][1],), ((want[3][1] + want[4][0]) / 2,), (None,)], "s double").select(
        fitted(F.col("s")).alias("p")).collect()
    assert [r["p"] for r in got] == [pytest.approx(v) if v is not None else None for v in (
        shares[0], shares[-1], shares[3], (shares[3] + shares[4]) / 2, None)]


# -- K-Means, PCA ----------------------------------------------------------


def test_kmeans_models_are_fixed_points_and_reproducible(spark):
    rng = random.Random(7)
    points = [(rng.gauss(c, 0.3), rng.gauss(-c, 0.3)) for c in (0, 4, 9) for _ in range(60)]
    rows = KM.point_rows(spark.createDataFrame(points, "a double, b double").repartition(4), ["a", "b"])
    again = KM.point_rows(spark.createDataFrame(points[::-1], "a double, b double").repartition(3), ["a", "b"])
    pairs = [(k, s) for k in (1, 2, 3, 5) for s in (1, 2, 3)]
    models, other = KM.fit_all(rows, pairs, 0.0), KM.fit_all(again, pairs, 0.0)
    x = np.array(points)
    for m, o in zip(models, other):
        assert np.array_equal(m.centers, o.centers) and m.cost == o.cost and len(m.centers) == m.k
        d2 = ((x[:, None] - m.centers[None]) ** 2).sum(2)
        assert m.cost == pytest.approx(d2.min(1).sum(), abs=1e-4)
        for c in range(m.k):
            assert m.centers[c] == pytest.approx(x[d2.argmin(1) == c].mean(0), abs=1e-6)
    best = KM.best_of_restarts(rows, [3], 20)[3]
    assert sorted(np.round(best.centers[:, 0])) == [0, 4, 9]
    assert KM.fit_all(rows.limit(0), pairs) == []


def test_plus_plus_draws_by_squared_distance(spark):
    """Far points win the race as often as their squared distance says."""
    rows = KM.point_rows(spark.createDataFrame([(0.0,), (1.0,), (3.0,)], "a double"), ["a"])
    models = [KM.KMeans(2, s) for s in range(600)]
    KM.seeded(rows, models)
    from_zero = [m.centers[1, 0] for m in models if m.centers[0, 0] == 0.0]
    assert 150 < len(from_zero) < 250
    assert sum(v == 3.0 for v in from_zero) / len(from_zero) == pytest.approx(0.9, abs=0.07)


def test_pair_agreement_equals_the_table_operators(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 2), rng.randint(0, 1)) for _ in range(90)]
    df = spark.createDataFrame(rows, "a int, b int")
    counts = {}
    for r in rows:
        counts[r] = counts.get(r, 0) + 1
    ari, nmi = CL.pair_agreement(counts)
    assert ari == pytest.approx(CL.adjusted_rand(df, "a", "b").first()[0])
    assert nmi == pytest.approx(CL.normalized_mutual_info(df, "a", "b").first()[0])
    assert CL.pair_agreement({(0, 1): 5, (1, 0): 4}) == (1.0, pytest.approx(1.0))


def test_pca_signs_and_scores(spark):
    rng = random.Random(9)
    data = [(t := rng.gauss(0, 3), rng.gauss(0, 0.1) - 2 * t, rng.gauss(0, 1)) for _ in range(400)]
    x = np.array(data) - np.mean(data, 0)
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    loadings, shares = CL.pca_fit(df, ["a", "b", "c"], k=2)
    assert all(max(one, key=abs) > 0 for one in loadings)
    values = np.sort(np.linalg.eigvalsh(np.cov(x.T)))[::-1]
    assert shares == pytest.approx((values / values.sum())[:2])
    got = df.select(*[c.alias(f"p{i}") for i, c in enumerate(CL.pca_project(["a", "b", "c"], loadings))]).collect()
    assert np.array([tuple(r) for r in got]) == pytest.approx(x @ np.array(loadings).T)


def test_kmeans_products_equal_differences():
    rng = np.random.default_rng(3)
    x = np.rint(rng.normal(size=(500, 3)) * 4) / 4 + 1000.0
    centers = x[rng.integers(0, 500, (6, 7))]
    centers[2, 3] = centers[2, 1]
    at = KM.nearest(x, centers)
    salts, h = np.arange(6, dtype=np.uint64) * 77, rng.integers(0, 2 ** 62, 500).astype(np.uint64)
    for i, (race, row) in enumerate(KM.raced(h, x, salts, centers)):
        d2 = KM.squares(x, centers[i])
        assert np.array_equal(at[i], d2.argmin(1))
        u = (KM.mixed(h ^ salts[i]) >> np.uint64(11)) * 2.0 ** -53
        with np.errstate(divide="ignore"):
            want = np.where(d2.min(1) > 0, -np.log(u) / d2.min(1), np.inf)
        assert race == want.min() and row == x[want.argmin()].tolist()


def test_kmeans_tasks_send_a_row_per_center(spark):
    points = [(float(i % 97), float(i % 31)) for i in range(4000)]
    rows = KM.point_rows(spark.createDataFrame(points, "a double, b double"), ["a", "b"]).coalesce(2)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        sent, plain = [], KM.small_rows
        KM.small_rows = lambda df, most: sent.append(df._jdf.queryExecution()) or plain(df, most)
        models = KM.fit_all(rows, [(3, 1), (3, 2)], most_iterations=2)
    finally:
        KM.small_rows = plain
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert all(m.size.sum() == 4000 for m in models) and len(sent) == 3 + 2 + 1


def test_silhouette_is_written_out(spark):
    from matchlake.operators import clustering as CL
    rng = np.random.default_rng(4)
    x, c = rng.normal(size=(60, 2)), np.append(rng.integers(0, 3, 59), 9)
    df = spark.createDataFrame([(*map(float, p), int(k)) for p, k in zip(x, c)], "a double, b double, cluster int")
    d2, want, cost = ((x[:, None] - x[None]) ** 2).sum(2), [], 0.0
    for i in range(60):
        mean = {k: d2[i, c == k].sum() / max((c == k).sum() - (k == c[i]), 1) for k in set(c)}
        b = min(v for k, v in mean.items() if k != c[i])
        want.append(0.0 if (c == c[i]).sum() == 1 else (b - mean[c[i]]) / max(b, mean[c[i]]))
        cost += ((x[i] - x[c == c[i]].mean(0)) ** 2).sum()
    out = CL.silhouette_sq(df, ["a", "b"])
    assert out.first()[0] == pytest.approx(np.mean(want))
    assert "lambda" not in out._jdf.queryExecution().toString()
    assert CL.wcss_and_silhouette(df, ["a", "b"]) == (pytest.approx(cost), pytest.approx(np.mean(want)))


def test_kmeans_queries_have_the_full_sizes(spark, sf):
    sweep = Q["k02_kmeans_k_sweep"](spark, sf).orderBy("k").collect()
    assert [r["k"] for r in sweep] == list(range(2, 11))
    assert [r["wcss"] for r in sweep] == sorted((r["wcss"] for r in sweep), reverse=True)
    stable = Q["k09_stability_over_seeds"](spark, sf).collect()
    assert len(stable) == 4 and all(-1 <= r["silhouette_change"] <= 1 and 0 <= r["nmi"] <= 1 for r in stable)


# -- N17: forests of bounded depth over all rows


def drawn_rows(spark, n=3000):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 5)).round(2)
    y = (3 * x[:, 0] + x[:, 1] + rng.normal(size=n) > 0).astype(int)
    names = [f"f{i}" for i in range(5)]
    return spark.createDataFrame([(i, int(y[i]), *map(float, x[i])) for i in range(n)],
                                 "id long, label int, " + ", ".join(f"{c} double" for c in names)), names


def test_levelled_forest_does_not_depend_on_partitions(spark):
    df, names = drawn_rows(spark)
    one, two = (LF.fit(df.repartition(n), "id", "label", names, trees=9, max_depth=4) for n in (2, 7))
    for name in ("feature", "cut", "w", "p", "gain"):
        assert np.array_equal(getattr(one, name), getattr(two, name))
    assert one.importances(5).argmax() == 0 and one.importances(5).sum() == pytest.approx(1)


def test_levelled_forest_equals_plain_loops(spark):
    df, names = drawn_rows(spark, 700)
    got = LF.fit(df, "id", "label", names, trees=6, max_depth=3)
    rows = np.concatenate([np.frombuffer(r["rows"], BI.record(5)) for r in LF.blocks(df, "id", "label", names).collect()])
    x, y = rows["x"], rows["y"].astype(float)
    assert len(rows) == 700 and 20 < x.max() < LF.CUTS
    gini = lambda w, p: 2 * p / w * (1 - p / w)
    for t, count in enumerate(LF.draws(rows["h"], 6, 42)):
        inside = {0: count.astype(float)}
        for node in range(7):
            if node not in inside:
                continue
            w = inside[node]
            assert (got.w[t, node], got.p[t, node]) == (w.sum(), (w * y).sum())
            f = got.feature[t, node]
            if f < 0:
                continue
            gains = {}
            for b in np.unique(x[w > 0, f])[:-1]:
                a = w * (x[:, f] <= b)
                gains[b] = w.sum() * gini(w.sum(), (w * y).sum()) - sum(s.sum() * gini(s.sum(), (s * y).sum()) for s in (a, w - a))
            assert got.gain[t, node] == pytest.approx(max(gains.values()))
            left = w * (x[:, f] <= got.cut[t, node])
            inside[2 * node + 1], inside[2 * node + 2] = left, w - left


def test_levelled_forest_ranks_features_as_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    df, names = drawn_rows(spark)
    known = MO.estimator("random_forest").fit(VectorAssembler(inputCols=names, outputCol="features").transform(df))
    assert LF.fit(df, "id", "label", names).importances(5) == pytest.approx(known.featureImportances.toArray(), abs=0.03)


def test_splits_taken_back_and_empty_forest(spark):
    f = LF.Forest.roots(1, 2)
    f.feature[0, :2], f.gain[0, :2] = (0, 1), (5.0, 3.0)
    f.w[0], f.p[0] = (10, 6, 4, 3, 3, 0, 0), (3, 2, 1, 1, 1, 0, 0)
    f.prune()
    assert (f.feature == -1).all() and f.importances(2).tolist() == [0, 0]
    df, names = drawn_rows(spark, 50)
    assert (LF.fit(df.withColumn("label", F.lit(1)), "id", "label", names, trees=2).feature == -1).all()
    assert (LF.fit(df.limit(0), "id", "label", names, trees=2).feature == -1).all()


@pytest.mark.parametrize("n", [0, 1, 7, 500])
def test_split_and_folds_are_those_of_both_operators(spark, n):
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    want = SA.kfold(SA.three_way_split(df, "k", "label"), "k", 5, 42, "label")
    got = SA.split_and_folds(df, "k", "label", 5)
    assert sorted(got.collect()) == sorted(want.collect()) and got.columns == want.columns
    if n == 500:
        sizes = [r["n"] for r in got.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()]
        assert len(sizes) == 3
