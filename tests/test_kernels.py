"""The kernels give the trees, sums and losses of their numpy twins."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from matchlake.operators import binned as BI
from matchlake.operators import boosting as BO
from matchlake.operators import forest as FO
from matchlake.operators import kernels as KE
from matchlake.operators import members as ME


def packed_rows(n, features, seed):
    rng = np.random.default_rng(seed)
    rows = np.zeros(n, BI.record(features))
    rows["x"], rows["h"], rows["fold"] = rng.integers(0, 60, (n, features)), np.sort(rng.integers(0, 2 ** 63, n)), rng.integers(0, 3, n)
    rows["x"][:, 0] %= 3  # runs out before the others
    rows["y"] = rng.random(n) < 1 / (1 + np.exp(-(rows["x"][:, 1] / 15.0 - 2) * (rows["x"][:, 2] / 20.0 - 1)))
    return rows


def asked(spark, name, rows, *args):
    df = spark.createDataFrame([(bytearray(rows.tobytes()),)], "rows binary")
    return bytes(df.select(KE.called(name, F.col("rows"), *[F.lit(a) for a in args])).first()[0])


@pytest.mark.parametrize("features", [3, 7, 8, 17])
@pytest.mark.parametrize("spec", [FO.ForestSpec(held=(0,)), FO.ForestSpec(max_depth=5, min_split=9, min_leaf=4, seed=7),
                                  FO.ForestSpec(bootstrap=False, held=(1, 2))])
def test_forest_kernel_grows_the_same_trees(spark, features, spec):
    assert KE.ready(spark)
    rows = packed_rows(2500, features, features)
    sums = 0
    for t in range(2):
        want = FO.grow(rows["x"], rows["y"], spec.counts(rows, t), spec, spec.tree_seed(t), 2)
        assert asked(spark, "grow", rows, FO.kernel_params(spec, features, 2, t, 1, 0), KE.marked(spec.held)) == want.to_bytes()
        sums = sums + want.predict(rows["x"][rows["fold"] == 0])
    got = asked(spark, "votes", rows, FO.kernel_params(spec, features, 2, 0, 2), KE.marked(spec.held) + KE.marked((0,)))
    assert np.array_equal(np.frombuffer(got, np.float64, len(sums)), sums)
    assert np.array_equal(np.frombuffer(got, np.uint8, len(sums), 8 * len(sums)), rows["y"][rows["fold"] == 0])


@pytest.mark.parametrize("spec", [
    BO.BoostSpec(rounds=6, held=(0,)), BO.BoostSpec(rounds=6, max_leaves=9, max_depth=3, held=(0,)),
    BO.BoostSpec(rounds=6, step=0.3, max_depth=5, max_leaves=None, l1=0.1, l2=1.0, min_child_weight=2, min_rows=1, subsample=0.7,
                 column_share=0.6, held=(0,))])
def test_boosting_kernel_grows_the_same_trees(spark, spec):
    assert KE.ready(spark)
    rows, margin, want, losses, aucs = packed_rows(3000, 7, 1), None, [], [], []
    held, y = np.isin(rows["fold"], spec.held), rows["y"]
    base = BO.base_margin(float(y[~held].sum()), float((~held).sum()))
    margin = np.full(len(rows), base)
    for number in range(spec.rounds):
        local = BO.LocalRows(rows, margin, spec, number)
        tree = BO.grow(local, spec, spec.columns(number, 7))
        margin += spec.step * local.predictions(tree)
        want.append(tree.to_bytes())
        losses.append(BO.log_loss(y[held], margin[held]).mean())
        aucs.append(BO.area(y[held], margin[held]))
    state = KE.marked(spec.held) + struct.pack("<iiiid", 0, 1, 0, 0, 0.0)
    for to in (2, spec.rounds):  # a state resumes where it stopped
        state = asked(spark, "boost", rows, BO.kernel_params(spec, 7, base, to), state)
    df = spark.createDataFrame([(0, bytearray(state))], "unit int, state binary")
    fit = df.mapInArrow(BO.fits_of, BO.FITS).first()
    assert [bytes(r["nodes"]) for r in df.mapInArrow(BO.trees_of, "unit int, round int, nodes binary").orderBy("round").collect()] == want
    assert fit["losses"] == pytest.approx(losses, abs=1e-12) and fit["aucs"] == aucs and fit["over"]


@pytest.fixture(scope="module")
def table(spark):
    rows = packed_rows(3000, 7, 5)
    data = [(int(h >> 1), int(r["y"]), int(r["fold"]), *map(float, r["x"])) for h, r in zip(rows["h"], rows)]
    return spark.createDataFrame(data, "id long, label int, code int, " + ", ".join(f"f{i} double" for i in range(7)))


def test_forest_searches_write_no_trees(spark, table, monkeypatch):
    rows = BI.binned_rows(table, "id", "label", [f"f{i}" for i in range(7)], "code")
    draws, parts = [{"trees": 5, "max_depth": None}, {"trees": 3, "max_depth": 4}], [((f,), (f,)) for f in range(3)]
    monkeypatch.setenv("MATCHLAKE_KERNELS", "0")
    plain = FO.search_forests(rows, draws, parts, 7)
    monkeypatch.delenv("MATCHLAKE_KERNELS")
    monkeypatch.setattr(FO, "train_forests", lambda *a, **b: pytest.fail("trees were written"))
    assert FO.search_forests(rows, draws, parts, 7) == pytest.approx(plain, abs=1e-12)


def test_members_without_ids_are_rated_the_same(spark, table, monkeypatch):
    members = ME.Members(table, "id", "label", "code", [f"f{i}" for i in range(7)])
    splits = [ME.Split((f,), (f,)) for f in range(3)]
    rated = lambda df: sorted((r["split"], r["model"], r["label"], round(r["probability"], 12), r["prediction"])
                              for r in df.collect())
    with_ids = members.scores(["random_forest", "boosting"], splits)
    monkeypatch.setattr(FO, "train_forests", lambda *a, **b: pytest.fail("trees were written"))
    assert rated(members.scores(["random_forest", "boosting"], splits, ids=False)) == rated(with_ids.drop("id"))


def test_search_ledgers_are_the_same_without_kernels(spark, table, monkeypatch):
    rows = BI.binned_rows(table, "id", "label", [f"f{i}" for i in range(7)], "code")
    draws = [BO.BoostSpec(rounds=12, step=0.3 if t % 2 else 0.001, max_depth=1 + t % 4, max_leaves=None, patience=20, seed=t)
             for t in range(9)]
    plain = lambda: [{k: v for k, v in r.items() if k != "seconds"} for r in BO.trial_search(
        rows, draws, [0, 1], 7, wave=3, startup=3, stops=(6,))]
    by_kernels = plain()
    monkeypatch.setenv("MATCHLAKE_KERNELS", "0")
    assert json.dumps(plain()) == json.dumps(by_kernels)


def test_big_trees_are_the_same_in_parts(spark, table, monkeypatch):
    rows = BI.binned_rows(table, "id", "label", [f"f{i}" for i in range(7)], "code")
    specs = [FO.ForestSpec(trees=3, held=(0,)), FO.ForestSpec(trees=2, max_depth=6, min_leaf=3, held=(1,))]
    trees = lambda df: {(r["forest"], r["tree"]): BI.Tree.from_bytes(bytes(r["nodes"])) for r in df.collect()}
    whole = trees(FO.train_forests(rows, specs, 7))
    monkeypatch.setattr(FO, "PASS_NODES", 3)
    monkeypatch.setattr(FO, "SENT_BYTES", 2000)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200")
    handed = []
    monkeypatch.setattr(FO, "passes", lambda now, plain=FO.passes: [handed.append(sum(len(v[1]) for v in p.values())) or p
                                                                  for p in plain(now)])
    try:
        parts = trees(FO.train_forests(rows.coalesce(2), specs, 7, local_rows=300))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    x = np.stack([np.frombuffer(bytes(r["x"]), np.uint8) for r in rows.select("x").collect()])
    assert whole.keys() == parts.keys() and len(handed) > 4
    assert all(len(whole[k].left) == len(parts[k].left) and np.array_equal(whole[k].predict(x), parts[k].predict(x)) for k in whole)


def test_what_a_search_hands_on_does_not_grow_with_the_rows(spark, table):
    rows = BI.binned_rows(table, "id", "label", [f"f{i}" for i in range(7)], "code")
    sizes = []
    assert KE.ready(spark)
    for some in (rows.where("id % 4 = 0"), rows):
        fits = BO.KernelFits(some, [BO.BoostSpec(rounds=9, max_depth=1, max_leaves=None, held=(0,))], 7)
        fits.advance([0], 2)
        assert fits.advance([0], 4)[0]["round"] == 4
        sizes.append(fits.state.select(F.length("state")).first()[0])
    assert sizes[0] == sizes[1] < 1000
