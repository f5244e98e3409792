"""Invariants for the rows-only operators: models, tuning, clustering, streams."""

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from matchlake.operators import curves as CU
from matchlake.operators import models as MO
from matchlake.operators import sampling as SA
from matchlake.session import ensure_checkpoint_dir
from matchlake.sources.adapter import modelling_table
from matchlake.streaming import jobs as ST

Q = queries()


@pytest.fixture(scope="module")
def labelled(spark, sf):
    return modelling_table(spark, sf).withColumnRenamed("is_good_match", "label")


def test_folds_partition_rows_and_balance_classes(labelled):
    f = SA.kfold(labelled, "application_id", 5, 42, "label")
    assert f.count() == labelled.count()
    per = {(r["fold"], r["label"]): r["n"] for r in f.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}
    for lab in (0, 1):
        sizes = [per[(k, lab)] for k in range(5)]
        assert max(sizes) - min(sizes) <= 1


def test_same_seed_same_split(labelled):
    a = SA.stratified_holdout(labelled, "application_id", "label").filter("is_test").select("application_id")
    b = SA.stratified_holdout(labelled, "application_id", "label").filter("is_test").select("application_id")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_logistic_learns_and_probabilities_bounded(spark, sf):
    out = Q["n01_logistic_balanced"](spark, sf)
    stats = out.agg(F.min("probability"), F.max("probability")).first()
    assert 0.0 <= stats[0] <= stats[1] <= 1.0
    assert CU.roc_auc(out).first()[0] > 0.7


def test_pipeline_round_trip_passes(spark, sf):
    r = Q["a06_a07_model_save_load_roundtrip"](spark, sf).first()
    assert r["status"] == "PASS" and r["rows"] > 0


def test_gap_transformer_in_saved_pipeline(spark, labelled, tmp_path):
    m = MO.fit(labelled, "decision_tree")
    MO.save(m, str(tmp_path / "m"))
    again = MO.load(str(tmp_path / "m"))
    assert isinstance(again.stages[0], MO.GapTransformer)


def test_kmeans_assigns_every_row(spark, sf):
    out = Q["k01_kmeans_best_of_seeds"](spark, sf)
    assert out.filter(F.col("cluster").isNull()).count() == 0
    assert out.select("cluster").distinct().count() == 2


def _resplit(spark, sf, folder, name, files):
    """The table in shuffled files, and every other one as it is."""
    for table in ("nation", "customer", "part", "orders", "events", "pages"):
        rows = spark.read.parquet(f"{sf}/{table}.parquet")
        if table == name:
            rows = rows.withColumn("_deal", F.rand(7)).repartitionByRange(files, "_deal").drop("_deal")
        rows.write.parquet(f"{folder}/{table}.parquet")
    return str(folder)


@pytest.mark.parametrize("name, query, batch", [
    ("events", "u01_request_metrics_stream", "u01_request_metrics_windowed"),
    ("pages", "u02_posting_ingest_stream", None), ("orders", "u03_continuous_scoring_stream", None)])
def test_streams_do_not_depend_on_files(spark, sf, tmp_path, monkeypatch, name, query, batch):
    monkeypatch.setattr(ST, "MAX_FILES", 2)
    monkeypatch.setattr(ST._stream, "__defaults__", (2,))
    whole = sorted(map(tuple, Q[batch or query](spark, sf).collect()))
    split = sorted(map(tuple, Q[query](spark, _resplit(spark, sf, tmp_path / "t", name, 10)).collect()))
    assert split == whole and split


def test_every_row_is_scored_or_in_quarantine(spark, sf, tmp_path):
    """Two jobs with a requirement out of range send their applications to quarantine."""
    folder = _resplit(spark, sf, tmp_path / "q", "orders", 3)
    real = ST.AD.jobs
    try:
        ST.AD.jobs = lambda s, d: real(s, d).withColumn(
            "python_required", F.when(F.col("job_id") % 50 == 0, 101.0).otherwise(F.col("python_required")))
        scored, quarantine = ST.run_continuous_scoring(spark, folder)
        n = spark.read.parquet(f"{folder}/orders.parquet").count()
        assert quarantine.count() > 0 and scored.count() + quarantine.count() == n
        assert quarantine.where("violations = ''").count() == 0
    finally:
        ST.AD.jobs = real


def test_a_retried_batch_counts_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a")], "id long, url string")
    path = str(tmp_path / "sink")
    ST._prepare(spark, path, rows.schema)
    for _ in range(2):
        ST._write_part(rows, path, 0)
    assert ST._parts(spark, path, rows.schema).count() == 1


def test_only_a_local_master_may_go_without_a_shared_folder():
    class Session:
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(ValueError, match="shared folder"):
        ensure_checkpoint_dir(Session)
