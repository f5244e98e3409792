"""Trained text vectors against dense linear algebra; keyed stream state; the
release flow and saved metadata."""

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from matchlake.functions import text as TX
from matchlake.functions.numeric import round_half_away
from matchlake.operators import text_vectors as TV
from matchlake.operators import tfidf as TF
from matchlake.plans import q_text as QT
from matchlake.streaming import jobs as ST

Q = queries()


def corpus(spark, n=60):
    rng = random.Random(4)
    topics = [["alpha", "beta", "gamma", "delta"], ["red", "green", "blue", "black"], ["north", "south", "east", "west"]]
    texts = [" ".join(rng.choice(topics[i % 3]) for _ in range(rng.randint(5, 20))) for i in range(n)]
    return spark.createDataFrame([(i, t) for i, t in enumerate([*texts, "", "<b>!!</b> 12"])] + [(None, None)], "id long, text string")


def test_pair_counts_equal_plain_loops(spark):
    tokens = TV.token_rows(corpus(spark), "text")
    terms, idf = TV.vocabulary(tokens, 8)
    lists = [[w for w in r["tokens"] or [] if w in terms] for r in tokens.collect()]
    want = {}
    for words in lists:
        for a in range(len(words)):
            for b in range(a + 1, min(len(words), a + 4)):
                for pair in ((words[a], words[b]), (words[b], words[a])):
                    want[pair] = want.get(pair, 0) + 1
    got = {(terms[r["i"]], terms[r["j"]]): r["n"] for r in TV.pair_counts(tokens, terms, 3).collect()}
    assert got == want and len(terms) == 8
    df = {t: sum(t in set(w) for w in lists) for t in terms}
    assert idf == pytest.approx([math.log((1 + len(lists)) / (1 + df[t])) + 1 for t in terms])


def test_range_finder_equals_dense_eigenvectors(spark):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((40, 4))
    dense = base @ np.diag([9.0, 6.0, -4.0, 2.0]) @ base.T + 0.01 * rng.standard_normal((40, 40))
    dense = (dense + dense.T) / 2
    cells = [(i, j, float(dense[i, j])) for i in range(40) for j in range(40)]
    table = spark.createDataFrame(cells, "i int, j int, w double").repartition(5, "i")
    assert TV.product(table, np.eye(40)) == pytest.approx(dense)
    got = TV.leading_vectors(table, 40, 4)
    values, vectors = np.linalg.eigh(dense)
    order = np.argsort(-np.abs(values))[:4]
    want = vectors[:, order] * np.sqrt(np.abs(values[order]))
    assert np.abs(got) == pytest.approx(np.abs(want), abs=1e-3)


def test_texts_of_one_topic_lie_near(spark):
    docs = corpus(spark)
    words = TV.train(docs, dim=6)
    v = np.array([r["v"] for r in docs.where("id < 60").orderBy("id").select(TV.text_vector(F.col("text"), words).alias("v")).collect()])
    near = v @ v.T
    same = np.arange(60)[:, None] % 3 == np.arange(60)[None] % 3
    assert near[same].min() > 0.8 and np.abs(near[~same]).max() < 0.5
    odd = docs.where("id is null or id >= 60").select(TV.text_vector(F.col("text"), words).alias("v")).collect()
    assert all(r["v"] == [0.0] * 6 for r in odd)
    none = TV.train(docs.limit(0))
    assert none.terms == [] and docs.select(F.size(TV.text_vector(F.col("text"), none)).alias("n")).agg(F.max("n")).first()[0] == TV.DIM


def test_posting_state_over_many_batches(spark, tmp_path):
    """Files arrive one per batch, later ones with smaller ids of the same URLs."""
    rows = [(30 - i, f"http://x/{i % 7}?a={i}", f"<title>t{30 - i}</title>") for i in range(30)]
    for part in range(6):
        spark.createDataFrame(rows[part * 5:part * 5 + 5], "page_id long, url string, html string").coalesce(1).write.mode(
            "append").parquet(f"{tmp_path}/pages.parquet")
    got = {(r["url"], r["id"], r["title"]) for r in ST.run_posting_ingest(spark, str(tmp_path), max_files=1).collect()}
    want = {}
    for i, url, _ in rows:
        url = url.split("?")[0]
        want[url] = min(i, want.get(url, i))
    assert got == {(u, i, f"t{i}") for u, i in want.items()}


def test_a_posting_batch_reads_no_stored_table(spark, sf, monkeypatch):
    reads = []
    real = ST._parts
    monkeypatch.setattr(ST, "_parts", lambda *a: reads.append(a) or real(*a))
    ST.run_posting_ingest(spark, sf)
    assert len(reads) == 1  # the result, after the stream


def test_release_flow(spark, sf):
    rows = {r["slice"]: r for r in Q["n16_release_flow"](spark, sf).collect()}
    assert set(rows) == {"all", "freshers", "experienced"}
    whole = rows["all"]
    for c in ("tn", "fp", "fn", "tp"):
        assert whole[c] == rows["freshers"][c] + rows["experienced"][c]
    assert whole["expected_cost"] == 500 * whole["fp"] + 2000 * whole["fn"]
    assert 0.1 <= whole["threshold"] < 0.9 and whole["method"] in ("sigmoid", "isotonic") and whole["brier_score"] < 0.25


def test_metadata_row(spark, sf):
    r = Q["a06_model_metadata"](spark, sf).first()
    assert r["model_name"] == "match-logistic" and len(r["selected_features"]) == 7 and r["n_training_samples"] > 0
    assert r["model_type"].startswith("GapTransformer") and 0.5 < r["training_metrics"]["roc_auc"] <= 1
    assert r["hyperparameters"]["maxIter"] == "100"


def test_long_batches_are_worked_off_in_parts(spark, monkeypatch):
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 6, n) for n in (0, 1, 3, 900, 2, 0, 40, 300, 7)]
    terms, vectors = [f"w{i}" for i in range(6)], rng.standard_normal((6, 4))
    tokens = pa.array([[terms[i] for i in t] for t in texts] + [None], pa.list_(pa.string()))
    parts = list(TV.light_parts(tokens, 300))
    assert [b for b, _ in parts] == [0, 3, 4, 7, 8] and pa.concat_arrays([p for _, p in parts]).equals(tokens)
    at, ids = TV.word_ids(tokens, pa.array(terms))
    seen = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            seen.append(len(key))
            return np.asarray(self)[key]

    sums = TV.text_sums(at, ids, vectors.view(Watched), len(tokens), 100)
    assert max(seen) <= 100 and np.allclose(sums, [vectors[t].sum(0) for t in texts] + [np.zeros(4)])
    alone = TV.text_sums(np.zeros(900, int), texts[3], vectors, 1, 100)
    assert np.array_equal(alone[0], sums[3])  # whatever texts stand beside it
    df = spark.createDataFrame([(" ".join(terms[i] for i in t).split(),) for t in texts] + [(None,)], "tokens array<string>").coalesce(1)
    whole = sorted(TV.pair_counts(df, terms, 5).collect())
    part_tokens = TV.PART_TOKENS
    plain = {}
    for t in texts:
        for a in range(len(t)):
            for b in range(max(a - 5, 0), min(a + 6, len(t))):
                if a != b:
                    plain[int(t[a]), int(t[b])] = plain.get((int(t[a]), int(t[b])), 0) + 1
    assert {(r["i"], r["j"]): r["n"] for r in whole} == plain and part_tokens <= 1 << 20
    batch = pa.RecordBatch.from_arrays([tokens], names=["tokens"])
    monkeypatch.setattr(TV, "PART_TOKENS", 64)
    counted = {}
    for out in TV.counter(terms, 5)(iter([batch])):
        for i, j, n in zip(*(c.to_pylist() for c in out.columns)):
            counted[i, j] = counted.get((i, j), 0) + n
        assert sum(out.column(2).to_pylist()) <= 64 * 10
    assert counted == plain


# -- packed texts in the joins of trained vectors


def test_packed_texts_give_the_same_vectors_in_fewer_bytes(spark):
    docs = corpus(spark)
    words = TV.train(docs, dim=24)  # 96 words and more: the vector is carried
    long_text = F.array_join(F.array_repeat(F.lit("alpha red north alpha"), 25), " ")
    docs = docs.withColumn("text", F.when(F.col("id") % 7 == 3, long_text).otherwise(F.col("text")))
    tokens = docs.select("id", "text", TX.token_array(TX.clean(F.col("text"))).alias("tokens"))
    rows = tokens.select(F.size("tokens").alias("n"), TV.text_vector(F.col("text"), words).alias("v"),
                         TV.packed_text(F.col("tokens"), words).alias("p")).collect()
    assert {len(r["p"]) for r in rows if r["n"] >= 96} == {24 * 8} and any(r["n"] == 0 for r in rows)
    assert all(len(r["p"]) == 2 * r["n"] for r in rows if r["n"] < 96)
    packed = pa.array([bytes(r["p"]) for r in rows], pa.binary())
    weighted = words.vectors * words.idf[:, None]
    assert np.array_equal(TV.packed_matrix(packed, weighted, TV.number_type(words)), np.array([r["v"] for r in rows]))
    pairs = [(i, j) for i in range(len(rows)) for j in range(len(rows))] * 2  # more than a stretch of pairs
    got = TV.packed_dots(words)(packed.take(pa.array([i for i, _ in pairs])), packed.take(pa.array([j for _, j in pairs])))
    assert len(pairs) > TV.PART_PAIRS
    want = spark.createDataFrame([(rows[i]["v"], rows[j]["v"]) for i, j in pairs], "a array<double>, b array<double>")
    assert got.to_pylist() == [r["d"] for r in want.select(TX.dot(F.col("a"), F.col("b")).alias("d")).collect()]
    empty = pa.array([b"", b""], pa.binary())
    assert TV.packed_dots(TV.train(docs.limit(0)))(empty, empty).to_pylist() == [0.0, 0.0]
    assert TV.packed_dots(words)(empty[:0], empty[:0]).to_pylist() == []


def test_trained_similarity_is_the_dot_of_both_vectors(spark, sf):
    resumes, jds = QT.resumes(spark, sf), QT.jds(spark, sf)
    words = TV.train(resumes.select("text").unionByName(jds.select("text")))
    rv = resumes.select(F.col("doc").alias("candidate_id"), TV.text_vector(F.col("text"), words).alias("rv"))
    jv = jds.select(F.col("doc").alias("job_id"), TV.text_vector(F.col("text"), words).alias("jv"))
    want = QT.apps(spark, sf).join(rv, "candidate_id").join(jv, "job_id").select(
        "application_id", round_half_away(TX.dot(F.col("rv"), F.col("jv")), 6).alias("s")).collect()
    got = {r["application_id"]: r["vector_similarity"] for r in Q["h10_trained_vector_similarity"](spark, sf).collect()}
    assert len(got) == len(want) and all(got[r["application_id"]] == pytest.approx(r["s"], abs=1e-6) for r in want)


def test_tfidf_from_written_tokens_is_that_of_the_texts(spark, sf):
    sides = QT.side_tokens(QT.resumes(spark, sf)), QT.side_tokens(QT.jds(spark, sf))
    a = QT.apps(spark, sf)
    want, got = (sorted(QT.tfidf_similarity(spark, sf, a, t).collect()) for t in (None, sides))
    assert [r[:4] for r in got] == [r[:4] for r in want] and [r[4] for r in got] == pytest.approx([r[4] for r in want], abs=1e-12)
    docs = spark.createDataFrame([(1, "x yy zz yy"), (2, None), (3, "")], "doc int, text string")
    made = docs.select("doc", TX.token_array(TX.clean(F.col("text"))).alias("tokens"))
    assert sorted(TF.fit(made, tokens="tokens").collect()) == sorted(TF.fit(docs).collect())
