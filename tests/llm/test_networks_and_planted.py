"""The quality network against plain loops, and planted cases through the pipeline."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from matchlake.llm import quality, queries
from matchlake.llm.batches import slices

SMALL = "/root/testdata/sf0.001"


def net_of(seed):
    rng = np.random.default_rng(seed)
    net = quality.ConvModel.start(rng)
    net.shift = rng.normal(0, 0.1, quality.FILTERS).astype(np.float32)
    net.dense = rng.normal(0, 0.3, 2 * quality.FILTERS).astype(np.float32)
    net.bias = 0.2
    return net


def plain_score(text, net):
    """Chunk by chunk, filter by filter."""
    raw = list(text)
    chunks = max(1, -(-(len(raw) - quality.CHUNK + quality.STEP) // quality.STEP))
    top, mass = np.full(quality.FILTERS, -np.inf), np.zeros(quality.FILTERS)
    for c in range(chunks):
        symbols = [raw[i] if i < len(raw) else 256 for i in range(c * quality.STEP, c * quality.STEP + quality.CHUNK)]
        x = np.concatenate([net.embed[s].astype(float) for s in symbols])
        for f in range(quality.FILTERS):
            z = float(x @ net.filters[:, f].astype(float)) + float(net.shift[f])
            top[f], mass[f] = max(top[f], z), mass[f] + max(z, 0.0)
    vector = np.concatenate([np.tanh(top), np.tanh(mass / chunks)])
    return 1 / (1 + np.exp(-(vector @ net.dense + net.bias)))


TEXTS = ["", "a", "sixteen bytes ab", "seventeen bytes a", "A longer text, with é and 日本, of some chunks. " * 3, "zz" * 40]


def test_forward_equals_plain_loops():
    net = net_of(1)
    got = quality.score_texts(pa.array([*TEXTS, None]), net)
    want = [plain_score(t.encode(), net) for t in [*TEXTS, ""]]
    assert got == pytest.approx(want, abs=1e-5)


def test_gradients_equal_differences():
    """Each gradient against the change of the weighted log loss."""
    net = net_of(2)
    _, _, raw, offsets = next(slices(pa.array(TEXTS)))
    target, scale = np.array([1, 0, 1, 0, 1, 0]), np.array([1, 2, 0.5, 1, 1, 3], np.float32)

    def loss():
        p = np.array([plain_score(t.encode(), net) for t in TEXTS])
        return -(scale * np.where(target == 1, np.log(p), np.log(1 - p))).sum() / len(TEXTS)

    grads = quality.gradients(net, raw, offsets, target, scale)
    rng = np.random.default_rng(0)
    for name in ("embed", "filters", "shift", "dense"):
        value = getattr(net, name)
        decay = quality.DECAY * value if name in ("embed", "filters", "dense") else np.zeros_like(value)
        wide = value.astype(np.float64)
        for _ in range(4):
            at = tuple(int(rng.integers(0, s)) for s in value.shape)
            if name == "embed":
                at = (int(rng.choice([256, *b"AaZzt"])), at[1])
            ends = []
            for step in (1e-4, -1e-4):
                moved = wide.copy()
                moved[at] += step
                setattr(net, name, moved)
                ends.append(loss())
            setattr(net, name, value)
            assert grads[name][at] - decay[at] == pytest.approx((ends[0] - ends[1]) / 2e-4, abs=2e-3)


def test_planted_cases_go_and_clean_documents_stay(spark, tmp_path):
    """Toxic documents, unknown languages, copies and benchmark passages go; the
    other planted documents stay until the last stage gives them a rate."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").first()["text"]
    clean = [r["text"] for r in docs.where("n_chars between 1500 and 2500 and lang = 'en'").join(
        spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1 and toxic = 0"), "doc_id").orderBy("doc_id").limit(4).collect()]
    insult = "You stupid idiot, you worthless moron. Pathetic loser, disgusting scum, trash and clown! " * 4
    tail = " ".join(f"newword{i} likeno{i}" for i in range(60))
    rows = [(10 ** 6, clean[0] + " " + insult), (10 ** 6 + 1, "12345 !!!"), (10 ** 6 + 2, None),
            (10 ** 6 + 3, clean[1] + " " + tail), (10 ** 6 + 4, clean[1] + " " + tail),
            (10 ** 6 + 5, clean[2] + "\n" + item + "\n" + clean[3])]
    planted = spark.createDataFrame([(i, t, "en", "x", len(t or "")) for i, t in rows], docs.schema)
    sf = str(tmp_path)
    docs.unionByName(planted).write.parquet(f"{sf}/documents.parquet")
    for name in ("labels", "benchmark"):
        src = "/root/testdata/sf0.01" if name == "labels" else SMALL
        spark.read.parquet(f"{src}/{name}.parquet").write.parquet(f"{sf}/{name}.parquet")
    queries.importable(spark)
    now, left = spark.read.parquet(f"{sf}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf).persist()
        left.append({r["doc_id"] - 10 ** 6 for r in now.where(F.col("doc_id") >= 10 ** 6).collect()})
    assert left == [{1, 2, 3, 4, 5}, {3, 4, 5}, {3, 5}, {3}, {3}]
    assert "rate" in now.columns and now.agg(F.min("rate")).first()[0] > 0
