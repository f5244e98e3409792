"""TF-IDF as joins and aggregates over sparse postings.

Documents are rows ``(doc, text)`` with an optional integer ``weight``: a
text that occurs in ``weight`` corpus rows (the same resume used by several
applications) is tokenised once and counted ``weight`` times, which gives
exactly the corpus statistics of the repeated rows without repeating work.

* vocabulary: top ``max_features`` terms by corpus frequency, ties by term
  (distributed top-k; the result is bounded by ``max_features``)
* idf = ln((1 + n) / (1 + df)) + 1, weight = tf * idf, then L2 per document
* postings stay sparse ``(doc, term, w)``; nothing is densified.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from matchlake.functions.text import clean, token_array
from matchlake.operators.small import one_row, small_rows
from matchlake.operators.text_vectors import word_ids

RECORD = np.dtype([("term", "<i4"), ("w", "<f8")])
PART_PAIRS = 200_000  # pairs a task of a join holds


def term_counts(docs: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """(doc, term, tf) from raw text: clean, alphabetic tokens, >= 2 chars."""
    return (docs.select(doc, F.explode(long_tokens(F.col(text))).alias("term"))
                .groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf")))


def long_tokens(text: Column) -> Column:
    """Alphabetic tokens of at least two characters of a text."""
    return long_of(token_array(clean(text)))


def long_of(tokens: Column) -> Column:
    return F.filter(tokens, lambda x: F.length(x) >= 2)


def tokens_of(text: str, tokens: str | None) -> Column:
    """``long_tokens`` of a text column, or of the column that holds all its tokens."""
    return long_of(F.col(tokens)) if tokens else long_tokens(F.col(text))


def fit(docs: DataFrame, doc: str = "doc", text: str = "text", weight: str | None = None,
        max_features: int = 5000, tokens: str | None = None) -> DataFrame:
    """Vocabulary with idf: (term, idf). Bounded by ``max_features`` rows. Terms are
    counted where the text is, so only a row per term and task is shuffled."""
    w = F.col(weight) if weight else F.lit(1)
    rows = docs.select(w.alias("weight"), tokens_of(text, tokens).alias("tokens"))
    term = lambda often, once: lambda t: F.struct(t.alias("term"), F.lit(often).alias("often"), F.lit(once).alias("once"))
    each = F.concat(F.transform("tokens", term(1, 0)), F.transform(F.array_distinct("tokens"), term(0, 1)))
    counts = rows.select("weight", F.explode(each).alias("t")).groupBy("t.term").agg(
        F.sum(F.col("weight") * F.col("t.often")).alias("cf"), F.sum(F.col("weight") * F.col("t.once")).alias("df"))
    return vocabulary(counts, docs.select(F.sum(w)).scalar(), max_features)


def fit_counts(counts: DataFrame, docs: DataFrame, doc: str = "doc", weight: str | None = None,
               max_features: int = 5000) -> DataFrame:
    """The vocabulary from the ``term_counts`` of ``docs``."""
    if weight:
        counts = counts.join(docs.select(doc, weight), doc)
        w = F.col(weight)
        n = docs.select(F.sum(weight)).scalar()
    else:
        w = F.lit(1)
        n = docs.select(F.count(F.lit(1))).scalar()
    stats = counts.groupBy("term").agg(F.sum(w * F.col("tf")).alias("cf"), F.sum(w).alias("df"))
    return vocabulary(stats, n, max_features)


def vocabulary(stats: DataFrame, n: Column, max_features: int) -> DataFrame:
    """(term, idf) of the most frequent of (term, cf, df); ``n`` texts in all."""
    vocab = stats.orderBy(F.col("cf").desc(), F.col("term")).limit(max_features)
    return vocab.select("term", (F.log((F.lit(1.0) + n) / (F.lit(1.0) + F.col("df"))) + 1).alias("idf"))


def transform(docs: DataFrame, vocab: DataFrame, doc: str = "doc", text: str = "text") -> DataFrame:
    """L2-normalised postings (doc, term, w)."""
    return transform_counts(term_counts(docs, doc, text), vocab, doc)


def transform_counts(counts: DataFrame, vocab: DataFrame, doc: str = "doc") -> DataFrame:
    """Postings from ``term_counts``. The vocabulary is capped at
    ``max_features`` rows, a proven bound, so it is broadcast."""
    tc = counts.join(F.broadcast(vocab), "term")
    raw = tc.select(doc, "term", (F.col("tf") * F.col("idf")).alias("w"))
    # One document's postings are bounded by its distinct terms, so the norm is
    # a window over the already doc-partitioned postings (no second join).
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(doc)))
    return raw.select(doc, "term", (F.col("w") / norm).alias("w"))


def vectors(postings: DataFrame, doc: str = "doc") -> DataFrame:
    """(doc, vector): a document's postings as one array of (term, w), bounded by its distinct terms."""
    return postings.groupBy(doc).agg(F.sort_array(F.collect_list(F.struct("term", "w"))).alias("vector"))


def vector_dot(a: Column, b: Column) -> Column:
    """Dot product of two such arrays (null: no terms): both are short, so each
    term of one is looked up in the other, and nothing is shuffled."""
    hit = lambda t: F.aggregate(b, F.lit(0.0), lambda s, y: s + F.when(y["term"] == t["term"], y["w"]).otherwise(0.0))
    return F.coalesce(F.aggregate(a, F.lit(0.0), lambda s, x: s + x["w"] * hit(x)), F.lit(0.0))


def packed_vectors(docs: DataFrame, vocab: DataFrame, doc: str = "doc", text: str = "text", max_features: int = 5000,
                   tokens: str | None = None) -> DataFrame:
    """(doc, vector): the normalised weights of ``transform`` as (term number, weight)
    records, a few bytes a term, made where the text is. The vocabulary is bounded."""
    rows = sorted(small_rows(vocab.select("term", "idf"), max_features), key=lambda r: r["term"])
    terms, idf = [r["term"] for r in rows], np.array([r["idf"] for r in rows], float)

    @arrow_udf("binary")
    def packed(tokens: pa.Array) -> pa.Array:
        at, ids = word_ids(tokens, pa.array(terms, pa.string()))
        cell, tf = np.unique(at * max(len(terms), 1) + ids, return_counts=True)
        at, out = cell // max(len(terms), 1), np.empty(len(cell), RECORD)
        out["term"] = cell % max(len(terms), 1)
        out["w"] = tf * idf[out["term"]]
        norm = np.sqrt(np.bincount(at, out["w"] * out["w"], len(tokens)))
        out["w"] /= norm[at]
        ends = np.cumsum(np.bincount(at, minlength=len(tokens))) * RECORD.itemsize
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(tokens), [None, pa.py_buffer(offsets), pa.py_buffer(out.tobytes())])

    return docs.select(doc, packed(tokens_of(text, tokens)).alias("vector"))


def unpacked(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, record) of all terms of packed vectors, in order."""
    raw = pc.fill_null(vectors.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    return np.repeat(np.arange(len(raw)), np.diff(offsets) // RECORD.itemsize), data.view(RECORD)


def packed_dots(a: pa.Array, b: pa.Array) -> pa.Array:
    """Dot products of packed vectors (null: no terms), summed in the terms' order."""
    if not len(a):
        return pa.array([], pa.float64())
    (x, left), (y, right) = unpacked(a), unpacked(b)
    wide = np.int64(1) << 32
    _, i, j = np.intersect1d(x * wide + left["term"], y * wide + right["term"], assume_unique=True, return_indices=True)
    return pa.array(np.bincount(x[i], left["w"][i] * right["w"][j], len(a)))


def meet(pairs: DataFrame, vectors: DataFrame, key: str, name: str, parts: int, heavy: list,
         how: str = "left") -> DataFrame:
    """The pairs with the vector of their ``key``, in so many parts that each holds few
    pairs. The ``heavy`` keys are spread over all parts."""
    spread = F.pmod(F.xxhash64(*[c for c in pairs.columns if not c.startswith("_")]), F.lit(parts)).cast("int")
    hot = F.coalesce(F.col(key).isin(heavy), F.lit(False)) if heavy else F.lit(False)
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
    right = vectors.select(F.col("doc").alias(key), F.col("vector").alias(name)).withColumn("_part", F.explode(copies))
    left = pairs.withColumn("_part", F.when(hot, spread).otherwise(0))
    return left.repartition(parts, key, "_part").join(right.repartition(parts, key, "_part"), [key, "_part"], how).drop("_part")


def pair_cosine(pairs: DataFrame, left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                name: str = "tfidf_similarity", part_pairs: int = PART_PAIRS, dot=packed_dots, how: str = "left") -> DataFrame:
    """H9: the pairs with the dot product of their ``packed_vectors``; pairs
    without a shared term get 0. Two joins of one packed row per document; no row per pair and
    term. A task of a join holds some ``part_pairs`` pairs; ``pairs`` are read several times.
    Other packed vectors come with their own ``dot``; ``how``: inner drops pairs without a vector."""
    n = one_row(pairs.agg(F.count(F.lit(1)).alias("n")))["n"]
    parts = max(pairs.sparkSession.sparkContext.defaultParallelism, math.ceil(n / part_pairs))
    both = pairs
    for key, vectors, side in ((left_key, left, "_left"), (right_key, right, "_right")):
        many = pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > part_pairs)
        heavy = [r[key] for r in small_rows(many, parts) if r[key] is not None]
        both = meet(both, vectors, key, side, parts, heavy, how)

    @arrow_udf("double")
    def dots(a: pa.Array, b: pa.Array) -> pa.Array:
        return dot(a, b)

    return both.select(*pairs.columns, dots(F.col("_left"), F.col("_right")).alias(name))


def top_terms(postings: DataFrame, doc_weight: DataFrame | None = None, doc: str = "doc",
              k: int = 20) -> DataFrame:
    """terms with the largest summed weight over the corpus rows."""
    p = postings
    w = F.col("w")
    if doc_weight is not None:
        p = p.join(doc_weight, doc)
        w = F.col("w") * F.col("weight")
    return (p.groupBy("term").agg(F.sum(w).alias("total_weight"))
             .orderBy(F.col("total_weight").desc(), F.col("term")).limit(k))
