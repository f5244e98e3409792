"""Word and text vectors trained on the corpus.

1. *Co-occurrence.* Words of the vocabulary (the ``max_terms`` most frequent) that
   stand within ``window`` words of each other are counted over all texts: per
   batch in numpy, summed by Spark.
2. *Weights.* Positive pointwise mutual information of each pair, a sparse
   symmetric table (i, j, w), written once and dealt out by i.
3. *Range finder.* The table is multiplied with a random block of ``dim`` + 10
   columns, and again with the orthonormal basis of the product, ``rounds`` times.
   A product is one pass: the block (vocabulary x columns, a bounded size) goes to
   the tasks, each returns the rows it holds. The small matrix in the last basis
   gives the leading eigenvectors; a word's vector is its row, scaled by the root of
   the eigenvalues.

A text's vector is the idf-weighted mean of its words' vectors, with length 1 (all
zeros without known words). Null texts are empty.

Joins carry *packed* texts: the numbers of the known words in order, two bytes each
(four in a vocabulary past 65,536), or the vector itself where that is no longer. A
packed text gives the same vector, to the bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from matchlake.functions.text import clean, token_array
from matchlake.operators.small import one_row, small_rows
from matchlake.session import cut_lineage

MAX_TERMS, WINDOW, DIM, ROUNDS, EXTRA = 5000, 5, 64, 3, 10
PART_TOKENS = 1 << 19  # tokens whose pairs a task holds at a time
VECTOR_TOKENS = 1 << 15  # tokens whose vectors it holds
PART_PAIRS = 1 << 12  # pairs whose vectors it holds


@dataclass
class WordVectors:
    """The vocabulary in order, idf and vector of each term."""

    terms: list[str]
    idf: np.ndarray
    vectors: np.ndarray

    @property
    def dim(self) -> int:
        return self.vectors.shape[1]


def word_ids(tokens: pa.Array, terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text number, term number) of the known words of token lists, in order."""
    if isinstance(tokens, pa.ChunkedArray):
        tokens = tokens.combine_chunks()
    at = np.repeat(np.arange(len(tokens)), pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False))
    ids = pc.fill_null(pc.index_in(tokens.flatten(), value_set=terms), -1).to_numpy(zero_copy_only=False)
    return at[ids >= 0], ids[ids >= 0].astype(np.int64)


def light_parts(tokens: pa.Array, most: int) -> Iterator[tuple[int, pa.Array]]:
    """(first text, token lists) of stretches of at most ``most`` tokens, or of one text."""
    if isinstance(tokens, pa.ChunkedArray):
        tokens = tokens.combine_chunks()
    ends = np.cumsum(pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    begin = 0
    while begin < len(ends):
        before = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, before + most, "right")))
        yield begin, tokens.slice(begin, stop - begin)
        begin = stop


def text_sums(at: np.ndarray, ids: np.ndarray, vectors: np.ndarray, texts: int, most: int) -> np.ndarray:
    """The sum of each text's vectors, of at most ``most`` tokens at a time. Stretches end
    where a text does or, in a longer text, every ``most`` tokens from its start, so the sums
    do not depend on the texts beside it."""
    out = np.zeros((texts, vectors.shape[1]))
    ends = np.append(np.flatnonzero(at[1:] != at[:-1]) + 1, len(at))
    begin = 0
    while begin < len(at):
        k = int(np.searchsorted(ends, begin + most, "right")) - 1
        stop = int(ends[k]) if k >= 0 and ends[k] > begin else begin + most
        part = at[begin:stop]
        first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        out[part[first]] += np.add.reduceat(vectors[ids[begin:stop]], first, 0)
        begin = stop
    return out


def vocabulary(tokens: DataFrame, max_terms: int) -> tuple[list[str], np.ndarray]:
    """The most frequent terms (ties by term) with idf over the texts."""
    n = one_row(tokens.agg(F.count(F.lit(1)).alias("n")))["n"]
    once = tokens.select(F.explode(F.array_distinct("tokens")).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    often = tokens.select(F.explode("tokens").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("cf"))
    top = often.orderBy(F.col("cf").desc(), "term").limit(max_terms).join(once, "term")
    rows = sorted(small_rows(top, max_terms), key=lambda r: (-r["cf"], r["term"]))
    return [r["term"] for r in rows], np.array([np.log((1 + n) / (1 + r["df"])) + 1 for r in rows])


def counter(terms: list[str], window: int):
    """A function from batches of token lists to (i, j, n), ``PART_TOKENS`` tokens at a time."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, size = pa.array(terms), len(terms)
        for batch in batches:
            for _, part in light_parts(batch.column(0), PART_TOKENS):
                text, ids = word_ids(part, known)
                for begin in range(0, len(ids), PART_TOKENS):
                    pairs = [np.zeros(0, np.int64)]
                    for step in range(1, window + 1):
                        stop = min(begin + PART_TOKENS, len(ids) - step)
                        same = np.flatnonzero(text[begin + step:stop + step] == text[begin:stop]) + begin if stop > begin else pairs[0]
                        a, b = ids[same], ids[same + step]
                        pairs += [a * size + b, b * size + a]
                    pair, n = np.unique(np.concatenate(pairs), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array((pair // max(size, 1)).astype(np.int32)),
                                                      pa.array((pair % max(size, 1)).astype(np.int32)), pa.array(n.astype(np.int64))],
                                                     names=["i", "j", "n"])

    return counted


def pair_counts(tokens: DataFrame, terms: list[str], window: int) -> DataFrame:
    """(i, j, n): how often two terms stand within ``window`` known words of each other, both ways."""
    pairs = tokens.select("tokens").mapInArrow(counter(terms, window), "i int, j int, n long")
    return pairs.groupBy("i", "j").agg(F.sum("n").alias("n"))


def mutual_information(counts: DataFrame) -> DataFrame:
    """(i, j, w): positive pointwise mutual information, written and dealt out by i."""
    counts = cut_lineage(counts)
    rows = counts.groupBy("i").agg(F.sum("n").alias("ni"))  # a row per term; the table is symmetric
    total = one_row(counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")))["n"]
    w = F.log(F.col("n").cast("double") * F.lit(float(total)) / (F.col("ni").cast("double") * F.col("nj")))
    both = counts.join(rows, "i").join(rows.select(F.col("i").alias("j"), F.col("ni").alias("nj")), "j")
    return cut_lineage(both.select("i", "j", w.alias("w")).where("w > 0").repartition("i"))


def product(table: DataFrame, block: np.ndarray) -> np.ndarray:
    """The (i, j, w) matrix times a block: each task sums the rows it holds."""
    sent = table.sparkSession.sparkContext.broadcast(block)

    def multiplied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right = sent.value
        out: dict[int, np.ndarray] = {}
        for batch in batches:
            i, j, w = (batch.column(c).to_numpy() for c in range(3))
            order = np.argsort(i, kind="stable")
            i, parts = i[order], w[order, None] * right[j[order]]
            first = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else np.zeros(0, np.int64)
            for at, sums in zip(i[first].tolist(), np.add.reduceat(parts, first, 0) if len(i) else []):
                out[at] = out[at] + sums if at in out else sums
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.int32()), pa.array([v.tolist() for v in out.values()],
                                                                                   pa.list_(pa.float64()))], names=["i", "v"])

    parts = table.select("i", "j", "w").mapInArrow(multiplied, "i int, v array<double>")
    whole = np.zeros_like(block)
    for r in small_rows(parts, block.shape[0] * 2):  # a row of the block each: tasks share no i
        whole[r["i"]] += r["v"]
    sent.destroy()
    return whole


def leading_vectors(table: DataFrame, size: int, dim: int, rounds: int = ROUNDS, seed: int = 42) -> np.ndarray:
    """(size, dim): the leading eigenvectors of a symmetric table, by falling
    size of the eigenvalue, scaled by the root of that size; each sign makes the largest entry positive."""
    width = min(size, dim + EXTRA)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, width)))[0]
    for _ in range(rounds):
        basis = np.linalg.qr(product(table, basis))[0]
    small = basis.T @ product(table, basis)
    values, turned = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-np.abs(values))[:dim]
    out = basis @ turned[:, order] * np.sqrt(np.abs(values[order]))
    signs = np.sign(out[np.abs(out).argmax(0), np.arange(out.shape[1])])
    return out * np.where(signs == 0, 1, signs)


def token_rows(texts: DataFrame, text: str) -> DataFrame:
    return texts.select(token_array(clean(F.col(text))).alias("tokens"))


def train(texts: DataFrame, text: str = "text", max_terms: int = MAX_TERMS, window: int = WINDOW, dim: int = DIM) -> WordVectors:
    """Word vectors of a corpus. ``max_terms`` x (``dim`` + 10) numbers bound what the driver holds."""
    return train_tokens(cut_lineage(token_rows(texts, text)), max_terms, window, dim)


def train_tokens(tokens: DataFrame, max_terms: int = MAX_TERMS, window: int = WINDOW, dim: int = DIM) -> WordVectors:
    """``train`` on a written table of token lists."""
    terms, idf = vocabulary(tokens, max_terms)
    if not terms:
        return WordVectors([], np.zeros(0), np.zeros((0, dim)))
    table = mutual_information(pair_counts(tokens, terms, window))
    found = leading_vectors(table, len(terms), dim)
    return WordVectors(terms, idf, np.pad(found, ((0, 0), (0, dim - found.shape[1]))))


def unit_vectors(tokens: pa.Array, known: pa.Array, weighted: np.ndarray) -> np.ndarray:
    """(texts, dim): the vectors of token lists."""
    out = np.zeros((len(tokens), weighted.shape[1]))
    for begin, part in light_parts(tokens, PART_TOKENS):
        at, ids = word_ids(part, known)
        out[begin:begin + len(part)] = text_sums(at, ids, weighted, len(part), VECTOR_TOKENS)
    return unit_length(out)


def unit_length(out: np.ndarray) -> np.ndarray:
    length = np.sqrt((out * out).sum(1, keepdims=True))
    return np.divide(out, length, out=np.zeros_like(out), where=length > 0)


def text_vector(text: Column, words: WordVectors) -> Column:
    """The vector of a text, an array of ``dim`` doubles."""
    weighted = words.vectors * words.idf[:, None]

    @arrow_udf("array<double>")
    def vectors(tokens: pa.Array) -> pa.Array:
        out = unit_vectors(tokens, pa.array(words.terms, pa.string()), weighted)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * words.dim), pa.array(out.ravel()))

    return vectors(token_array(clean(text)))


def number_type(words: WordVectors) -> np.dtype:
    return np.dtype("<u2" if len(words.terms) <= 1 << 16 else "<u4")


def packed_text(tokens: Column, words: WordVectors) -> Column:
    """The packed text of a token list. ``dim`` doubles long: the vector; else shorter: word numbers."""
    weighted, kind = words.vectors * words.idf[:, None], number_type(words)

    @arrow_udf("binary")
    def packed(lists: pa.Array) -> pa.Array:
        known, out = pa.array(words.terms, pa.string()), []
        for _, part in light_parts(lists, PART_TOKENS):
            at, ids = word_ids(part, known)
            ends = np.cumsum(np.bincount(at, minlength=len(part)))
            raw, last = ids.astype(kind).tobytes(), 0
            for i, end in enumerate((ends * kind.itemsize).tolist()):
                whole = end - last >= words.dim * 8
                out.append(unit_vectors(part.slice(i, 1), known, weighted).tobytes() if whole else raw[last:end])
                last = end
        return pa.array(out, pa.binary())

    return packed(tokens)


def packed_matrix(texts: pa.Array, weighted: np.ndarray, kind: np.dtype) -> np.ndarray:
    """(texts, dim): the vectors of packed texts."""
    raw, dim = texts.to_pylist(), weighted.shape[1]
    length = np.array([len(b) for b in raw], np.int64)
    whole, out = length == dim * 8, np.zeros((len(raw), dim))
    short = np.flatnonzero(~whole)
    ids = np.frombuffer(b"".join(raw[i] for i in short), kind).astype(np.int64)
    at = np.repeat(np.arange(len(short)), length[short] // kind.itemsize)
    out[short] = unit_length(text_sums(at, ids, weighted, len(short), VECTOR_TOKENS))
    if whole.any():
        out[whole] = np.frombuffer(b"".join(raw[i] for i in np.flatnonzero(whole))).reshape(-1, dim)
    return out


def packed_dots(words: WordVectors):
    """A function from two arrays of packed texts to the dot products of their vectors,
    summed in the order of ``functions.text.dot``. A text that several pairs of a stretch share is unpacked once."""
    weighted, kind = words.vectors * words.idf[:, None], number_type(words)

    def dots(a: pa.Array, b: pa.Array) -> pa.Array:
        out = np.zeros(len(a))
        for begin in range(0, len(a), PART_PAIRS):
            x, y = (side.slice(begin, PART_PAIRS).dictionary_encode() for side in (a, b))
            i, j = (side.indices.to_numpy() for side in (x, y))
            left, right = (np.ascontiguousarray(packed_matrix(side.dictionary, weighted, kind).T) for side in (x, y))
            part = out[begin:begin + PART_PAIRS]
            for f in range(len(left)):
                part += left[f][i] * right[f][j]
        return pa.array(out)

    return dots
