"""Benchmark decontamination with a BM25 index and block-max WAND.

Test items go into an inverted index; a posting's impact is the term's BM25
weight in the item divided by the item's score against itself, so an item's
threshold is the same share of its own score for all. Every training text is
cut into passages (windows of twice the longest item, every longest item, so a
copied item lies whole in one), and every passage is a query that retrieves
*all* items above the threshold:

* upper bounds first: per item range, the best impact of each distinct term of
  a passage; passages whose sum stays below the threshold in every range cannot
  hold an item;
* block-max WAND on the others: terms' best impacts choose the pivot item,
  blocks of postings are skipped on their own maxima, survivors are scored.

A retrieved item counts as contamination if at least ``SIMILARITY`` of its
five-word shingles occur in the passage, and at least ``PART_OVERLAP`` of the
shingles of its question and of its answer, each. The question is the first two
thirds of the item's words, the answer the rest. An item of fewer than five words
is one shingle, its whole word sequence (of one word: question and answer alike).

Words are lower-cased and cut at white space and ASCII punctuation. Null items and
items without words are left out; repeated items are found once per id. Null and
empty texts hold no item. The index of a benchmark part goes to every task; a
benchmark over ``PART_BYTES`` is split into parts, each with the whole benchmark's
document frequencies. The texts are queried against one part after the other, each
part's finds are written, and the driver holds one part at a time.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from matchlake.llm.batches import byte_parts, plain_words, text_slices, written

SHINGLE, SIMILARITY, PART_OVERLAP, THRESHOLD = 5, 0.8, 0.5, 0.6
K1, B = 1.2, 0.75
RANGE_ITEMS, MAX_RANGES, BLOCK = 4, 256, 8
PART_BYTES = 16 << 20
LONG_TEXT = 4 << 20
FOUND = "array<struct<item_id:long,bm25_share:double,similarity:double,question_overlap:double,answer_overlap:double>>"


def shingles(words: list[bytes]) -> set[tuple]:
    n = min(SHINGLE, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


class Index:
    """Impacts of a benchmark part. ``frequency`` (term -> items) and the item
    count cover the whole benchmark."""

    def __init__(self, items: list[tuple[int, bytes]], frequency: dict[bytes, int], n_items: int, mean_words: float):
        parsed = [(i, w) for i, t in items if (w := plain_words(t))]
        parsed = sorted({(i, tuple(w)) for i, w in parsed})
        self.ids = [i for i, _ in parsed]
        self.longest = max((len(w) for _, w in parsed), default=SHINGLE)
        self.parts = []
        rows: dict[bytes, list[tuple[int, float]]] = {}
        for number, (_, words) in enumerate(parsed):
            words = list(words)
            cut = max(1, min(len(words) - 1, -(-2 * len(words) // 3)))
            self.parts.append((shingles(words), shingles(words[:cut]), shingles(words[cut:] or words)))
            length = K1 * (1 - B + B * len(words) / mean_words)
            weight = {w: math.log(1 + (n_items - frequency[w] + 0.5) / (frequency[w] + 0.5))
                      * n * (K1 + 1) / (n + length) for w, n in Counter(words).items()}
            total = sum(weight.values())
            for w, x in weight.items():
                rows.setdefault(w, []).append((number, x / total))
        self.terms = {w: k for k, w in enumerate(sorted(rows))}
        self.postings = [(np.array([i for i, _ in rows[w]]), np.array([x for _, x in rows[w]])) for w in self.terms]
        self.best = [float(x.max()) for _, x in self.postings]
        #: Of each block of postings: its last item and its largest impact.
        self.blocks = [(i[BLOCK - 1::BLOCK].tolist() + ([int(i[-1])] if len(i) % BLOCK else []),
                        [float(x[k:k + BLOCK].max()) for k in range(0, len(x), BLOCK)]) for i, x in self.postings]
        span = max(RANGE_ITEMS, -(-len(parsed) // MAX_RANGES))
        self.ranges = np.zeros((len(self.terms), max(1, -(-len(parsed) // span))), np.float32)
        for k, (i, x) in enumerate(self.postings):
            np.maximum.at(self.ranges[k], i // span, x)

    def wand(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """(item number, score) of every item whose impacts over the terms sum
        to the threshold."""
        lists = [[self.postings[t][0].tolist(), self.postings[t][1], self.best[t], *self.blocks[t], 0] for t in terms]
        found, slack = [], threshold - 1e-12
        while True:
            lists = sorted((x for x in lists if x[5] < len(x[0])), key=lambda x: x[0][x[5]])
            bound, pivot = 0.0, None
            for k, x in enumerate(lists):
                bound += x[2]
                if bound >= slack:
                    pivot = k
                    break
            if pivot is None:
                return found
            item = lists[pivot][0][lists[pivot][5]]
            while pivot + 1 < len(lists) and lists[pivot + 1][0][lists[pivot + 1][5]] == item:
                pivot += 1
            held = lists[:pivot + 1]
            bound, until = 0.0, len(self.ids)
            for x in held:
                b = x[5] // BLOCK
                while b < len(x[3]) and x[3][b] < item:
                    b += 1
                if b < len(x[3]):
                    bound += x[4][b]
                    until = min(until, x[3][b] + 1)
            if bound >= slack:
                for x in held:
                    while x[5] < len(x[0]) and x[0][x[5]] < item:
                        x[5] += 1
                score = sum(float(x[1][x[5]]) for x in held if x[5] < len(x[0]) and x[0][x[5]] == item)
                if score >= slack:
                    found.append((item, score))
                until = item + 1
            else:  # no item before the nearest block end, or the next list's item, can reach it
                if pivot + 1 < len(lists):
                    until = min(until, lists[pivot + 1][0][lists[pivot + 1][5]])
                until = max(until, item + 1)
            for x in held:
                while x[5] < len(x[0]) and x[0][x[5]] < until:
                    x[5] += 1

    def candidates(self, texts: list[list[bytes]], threshold: float) -> list[tuple[int, int, list[int]]]:
        """(text, first word, distinct terms) of the passages that some range's
        upper bound lets through."""
        if not self.terms:
            return []
        get, size = self.terms.get, self.longest
        counts = np.array([len(w) for w in texts])
        term = np.array([get(w, -1) for words in texts for w in words], np.int64)
        if not len(term):
            return []
        per = -(-counts // size)
        first_stretch = np.cumsum(per) - per
        begin = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(texts)), counts)
        stretch = first_stretch[owner] + (np.arange(len(term)) - begin[owner]) // size
        known = term >= 0
        # A passage is a stretch and the next one of the same text.
        passage = np.concatenate([stretch[known], stretch[known] - 1])
        inside = np.append(np.ones(int(known.sum()), bool), stretch[known] > first_stretch[owner[known]])
        pairs = np.unique(passage[inside] * len(self.terms) + np.tile(term[known], 2)[inside])
        if not len(pairs):
            return []
        at, distinct = pairs // len(self.terms), pairs % len(self.terms)
        heads = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
        tails = np.append(heads[1:], len(at))
        bound = np.add.reduceat(self.ranges[distinct], heads).max(1)
        out = []
        for k in np.flatnonzero(bound >= threshold - 1e-3).tolist():  # float32 sums, rounded down at most this much
            s = int(at[heads[k]])
            text = int(np.searchsorted(first_stretch, s, "right")) - 1
            out.append((text, (s - int(first_stretch[text])) * size, distinct[heads[k]:tails[k]].tolist()))
        return out

    def search(self, texts: list[list[bytes]], threshold: float = THRESHOLD) -> list[dict[int, tuple]]:
        """For each text (its words) the verified items: id -> (score share,
        similarity, question overlap, answer overlap), the best passage each."""
        out: list[dict[int, tuple]] = [{} for _ in texts]
        for text, at, terms in self.candidates(texts, threshold):
            hits = self.wand(terms, threshold)
            if not hits:
                continue
            there = shingles_of_passage(texts[text][at:at + 2 * self.longest], {len(next(iter(p)))
                                        for i, _ in hits for p in self.parts[i]})
            for item, score in hits:
                whole, question, answer = (len(p & there) / len(p) for p in self.parts[item])
                if whole >= SIMILARITY and question >= PART_OVERLAP and answer >= PART_OVERLAP:
                    row = (score, whole, question, answer)
                    key = self.ids[item]
                    if row > out[text].get(key, ()):
                        out[text][key] = row
        return out


def shingles_of_passage(words: list[bytes], lengths: set[int]) -> set[tuple]:
    return {tuple(words[i:i + n]) for n in lengths for i in range(len(words) - n + 1)}


def search_texts(texts: pa.Array, index: Index, threshold: float = THRESHOLD) -> list[dict[int, tuple]]:
    out: list[dict[int, tuple]] = []
    for a, b, part in text_slices(texts, 1 << 20):
        if b - a == 1 and len(part[0]) > LONG_TEXT:  # parts that share a passage's length of words
            found, tail = {}, []
            for piece in byte_parts(part[0], LONG_TEXT):
                words = tail + plain_words(piece)
                for key, row in index.search([words], threshold)[0].items():
                    found[key] = max(row, found.get(key, ()))
                tail = words[-2 * index.longest:]
            out.append(found)
        else:
            out += index.search([plain_words(t) for t in part], threshold)
    return out


def indexes(benchmark: DataFrame, part_bytes: int = PART_BYTES) -> Iterator[tuple[Index, int]]:
    """(index, number of parts) of the benchmark's parts of about ``part_bytes`` of text, one at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text") \
        .where(F.col("item_id").isNotNull() & F.col("text").isNotNull()).distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = max(1, -(-total // part_bytes))

    @arrow_udf("array<string>")
    def split(texts: pa.Array) -> pa.Array:
        return pa.array([[w.decode() for w in plain_words(t)]
                         for _, _, part in text_slices(texts) for t in part], pa.list_(pa.string()))

    worded = items.withColumn("words", split("text")).where(F.size("words") > 0)
    n, mean = worded.agg(F.count(F.lit(1)), F.avg(F.size("words"))).first()
    if not n:
        return
    frequency = worded.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word") \
        .agg(F.count(F.lit(1)).alias("n"))
    for k in range(n_parts):
        part = worded.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_parts)) == k)
        rows = [(r["item_id"], r["text"].encode()) for r in part.select("item_id", "text").toLocalIterator()]
        needed = part.select(F.explode("words").alias("word")).distinct()
        known = {r["word"].encode(): r["n"] for r in frequency.join(needed, "word").toLocalIterator()}
        yield Index(rows, known, n, mean), n_parts


def found_items(text: Column | str, index: Index, threshold: float = THRESHOLD) -> Column:
    """The verified items of a text column, as an array of structs."""
    @arrow_udf(FOUND)
    def searched(texts: pa.Array) -> pa.Array:
        rows = [[dict(zip(("item_id", "bm25_share", "similarity", "question_overlap", "answer_overlap"), (k, *v),
                          strict=True)) for k, v in sorted(found.items())]
                for found in search_texts(texts, index, threshold)]
        kind = pa.struct([("item_id", pa.int64()), *((c, pa.float64()) for c in (
            "bm25_share", "similarity", "question_overlap", "answer_overlap"))])
        return pa.array(rows, pa.list_(kind))

    return searched(F.col(text) if isinstance(text, str) else text)


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                 part_bytes: int = PART_BYTES) -> DataFrame:
    """(doc_id, item_id, bm25_share, similarity, question_overlap,
    answer_overlap) of every text that holds an item."""
    schema = docs.select("doc_id").schema
    out = None
    for index, parts in indexes(benchmark, part_bytes):
        hit = (docs.select("doc_id", F.explode(found_items("text", index, threshold)).alias("hit"))
               .select("doc_id", "hit.*"))
        hit = written(hit, "decontamination-part") if parts > 1 else hit
        out = hit if out is None else out.unionByName(hit)
    if out is None:
        empty = docs.sparkSession.createDataFrame([], schema)
        out = empty.select("doc_id", F.explode(F.lit(None).cast(FOUND)).alias("hit")).select("doc_id", "hit.*")
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
                    part_bytes: int = PART_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no item, unchanged."""
    out = docs
    for index, parts in indexes(benchmark, part_bytes):
        out = out.where(F.size(found_items("text", index, threshold)) == 0)
        out = written(out, "decontamination-part") if parts > 1 else out
    return out
