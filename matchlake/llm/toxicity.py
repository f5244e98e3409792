"""Toxicity by multiple-instance learning.

A document is a bag of sentences (ended by ``.``, ``!``, ``?`` or a line
break). A sentence's score is a logistic function of its words' weights; the
document's is the noisy-or of its sentences: 1 - prod(1 - p). Only documents
are labelled; the gradient of the bag's likelihood shares the blame among its
sentences, and the learned sentence scores then locate the offending ones.

Words are lower-cased and cut at white space and ASCII punctuation; a word
repeated at once counts once. A word's weight is that of itself and of its
first four and five bytes, so inflected forms share evidence; weights are
not negative. Very long
texts are scored piecewise, cut at sentence ends: the noisy-or is a sum of
log(1 - p) over sentences. Null and empty texts have no sentence and score 0.
Rows are scored one by one; extra columns pass through.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from matchlake.llm.batches import slices
from matchlake.llm.labelled import labelled_sample

PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
PLAIN = bytes.maketrans(bytes(range(65, 91)) + PUNCTUATION, bytes(range(97, 123)) + b" " * len(PUNCTUATION))
ENDS = np.zeros(256, bool)
ENDS[[ord(c) for c in ".!?\n"]] = True
BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
MIN_DOCS, ROUNDS, RATE, PENALTY, SMALLEST = 10, 120, 0.15, 0.3, 0.05
PER_CLASS = 2000


def sentence_words(raw: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words, start of each word, sentence number of each word) of raw bytes."""
    plain = raw.tobytes().translate(PLAIN)
    solid = ~BLANK[np.frombuffer(plain, np.uint8)]
    starts = np.flatnonzero(solid & ~np.append(False, solid[:-1]))
    ends = np.flatnonzero(ENDS[raw])
    return plain.split(), starts, np.searchsorted(ends, starts)


def parted(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts with a line break between them: no word reaches into the next text."""
    return np.insert(raw, offsets[1:-1], 10), offsets + np.minimum(np.arange(len(offsets)), max(0, len(offsets) - 2))


def features(word: bytes) -> list[bytes]:
    """The word and its beginnings (white space marks a beginning)."""
    return [word, b" " + word[:4], b" " + word[:5]]


class WordScores(dict):
    """Score of each word met, kept up to a bounded number of words."""

    def __init__(self, weights: dict[bytes, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: bytes) -> float:
        if len(self) > 400_000:
            self.clear()
        score = self[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return score


@dataclass
class SentenceModel:
    weights: dict[bytes, float]
    bias: float

    def word_scores(self, words: list[bytes], opens: np.ndarray) -> np.ndarray:
        """Score of each word; one that repeats the word before it in its
        sentence has none. ``opens``: the first word of each sentence."""
        if "known" not in self.__dict__:
            self.known = WordScores(self.weights)
        scores = np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))
        again = np.append(False, np.fromiter(map(bytes.__eq__, words[1:], words), bool, max(0, len(words) - 1)))
        again[opens] = False
        scores[again] = 0.0
        return scores


def log_clean(margin: np.ndarray) -> np.ndarray:
    """log(1 - sigmoid(margin))."""
    return -np.logaddexp(0.0, margin)


def fit(texts: pa.Array, target: np.ndarray, weight: np.ndarray, rounds: int = ROUNDS) -> SentenceModel:
    """Word weights and bias by Adam on the weighted bag likelihood. Memory is
    eight bytes per word of the texts, beside what the distinct words need."""
    ids: dict[bytes, int] = {}
    parts, bags, n_sent, n_docs = [], [], 0, len(target)
    for a, _, raw, offsets in slices(texts, 1 << 20):  # a slice's words become numbers at once
        raw, offsets = parted(raw, offsets)
        w, starts, sentence = sentence_words(raw)
        number = np.fromiter((ids.setdefault(x, len(ids)) for x in w), np.int32, len(w))
        # a sentence does not cross texts
        key = (np.searchsorted(offsets, starts, "right") - 1 + a).astype(np.int64) << 32 | sentence
        if not len(w):
            continue
        opens = np.append(True, key[1:] != key[:-1])
        fresh = opens | np.append(True, number[1:] != number[:-1])
        parts.append((number[fresh], (np.cumsum(opens) - 1 + n_sent)[fresh].astype(np.int32)))
        bags.append((key[opens] >> 32).astype(np.int32))
        n_sent += len(bags[-1])
    if not n_sent or not 0 < (weight * target).sum() < weight.sum():
        return SentenceModel({}, -30.0 if not len(target) or not target.any() else 30.0)
    bag = np.concatenate(bags)
    named: dict[bytes, int] = {}
    of_word = np.array([[named.setdefault(f, len(named)) for f in features(w)] for w in ids], np.int32)
    del ids
    in_docs = np.zeros(len(named), np.int64)
    for word, sentence in parts:  # a text is in one slice
        both = np.unique(of_word[word].astype(np.int64) * n_docs + bag[sentence][:, None])
        in_docs += np.bincount(both // n_docs, minlength=len(named))
    usual = in_docs >= MIN_DOCS
    n_words = int(usual.sum())
    place = np.where(usual, np.cumsum(usual) - 1, n_words).astype(np.int32)[of_word]  # n_words: a rare feature
    theta = np.zeros(n_words + 1)
    share = (weight * target).sum() / weight.sum()
    theta[-1] = np.log(share / max(1.0, n_sent / n_docs))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    scale = weight / weight.sum()
    for step in range(1, rounds + 1):
        of_words = np.append(theta[:-1], 0.0)[place].sum(1)
        margin = np.full(n_sent, theta[-1])
        for word, sentence in parts:
            margin[sentence[0]:sentence[-1] + 1] += np.bincount(sentence - sentence[0], of_words[word])
        clean = np.bincount(bag, log_clean(margin), n_docs)
        toxic = -np.expm1(clean)
        blame = np.where(target == 1, -np.exp(clean) / np.maximum(toxic, 1e-12), 1.0) * scale
        slope = blame[bag] * np.exp(-np.logaddexp(0.0, -margin))
        of_words = np.zeros(len(place))
        for word, sentence in parts:
            of_words += np.bincount(word, slope[sentence], len(place))
        grad = np.bincount(place.ravel(), np.repeat(of_words, place.shape[1]), n_words + 1)[:-1]
        grad = np.append(grad + PENALTY / n_docs * theta[:-1], slope.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad * grad
        theta -= RATE * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-9)
        np.maximum(theta[:-1], 0.0, out=theta[:-1])  # a word can only add to the blame
    names = np.array(list(named), object)[usual]
    kept = np.abs(theta[:-1]) >= SMALLEST
    return SentenceModel(dict(zip(names[kept].tolist(), theta[:-1][kept].tolist(), strict=True)), float(theta[-1]))


def pieces(raw: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """The bytes in parts of about ``limit``, cut behind sentence ends, or at
    white space where there is none."""
    at = 0
    while len(raw) - at > limit:
        window = raw[at:at + limit]
        cut = np.flatnonzero(ENDS[window])
        if not len(cut):
            cut = np.flatnonzero(BLANK[window])
        size = int(cut[-1]) + 1 if len(cut) else limit
        yield raw[at:at + size]
        at += size
    yield raw[at:]


def score_texts(texts: pa.Array, model: SentenceModel, limit: int = 4 << 20) -> np.ndarray:
    out = np.zeros(len(texts))
    for a, b, raw, offsets in slices(texts, limit):
        raw, offsets = parted(raw, offsets)
        for part in pieces(raw, limit) if b == a + 1 else [raw]:
            words, starts, sentence = sentence_words(part)
            if not words:
                continue
            owner = np.searchsorted(offsets, starts, "right") - 1 if b > a + 1 else np.zeros(len(starts), np.int64)
            key = owner.astype(np.int64) << 32 | sentence
            cut = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            margin = np.add.reduceat(model.word_scores(words, cut), cut) + model.bias
            np.add.at(out, a + owner[cut], log_clean(margin))
    return -np.expm1(out)


def toxicity(text: Column | str, model: SentenceModel) -> Column:
    """Probability that the text is toxic."""
    @arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(score_texts(texts, model))

    return scored(F.col(text) if isinstance(text, str) else text)


def offending(text: Column | str, model: SentenceModel, least: float = 0.5) -> Column:
    """Sentences that score ``least`` or more: array of (begin byte, score, sentence)."""
    @arrow_udf("array<struct<begin:long,score:double,sentence:string>>")
    def located(texts: pa.Array) -> pa.Array:
        out = []
        for a, b, raw, offsets in slices(texts):
            for i in range(b - a):
                part = raw[offsets[i]:offsets[i + 1]]
                words, _, sentence = sentence_words(part)
                found = []
                if words:
                    cut = np.flatnonzero(np.append(True, sentence[1:] != sentence[:-1]))
                    p = 1 / (1 + np.exp(-np.add.reduceat(model.word_scores(words, cut), cut) - model.bias))
                    edges = np.concatenate([[0], np.flatnonzero(ENDS[part]) + 1, [len(part)]])
                    for k in np.flatnonzero(p >= least).tolist():
                        s = int(sentence[cut[k]])
                        found.append({"begin": int(edges[s]), "score": float(p[k]), "sentence":
                                      part[edges[s]:edges[s + 1]].tobytes().decode("utf-8", "replace").strip()})
                out.append(found)
        return pa.array(out, pa.list_(pa.struct([("begin", pa.int64()), ("score", pa.float64()),
                                                 ("sentence", pa.string())])))

    return located(F.col(text) if isinstance(text, str) else text)


def fitted(docs: DataFrame, labels: DataFrame, folds: int = 5) -> SentenceModel:
    """The model of a bounded sample of the labelled training rows."""
    sample = labelled_sample(docs, labels, "toxic", folds, PER_CLASS)
    texts, target, weight = (sample[c].combine_chunks() for c in ("text", "target", "weight"))
    del sample  # its texts are copied already
    return fit(texts, target.to_numpy(), weight.to_numpy())


def frequent_words(model: SentenceModel, n: int = 20) -> list[tuple[bytes, float]]:
    """The heaviest words, for inspection."""
    return Counter(model.weights).most_common(n)
