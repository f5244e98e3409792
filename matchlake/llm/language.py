"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary.
The probability of a word is the sum over *all* its segmentations into pieces
(a forward recursion), a text's is the product over its words, and the language
with the largest one is predicted; the score is its posterior under equal
priors. The piece probabilities come from expectation maximisation over the
same lattice on a bounded sample of training texts per language.

Words are lower-cased runs of letters and their combining marks behind the
vocabulary's word mark; pieces are all its lower-case pieces of such characters, of
any length. Words of up to ``PART`` characters are worked out many at a time, longer
ones in blocks that carry the recursion over (only the fit cuts them). A character that no
piece covers is a piece of its own with a small fixed probability. A text that
is null or has no letter is ``und`` with score 0, as is every text if nothing
was learned. Ties go to the language that sorts first.

A text is *known* if the log probability a letter (word marks count) in its
language reaches ``FLOOR``: the posterior only compares the learned languages
and is near 1 for long texts in any other. Texts of fewer than ``EVIDENCE``
letters, and all texts with letters if nothing was learned, pass for known.

Rows are scored one by one; extra columns pass through.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from matchlake.llm.batches import id_remainder, text_slices, written

UNKNOWN = "und"
MARK = "▁"
PART, BLOCK = 32, 4096
PER_LANGUAGE, MAX_BYTES = 300, 100_000
#: Up to so many languages, the table of their sizes goes to every task; beyond, it is joined.
FEW_LANGUAGES = 20_000
ROUNDS, ALPHA = 4, 0.05
#: Probability of a character outside the vocabulary, and the factor per
#: character that keeps the recursion of a part within double range.
STRAY, LIFT = 1e-7, 100.0
#: Least mean log probability a letter of a known text, and the letters that it takes to reject one.
FLOOR, EVIDENCE = -3.5, 20
CACHE = 400_000
PLAIN_LETTERS = re.compile(r"[^\W\d_]+")
BUCKETS = 1 << 20


@lru_cache(1)
def marked_letters() -> tuple[re.Pattern, re.Pattern]:
    """(any combining mark, runs that begin with a letter and hold letters and marks)."""
    def ranges(wanted) -> str:
        found, last = [], -2
        for c in filter(wanted, range(sys.maxunicode + 1)):
            if c == last + 1:
                found[-1][1] = c
            else:
                found.append([c, c])
            last = c
        return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in found)

    marks = ranges(lambda c: unicodedata.category(chr(c))[0] == "M")
    letters = ranges(lambda c: chr(c).isalpha())
    return re.compile(f"[{marks}]"), re.compile(f"[{letters}][{letters}{marks}]*")


def is_letter_or_mark(c: str) -> bool:
    return c.isalpha() or unicodedata.category(c)[0] == "M"


@lru_cache(2)
def vocabulary(path: str) -> dict[str, int]:
    """Lower-case pieces, numbered from 1 (0 stands for a stray character)."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = {model.id_to_piece(i) for i in range(model.get_piece_size())
             if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    kept = sorted(n for n in names if n == n.lower() and all(c == MARK or is_letter_or_mark(c) for c in n))
    return {n: i for i, n in enumerate(kept, 1)}


@lru_cache(2)
def longest_piece(path: str) -> int:
    return max(map(len, vocabulary(path)), default=1)


@lru_cache(2)
def trie(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The vocabulary as a trie: sorted keys (node, character), the child of
    each key, and the piece that ends at each node (0: none)."""
    pieces, nodes = vocabulary(path), {"": 0}
    for name in sorted(pieces):
        for i in range(1, len(name) + 1):
            nodes.setdefault(name[:i], len(nodes))
    keys = np.array([nodes[n[:-1]] << 21 | ord(n[-1]) for n in nodes if n], np.int64)
    child = np.array([i for n, i in nodes.items() if n], np.int64)
    order = np.argsort(keys)
    return keys[order], child[order], np.array([pieces.get(n, 0) for n in nodes], np.int64)


def words_in(text: str) -> list[str]:
    """Marked, lower-cased words."""
    text = text.lower()
    if text.isascii() or not marked_letters()[0].search(text):
        found = PLAIN_LETTERS.findall(text)
        if not all(map(str.isalpha, found)):  # other numerals are no letters
            found = marked_letters()[1].findall(text)
    else:
        found = marked_letters()[1].findall(text)
    return [MARK + w for w in found]


def cut_words(counts: Counter) -> Counter:
    """Words longer than ``PART`` in parts: for the fit only."""
    out: Counter[str] = Counter()
    for word, n in counts.items():
        for i in range(0, len(word), PART):
            out[word[i:i + PART]] += n
    return out


class Lattice:
    """All pieces of many words of similar length: ``piece[i, n, w]`` is the
    piece of n + 1 characters at place i of word w (-1: none, 0: a stray)."""

    def __init__(self, words: list[str], path: str):
        keys, child, ends = trie(path)
        self.n, self.length = len(words), np.fromiter(map(len, words), np.int64, len(words))
        self.size = int(self.length.max(initial=0))
        padded = np.array(words, f"U{max(1, self.size)}") if words else np.zeros(0, "U1")
        letters = padded.view(np.uint32).reshape(self.n, max(1, self.size)).T.astype(np.int64)
        self.longest = min(longest_piece(path), max(1, self.size))
        self.piece = np.full((self.size, self.longest, self.n), -1, np.int64)
        place, word = np.nonzero(letters[:self.size] > 0)
        node = np.zeros(len(place), np.int64)
        for n in range(self.longest):
            key = node << 21 | letters[place + n, word]
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[at] == key
            if n == 0:
                self.piece[place, 0, word] = 0
            place, word, node = place[hit], word[hit], child[at[hit]]
            piece = ends[node]
            full = piece > 0
            self.piece[place[full], n, word[full]] = piece[full]
            inside = place + n + 1 < self.size
            place, word, node = place[inside], word[inside], node[inside]
        #: Whether any word has a piece of a length at a place: most long ones are not there.
        self.present = (self.piece >= 0).any(2)

    def lift(self, probability: np.ndarray) -> list[np.ndarray]:
        """Probabilities times LIFT to the length, by length; the last row is for no piece."""
        padded = np.concatenate([probability, np.zeros((1, probability.shape[1]))])
        return [padded * LIFT ** (n + 1) for n in range(self.longest)]

    def forward(self, lifted: list[np.ndarray]) -> np.ndarray:
        """Scaled sums over the segmentations of each word's first k
        characters: array (k, word, language)."""
        alpha = np.zeros((self.size + 1, self.n, lifted[0].shape[1]))
        alpha[0] = 1.0
        for k in range(1, self.size + 1):
            for n in range(min(k, self.longest)):
                if self.present[k - n - 1, n]:
                    alpha[k] += alpha[k - n - 1] * lifted[n][self.piece[k - n - 1, n]]
        return alpha

    def log_sums(self, probability: np.ndarray) -> np.ndarray:
        """log probability of each word in each language."""
        alpha = self.forward(self.lift(probability))
        return np.log(alpha[self.length, np.arange(self.n)]) - (self.length * np.log(LIFT))[:, None]

    def expected(self, probability: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece: (piece, language); counts: (word, language)."""
        lifted, index = self.lift(probability), np.arange(self.n)
        alpha = self.forward(lifted)
        beta = np.zeros_like(alpha)
        beta[self.length, index] = 1.0
        share, use = counts / alpha[self.length, index], np.zeros((len(probability) + 1, counts.shape[1]))
        for k in range(self.size - 1, -1, -1):
            for n in range(min(self.size - k, self.longest)):
                if not self.present[k, n]:
                    continue
                onward = beta[k + n + 1] * lifted[n][self.piece[k, n]]
                beta[k] += onward
                mass = alpha[k] * onward * share
                for j in range(mass.shape[1]):
                    use[:, j] += np.bincount(self.piece[k, n] % len(use), mass[:, j], len(use))
        return use[:-1]


def long_word_sums(word: str, probability: np.ndarray, path: str) -> np.ndarray:
    """log probability of one long word in each language: the recursion runs
    through blocks of places, carries the last sums over and keeps them in range."""
    longest, done = longest_piece(path), 0
    padded = np.concatenate([probability, np.zeros((1, probability.shape[1]))])
    window = np.zeros((longest, probability.shape[1]))  # sums up to the last places, the latest first
    window[0] = 1.0
    scale = np.zeros(probability.shape[1])
    while done < len(word):
        # piece[i, n] ends behind place done + i: look it up where it begins.
        first = max(0, done - longest + 1)
        text = word[first:done + BLOCK]
        begins = Lattice([text], path).piece[:, :, 0]
        if begins.shape[1] < longest:
            begins = np.pad(begins, ((0, 0), (0, longest - begins.shape[1])), constant_values=-1)
        ends = np.arange(done - first, len(text))
        at = ends[:, None] - np.arange(longest)[None]
        piece = np.where(at >= 0, begins[np.maximum(at, 0), np.arange(longest)[None]], -1)
        for row in padded[piece]:
            total = (window * row).sum(0)
            scale += np.log(total)
            window = np.concatenate([np.ones((1, len(total))), window[:-1] / total])
        done += len(ends)
    return scale


def lattices(words: list[str], path: str, step: int = 8000) -> Iterator[tuple[np.ndarray, Lattice]]:
    """(positions, lattice) of the words in runs of similar length."""
    order = np.argsort(np.fromiter(map(len, words), np.int64, len(words)), kind="stable")
    for i in range(0, len(words), step):
        part = order[i:i + step]
        yield part, Lattice([words[w] for w in part.tolist()], path)


@dataclass
class PieceModel:
    languages: list[str]
    probability: np.ndarray  # (piece, language); row 0 is the stray character
    path: str


def fit(counts: dict[str, Counter], path: str, rounds: int = ROUNDS) -> PieceModel:
    """Piece probabilities per language from word counts."""
    counts = {x: cut_words(c) for x, c in counts.items()}
    languages = sorted(counts)
    size = len(vocabulary(path)) + 1
    words = sorted(set().union(*counts.values())) if counts else []
    weights = np.array([[counts[x][w] for x in languages] for w in words], np.float64).reshape(len(words), len(languages))
    probability = np.full((size, len(languages)), 1.0 / size)
    probability[0] = STRAY
    parts = [(part, weights[at]) for at, part in lattices(words, path)]
    for _ in range(rounds):
        use = sum((part.expected(probability, w) for part, w in parts), np.zeros_like(probability)) + ALPHA
        use[0] = 0.0
        probability = use / use.sum(0) * (1 - STRAY)
        probability[0] = STRAY
    return PieceModel(languages, probability, path)


class WordScores:
    """Rows of log probabilities of the words met, up to a bounded number."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.place: dict[str, int] = {}
        self.rows = np.zeros((0, len(self.model.languages)))

    def add(self, words: list[str]) -> np.ndarray:
        """The row of each word."""
        fresh = list(set(words) - self.place.keys())
        if len(self.place) + len(fresh) > CACHE and self.place:
            self.clear()
            fresh = list(set(words))
        if fresh:
            new = np.empty((len(fresh), len(self.model.languages)))
            short = np.array([i for i, w in enumerate(fresh) if len(w) <= PART + 1], np.int64)
            for at, part in lattices([fresh[i] for i in short.tolist()], self.model.path):
                new[short[at]] = part.log_sums(self.model.probability)
            for i in set(range(len(fresh))) - set(short.tolist()):
                new[i] = long_word_sums(fresh[i], self.model.probability, self.model.path)
            self.place.update(zip(fresh, range(len(self.rows), len(self.rows) + len(fresh)), strict=True))
            self.rows = np.concatenate([self.rows, new])
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def rows_sum(self, words: list[str]) -> np.ndarray:
        places = self.add(words)  # which may replace the rows
        return self.rows[places].sum(0)


def parts_of(text: str, limit: int = 1 << 20) -> Iterator[str]:
    """A long text in parts cut at white space (a stretch without any stays whole)."""
    at = 0
    while len(text) - at > limit:
        cut = max(text.rfind(c, at, at + limit) for c in " \n\t") + 1
        if cut <= at:
            cut = min((p for c in " \n\t" if (p := text.find(c, at + limit)) >= 0), default=len(text) - 1) + 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def score_texts(texts: pa.Array, scores: WordScores) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, posterior, whether the language is known) of each text."""
    names, best = scores.model.languages, []
    posterior, known = np.zeros(len(texts)), np.zeros(len(texts), bool)
    for a, b, part in text_slices(texts, 1 << 20):
        total, seen, letters = np.zeros((b - a, len(names))), np.zeros(b - a, bool), np.zeros(b - a, np.int64)
        words, owner = [], []
        for i, text in enumerate(part):
            for chunk in parts_of(text.decode("utf-8", "replace")):
                found = words_in(chunk)
                if len(part) == 1 and found and names:
                    total[0] += scores.rows_sum(found)
                else:
                    words += found
                    owner.append((i, len(found)))
                seen[i] |= bool(found)
                letters[i] += sum(map(len, found))
        if words and names:
            places = scores.add(words)
            counts = np.array([n for _, n in owner])
            who = np.array([i for i, _ in owner])[counts > 0]
            cut = (np.cumsum(counts) - counts)[counts > 0]
            np.add.at(total, who, np.add.reduceat(scores.rows[places], cut))
        if names:
            top = total.argmax(1)
            share = 1.0 / np.exp(total - total[np.arange(b - a), top][:, None]).sum(1)
            posterior[a:b] = np.where(seen, share, 0.0)
            known[a:b] = seen & ((letters < EVIDENCE) | (total.max(1) >= FLOOR * letters))
            best += [names[k] if s else UNKNOWN for k, s in zip(top.tolist(), seen.tolist(), strict=True)]
        else:
            best += [UNKNOWN] * (b - a)
            known[a:b] = seen
    return best, posterior, known


def language(text: Column | str, model: PieceModel) -> Column:
    """struct(lang_pred, score, known) of a text column."""
    @arrow_udf("struct<lang_pred:string,score:double,known:boolean>")
    def identified(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scores = WordScores(model)
        for texts in batches:
            names, posterior, known = score_texts(texts, scores)
            yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(posterior), pa.array(known)],
                                             ["lang_pred", "score", "known"])

    return identified(F.col(text) if isinstance(text, str) else text)


def sample_counts(docs: DataFrame, folds: int = 4, held: int = 2, per_language: int = PER_LANGUAGE,
                  max_bytes: int = MAX_BYTES) -> dict[str, Counter]:
    """Word counts per language over about ``per_language`` training texts of
    each, drawn by a hash of id and text; equal texts count once. Texts over
    ``max_bytes`` are not drawn. Any number of languages is learned."""
    usable = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()
                        & (id_remainder("doc_id", folds) != held))
    sizes = written(usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "languages")
    few = sizes.limit(FEW_LANGUAGES + 1).count() <= FEW_LANGUAGES
    share = F.least(F.lit(1.0), F.lit(float(per_language)) / F.col("n"))
    drawn = (usable.where(F.octet_length("text") <= max_bytes).select("lang", "text", F.col("doc_id").alias("id"))
             .join(F.broadcast(sizes) if few else sizes, "lang").where(F.pmod(F.xxhash64("id", F.substring("text", 1, 64)), F.lit(BUCKETS)) < share * BUCKETS)
             .select("lang", "text").distinct())
    counts: dict[str, Counter] = {}
    for lang, text in drawn.toLocalIterator():
        counts.setdefault(lang, Counter()).update(words_in(text))
    for r in sizes.select("lang").toLocalIterator():  # a language without a drawn text is learned from none
        counts.setdefault(r["lang"], Counter())
    return counts


def fitted(docs: DataFrame, path: str, folds: int = 4, held: int = 2) -> PieceModel:
    return fit(sample_counts(docs, folds, held), path)
