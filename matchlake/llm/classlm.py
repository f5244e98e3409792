"""Perplexity under Brown's class-based bigram model.

A word's probability after another is the transition probability between their
classes times the word's emission probability in its class. Tokens are
lower-cased (A-Z) words ``[^\\x20\\x09-\\x0D]+`` and one end per text, which is
also what the first word follows.

Everything is counted over all training texts:

1. word counts: counted per task, summed by one shuffle;
2. *atoms*: the end, the ``TOP_WORDS`` most frequent words one by one, and all
   others pooled by a hash of their last three bytes; atom bigrams are counted per
   task and summed, and exchange clustering moves atoms between ``CLASSES``
   classes while the class bigram likelihood rises. That gives the classes a start;
3. *every other word* that occurs ``LEAST_COUNT`` times is then exchanged on its own:
   how often each class comes before and after it is a Spark table (a packed vector
   per word slot, merged over ``FAN`` tasks at a time), which grows with the vocabulary;
   each word goes to the class with the largest gain in likelihood against the class
   bigram matrix, worked out in tasks; all words of a round move at once;
4. class bigrams and the classes' tokens are counted again with the final classes.

The final class of a word is read from a table of 2^``SLOT_BITS`` slots by the word's
hash, a fixed 4 MB on every worker: words that share a slot share a class (1 in 50
of 80,000 words). Words in empty slots, rare or unseen, have their pool's class.

Emissions are ``(c + 0.1) / (n + 0.1 * (v + 1))`` with the class's tokens n and
distinct words v, transitions are smoothed towards the class unigram. The
baseline is the same formula over the whole vocabulary.

Scoring needs the exact count of every word of every text. Texts are dealt to
blocks of bounded bytes; a block asks the count table for its distinct words by
an equi-join and is scored next to the answer, so no task holds the vocabulary.

Null texts read as empty: one end. Rows are scored one by one, so repeated rows
and ids need no care; extra columns are ignored. With no training text all
counts are 0.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from matchlake.llm.batches import LOWER, SLICE_BYTES, id_remainder, slices, spark_size, written

FOLDS, ADD = 10, 0.1
TOP_WORDS, POOLS, CLASSES, PASSES, PULL = 767, 256, 64, 8, 10.0
LEAST_COUNT, SLOT_BITS, SLOT_BLOCK = 5, 22, 16
#: Tasks whose vectors of a slot are merged at a time.
FAN = 64
BLOCK_BYTES, FLUSH = 16 << 20, 300_000
END = b""


class AtomOf(dict):
    """Atom of a word: 0 the end, then the top words, then the pools. Words met
    are kept up to a bound."""

    def __init__(self, top: list[bytes]):
        super().__init__()
        self.fixed = {END: 0} | {w: i for i, w in enumerate(top, 1)}
        self.base = 1 + len(top)
        self.update(self.fixed)

    def __missing__(self, word: bytes) -> int:
        if len(self) > FLUSH:
            self.clear()
            self.update(self.fixed)
        atom = self[word] = self.base + zlib.crc32(word[-3:]) % POOLS
        return atom


# -- counting --------------------------------------------------------------


def text_parts(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The lower-cased texts in slices of about ``limit`` bytes, nulls as empty.
    Each slice is an array of its own: kernels have misread slices of larger arrays."""
    for a, b, raw, offsets in slices(texts, limit):
        yield pa.LargeStringArray.from_buffers(b - a, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
                                               pa.py_buffer(raw.tobytes().translate(LOWER)))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words of all texts, one behind the other; words of each text)."""
    pa.set_memory_pool(pa.system_memory_pool())  # gives memory back between slices
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    solid = pc.not_equal(flat, "")
    if not pc.all(solid).as_py():  # what white space at a text's ends leaves
        kept = solid.to_numpy(zero_copy_only=False).astype(np.int64)
        sums = np.append(0, np.cumsum(kept))
        edges = np.append(0, np.cumsum(sizes))
        sizes, flat = np.diff(sums[edges]), flat.filter(solid)
    return flat, sizes


def local_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """(distinct words, number of each token) of texts, an end (number 0) before, between and behind them."""
    flat, sizes = split_words(texts)
    coded = flat.dictionary_encode()
    ids = coded.indices.to_numpy().astype(np.int64) + 1
    ends = np.cumsum(sizes)
    return [END, *coded.dictionary.cast(pa.large_binary()).to_pylist()], np.insert(ids, np.append(0, ends), 0)


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n) of the texts of a task, slice by slice."""
    for batch in batches:
        for texts in text_parts(batch.column(0)):
            flat, sizes = split_words(texts)
            counts = flat.value_counts()
            words = pa.concat_arrays([counts.field("values").cast(pa.large_binary()), pa.array([END], pa.large_binary())])
            n = np.append(counts.field("counts").to_numpy(), len(sizes))
            yield pa.record_batch([words.cast(pa.binary()), pa.array(n)], names=["word", "n"])


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n) over all texts, written once."""
    parts = training.select("text").mapInArrow(count_words, "word binary, n long")
    return written(parts.groupBy("word").agg(F.sum("n").alias("n")), "word-counts")


def atom_pairs(training: DataFrame, top: list[bytes]) -> np.ndarray:
    """The atom bigram matrix of all texts."""
    size = 1 + len(top) + POOLS

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        atom, total = AtomOf(top), np.zeros(size * size, np.int64)
        for batch in batches:
            for texts in text_parts(batch.column(0)):
                words, run = local_words(texts)
                ids = np.fromiter(map(atom.__getitem__, words), np.int64, len(words))[run]
                total += np.bincount(ids[:-1] * size + ids[1:], minlength=size * size)
        met = np.flatnonzero(total)
        yield pa.record_batch([pa.array(met), pa.array(total[met])], names=["pair", "n"])

    table = (training.select("text").mapInArrow(pairs, "pair long, n long").groupBy("pair")
             .agg(F.sum("n").alias("n"))).toArrow()  # at most size * size rows
    matrix = np.zeros(size * size, np.int64)
    matrix[table["pair"].to_numpy()] = table["n"].to_numpy()
    return matrix.reshape(size, size)


# -- classes ---------------------------------------------------------------


def xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def likelihood(pairs: np.ndarray, of: np.ndarray, classes: int) -> float:
    """Log likelihood of the class bigrams, less terms that no class changes."""
    n = np.zeros((classes, classes))
    np.add.at(n, (of[:, None], of[None, :]), pairs)
    return float(xlogx(n).sum() - xlogx(n.sum(1)).sum() - xlogx(n.sum(0)).sum())


def exchange_classes(pairs: np.ndarray, classes: int = CLASSES, passes: int = PASSES) -> np.ndarray:
    """Class of each atom: from classes by frequency rank, atoms are moved one
    at a time to the class that raises the likelihood most."""
    pairs = pairs.astype(np.float64)
    size = len(pairs)
    classes = min(classes, size)
    rank = np.argsort(-(pairs.sum(0) + pairs.sum(1)), kind="stable")
    of = np.empty(size, np.int64)
    of[rank] = np.arange(size) % classes
    one = np.zeros((size, classes))
    one[np.arange(size), of] = 1.0
    to, back = pairs @ one, pairs.T @ one  # what follows and precedes each atom, by class
    table = one.T @ to
    for _ in range(passes):
        moved = 0
        for w in rank.tolist():
            own, here = pairs[w, w], of[w]
            out, into = to[w].copy(), back[w].copy()
            out[here] -= own
            into[here] -= own
            table[here] -= out
            table[:, here] -= into
            table[here, here] -= own
            # The marginals of the other classes get the atom's bigrams wherever it goes.
            row, column = table.sum(1) + into, table.sum(0) + out
            gain = (xlogx(table + out).sum(1) - xlogx(table).sum(1)
                    + xlogx(table + into[:, None]).sum(0) - xlogx(table).sum(0))
            d = np.diagonal(table)
            gain += (xlogx(d + out + into + own) - xlogx(d + out) - xlogx(d + into) + xlogx(d))
            gain -= xlogx(row + out.sum() + own) - xlogx(row)
            gain -= xlogx(column + into.sum() + own) - xlogx(column)
            best = int(gain.argmax())
            if gain[best] <= gain[here] + 1e-9:
                best = int(here)
            table[best] += out
            table[:, best] += into
            table[best, best] += own
            if best != here:
                moved += 1
                of[w] = best
                to[:, here] -= pairs[:, w]
                to[:, best] += pairs[:, w]
                back[:, here] -= pairs[w]
                back[:, best] += pairs[w]
        if not moved:
            break
    return of


def slots(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) >> (64 - SLOT_BITS) for w in words], np.int64)


@dataclass
class ClassOf:
    """The class of any word: of its own if it is the end or a top word, else
    of its slot, else of its pool."""

    top: list[bytes]
    of: np.ndarray  # class of each atom
    table: np.ndarray | None = None  # class + 1 of each slot; 0: none

    def __call__(self, words: list[bytes]) -> np.ndarray:
        fixed, base = {END: 0} | {w: i for i, w in enumerate(self.top, 1)}, 1 + len(self.top)
        at = np.fromiter((fixed[w] if w in fixed else base + zlib.crc32(w[-3:]) % POOLS for w in words), np.int64, len(words))
        out = self.of[at]
        if self.table is not None and len(words):
            kept = self.table[slots(words)].astype(np.int64)
            out = np.where((at >= base) & (kept > 0), kept - 1, out)
        return out


def class_pairs(training: DataFrame, classes: ClassOf) -> np.ndarray:
    """The class bigram matrix of all texts."""
    size, sent = int(classes.of.max()) + 1, training.sparkSession.sparkContext.broadcast(classes)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size * size, np.int64)
        for batch in batches:
            for texts in text_parts(batch.column(0)):
                words, run = local_words(texts)
                of = sent.value(words)[run]
                total += np.bincount(of[:-1] * size + of[1:], minlength=size * size)
        met = np.flatnonzero(total)
        yield pa.record_batch([pa.array(met), pa.array(total[met])], names=["pair", "n"])

    table = (training.select("text").mapInArrow(pairs, "pair long, n long").groupBy("pair")
             .agg(F.sum("n").alias("n"))).toArrow()  # at most size * size rows
    matrix = np.zeros(size * size, np.int64)
    matrix[table["pair"].to_numpy()] = table["n"].to_numpy()
    sent.destroy()
    return matrix.reshape(size, size)


def slot_bytes(rows: DataFrame, value: str) -> np.ndarray:
    """The table of 2^SLOT_BITS bytes of (slot, value) rows, at most one a slot, fetched in packed blocks."""
    @arrow_udf("binary")
    def packed(cells: pa.Array) -> pa.Array:
        out = []
        for block in cells:
            flat = np.zeros(1 << SLOT_BLOCK, np.uint8)
            flat[block.values.field(0).to_numpy()] = block.values.field(1).to_numpy()
            out.append(flat.tobytes())
        return pa.array(out, pa.binary())

    blocks = rows.groupBy(F.shiftright("slot", SLOT_BLOCK).alias("block")).agg(F.collect_list(F.struct(
        F.col("slot").bitwiseAND((1 << SLOT_BLOCK) - 1).cast("int").alias("at"), F.col(value).cast("int").alias("v"))).alias("cells"))
    table = np.zeros(1 << SLOT_BITS, np.uint8)
    for r in blocks.select("block", packed("cells").alias("bytes")).toLocalIterator():
        table[r["block"] << SLOT_BLOCK:(r["block"] + 1) << SLOT_BLOCK] = np.frombuffer(r["bytes"], np.uint8)
    return table


def packed_cells(keys: np.ndarray, n: np.ndarray, codes: int) -> tuple[np.ndarray, list[bytes]]:
    """(slots, packed vector of each) of sorted keys ``slot * codes + code``: the
    width of a count, the codes, the counts."""
    slot, code = keys // codes, (keys % codes).astype(np.uint8)
    first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.zeros(0, np.int64)
    out = []
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(slot)]):
        counts = n[a:b]
        width = 1 if counts.max() < 256 else 2 if counts.max() < 65536 else 8
        out.append(bytes([width]) + code[a:b].tobytes() + counts.astype(f"<u{width}").tobytes())
    return slot[first], out


def summed_cells(lists: pa.Array, codes: int) -> np.ndarray:
    """(rows, codes): the sums of the packed vectors of each row."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().cast(pa.large_binary())
    row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    offsets = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset:flat.offset + len(flat) + 1]
    raw = np.frombuffer(flat.buffers()[2], np.uint8) if len(flat) else np.zeros(0, np.uint8)
    out = np.zeros(len(lists) * codes)
    width = raw[offsets[:-1]].astype(np.int64) if len(flat) else np.zeros(0, np.int64)
    for w in np.unique(width).tolist():
        hit = np.flatnonzero(width == w)
        size = (offsets[hit + 1] - offsets[hit] - 1) // (1 + w)
        step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        code = raw[np.repeat(offsets[hit] + 1, size) + step]
        at = np.repeat(offsets[hit] + 1 + size, size) + w * step
        n = sum(raw[at + k].astype(np.int64) << (8 * k) for k in range(w))
        out += np.bincount(np.repeat(row[hit], size) * codes + code, n, len(out))
    return out.reshape(len(lists), codes)


def slot_neighbours(training: DataFrame, classes: ClassOf, wanted: np.ndarray) -> DataFrame:
    """(slot, here, lists): of each wanted slot its words' class now and packed vectors of how
    often each neighbour occurs: class c before as code c, class c behind as code classes + c."""
    codes = 2 * (int(classes.of.max()) + 1)
    sent = training.sparkSession.sparkContext.broadcast((classes, wanted))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_word, marked = sent.value
        top = set(of_word.top) | {END}
        part = TaskContext.get().partitionId()
        for batch in batches:
            for texts in text_parts(batch.column(0)):
                words, run = local_words(texts)
                of, at = of_word(words), slots(words)
                asked = np.flatnonzero((marked[at] > 0) & np.fromiter((w not in top for w in words), bool, len(words)))
                slot, place = np.unique(at[asked], return_inverse=True)
                here = np.zeros(len(slot), np.int16)
                here[place] = of[asked]
                local = np.full(len(words), -1)
                local[asked] = place
                c, hit = of[run], np.flatnonzero(local[run] >= 0)  # never the first or last token: those are ends
                base = local[run[hit]] * codes
                n = np.bincount(np.concatenate([base + c[hit - 1], base + codes // 2 + c[hit + 1]]), minlength=len(slot) * codes)
                keys = np.flatnonzero(n)
                _, cells = packed_cells(keys, n[keys], codes)
                yield pa.record_batch([pa.array(slot.astype(np.int32)), pa.array(np.full(len(slot), part, np.int32)),
                                       pa.array(here), pa.array(cells, pa.binary())], names=["slot", "part", "here", "cells"])

    @arrow_udf("binary")
    def merged(lists: pa.Array) -> pa.Array:
        total = summed_cells(lists, codes).astype(np.int64).ravel()
        keys = np.flatnonzero(total)
        return pa.array(packed_cells(keys, total[keys], codes)[1], pa.binary())

    parts = training.select("text").mapInArrow(counted, "slot int, part int, here short, cells binary")
    tasks = training.rdd.getNumPartitions()
    while True:  # a group has the vectors of FAN tasks at most, one of each slice
        tasks = -(-tasks // FAN)
        parts = parts.groupBy("slot", F.floor(F.col("part") / FAN).cast("int").alias("part")).agg(
            F.max("here").alias("here"), F.collect_list("cells").alias("lists"))
        if tasks <= 1:
            return parts.drop("part")
        parts = parts.select("slot", "part", "here", merged("lists").alias("cells"))


def best_classes(table: np.ndarray, out: np.ndarray, into: np.ndarray, here: np.ndarray) -> np.ndarray:
    """The class to which each of many words of classes ``here`` should go, each as
    if it moved alone: row w of ``out`` counts the classes behind word w, of ``into``
    those before it, ``table`` all class bigrams with it. Only classes that a word
    meets enter its sums."""
    t, words = table.astype(np.float64), np.arange(len(here))

    def side(mine: np.ndarray, other: np.ndarray, bigrams: np.ndarray) -> np.ndarray:
        """Sum over the classes c met of f(t[k, c] + mine[c]) - f(t[k, c]), without the word, for every k."""
        w, c = np.nonzero(mine)
        gain = np.zeros(mine.shape)
        if len(w):
            n = mine[w, c]
            left = bigrams[:, c].T.copy()
            left[np.arange(len(w)), here[w]] -= n
            left -= np.where((c == here[w])[:, None], other[w], 0)
            np.maximum(left, 0, out=left)
            first = np.flatnonzero(np.append(True, w[1:] != w[:-1]))
            gain[w[first]] = np.add.reduceat(xlogx(left + n[:, None]) - xlogx(left), first)
        return gain

    gain = side(out, into, t) + side(into, out, t.T)
    own = np.zeros(out.shape)
    own[words, here] = 1.0
    d = np.maximum(np.diagonal(t)[None] - own * (out + into), 0)
    gain += xlogx(d + out + into) - xlogx(d + out) - xlogx(d + into) + xlogx(d)
    for total, edge in ((out.sum(1, keepdims=True), t.sum(1)), (into.sum(1, keepdims=True), t.sum(0))):
        rest = np.maximum(edge[None] - own * total, 0)
        gain -= xlogx(rest + total) - xlogx(rest)
    best = gain.argmax(1)
    return np.where(gain[words, best] > gain[words, here] + 1e-9, best, here)


def refined(training: DataFrame, counts: DataFrame, classes: ClassOf, pairs: np.ndarray) -> ClassOf:
    """The classes after a round in which every frequent word is exchanged;
    ``pairs`` is the atom bigram matrix."""
    size = int(classes.of.max()) + 1
    one = np.zeros((len(classes.of), size), np.int64)
    one[np.arange(len(classes.of)), classes.of] = 1
    table = one.T @ pairs @ one

    @arrow_udf("int")
    def slot(words: pa.Array) -> pa.Array:
        return pa.array(slots(words.to_pylist()), pa.int32())

    often = counts.where((F.col("n") > 0) & (F.octet_length("word") > 0)).groupBy(slot("word").alias("slot")).agg(
        F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)
    wanted = slot_bytes(often.select("slot", F.lit(1).alias("v")), "v")

    @arrow_udf("int")
    def chosen(lists: pa.Array, here: pa.Array) -> pa.Array:
        now, out = here.to_numpy().astype(np.int64), [np.zeros(0, np.int64)]
        for a in range(0, len(now), 512):
            v = summed_cells(lists.take(pa.array(np.arange(a, min(a + 512, len(now))))), 2 * size)
            out.append(best_classes(table, v[:, size:], v[:, :size], now[a:a + 512]) + 1)
        return pa.array(np.concatenate(out).astype(np.int32))

    moved = slot_neighbours(training, classes, wanted).select("slot", chosen("lists", "here").alias("v"))
    return ClassOf(classes.top, classes.of, slot_bytes(moved, "v"))


@dataclass
class ClassModel:
    of_word: ClassOf
    move: np.ndarray        # log10 P(class | class before)
    tokens: np.ndarray      # training tokens of each class
    words: np.ndarray       # distinct training words of each class
    n: int                  # training tokens
    v: int                  # distinct training tokens

    def classes(self, words: list[bytes]) -> np.ndarray:
        return self.of_word(words)

    def emission(self, counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
        return np.log10((counts + ADD) / (self.tokens[classes] + ADD * (self.words[classes] + 1)))

    def baseline(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ADD) / (self.n + ADD * (self.v + 1)))


def transitions(table: np.ndarray, pull: float = PULL) -> np.ndarray:
    """log10 of the smoothed probability of a class after a class."""
    classes = len(table)
    alone = (table.sum(0) + 1.0) / (table.sum() + classes)
    return np.log10((table + pull * alone) / (table.sum(1, keepdims=True) + pull))


def fitted(training: DataFrame, counts: DataFrame) -> ClassModel:
    """The model of all training texts and their word counts."""
    n, v = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    top = [bytes(r["word"]) for r in counts.where(F.octet_length("word") > 0)
           .orderBy(F.desc("n"), "word").limit(TOP_WORDS).collect()]
    pairs = atom_pairs(training, top)
    of_word = refined(training, counts, ClassOf(top, exchange_classes(pairs)), pairs)
    move = transitions(class_pairs(training, of_word))
    sent = training.sparkSession.sparkContext.broadcast(of_word)

    @arrow_udf("int")
    def class_of(words: pa.Array) -> pa.Array:
        return pa.array(sent.value(words.to_pylist()), pa.int32())

    tokens, words = np.zeros(len(move)), np.zeros(len(move))
    sums = counts.where("n > 0").groupBy(class_of("word").alias("c")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v"))
    for row in sums.collect():  # a row per class
        tokens[row["c"]], words[row["c"]] = row["n"], row["v"]
    return ClassModel(of_word, move, tokens, words, int(n), int(v))


# -- scoring ---------------------------------------------------------------

SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
          "score double")


def distinct_words(key: tuple, block: pa.Table) -> pa.Table:
    """(block, word) of every word of a block, the end included."""
    met = pa.array([], pa.large_string())
    for texts in text_parts(block["text"]):
        met = pc.unique(pa.concat_arrays([met, pc.unique(split_words(texts)[0])]))
    words = pa.concat_arrays([met.cast(pa.large_binary()), pa.array([END], pa.large_binary())]).cast(pa.binary())
    return pa.table({"block": pa.array(np.full(len(words), key[0].as_py(), np.int64)), "word": words})


def score_block(block: pa.Table, counted: pa.Table, model: ClassModel) -> pa.Table:
    """Scores of a block's texts from the counts of its words."""
    if not len(block):
        return pa.table({k: pa.array([], t) for k, t in zip(
            [c.split()[0] for c in SCORES.split(", ")],
            [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()], strict=True)})
    words = counted["word"].to_pylist()
    counts = counted["n"].to_numpy().astype(np.float64)
    of = model.classes(words)
    base, emit, known = model.baseline(counts), model.emission(counts, of), counts > 0
    end, listed = words.index(END), pa.array(words, pa.large_binary())
    sums: list[list[np.ndarray]] = [[], [], [], []]
    for texts in text_parts(block["text"]):
        flat, n = split_words(texts)
        ids = pc.index_in(flat.cast(pa.large_binary()), value_set=listed).to_numpy(zero_copy_only=False).astype(np.int64)
        ids = np.insert(ids, np.cumsum(n), end)
        first = np.cumsum(n + 1) - (n + 1)
        before = np.append(end, ids[:-1])  # a text follows an end
        for out, values in zip(sums, (np.ones(len(ids), np.int64), known[ids].astype(np.int64), base[ids],
                                      emit[ids] + model.move[of[before], of[ids]]), strict=True):
            out.append(np.add.reduceat(values, first))
    sizes, seen, low, high = map(np.concatenate, sums)
    return pa.table({"doc_id": block["doc_id"], "held_out": block["held_out"], "n_tokens": sizes, "n_known": seen,
                     "train_tokens": np.full(len(block), model.n), "base_score": low, "score": high})


def perplexity(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Score every text under the model of the texts whose id remainder modulo
    ``folds`` is not 0: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score (log10 probabilities)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       (id_remainder("doc_id", folds) == 0).alias("held_out"))
    training = rows.where(~F.col("held_out"))
    counts = word_counts(training)
    model = fitted(training, counts)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(-(-size // BLOCK_BYTES), min(spark_size(docs.sparkSession), 2 * docs.sparkSession.sparkContext.defaultParallelism))
    # Equal rows spread too: their place in the scan tells them apart, the same at every try.
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), F.lit(blocks))) \
        .repartition("block")
    asked = blocked.groupBy("block").applyInArrow(distinct_words, "block long, word binary")
    answered = asked.join(counts, "word", "left").select("block", "word", F.coalesce("n", F.lit(0)).alias("n"))

    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(texts: pa.Table, words: pa.Table) -> pa.Table:
        return score_block(texts, words, sent.value)

    return blocked.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(scored, SCORES)
