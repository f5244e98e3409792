"""Phrase collocations per language, from count streams in prefix and suffix order.

*Counting.* Phrases of 1 to ``LONGEST`` words are counted one length at a time.
A phrase can reach ``LEAST`` only if both phrases one word shorter inside it
do, so a pass emits only occurrences whose two parts are marked in the bit
table of the last pass. That table has a fixed size (``BITS`` bits, 16 MB,
whatever the corpus) and is addressed by a hash: a clash lets a rare phrase
through to the exact count, and never hides a frequent one. Occurrences are
counted per text slice, then by a map-side combining ``groupBy``; only phrases
that reach ``LEAST`` are written.

*Scoring.* Every cut of a candidate is a row with its first part and its rest.
In prefix order (sorted by first part) the cuts are merge-joined with the
counts for l, and the longest first parts give each phrase's best extension to
the right; in suffix order (sorted by rest) another merge join gives r, and the
longest rests the best extension to the left. Both are Spark sort-merge joins
of sorted streams; no hash table holds the counts, and a hot part is split by
AQE like any skewed join. A longer phrase that holds a candidate as often as it occurs
implies such a phrase with one more word, so the two extensions decide what is
dropped.

The best 2000 of a language are ranked in two steps, first within hash parts of
the language, so no task sorts all its phrases. Counts are longs; scores use
38-digit decimals. Null texts are empty, null languages read as ``und``. A
repeated row counts each time. An empty table gives no rows. Only the text and
language columns are read, whatever else there is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from matchlake.llm.batches import slices, written

LONGEST, LEAST, TOP = 5, 100, 2000
BITS, BLOCK = 27, 16  # a table of 2^27 bits, packed in blocks of 2^16
PART_BYTES, HASH_PARTS = 4 << 20, 64
UNKNOWN = "und"
STEP, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xFF51AFD7ED558CCD)

#: Pieces end at .,;:!? and line breaks; all of these become a full stop, A-Z become small.
STOPS = b".,;:!?\n\x0b\x0c\r"
PLAIN = bytes.maketrans(bytes(range(65, 91)) + STOPS, bytes(range(97, 123)) + b"." * len(STOPS))


# -- words and hashes ------------------------------------------------------


def pieces(text: bytes, limit: int) -> Iterator[bytes]:
    """A text of whole pieces in parts of about ``limit`` bytes (a longer piece stays whole)."""
    at = 0
    while len(text) - at > limit:
        cut = text.rfind(b".", at, at + limit) + 1 or text.find(b".", at + limit) + 1
        if not cut:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


def numbered(text: bytes) -> tuple[list[bytes], np.ndarray]:
    """(distinct words, number of each word) of a plain text; number 0 is a piece's end."""
    known = {b".": 0}
    words = text.replace(b".", b" . ").split()
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    return list(known), ids


def word_hashes(words: list[bytes], lang: str) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def addresses(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit numbers (below 2^bits) of phrases, from a (words, phrases) array of word hashes."""
    total = np.zeros(hashes.shape[1], np.uint64)
    for row in hashes:
        total = (total ^ row) * STEP
    total = (total ^ (total >> np.uint64(32))) * MIX
    return (total >> np.uint64(64 - bits)).astype(np.int64)


def marked(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def begins(ids: np.ndarray, hashes: np.ndarray, n: int, table: np.ndarray | None) -> np.ndarray:
    """Positions at which a phrase of ``n`` words begins whose two parts of n - 1 words are marked."""
    inside = ids != 0
    if n == 1:
        return np.flatnonzero(inside)
    if len(ids) < n:
        return np.zeros(0, np.int64)
    part = inside[:len(ids) - n + 2].copy()
    for k in range(1, n - 1):
        part &= inside[k:len(part) + k]
    at = np.flatnonzero(part)
    bits = (8 * len(table)).bit_length() - 1
    part[at] = marked(table, addresses(np.stack([hashes[ids[at + k]] for k in range(n - 1)]), bits))
    return np.flatnonzero(part[:-1] & part[1:])


def distinct(ids: np.ndarray, at: np.ndarray, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(one beginning of each distinct phrase of ``n`` words, how often it occurs)."""
    code, high = ids[at], width
    for k in range(1, n):
        if high > (1 << 62) // width:
            code = np.unique(code, return_inverse=True)[1]
            high = len(at)
        code, high = code * width + ids[at + k], high * width
    _, first, often = np.unique(code, return_index=True, return_counts=True)
    return at[first], often


def phrase_counts(text: bytes, lang: str, n: int, table: np.ndarray | None) -> tuple[pa.Array, np.ndarray]:
    words, ids = numbered(text)
    hashes = word_hashes(words, lang) if n > 1 else None
    at, often = distinct(ids, begins(ids, hashes, n, table), n, len(words))
    spelled = pa.array(words, pa.large_binary())
    columns = [spelled.take(pa.array(ids[at + k])) for k in range(n)]
    joined = columns[0] if n == 1 else pc.binary_join_element_wise(*columns, pa.scalar(b" ", pa.large_binary()))
    return joined.view(pa.large_string()), often


# -- count streams ---------------------------------------------------------


def counted(docs: DataFrame, text: str, lang: str, n: int, least: int, table,
            part_bytes: int) -> DataFrame:
    """(lang, phrase, a) of the phrases of ``n`` words with ``a`` of at least
    ``least``; for single words also one row a language without a phrase: all words."""
    def emitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = table.value if table is not None else None
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for a, b, raw, offsets in slices(batch.column(1)):
                plain = raw.tobytes().translate(PLAIN)
                for tongue in dict.fromkeys(langs[a:b]):
                    own = [plain[offsets[i]:offsets[i + 1]] for i in range(b - a) if langs[a + i] == tongue]
                    for part in pieces(b".".join(own), part_bytes):
                        phrases, often = phrase_counts(part, tongue, n, bits)
                        if n == 1:
                            phrases = pa.concat_arrays([phrases, pa.array([None], pa.large_string())])
                            often = np.append(often, often.sum())
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([tongue] * len(phrases), pa.string()), phrases.cast(pa.string()),
                             pa.array(often)], names=["lang", "phrase", "a"])

    read = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    parts = read.mapInArrow(emitted, "lang string, phrase string, a long")
    sums = parts.groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
    return sums.where((F.col("a") >= least) | F.col("phrase").isNull())


def bit_table(phrases: DataFrame, bits: int):
    """The broadcast bit table of (lang, phrase) rows: 2^bits bits at any number of rows."""
    block = min(BLOCK, bits)

    @arrow_udf("int")
    def address(langs: pa.Array, spelled: pa.Array) -> pa.Array:
        out = np.zeros(len(langs), np.int64)
        for i, (tongue, phrase) in enumerate(zip(langs.to_pylist(), spelled.to_pylist(), strict=True)):
            out[i] = addresses(word_hashes(phrase.encode().split(b" "), tongue)[:, None], bits)[0]
        return pa.array(out, pa.int32())

    @arrow_udf("binary")
    def packed(found: pa.Array) -> pa.Array:
        out = []
        for places in found:
            flags = np.zeros(1 << block, bool)
            flags[places.values.to_numpy()] = True
            out.append(np.packbits(flags).tobytes())
        return pa.array(out, pa.binary())

    at = phrases.select(address("lang", "phrase").alias("at"))
    blocks = at.groupBy(F.shiftright("at", block).alias("block")).agg(
        F.collect_set(F.col("at").bitwiseAND((1 << block) - 1)).alias("places"))
    table = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (block - 3)
    for row in blocks.select("block", packed("places").alias("bits")).toLocalIterator():
        table[row["block"] * size:(row["block"] + 1) * size] = np.frombuffer(row["bits"], np.uint8)
    return phrases.sparkSession.sparkContext.broadcast(table)


def count_streams(docs: DataFrame, text: str, lang: str, longest: int, least: int, bits: int,
                  part_bytes: int) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, a) of all phrases of up to ``longest`` words with
    a >= ``least``, (lang, n) with all words of a language), written tables."""
    table, streams, totals = None, None, None
    for n in range(1, longest + 1):
        found = written(counted(docs, text, lang, n, least, table, part_bytes), f"collocations-{n}")
        if table is not None:
            table.destroy()
        if n == 1:
            totals = found.where(F.col("phrase").isNull()).select("lang", F.col("a").alias("n"))
            found = found.where(F.col("phrase").isNotNull())
        stream = found.select("lang", "phrase", F.lit(n).alias("words"), "a")
        streams = stream if streams is None else streams.unionByName(stream)
        table = bit_table(found, bits) if n < longest else None
    return streams, totals


# -- scores ----------------------------------------------------------------


def exact_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)) without rounding."""
    wide = lambda c, digits: c.cast(f"decimal({digits},0)")
    top, low = (F.lit(1000) * wide(a, 17)) * wide(n, 16), wide(left, 17) * wide(right, 17)
    return F.call_function("div", top, low)


def scored(streams: DataFrame, totals: DataFrame) -> DataFrame:
    """Every phrase of two or more words with its lowest-scoring cut, and the
    best count of a phrase that extends it by one word (null: none)."""
    many = streams.where(F.col("words") > 1)
    cuts = many.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("*", F.expr("substring_index(phrase, ' ', k)").alias("head"),
                       F.expr("substring_index(phrase, ' ', k - words)").alias("rest"))
    heads = streams.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    rests = streams.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    prefix_order = cuts.join(heads.hint("merge"), ["lang", "head"])
    suffix_order = prefix_order.join(rests.hint("merge"), ["lang", "rest"])
    each = suffix_order.join(totals, "lang").select(
        "lang", "phrase", "a", "n", F.struct(
            exact_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("score"), "k", "l", "r").alias("cut"))
    best = each.groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("n").alias("n"), F.min("cut").alias("cut"))
    right = cuts.where(F.col("k") == F.col("words") - 1).select("lang", F.col("head").alias("phrase"), "a")
    left = cuts.where(F.col("k") == 1).select("lang", F.col("rest").alias("phrase"), "a")
    longer = right.unionByName(left).groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    return best.join(longer.hint("merge"), ["lang", "phrase"], "left").select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score", "cut.k", "longer")


def ranked(found: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language, ranked within hash parts first."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(HASH_PARTS))
    near = found.withColumn("part", part).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    return near.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))) \
        .where(F.col("rank") <= top).drop("part")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST,
                 least: int = LEAST, top: int = TOP, bits: int = BITS, part_bytes: int = PART_BYTES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, k): each language's best phrases
    of 2 to ``longest`` words that occur ``least`` times and in no longer phrase as often."""
    streams, totals = count_streams(docs, text, lang, longest, least, bits, part_bytes)
    found = scored(streams, totals)
    found = found.where(F.col("longer").isNull() | (F.col("longer") < F.col("a"))).drop("longer")
    return ranked(found, top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score",
                                     "k")
