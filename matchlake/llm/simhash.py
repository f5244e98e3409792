"""SimHash near-duplicates through vantage-point trees.

Fingerprints. A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, shingles
are ``width`` consecutive words joined by a space (repeats included; fewer
words: the whole sequence; none: fingerprint zero). A fingerprint bit is set if
it is set in over half of the shingles' XXH64 values (seed 42).

Links. Distinct fingerprints at ``bits`` or fewer differing bits are linked,
exactly. The space is partitioned by Hamming distance to a vantage point, taken
per block of the 64 bits: by the triangle inequality the block distances of two
linked fingerprints differ by at most ``bits`` in sum. The tuple of block
distances names a shard; a fingerprint is stored in its own shard and also
queries the shards its ball of ``bits`` overlaps, of the two shards of a pair
only the later one. More fingerprints get more blocks, so shards stay small.
Inside a shard an in-memory tree splits further by distance bands around
vantage points taken from the shard, and prunes by the same bound. A shard
returns a spanning forest of its links, not the links, so a dense group of near
copies costs rows in proportion to its members. Copies share a fingerprint and
are one node throughout.

Null texts read as empty. Repeated rows and ids are rows of their own with the
same fingerprint. A null id links like any other, is never a component's id and
gets null if nothing it reaches has one. Extra columns are ignored.
"""

from __future__ import annotations

from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from matchlake.llm.batches import text_slices, words_of, written
from matchlake.llm.components import components

WIDTH, BITS, SEED = 3, 2, 42
#: The outer vantage point: any fixed 64 bits do.
VANTAGE = 0x5D39_A6C4_1E87_72B3
#: Rows of a mean shard, about. Block distances are binomial, so the middle shards hold several
#: times as many; small shards keep those small, too, and spread evenly over tasks.
SHARD_TARGET = 256
#: Blocks of the 64 bits, and about how many shards the block distances of random fingerprints fill.
BLOCKINGS = ((2, 1 << 7), (4, 1 << 12), (6, 1 << 16), (8, 1 << 20), (12, 1 << 26), (16, 1 << 32))
BRUTE = 1 << 20
BIT_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def shingle_hashes(text: bytes, width: int = WIDTH) -> list[int]:
    words = words_of(text)
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= width:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    blanks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate([[0], blanks + 1])[:len(words) - width + 1].tolist()
    ends = np.append(blanks, len(joined))[width - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends, strict=True)]


def fingerprints(texts: list[bytes], width: int = WIDTH) -> np.ndarray:
    """One unsigned fingerprint per text."""
    n = len(texts)
    sizes, parts = np.zeros(n, np.int64), []
    for i, text in enumerate(texts):
        hashes = shingle_hashes(text, width)
        sizes[i] = len(hashes)
        parts.append(np.array(hashes, np.uint64))
    rows = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    octets = rows.astype(">u8").view(np.uint8).reshape(-1, 8)
    owner = np.repeat(np.arange(n) * 256, sizes)
    set_bits = np.empty((n, 64), np.int64)
    for k in range(8):  # how often each byte value stands at place k, then its bits
        seen = np.bincount(owner + octets[:, k], minlength=n * 256).reshape(n, 256)
        set_bits[:, 8 * k:8 * k + 8] = seen @ BIT_OF_BYTE
    major = (2 * set_bits > sizes[:, None]).astype(np.uint8)
    return np.packbits(major, axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprint(text: Column | str, width: int = WIDTH) -> Column:
    """The fingerprint as a signed long."""
    @arrow_udf("long")
    def fingerprinted(texts: pa.Array) -> pa.Array:
        out = np.zeros(len(texts), np.uint64)
        for a, b, part in text_slices(texts):
            out[a:b] = fingerprints(part, width)
        return pa.array(out.view(np.int64))

    return fingerprinted(F.col(text) if isinstance(text, str) else text)


def as_hex(fp: Column | str) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# -- links -----------------------------------------------------------------


def block_masks(blocks: int) -> list[int]:
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    return [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def overlaps(blocks: int, bits: int) -> list[list[int]]:
    """Differences of block distances with a sum of at most ``bits``, later
    than or equal to zero in lexicographic order."""
    out = [[]]
    for _ in range(blocks):
        out = [a + [d] for a, d in product(out, range(-bits, bits + 1)) if sum(map(abs, a)) + abs(d) <= bits]
    return [d for d in out if d >= [0] * blocks]


class Forest:
    """Union of links as smallest-label pointers over local node numbers."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            open_ = x != y
            if not open_.any():
                return
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while (flat := self.label[self.label]).tobytes() != self.label.tobytes():
                self.label = flat


def tree_links(fps: np.ndarray, stored: np.ndarray, queries: np.ndarray, bits: int, forest: Forest,
               depth: int = 0) -> None:
    """Link every query to the stored fingerprints within ``bits``."""
    if len(stored) * len(queries) > BRUTE and depth < 8:
        vantage = fps[stored[(depth * 7919) % len(stored)]]
        near, far = (np.bitwise_count(fps[x] ^ vantage) for x in (stored, queries))
        stored, queries = stored[np.argsort(near, kind="stable")], queries[np.argsort(far, kind="stable")]
        near.sort()
        far.sort()
        for d in np.unique(near).tolist():
            a, b = np.searchsorted(near, [d, d + 1])
            p, q = np.searchsorted(far, [max(0, d - bits), d + bits + 1])
            if q > p:
                tree_links(fps, stored[a:b], queries[p:q], bits, forest, depth + 1)
        return
    step = max(1, BRUTE // max(1, len(stored)))
    for i in range(0, len(queries), step):
        part = queries[i:i + step]
        q, s = np.nonzero(np.bitwise_count(fps[part][:, None] ^ fps[stored][None, :]) <= bits)
        forest.link(part[q], stored[s])


def shard_forest(table: pa.Table, bits: int) -> pa.Table:
    """(u, v) spanning the links found in one shard of (shard, fp, own)."""
    fps = table["fp"].to_numpy().astype(np.int64).view(np.uint64)
    own = table["own"].to_numpy(zero_copy_only=False).astype(bool)
    forest = Forest(len(fps))
    if own.any():
        tree_links(fps, np.flatnonzero(own), np.arange(len(fps)), bits, forest)
    moved = np.flatnonzero(forest.label != np.arange(len(fps)))
    signed = fps.view(np.int64)
    return pa.table({"u": signed[moved], "v": signed[forest.label[moved]]})


def links(fps: DataFrame, bits: int = BITS, blocks: int | None = None) -> DataFrame:
    """Edges (u, v) that span all links between the distinct longs ``fp``."""
    if blocks is None:
        n = fps.count()
        blocks = next((b for b, shards in BLOCKINGS if n <= shards * SHARD_TARGET), BLOCKINGS[-1][0])
    near = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(_signed(VANTAGE))).bitwiseAND(F.lit(_signed(m))))
            for m in block_masks(blocks)]
    moves = overlaps(blocks, bits)
    # A shard's name packs the block distances into 6 bits each (7 if there is one block).
    placed = fps.select("fp", F.array(*[d.cast("int") for d in near]).alias("place"))
    visits = placed.select("fp", "place", F.explode(F.array(*[F.array(*[F.lit(x) for x in m]) for m in moves]))
                           .alias("move"))
    visits = (visits.withColumn("shard", F.zip_with("place", "move", lambda a, b: a + b))
              .where(F.forall("shard", lambda x: x >= 0))
              .withColumn("own", F.forall("move", lambda x: x == 0))
              .select(F.concat_ws(",", F.col("shard").cast("array<string>")).alias("shard"), "fp", "own"))

    def spanned(table: pa.Table) -> pa.Table:
        return shard_forest(table, bits)

    return visits.groupBy("shard").applyInArrow(spanned, "u long, v long")


def near_duplicates(docs: DataFrame, width: int = WIDTH, bits: int = BITS, id_col: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """One row per document: doc_id, text_key (a hash of its text), fp (long),
    component_id (smallest id reachable through links)."""
    marked = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"),
                                 fingerprint(text, width).alias("fp")), "fingerprints")
    smallest = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    roots = components(links(smallest.select("fp"), bits))
    linked = smallest.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .withColumn("root", F.coalesce("root", "fp"))
    component = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(component, "root").select("fp", "component_id")
    return marked.join(named, "fp")


def one_of_each(docs: DataFrame, width: int = WIDTH, bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component one row
    stays, that of the smallest doc_id (a row without id only if no row of its
    component has one)."""
    found = near_duplicates(docs, width, bits)
    best = (found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("alone"))
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("best"))
            .select(F.col("best.doc_id").alias("kept_id"), F.col("best.text_key").alias("kept_key")).distinct())
    # How many rows have that id and text is known on the narrow side; only rows that repeat are numbered.
    rows = found.groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("key")).agg(F.count(F.lit(1)).alias("copies"))
    chosen = best.join(rows, F.col("kept_id").eqNullSafe(F.col("id")) & (F.col("kept_key") == F.col("key"))).select(
        "kept_id", "kept_key", "copies")
    # The row rides along as one struct, so that no column of it can clash with these names.
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"))
    kept = whole.join(chosen, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("key") == F.col("kept_key")))
    order = Window.partitionBy("id", "key").orderBy(F.xxhash64("row"))
    repeated = kept.where("copies > 1").withColumn("copy", F.row_number().over(order)).where("copy = 1")
    return kept.where("copies = 1").select("row.*").unionByName(repeated.select("row.*"))
