"""Shared helpers: text batches of bounded size, split rules, shared folders.

Python workers see Arrow string arrays; the operators want slices of a bounded
number of text bytes so that a worker's memory does not depend on how many
rows or how long a text Spark puts into one Arrow batch. A text longer than
the bound is a slice of its own.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.session import ensure_checkpoint_dir

SLICE_BYTES = 4 << 20

#: ASCII white space of the word rule ``[^\\x20\\x09-\\x0D]+`` (what bytes.split() splits on).
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def utf8_parts(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; nulls read as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, offsets


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) with at most ``limit`` bytes
    or a single row each; together they cover every row."""
    raw, offsets = utf8_parts(texts)
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + limit, "right")) - 1)
        yield a, b, raw[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        a = b


def text_slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """Like :func:`slices`, with one ``bytes`` object per row."""
    for a, b, raw, offs in slices(texts, limit):
        whole = raw.tobytes()
        yield a, b, [whole[i:j] for i, j in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True)]


def words_of(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z only) words ``[^\\x20\\x09-\\x0D]+``."""
    return text.translate(LOWER).split()


PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
PLAIN = bytes.maketrans(PUNCTUATION, b" " * len(PUNCTUATION))


def plain_words(text: bytes) -> list[bytes]:
    """Lower-cased words between white space and ASCII punctuation."""
    return text.decode("utf-8", "replace").lower().encode().translate(PLAIN).split()


def byte_parts(text: bytes, limit: int) -> Iterator[bytes]:
    """A long text in parts of about ``limit`` bytes, cut behind white space
    (a stretch without any stays whole)."""
    at = 0
    while len(text) - at > limit:
        cut = max(text.rfind(c, at, at + limit) for c in (b" ", b"\n", b"\t")) + 1
        if cut <= at:
            found = [p for c in (b" ", b"\n", b"\t") if (p := text.find(c, at + limit)) >= 0]
            if not found:
                break
            cut = min(found) + 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def id_remainder(doc_id: Column | str, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id reads as empty text."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def spark_size(spark: SparkSession) -> int:
    """The session's shuffle width: the number of tasks work is dealt to."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """Write ``df`` as Parquet to a fresh folder below the shared checkpoint
    folder and read it back: the plan behind it runs once and survives the
    loss of executors."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
