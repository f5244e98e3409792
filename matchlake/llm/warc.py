"""WARC archives: write one record per page, read them back by boundary chains.

Writing. Payloads are the pages' html in UTF-8 (null: empty). Of equal payloads
of at least ``MIN_REVISIT`` bytes the record with the smallest page_id is the
response and the others are revisit records that name it and carry no payload;
smaller payloads are all responses. Archives are plain text files of Spark's
own writer whose record separator is the CRLF pair that ends a WARC record, so
they land wherever Spark can write. They roll over after ``RECORDS`` records or
``ARCHIVE_BYTES`` bytes, whichever comes first: records of similar size share
archives of as many records as fit (a record over the bound has its own).

Reading. A task holds one archive at a time and scans it in blocks for the
record magic at the file's start or behind the CRLF pair that ends a record.
Every hit is a *candidate*: a payload may hold the magic, or a whole record,
itself. Its header ends at the next empty line however long it is; headers of
different candidates do not overlap, so the scan stays linear. A candidate's
header gives the offset of its successor;
pointer jumping over these offsets from the start of the file keeps the
candidates that the chain reaches and rejects the others. A chain that leads to
no candidate ends there, so a cut-off last record is dropped and nothing is
invented. An archive is bounded in records and bytes when written here; one
from elsewhere must fit Spark's binary file rows (2 GB).

Repeated rows: rows with the smallest page_id of their payload are all
responses, any other row revisits that id. A null page_id is written as an
absent id, read back as null, and never is the response that others refer to
unless no row of the payload has an id. Empty tables give empty archives.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.session import ensure_checkpoint_dir

MIN_REVISIT = 100
RECORDS = 2000
ARCHIVE_BYTES = 64 << 20
#: Bytes of a record's header without its url, at most.
HEADER_BYTES = 1024
BLOCK = 8 << 20
MAGIC = b"WARC/1.0\r\n"
CRLF = "\r\n"
HEADER_END = b"\r\n\r\n"
SEPARATOR = 4

CANDIDATES = ("path string, begin long, next long, size long, page_id long, record_type string, refers_to long, "
              "payload_bytes long, payload_digest string, url string")
RECORDS_OUT = ("path string, begin long, page_id long, record_type string, refers_to long, "
               "payload_bytes long, payload_digest string, url string")


def records(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """page_id, url, payload, payload_bytes, payload_digest, refers_to (null for
    a response) of every page row."""
    base = (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                         F.coalesce("html", F.lit("")).alias("payload"))
            .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
            .withColumn("payload_digest", F.sha2("payload", 256)))
    first = (base.where(F.col("payload_bytes") >= min_revisit).groupBy("payload_digest")
             .agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
             .drop("copies"))
    return (base.join(first, "payload_digest", "left")
            .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first_id")), F.col("first_id")))
            .drop("first_id"))


def record_text() -> F.Column:
    """The whole record up to its closing CRLF pair, which the writer adds."""
    revisit = F.col("refers_to").isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    page_id = F.coalesce(F.col("page_id").cast("string"), F.lit(""))
    url = F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", " ")
    lines = [F.lit("WARC/1.0"),
             F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
             F.concat(F.lit("WARC-Record-ID: <urn:page:"), page_id, F.lit(">")),
             F.concat(F.lit("WARC-Target-URI: "), url),
             F.lit("WARC-Date: 1970-01-01T00:00:00Z"),
             F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
             F.concat(F.lit("X-Payload-Length: "), F.col("payload_bytes").cast("string")),
             F.when(revisit, F.concat(F.lit("WARC-Refers-To: <urn:page:"), F.col("refers_to").cast("string"),
                                      F.lit(">"))),
             F.lit("Content-Type: text/html"),
             F.concat(F.lit("Content-Length: "), F.octet_length(block).cast("string"))]
    return F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), block)


def size_class(payload_bytes: F.Column, url: F.Column, per_file: int, file_bytes: int) -> F.Column:
    """0 for records of which ``per_file`` fit into an archive, one more for
    each fourfold size."""
    bound = payload_bytes + F.coalesce(F.octet_length(url), F.lit(0)) + F.lit(HEADER_BYTES)
    steps, fits = F.lit(0), file_bytes // per_file
    while fits < file_bytes:
        steps, fits = steps + (bound > F.lit(fits)).cast("int"), 4 * fits
    return steps


def write_archives(pages: DataFrame, path: str, min_revisit: int = MIN_REVISIT, per_file: int = RECORDS,
                   compression: str = "gzip", file_bytes: int = ARCHIVE_BYTES) -> None:
    """Archives of all pages below ``path``."""
    html = F.octet_length(F.coalesce("html", F.lit(""))).cast("long")
    found = pages.select(size_class(html, F.col("url").cast("string"), per_file, file_bytes).alias("c")).distinct()
    classes = sorted(r["c"] for r in found.collect()) or [0]
    every = records(pages, min_revisit)
    for c in classes:
        part = every if len(classes) == 1 else \
            every.where(size_class(F.col("payload_bytes"), F.col("url"), per_file, file_bytes) == c)
        (part.select(record_text().alias("value")).write.mode("errorifexists" if c == classes[0] else "append")
         .option("lineSep", CRLF + CRLF).option("maxRecordsPerFile", max(1, per_file >> 2 * c))
         .option("compression", compression).text(path))


def header_fields(header: bytes) -> dict[bytes, bytes]:
    """Lower-cased field names and values of a record header."""
    out = {}
    for line in header.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.strip().lower()] = value.strip()
    return out


def _page(value: bytes | None) -> int | None:
    m = re.fullmatch(rb"<urn:page:(-?\d+)>", value or b"")
    return int(m[1]) if m else None


def block_candidates(data: bytes, begin: int, end: int) -> Iterator[tuple]:
    """(begin, next, fields, payload offset, size) of every place in
    data[begin:end] where a whole record could start."""
    at = data.find(MAGIC, begin, end + len(MAGIC) - 1)
    while at >= 0:
        starts = at == 0 or data[max(0, at - SEPARATOR):at] == HEADER_END
        head_end = data.find(HEADER_END, at) if starts else -1
        if head_end >= 0:
            fields = header_fields(data[at:head_end])
            size = fields.get(b"content-length", b"")
            if size.isdigit():
                body = head_end + len(HEADER_END)
                following = body + int(size) + SEPARATOR
                if following <= len(data):
                    yield at, following, fields, body, int(size)
        at = data.find(MAGIC, at + 1, end + len(MAGIC) - 1)


def scan_archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate records of archives (path, content), block by block."""
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            data = content.as_buffer().to_pybytes()
            if data[:2] == b"\x1f\x8b":
                data = zlib.decompress(data, wbits=31)
            for begin in range(0, len(data), BLOCK):
                rows = []
                for at, following, fields, body, size in block_candidates(data, begin, min(begin + BLOCK, len(data))):
                    kind = fields.get(b"warc-type", b"").decode("ascii", "replace")
                    digest = fields.get(b"warc-payload-digest", b"").decode("ascii", "replace").removeprefix("sha256:")
                    length = fields.get(b"x-payload-length", b"")
                    if kind == "response":  # from the payload itself, not from what the header says
                        digest, length = hashlib.sha256(data[body:body + size]).hexdigest(), str(size).encode()
                    rows.append((path, at, following, len(data), _page(fields.get(b"warc-record-id")), kind,
                                 _page(fields.get(b"warc-refers-to")), int(length) if length.isdigit() else None, digest,
                                 fields.get(b"warc-target-uri", b"").decode("utf-8", "replace")))
                columns = list(zip(*rows, strict=True)) or [()] * 10
                kinds = [pa.string(), *[pa.int64()] * 4, pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                      names=[x.split()[0] for x in CANDIDATES.split(", ")])


def reachable(begin: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Which candidates of one file the chain from offset 0 reaches: after k
    rounds of pointer jumping the marks cover 2^k records."""
    n = len(begin)
    place = np.searchsorted(begin, following)
    jump = np.append(np.where((place < n) & (np.append(begin, -1)[np.minimum(place, n)] == following), place, n), n)
    marked = np.append(begin == 0, False)
    while True:
        marked_next = marked.copy()
        marked_next[jump[marked]] = True
        marked_next[n] = False
        jump = jump[jump]
        if (jump == n).all() and (marked_next == marked).all():
            return marked[:n]
        marked = marked_next


def follow_chain(table: pa.Table) -> pa.Table:
    """The candidates of one archive that are records."""
    table = table.sort_by("begin")
    keep = reachable(table["begin"].to_numpy(), table["next"].to_numpy())
    return table.filter(pa.array(keep)).drop_columns(["next", "size"])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of the archives below ``path``: path, begin, page_id,
    record_type, refers_to, payload_bytes, payload_digest, url."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    candidates = files.mapInArrow(scan_archives, CANDIDATES)
    return candidates.groupBy("path").applyInArrow(follow_chain, RECORDS_OUT)


def archive_round_trip(pages: DataFrame, min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Write the archives of ``pages`` to a fresh shared folder and read them."""
    spark = pages.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, min_revisit)
    return read_archives(spark, path)
