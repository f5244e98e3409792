"""A bounded sample of labelled documents for fitting a classifier.

Rows are drawn by a hash of their id, per class, so that each class brings
about ``per_class`` rows at any input size; each row carries the inverse of its
class's share as its weight. Texts over ``max_bytes`` are left out of the
*sample* (scoring always covers whole texts). Both bounds are parameters.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.llm.batches import id_remainder
from matchlake.operators.small import small_rows

PER_CLASS, MAX_BYTES = 3000, 100_000
BUCKETS = 1 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, folds: int, per_class: int = PER_CLASS,
                    max_bytes: int = MAX_BYTES) -> pa.Table:
    """Arrow table (text, target, weight) in id order, from rows whose id
    remainder modulo ``folds`` is not 0. An id with several labels counts as
    its largest; null ids, labels other than 0 and 1 and null texts bring none."""
    known = (labels.select(F.col("doc_id").alias("labelled_id"), F.col(target).cast("int").alias("target"))
             .where(F.col("labelled_id").isNotNull() & F.col("target").isin(0, 1)
                    & (id_remainder("labelled_id", folds) != 0))
             .groupBy("labelled_id").agg(F.max("target").alias("target")))
    counts = {r["target"]: r["n"] for r in small_rows(known.groupBy("target").agg(F.count(F.lit(1)).alias("n")), 2)}
    share = {c: min(1.0, per_class / n) for c, n in counts.items()}
    rate = F.when(F.col("target") == 1, share.get(1, 1.0)).otherwise(share.get(0, 1.0))
    drawn = known.where(F.pmod(F.xxhash64("labelled_id"), F.lit(BUCKETS)) < rate * BUCKETS) \
        .withColumn("weight", 1.0 / rate)
    # About 2 * per_class small rows by construction: far below any broadcast limit.
    picked = (docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("labelled_id"))
              .where(F.col("text").isNotNull() & (F.octet_length("text") <= max_bytes))
              .select("doc_id", "text", "target", "weight"))
    # Repeated ids could still multiply rows: keep the documented bound.
    table = picked.limit(8 * per_class).toArrow()
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
