"""Job-board relations: paging, lookup, keyword search, URL-dedup ingest, and
request-log totals (F1, B21, B20, C2, D33)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def page(df: DataFrame, skip: int = 0, limit: int = 100, ts: str = "published_at",
         key: str = "id") -> DataFrame:
    """newest first with a unique tiebreak; Spark plans a distributed
    top-(skip+limit) (TakeOrderedAndProject), never a full sort on one task."""
    return df.orderBy(F.col(ts).desc(), F.col(key)).offset(skip).limit(limit)


def lookup(df: DataFrame, value, key: str = "id") -> DataFrame:
    """Rows with the key (empty when missing); pushed into the scan."""
    return df.filter(F.col(key) == F.lit(value))


def search(df: DataFrame, query: str, cols=("title", "company", "location")) -> DataFrame:
    """Case-insensitive substring over several columns, OR-ed."""
    q = F.lit(query.lower())
    cond = None
    for c in cols:
        m = F.coalesce(F.lower(F.col(c)).contains(q), F.lit(False))
        cond = m if cond is None else (cond | m)
    return df.filter(cond)


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Keep the row with the smallest ``order`` per ``key``.

    Aggregates ``min(struct(order, ...))`` so partial aggregation runs before
    the shuffle: a key holding a third of all rows is collapsed map-side
    instead of landing whole in one task (as a window would).
    """
    others = [c for c in df.columns if c not in (key, order)]
    best = F.min(F.struct(F.col(order), *[F.col(c) for c in others])).alias("_b")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"_b.{c}").alias(c) for c in [order] + others])


def new_postings(incoming: DataFrame, existing: DataFrame, key: str = "url",
                 order: str = "id") -> DataFrame:
    """First row per URL within the batch, minus URLs already stored."""
    return first_per_key(incoming, key, order).join(existing.select(key), key, "left_anti")


def request_metrics(log: DataFrame, by: list | None = None) -> DataFrame:
    """Requests, errors, mean latency rounded to 4 (0 when empty)."""
    aggs = [F.count(F.lit(1)).alias("total_requests"),
            F.count_if(F.col("status_code") >= 400).alias("total_errors"),
            F.coalesce(F.round(F.avg("latency_s"), 4), F.lit(0.0)).alias("avg_latency")]
    return log.groupBy(*(by or [])).agg(*aggs)
