"""Job-board postings and the request log, derived from ``pages`` / ``events``.

posting: id, title, company, location, description, url, source, published_at
request log: request_id, ts, path (event_type), latency_s (value), status_code,
error (the event type 'error' is a failed request).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.sources.tables import table

# Epoch start of the derived publication times and their spread.
PUBLISHED_EPOCH_S = 1704067200
PUBLISHED_SPREAD_S = 8640000
PUBLISHED_MULT = 2654435761


def epoch_ntz(seconds) -> "F.Column":
    """Seconds since the epoch as a TIMESTAMP_NTZ wall clock: independent of
    the session time zone (like the test tables' own timestamps)."""
    secs = seconds if not isinstance(seconds, (int, float)) else F.lit(seconds)
    return F.timestamp_add("SECOND", secs, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posting table. Published time is a deterministic function of the id."""
    pages = table(spark, sf_dir, "pages")
    pid = F.col("page_id")
    return pages.select(
        pid.alias("id"),
        F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("title"),
        F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("company"),
        F.regexp_extract("html", r'<html lang="([a-z]+)"', 1).alias("location"),
        F.col("html").alias("description"),
        F.col("url"),
        F.lit("pages").alias("source"),
        epoch_ntz(F.lit(PUBLISHED_EPOCH_S) + (pid * PUBLISHED_MULT) % PUBLISHED_SPREAD_S).alias("published_at"),
    )


def request_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").alias("request_id"), F.col("ts"),
        F.col("event_type").alias("path"), F.col("value").alias("latency_s"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
        F.when(F.col("event_type") == "error", F.lit("error")).alias("error"),
    )
