"""Structured Streaming twins of the always-on behaviours.

Each job reads the test tables as a file stream, runs the same operator code
as its batch twin and is run bounded with ``trigger(availableNow=True)``, with
a checkpoint under the shared checkpoint folder.

Sinks are folders with one ``epoch=N`` part per micro-batch. A part is
overwritten if its batch is retried, so a batch counts once however often it
runs. No job drops rows by event time: a bounded run over a stored table gives
the same rows whatever the order and number of its files.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.functions import rules as RU
from matchlake.operators import board as BO
from matchlake.operators.scoring import score_linear
from matchlake.session import shared_path
from matchlake.sources import adapter as AD
from matchlake.sources.postings import PUBLISHED_EPOCH_S, PUBLISHED_MULT, PUBLISHED_SPREAD_S, epoch_ntz


MAX_FILES = 100


def _stream(spark: SparkSession, sf_dir: str, name: str, max_files: int = MAX_FILES) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    # A file stream source watches a directory or glob; the one-character class
    # makes the glob match exactly this table file.
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(
        f"{sf_dir.rstrip('/')}/{name}.parque[t]")


def _run_dir(spark: SparkSession, job: str) -> str:
    return shared_path(spark, f"streams/{job}-{uuid.uuid4().hex[:12]}")


def _await(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def _parts(spark: SparkSession, path: str, schema) -> DataFrame:
    """The epochs written so far (an empty table before the first)."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("epoch", T.LongType())])).parquet(path)


def _write_part(batch: DataFrame, path: str, epoch: int) -> None:
    batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def _prepare(spark: SparkSession, path: str, schema) -> None:
    """An empty part, so that the table can be read before the first batch."""
    _write_part(spark.createDataFrame([], schema), path, -1)


def request_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _stream(spark, sf_dir, "events")
    return ev.select(F.col("event_id").alias("request_id"), "ts",
                     F.col("event_type").alias("path"),
                     F.col("value").alias("latency_s"),
                     F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"))


def windowed_request_metrics(log: DataFrame, window: str = "1 hour") -> DataFrame:
    """D33 per tumbling event-time window, late rows included."""
    return (log.groupBy(F.window("ts", window).alias("w"))
               .agg(F.count(F.lit(1)).alias("total_requests"),
                    F.count_if(F.col("status_code") >= 400).alias("total_errors"),
                    F.avg("latency_s").alias("avg_latency"))
               .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                       "total_requests", "total_errors",
                       F.coalesce(F.round("avg_latency", 4), F.lit(0.0)).alias("avg_latency")))


def run_request_metrics(spark: SparkSession, sf_dir: str, window: str = "1 hour") -> DataFrame:
    """U1 on a stream: each batch writes the windows it changed; the table is
    the last state of every window. State is one row per window."""
    base = _run_dir(spark, "request-metrics")
    agg = windowed_request_metrics(request_log_stream(spark, sf_dir), window)
    _prepare(spark, f"{base}/out", agg.schema)
    q = (agg.writeStream.outputMode("update").foreachBatch(lambda batch, epoch: _write_part(batch, f"{base}/out", epoch))
            .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    _await(q)
    values = agg.columns[2:]
    last = (_parts(spark, f"{base}/out", agg.schema).groupBy("window_start", "window_end")
            .agg(F.max_by(F.struct(*values), "epoch").alias("last")))
    return last.select("window_start", "window_end", "last.*")


def run_posting_ingest(spark: SparkSession, sf_dir: str, max_files: int | None = None) -> DataFrame:
    """Postings arrive as a stream; the state is the smallest id's posting of
    each URL (C2), kept by Spark's state store. A micro-batch reads its own rows
    and their URLs' states, never the table, and writes the URLs whose posting it
    changed; the table is the last state written per URL, whatever the order of arrival."""
    base = _run_dir(spark, "posting-ingest")
    pages = _stream(spark, sf_dir, "pages", *([max_files] if max_files else []))
    pid = F.col("page_id")
    posts = pages.select(
        pid.alias("id"), F.regexp_replace("url", r"[?#].*$", "").alias("url"),
        F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("title"),
        epoch_ntz(F.lit(PUBLISHED_EPOCH_S) + (pid * PUBLISHED_MULT) % PUBLISHED_SPREAD_S).alias("published_at"))
    first = posts.groupBy("url").agg(F.min(F.struct("id", "title", "published_at")).alias("first")).select(
        "first.id", "url", "first.title", "first.published_at")
    _prepare(spark, f"{base}/table", first.schema)
    q = (first.writeStream.outputMode("update").foreachBatch(lambda batch, epoch: _write_part(batch, f"{base}/table", epoch))
              .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start())
    _await(q)
    return BO.first_per_key(_parts(spark, f"{base}/table", first.schema).drop("epoch"), "url", "id").select(*posts.columns)


def run_continuous_scoring(spark: SparkSession, sf_dir: str, threshold: float = 0.5,
                           arrive: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Arriving applications joined to the static candidate/job tables,
    validated (B16), valid rows scored with the stateless stored-weight
    scorer, invalid rows quarantined; returns (scored, quarantine).
    ``arrive`` may change the joined rows before they are validated."""
    base = _run_dir(spark, "scoring")
    orders = _stream(spark, sf_dir, "orders")
    n_part = spark.read.parquet(f"{sf_dir.rstrip('/')}/part.parquet").count()
    apps = orders.select(F.col("o_orderkey").alias("application_id"), F.col("o_custkey").alias("candidate_id"),
                         ((F.col("o_orderkey") * 31) % n_part).alias("job_id"))
    cand = AD.candidates(spark, sf_dir).withColumnRenamed("location", "location_student")
    job = AD.jobs(spark, sf_dir).withColumnRenamed("location", "location_job")
    rows = apps.join(cand, "candidate_id", "left").join(job, "job_id", "left")
    checked = RU.validate_domain(arrive(rows) if arrive else rows)

    outputs = {"scored": lambda rows: score_linear(rows.filter(F.col("status") == "valid"), threshold=threshold,
                                                   keep=["application_id"]),
               "quarantine": lambda rows: rows.filter(F.col("status") != "valid")
               .select("application_id", "violations")}
    schemas = {name: of(checked).schema for name, of in outputs.items()}
    for name, schema in schemas.items():
        _prepare(spark, f"{base}/{name}", schema)

    def sink(batch: DataFrame, epoch: int) -> None:
        batch.persist()
        for name, of in outputs.items():
            _write_part(of(batch), f"{base}/{name}", epoch)
        batch.unpersist()

    q = checked.writeStream.foreachBatch(sink).option("checkpointLocation", f"{base}/ckpt").trigger(
        availableNow=True).start()
    _await(q)
    scored, quarantine = (_parts(spark, f"{base}/{n}", schemas[n]).drop("epoch") for n in ("scored", "quarantine"))
    return scored, quarantine
