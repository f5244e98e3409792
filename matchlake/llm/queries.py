"""The ``opN_*`` queries: each operator with its production parameters over its
whole table, and DuckDB twins where SQL can express the rows."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchlake.llm import (
    classlm,
    collocations,
    decontamination,
    extraction,
    language,
    mixing,
    neighbours,
    periodic,
    quality,
    simhash,
    token_counts,
    toxicity,
    warc,
)
from matchlake.llm.batches import id_remainder
from matchlake.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Python workers that inherit no path find the package where the driver has it."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def query(name: str, sql: str | None = None):
    def registered(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            importable(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn
    return registered


# -- 1 ---------------------------------------------------------------------

_BINS = ", ".join(mixing.BINS)
_WORD = r"[^\x20\x09-\x0D]+"
_STEP = 0.5 / (1.0 + mixing.RIDGE)
_BETAS = ", ".join(repr(mixing.momentum(k)) for k in range(mixing.STEPS + 1))
_GOAL = sum(mixing.TARGETS.values())


def _sql_mixing() -> str:
    """Features, naive Bayes and gradient steps; the steps are a recursive
    query over one row that holds the bin table as lists."""
    d = mixing.DOMAINS
    likely = " * ".join(
        f"((SELECT count(*) FROM lab l WHERE l.domain = '{{d}}' AND l.{b} = c.{b}) + 1.0) / (n_{{d}} + {n})"
        for b, n in mixing.BINS.items())
    joint = ", ".join(f"(n_{x} + 1.0) / (n_{d[0]} + n_{d[1]} + n_{d[2]} + {len(d)}) * {likely.format(d=x)} AS j_{x}"
                      for x in d)
    lists = ", ".join(f"list(p_{x} ORDER BY {_BINS}) AS l_{x}" for x in d)
    got = ", ".join(f"list_dot_product(list_transform(idx, lambda i: w[i] * y[i]), l_{x}) - {mixing.TARGETS[x] / _GOAL!r}"
                    f" AS e_{x}" for x in d)
    slope = " + ".join(f"e_{x} * l_{x}[i]" for x in d)
    half = "substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) < '8'"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{mixing.LETTERS[0]}', '{mixing.LETTERS[1]}'), '{_WORD}')"

    def speaks(x: str) -> str:
        n = f"(SELECT count(*) FILTER (domain = '{x}') FROM learn)"
        rest = " + ".join(o for o in d if o != x)
        ratio = f"((2 * {x} + 1) * CAST((SELECT count(*) FROM learn) - {n} + 1 AS DOUBLE)) / ((2 * ({rest}) + 1) * CAST({n} + 1 AS DOUBLE))"
        return f"""say_{x} AS (SELECT word FROM (SELECT word, {x} AS n, {ratio} AS ratio FROM per_word)
          WHERE n >= {mixing.LEAST_DOCS} AND ratio >= {mixing.LEAST_RATIO} ORDER BY ratio DESC, word LIMIT {mixing.MOST_WORDS})"""

    return f"""
    WITH RECURSIVE dom AS (
      SELECT doc_id, CASE WHEN max(coalesce(toxic, 0)) = 1 THEN 'toxic'
                          WHEN min(coalesce(quality, 1)) = 0 THEN 'poor' ELSE 'good' END AS domain
      FROM labels WHERE doc_id IS NOT NULL AND (quality IS NOT NULL OR toxic IS NOT NULL) GROUP BY doc_id),
    drawn AS (SELECT doc_id, domain FROM (SELECT *, count(*) OVER (PARTITION BY domain) AS n FROM dom WHERE {half})
              WHERE CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 2, 6) AS BIGINT) < least(1.0, {mixing.LABELLED}.0 / n) * {16 ** 6}.0),
    learn AS (SELECT domain, list_distinct({words}) AS ws FROM documents JOIN drawn USING (doc_id)),
    per_word AS (SELECT word, {", ".join(f"count(*) FILTER (domain = '{x}') AS {x}" for x in d)}
                 FROM (SELECT domain, unnest(ws) AS word FROM learn) GROUP BY word),
    {speaks("poor")}, {speaks("toxic")},
    numbered AS (SELECT row_number() OVER () AS rid, doc_id, text, {words} AS ws FROM documents),
    said AS (SELECT rid, count(p.word) AS poor, count(t.word) AS toxic FROM (SELECT rid, unnest(ws) AS word FROM numbered) w
             LEFT JOIN say_poor p USING (word) LEFT JOIN say_toxic t USING (word) GROUP BY rid),
    counted AS (
      SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS n_tokens, length(coalesce(text, '')) AS chars,
             len(ws) AS said_n, len(list_distinct(ws)) AS different,
             len(regexp_extract_all(coalesce(text, ''), '[A-Z]')) AS upper_n,
             len(regexp_extract_all(coalesce(text, ''), '[{mixing.MARKS}]')) AS marks,
             len(regexp_extract_all(coalesce(text, ''), '[0-9]')) AS digits,
             coalesce(poor, 0) AS poor, coalesce(toxic, 0) AS toxic
      FROM numbered LEFT JOIN said USING (rid)),
    feats AS (
      SELECT doc_id, n_tokens, least(15, length(bin(n_tokens + 1)) - 1) AS b_len,
             least(10, (20 * upper_n) // (chars + 1)) AS b_upper, least(10, (40 * marks) // (chars + 1)) AS b_mark,
             least(10, (40 * digits) // (chars + 1)) AS b_digit,
             least(15, chars // greatest(n_tokens, 1)) AS b_word,
             least(10, (20 * poor) // (n_tokens + 1)) AS b_poor, least(5, toxic) AS b_toxic,
             (20 * (said_n - different)) // (said_n + 1) AS b_again FROM counted),
    lab AS (SELECT domain, {_BINS} FROM feats JOIN dom USING (doc_id) WHERE NOT {half}),
    sizes AS (SELECT {', '.join(f"count(*) FILTER (domain = '{x}') AS n_{x}" for x in d)} FROM lab),
    cells AS (SELECT {_BINS}, sum(n_tokens) AS tokens FROM feats GROUP BY ALL),
    joint AS (SELECT c.*, {joint} FROM cells c, sizes),
    post AS (SELECT {_BINS}, tokens, {', '.join(f"j_{x} / ({' + '.join('j_' + z for z in d)}) AS p_{x}" for x in d)}
             FROM joint),
    packed AS (SELECT list(CAST(tokens AS DOUBLE) / (SELECT sum(tokens) FROM cells) ORDER BY {_BINS}) AS w,
                      range(1, count(*) + 1) AS idx, {lists} FROM post WHERE tokens > 0),
    steps AS (
      SELECT 0 AS k, list_transform(idx, lambda i: CAST(1.0 AS DOUBLE)) AS r,
             list_transform(idx, lambda i: CAST(1.0 AS DOUBLE)) AS before FROM packed
      UNION ALL
      SELECT k + 1, list_transform(idx, lambda i: greatest(CAST(0.0 AS DOUBLE),
               y[i] - {2 * _STEP!r} * ({slope} + {mixing.RIDGE!r} * (y[i] - 1.0)))), r
      FROM (SELECT k, r, w, idx, y, {', '.join('l_' + x for x in d)}, {got}
            FROM (SELECT k, r, packed.*, list_transform(idx, lambda i:
                    r[i] + ([{_BETAS}])[k + 1] * (r[i] - before[i])) AS y
                  FROM steps, packed WHERE k < {mixing.STEPS}))),
    named AS (SELECT {', '.join(f"list({b} ORDER BY {_BINS}) AS {b}" for b in mixing.BINS)}
              FROM post WHERE tokens > 0),
    rated AS (SELECT {', '.join(f'unnest(named.{b}) AS {b}' for b in mixing.BINS)}, unnest(r) AS rate
              FROM steps, named WHERE k = {mixing.STEPS})
    SELECT doc_id, CAST(f.n_tokens AS BIGINT) AS n_tokens, {', '.join(f'round(p_{x}, 6) AS p_{x}' for x in d)},
           round(coalesce(rate, 1.0), 6) AS rate
    FROM feats f JOIN post USING ({_BINS}) LEFT JOIN rated USING ({_BINS})"""


@query("op1_mixing_to_targets", _sql_mixing())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, posteriors and rate of every document, to 6 decimals."""
    rates = mixing.mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rates.select("doc_id", "n_tokens", *[F.round(c, 6).alias(c) for c in
                                                (*[f"p_{d}" for d in mixing.DOMAINS], "rate")])


# -- 2 to 10 ---------------------------------------------------------------


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.token_counts(table(spark, sf_dir, "documents"), TOKENIZER)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query("op3_warc_round_trip", f"""
    WITH p AS (SELECT page_id, coalesce(html, '') AS body,
                      octet_length(encode(coalesce(html, ''))) AS n,
                      sha256(coalesce(html, '')) AS digest FROM pages),
         f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM p)
    SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
           CASE WHEN n >= {warc.MIN_REVISIT} AND page_id IS DISTINCT FROM first_id AND first_id IS NOT NULL
                THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= {warc.MIN_REVISIT} AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
    FROM f""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_round_trip(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_quality_network")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fitted(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"),
                         quality.quality("text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op5_class_language_model")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classlm.perplexity(table(spark, sf_dir, "documents"))


@query("op6_toxicity_instances")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"),
                         toxicity.toxicity("text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op7_benchmark_matches")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, item_id, ...) of every document that holds a benchmark item."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op8_language")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fitted(docs, PIECES)
    scored = docs.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"),
                         language.language("text", model).alias("found"))
    return scored.select("doc_id", "held_out", "found.lang_pred", "found.score")


@query("op9_nearest_neighbours")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@query("op10_simhash_components")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex("fp").alias("fingerprint"), "component_id")


# -- 11 --------------------------------------------------------------------


def repeating(doc_id: str, text: str) -> Column:
    """The text whose word i >= a is the original word a + (i - a) % p, for the
    tenth of the ids that the contract names (h, g, a and p are its); other
    texts as they are. A null id reads as empty text."""
    h = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    words = F.regexp_extract_all(F.col(text), F.lit(f"({_WORD})"), F.lit(1))
    parts = F.struct(words.alias("words"), F.size(words).cast("long").alias("n"), F.floor(h / 10).cast("long").alias("g"))

    def turned(s):
        a = s["g"] % F.greatest(s["n"], F.lit(1))
        p = F.lit(1) + F.floor((s["n"] - a) / (F.lit(3) + s["g"] % 8))
        order = F.sequence(F.lit(0).cast("long"), s["n"] - 1)
        at = F.transform(order, lambda i: F.when(i >= a, a + (i - a) % p).otherwise(i).cast("int"))
        return F.array_join(F.transform(at, lambda i: F.get(s["words"], i)), " ")

    whole = F.get(F.transform(F.array(parts), lambda s: F.when(s["n"] > 0, turned(s)).otherwise(F.lit(""))), F.lit(0))
    return F.when(h % 10 == 0, whole).otherwise(F.col(text))


@query("op11_periodic_runs")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", repeating("doc_id", "text").alias("text"))
    found = periodic.periodic_runs(docs)
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[r[k].cast("string") for k in ("start", "length", "period")]))
    listed = F.when(F.size("runs") > 0, F.concat(F.array_join(lines, "\n"), F.lit("\n"))).otherwise("")
    best = periodic.strongest("runs")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")).select(
        "doc_id", "n_runs", "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")


# -- 12 --------------------------------------------------------------------


@query("op12_phrase_collocations")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


# -- 13 --------------------------------------------------------------------


@query("op13_main_text")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = pages.select("page_id", "url", extraction.main_text("html", extraction.learned(pages)).alias("text"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
