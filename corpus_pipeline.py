"""A training-data pipeline over ``documents``.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns what it keeps, which is written as Parquet and reread as the next
one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm import decontamination, language, mixing, queries, simhash, toxicity
from matchlake.llm.batches import written
from matchlake.sources.tables import table

#: A document goes if its toxicity reaches this.
TOXIC = 0.5


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents whose toxicity is ``TOXIC`` or more."""
    queries.importable(spark)
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.toxicity("text", model) < TOXIC)


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a known language: null texts, texts without a
    letter and texts that the model of the corpus' languages finds too unlikely.
    If no language was learned, all texts with letters stay."""
    queries.importable(spark)
    model = language.fitted(docs, queries.PIECES)
    return docs.where(language.language("text", model)["known"])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash component."""
    queries.importable(spark)
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item."""
    queries.importable(spark)
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Gives every document its sampling rate; those with rate 0 go."""
    return mixing.mixed_documents(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language", drop_unknown_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix),
]

#: Stages learn models and link components, which SQL cannot express; tests/llm checks them by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return written(STAGES[-1][1](spark, docs, sf_dir), f"pipeline-{STAGES[-1][0]}")
