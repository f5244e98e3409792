"""Bounded driver-side statistics.

Column summaries (a mean per column, a centroid per cluster) are tiny and
bounded by the number of columns / clusters. They are fetched with a checked
row bound and re-enter plans as literals, which keeps downstream plans flat
(no nested scalar subqueries, usable inside higher-order functions), exactly
as MLlib's own scalers and evaluators do with their summaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F


def small_rows(df: DataFrame, max_rows: int) -> list[Row]:
    """Collect at most ``max_rows`` rows; fail loudly if the bound is broken."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"expected at most {max_rows} rows, got more; refusing to collect")
    return rows


def one_row(df: DataFrame) -> Row:
    return small_rows(df, 1)[0]


def num(v) -> Column:
    """A double literal (null stays a typed null)."""
    return F.lit(None).cast("double") if v is None else F.lit(float(v))
