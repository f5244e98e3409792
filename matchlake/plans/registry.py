"""Query registry shared by the plan modules.

``query(name, sql=None)`` registers a ``(spark, sf_dir) -> DataFrame``
callable and, when given, its DuckDB twin.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def r(x, d: int = 9):
    """Round a float output (summation order differs between engines) with the
    same half-away-from-zero rule on binary doubles that the SQL twins use."""
    from matchlake.functions.numeric import round_half_away
    return round_half_away(x, d)
