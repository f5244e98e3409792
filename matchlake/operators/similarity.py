"""Dense-vector similarity: pair cosine, bounded heatmap, encoder plug-in,
histogram (H7, H10, C3/F6, J3, D27)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from matchlake.functions.numeric import round_half_away
from matchlake.functions.text import cosine, norm
from matchlake.session import cut_lineage


def flat(rows: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values as doubles, start of each row, length of each row; -1: the row is null or holds a null)."""
    values = rows.flatten()
    length = rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    start = np.cumsum(length) - length
    usable = ~rows.is_null().to_numpy(zero_copy_only=False)
    if values.null_count:
        at = np.flatnonzero(values.is_null().to_numpy(zero_copy_only=False))
        usable[np.searchsorted(np.cumsum(length), at, "right")] = False
    return values.to_numpy(zero_copy_only=False).astype(np.float64), start, np.where(usable, length, -1)


def row_dots(a: pa.Array, b: pa.Array) -> pa.Array:
    """``functions.text.dot`` of two array columns, summed in the same order."""
    (x, xs, xl), (y, ys, yl) = flat(a), flat(b)
    out, known = np.zeros(len(a)), (xl == yl) & (xl >= 0)
    for width in np.unique(xl[known]):
        rows = np.flatnonzero(known & (xl == width))
        for f in range(width):
            out[rows] += x[xs[rows] + f] * y[ys[rows] + f]
    return pa.array(out, pa.float64(), mask=~known)


def dots(a: Column, b: Column) -> Column:
    @arrow_udf("double")
    def dotted(left: pa.Array, right: pa.Array) -> pa.Array:
        return row_dots(left, right)

    return dotted(a, b)


def pair_cosine(pairs: DataFrame, vectors: DataFrame, left_key: str, right_key: str,
                vec_id: str = "vec_id", vec: str = "embedding", name: str = "similarity",
                decimals: int | None = 6) -> DataFrame:
    """Cosine per (left, right) pair, vectors looked up by id (two
    many-to-one joins; AQE picks broadcast or shuffle by measured size). Norms
    are worked out once for each vector, products for many pairs at a time."""
    lv = vectors.select(F.col(vec_id).alias(left_key), F.col(vec).alias("_lv"), norm(F.col(vec)).alias("_ln"))
    rv = vectors.select(F.col(vec_id).alias(right_key), F.col(vec).alias("_rv"), norm(F.col(vec)).alias("_rn"))
    den = F.col("_ln") * F.col("_rn")
    c = F.when(den == 0, F.lit(0.0)).otherwise(dots(F.col("_lv"), F.col("_rv")) / den)
    if decimals is not None:
        c = round_half_away(c, decimals)
    return pairs.join(lv, left_key, "left").join(rv, right_key, "left").select(
        *pairs.columns, c.alias(name))


def heatmap(left: DataFrame, right: DataFrame, key: str, vec: str, n: int = 10) -> DataFrame:
    """Cosine matrix of the first ``n`` left rows x first ``n`` right
    rows (by key). The right block is a bounded (n-element) array delivered
    by a scalar subquery, so no join and no unbounded pair set."""
    lh = left.orderBy(key).limit(n)
    rh = right.orderBy(key).limit(n)
    block = rh.select(F.sort_array(F.collect_list(F.struct(F.col(key).alias("k"), F.col(vec).alias("v"))))).scalar()
    return (lh.select(F.col(key).alias("left_id"), F.col(vec).alias("lv"), F.explode(block).alias("r"))
              .select("left_id", F.col("r.k").alias("right_id"),
                      round_half_away(cosine(F.col("lv"), F.col("r.v")), 6).alias("similarity")))


def histogram(df: DataFrame, value: str, by=(), bins: int = 30) -> DataFrame:
    """Equal-width bins between the global min and max (last bin closed),
    counted per group; min/max are scalar subqueries. The values are worked out
    and written once, next to their groups only."""
    df = cut_lineage(df.select(*by, value))
    lo = df.select(F.min(value)).scalar()
    hi = df.select(F.max(value)).scalar()
    width = (hi - lo) / bins
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col(value) - lo) / width).cast("int"), F.lit(bins - 1)))
    return df.groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def encode(df: DataFrame, text_col: str, encoder_factory, dim: int, out: str = "embedding") -> DataFrame:
    """Sentence-encoder plug-in as an iterator pandas UDF: the model is
    built once per Python worker and fed Arrow batches of texts.
    ``encoder_factory()`` returns a callable ``list[str] -> array (n, dim)``."""
    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _enc(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = encoder_factory()
        for s in batches:
            vecs = model(s.fillna("").tolist())
            yield pd.Series([list(map(float, v)) for v in vecs])

    return df.withColumn(out, _enc(F.col(text_col)))


def column_cosine(a: Column, b: Column) -> Column:
    return cosine(a, b)
