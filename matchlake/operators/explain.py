"""Model explanation and scenario scoring.

A grid leaves all features but one or two as they are, so rows that agree on
the rest score alike at every grid point. They are counted first (map-side
combined); only their distinct rests meet the literal grid, and the grid means
are weighted by the counts. For a linear scorer the rest is one number, so its
distinct values do not grow with the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.functions.numeric import round_half_away
from matchlake.operators.curves import linspace_grid
from matchlake.operators.quantiles import percentiles
from matchlake.operators.scoring import linear_margin, sigmoid
from matchlake.operators.small import num, one_row, small_rows


REST_DECIMALS = 9


class LinearScorer:
    """N15 as a function of a {feature: Column} mapping, which can also score
    from the margin that the features outside a grid add up to."""

    def __init__(self, weights: dict, decimals: int = 6):
        self.weights, self.decimals = weights, decimals

    def __call__(self, cols: dict[str, Column]) -> Column:
        return self._score(linear_margin(cols, self.weights))

    def _score(self, margin: Column) -> Column:
        return round_half_away(sigmoid(margin), self.decimals)

    def rest(self, cols: dict[str, Column], moved: list[str]) -> Column:
        """The margin without the ``moved`` features. Float noise of the sum,
        far below the score's own decimals, is rounded off so that equal rests
        meet in one group."""
        kept = {f: w for f, w in self.weights.items() if f not in moved}
        return round_half_away(linear_margin(cols, kept), REST_DECIMALS)

    def finish(self, rest: Column, cols: dict[str, Column]) -> Column:
        """The score from a rest and the moved features."""
        for f, x in cols.items():
            if f in self.weights:
                rest = rest + num(self.weights[f]) * x
        return self._score(rest)


def linear_scorer(weights: dict, decimals: int = 6) -> LinearScorer:
    return LinearScorer(weights, decimals)


def percentile_grid(df: DataFrame, feature: str, n: int, lo_q: float = 0.05, hi_q: float = 0.95) -> list[float]:
    lo, hi = one_row(percentiles(df, feature, [lo_q, hi_q]))["q"]
    return linspace_grid(lo, hi, n) if n > 1 else [lo]


def _on_grid(df: DataFrame, features: list[str], scorer, point: dict[str, str], grid: Column,
             grid_decimals: int | None) -> DataFrame:
    """A row per grid point: its struct ``g``, the number of rows and the mean
    score with the ``point`` features (feature -> field of the grid's structs)
    set to it. Null scores are left out of the mean."""
    cols = {f: F.col(f) for f in features}
    if isinstance(scorer, LinearScorer):
        rests = df.select(scorer.rest(cols, list(point)).alias("_rest")).groupBy("_rest")
        score = scorer.finish(F.col("_rest"), {f: F.col(f"g.{v}") for f, v in point.items()})
    else:
        rests = df.groupBy(*[f for f in features if f not in point])
        score = scorer({**cols, **{f: F.col(f"g.{v}") for f, v in point.items()}})
    met = rests.agg(F.count(F.lit(1)).alias("_n")).select("*", F.explode(grid).alias("g"))
    scored = met.select("g", "_n", score.alias("_p"))
    known = F.sum(F.when(F.col("_p").isNotNull(), F.col("_n")))
    if grid_decimals is None:
        mean = F.sum(F.col("_p") * F.col("_n")) / known
    else:
        unit = float(10 ** grid_decimals)
        mean = F.sum(F.floor(F.col("_p") * unit + 0.5).cast("long") * F.col("_n")) / known / F.lit(unit)
    return scored.groupBy("g").agg(F.sum("_n").alias("n_rows"), mean.alias("mean_probability"))


def partial_dependence(df: DataFrame, features: list[str], scorer, feature: str,
                       grid: list[float], grid_decimals: int | None = None) -> DataFrame:
    """Mean score with ``feature`` set to each grid value for every row
    (``grid_decimals``: scores are rounded, take the exact integer-sum mean)."""
    g = F.array(*[F.struct(F.lit(i).alias("i"), num(v).alias("v")) for i, v in enumerate(grid)])
    return _on_grid(df, features, scorer, {feature: "v"}, g, grid_decimals).select(
        F.col("g.i").alias("grid_index"), F.col("g.v").alias("grid_value"), "n_rows", "mean_probability")


def partial_dependence_2d(df: DataFrame, features: list[str], scorer, fa: str, ga: list[float],
                          fb: str, gb: list[float], grid_decimals: int | None = None) -> DataFrame:
    """Two-feature grid (len(ga) x len(gb) points)."""
    g = F.array(*[F.struct(F.lit(i).alias("i"), num(a).alias("a"), F.lit(j).alias("j"), num(b).alias("b"))
                  for i, a in enumerate(ga) for j, b in enumerate(gb)])
    return _on_grid(df, features, scorer, {fa: "a", fb: "b"}, g, grid_decimals).select(
        F.col("g.i").alias("i"), F.col("g.j").alias("j"), F.col("g.a").alias("value_a"),
        F.col("g.b").alias("value_b"), "mean_probability")


def what_if(df: DataFrame, features: list[str], scorer, scenarios: list[dict], key: str,
            threshold: float = 0.5) -> DataFrame:
    """Every row under each scenario of overridden fields (null keeps the
    row's value) -> probability and decision per scenario."""
    sc = F.array(*[F.struct(F.lit(i).alias("scenario"),
                            *[num(s.get(f)).alias(f) for f in features]) for i, s in enumerate(scenarios)])
    x = df.select(key, *features, F.explode(sc).alias("s"))
    cols = {f: F.coalesce(F.col(f"s.{f}"), F.col(f).cast("double")) for f in features}
    p = scorer(cols)
    return x.select(key, F.col("s.scenario").alias("scenario"), p.alias("probability"),
                    (p >= threshold).cast("int").alias("prediction"))


# ---------------------------------------------------------------- N5
def gaussian_nb_fit(df: DataFrame, features: list[str], label: str = "label",
                    var_smoothing: float = 1e-9, max_classes: int = 1000) -> list[dict]:
    """Per-class prior, mean and population variance (+ smoothing): a few
    aggregate rows, checked against ``max_classes``."""
    eps_row = one_row(df.agg(F.greatest(*[F.var_pop(f) for f in features]).alias("m")))
    eps = var_smoothing * (eps_row["m"] or 0.0)
    stats = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"),
                                  *[F.avg(f).alias(f"mu_{f}") for f in features],
                                  *[F.var_pop(f).alias(f"var_{f}") for f in features])
    rows = sorted(small_rows(stats, max_classes), key=lambda r: r[label])
    n = sum(r["n"] for r in rows)
    return [{"c": r[label], "prior": r["n"] / n, "mu": [r[f"mu_{f}"] for f in features],
             "var": [r[f"var_{f}"] + eps for f in features]} for r in rows]


def gaussian_nb_jll(cols: dict, features: list[str], cls: dict) -> Column:
    jll = num(math.log(cls["prior"]))
    for f, mu, var in zip(features, cls["mu"], cls["var"]):
        jll = jll - num(0.5 * math.log(2 * math.pi * var)) - (cols[f] - num(mu)) * (cols[f] - num(mu)) / num(2 * var)
    return jll


def gaussian_nb_score(df: DataFrame, model: list[dict], features: list[str], decimals: int = 6) -> Column:
    """P(class 1) for a binary model (softmax of the two joint log-likelihoods)."""
    cols = {f: F.col(f).cast("double") for f in features}
    j0, j1 = (gaussian_nb_jll(cols, features, c) for c in model[:2])
    return round_half_away(F.lit(1.0) / (F.lit(1.0) + F.exp(j0 - j1)), decimals)
