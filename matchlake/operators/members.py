"""Member models over many train / score splits at once.

Rows carry a small ``code``; a split leaves the rows of some codes out of the
training and scores the rows of some. Forests and boosted models of all splits
are trained in the same jobs; linear models of all splits score in one pass over
the rows, from their coefficients. The result is one long table, so every metric of
every model and split is one grouped aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchlake.operators import boosting as BO
from matchlake.operators import explain as EX
from matchlake.operators import forest as FO
from matchlake.operators import models as MO
from matchlake.operators.binned import binned_rows
from matchlake.operators.knn import knn_probability
from matchlake.operators.small import num, one_row, small_rows
from matchlake.operators.tuning import pmap
from matchlake.session import cut_lineage

NEIGHBOURS = 15
COLUMNS = ["split", "model", "id", "label", "probability", "prediction"]


@dataclass(frozen=True)
class Split:
    """Train without the codes ``out``, score those of ``scored``."""

    out: tuple[int, ...]
    scored: tuple[int, ...]


def folds_of(k: int, codes: int) -> list[Split]:
    """The k folds of ``code % k``."""
    held = [tuple(c for c in range(codes) if c % k == f) for f in range(k)]
    return [Split(h, h) for h in held]


class Members:
    """Rows with id, label, features and code, ready for every kind of model."""

    def __init__(self, df: DataFrame, key: str, label: str, code: str, features: list[str]):
        cols = [F.col(f).cast("double").alias(f) for f in features]
        self.rows = cut_lineage(df.select(F.col(key).alias("id"), F.col(label).cast("int").alias("label"),
                                          F.col(code).cast("int").alias("code"), *cols))
        self.features = features
        self._binned = None

    @property
    def binned(self) -> DataFrame:
        if self._binned is None:
            self._binned = binned_rows(self.rows, "id", "label", self.features, "code")
        return self._binned

    def sides(self, split: Split) -> tuple[DataFrame, DataFrame]:
        return self.rows.where(~F.col("code").isin(list(split.out))), self.rows.where(F.col("code").isin(list(split.scored)))

    def scores(self, kinds: list[str], splits: list[Split], ids: bool = True) -> DataFrame:
        """(split, model, id, label, probability, prediction) of every kind on every split, or without id."""
        out = None
        for kind in kinds:
            one = self._forest_ratings if kind == "random_forest" and not ids else getattr(self, f"_{kind}")
            part = one(splits).withColumn("model", F.lit(kind)).select(*[c for c in COLUMNS if ids or c != "id"])
            out = part if out is None else out.unionByName(part)
        return out

    # -- linear models -----------------------------------------------------

    def linear_models(self, kind: str, splits: list[Split]) -> list[tuple[float, list[float]]]:
        """(intercept, weights) of each split's model, on the features as they are."""
        x = cut_lineage(MO.VectorAssembler(inputCols=self.features, outputCol="raw_features").transform(self.rows)
                        .select("code", "label", "raw_features"))

        def fitted(split: Split) -> tuple[float, list[float]]:
            frames = MO.fold_frames(x, F.col("code").isin(list(split.out)))
            model = frames.fit(kind)
            scale = np.where(frames.scaler.std.toArray() == 0, 1.0, frames.scaler.std.toArray())
            w = model.coefficients.toArray() / scale
            return float(model.intercept - w @ frames.scaler.mean.toArray()), w.tolist()

        return pmap(fitted, splits)

    def margin(self, model: tuple[float, list[float]]) -> Column:
        total = num(model[0])
        for f, w in zip(self.features, model[1]):
            total = total + num(w) * F.col(f)
        return total

    def _linear(self, kind: str, splits: list[Split]) -> DataFrame:
        models = self.linear_models(kind, splits)
        table = self.rows.sparkSession.createDataFrame([(i, *m) for i, m in enumerate(models)],
                                                       "split int, base double, weights array<double>")
        codes = self.rows.sparkSession.createDataFrame([(i, c) for i, s in enumerate(splits) for c in s.scored], "split int, code int")
        x = F.array(*self.features)
        long = self.rows.select("id", "label", "code", x.alias("x")).join(codes, "code").join(table, "split")
        m = F.aggregate(F.zip_with("x", "weights", lambda a, b: a * b), F.col("base"), lambda t, v: t + v)
        return long.select("split", "id", "label", m.alias("margin")).select(
            "split", "id", "label", (F.lit(1.0) / (F.lit(1.0) + F.exp(-F.col("margin")))).alias("probability"),
            (F.col("margin") > 0).cast("int").alias("prediction"))

    def _logistic(self, splits: list[Split]) -> DataFrame:
        return self._linear("logistic", splits)

    def _linear_svc(self, splits: list[Split]) -> DataFrame:
        return self._linear("linear_svc", splits)

    # -- trees -------------------------------------------------------------

    def _from_trees(self, scores: DataFrame) -> DataFrame:
        return scores.select(F.col("forest").alias("split"), "id", F.col("y").alias("label"), "probability",
                             (F.col("probability") > 0.5).cast("int").alias("prediction"))

    def _forest(self, spec: dict, splits: list[Split], per_split: int | None = None) -> DataFrame:
        specs = [FO.ForestSpec(held=s.out, **spec) for s in splits]
        n = len(self.features)
        trees = FO.train_forests(self.binned, specs, n, per_split)
        return self._from_trees(FO.forest_scores(self.binned, trees, specs, n, {i: s.scored for i, s in enumerate(splits)}))

    def _random_forest(self, splits: list[Split]) -> DataFrame:
        return self._forest({"trees": 100}, splits)

    def _forest_ratings(self, splits: list[Split]) -> DataFrame:
        specs = [FO.ForestSpec(held=s.out, trees=100) for s in splits]
        found = FO.forest_ratings(self.binned, specs, [s.scored for s in splits], len(self.features))
        return found.select(F.col("forest").alias("split"), F.col("y").alias("label"), "probability",
                            (F.col("probability") > 0.5).cast("int").alias("prediction"))

    def _decision_tree(self, splits: list[Split]) -> DataFrame:
        return self._forest({"trees": 1, "max_depth": 6, "min_leaf": 10, "bootstrap": False}, splits, len(self.features))

    def _boosting(self, splits: list[Split]) -> DataFrame:
        specs = [BO.BoostSpec(held=s.out) for s in splits]
        units = list(range(len(splits)))
        if FO.by_kernels(self.binned):
            fits = BO.KernelFits(self.binned, specs, len(self.features), losses=False)
            fits.advance(units, specs[0].rounds)
            trees = fits.trees()
        else:
            _, trees = BO.advance(self.binned, BO.started(self.binned, units), specs, units, specs[0].rounds, len(self.features))
        kept = trees.orderBy("unit", "round").select(F.col("unit").alias("forest"), "nodes")
        sums = BO.summed_trees(self.binned, kept, len(self.features), {i: s.scored for i, s in enumerate(splits)})
        counts = small_rows(self.rows.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.sum("label").alias("pos")), 1000)
        base = [BO.base_margin(*(float(sum(r[c] for r in counts if r["code"] not in s.out)) for c in ("pos", "n"))) for s in splits]
        first = F.element_at(F.array(*[num(b) for b in base]), F.col("forest") + 1)
        margin = first + F.lit(specs[0].step) * F.col("total")
        return self._from_trees(sums.withColumn("probability", F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))))

    # -- neighbours, naive Bayes -------------------------------------------

    def _split_by_split(self, one, splits: list[Split]) -> DataFrame:
        out = None
        for i, part in enumerate(pmap(one, splits, 4)):
            part = part.withColumn("split", F.lit(i)).withColumn("prediction", (F.col("probability") > 0.5).cast("int"))
            out = part if out is None else out.unionByName(part)
        return out

    def _knn(self, splits: list[Split]) -> DataFrame:
        def one(split: Split) -> DataFrame:
            train, test = self.sides(split)
            s = one_row(train.agg(*[F.avg(f).alias(f"m_{f}") for f in self.features],
                                  *[F.stddev_pop(f).alias(f"s_{f}") for f in self.features]))
            scaled = [((F.col(f) - num(s[f"m_{f}"])) / num(s[f"s_{f}"] or 1.0)).alias(f) for f in self.features]
            found = knn_probability(test.select("id", *scaled), "id", train.select("id", "label", *scaled), "id", self.features,
                                    "label", NEIGHBOURS)
            return cut_lineage(test.select("id", "label").join(found, F.col("id") == F.col("query")).drop("query"))

        return self._split_by_split(one, splits)

    def _naive_bayes(self, splits: list[Split]) -> DataFrame:
        def one(split: Split) -> DataFrame:
            train, test = self.sides(split)
            p = EX.gaussian_nb_score(test, EX.gaussian_nb_fit(train, self.features), self.features, decimals=12)
            return test.select("id", "label", p.alias("probability"))

        return self._split_by_split(one, splits)
