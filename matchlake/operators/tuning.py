"""Random search over margin machines, model choice, stacking (T2, T9, N9, F7) on MLlib.

All loops are over *models and parameter draws* (a handful of driver-side
iterations); every fit and every metric is a distributed Spark job over the
shared, persisted fold table. One fold column (M3/M4) is reused everywhere so
out-of-fold scores are clean. Searches over trees are in ``forest`` and ``boosting``.
"""

from __future__ import annotations

import json
import math
import os
import random
import statistics

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchlake.operators import models as MO
from matchlake.operators.curves import roc_auc
from matchlake.operators.margins import FoldRows
from matchlake.operators.small import one_row, small_rows
from matchlake.session import cut_lineage

# Concurrent fits from driver threads; small fits are scheduling-bound, so
# more threads than cores keeps executors busy (override per deployment).
PARALLELISM = int(os.environ.get("MATCHLAKE_FIT_PARALLELISM", "16"))


def pmap(fn, items, parallelism: int = PARALLELISM):
    """Run independent fits concurrently from driver threads (as
    ``CrossValidator(parallelism=...)`` does); each fit is its own Spark job
    set, so the cluster scheduler interleaves them."""
    from concurrent.futures import ThreadPoolExecutor
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        return list(ex.map(fn, items))


def fold_ids(df: DataFrame, fold: str, most: int = 1000) -> list[int]:
    return sorted(r[fold] for r in small_rows(df.select(fold).distinct(), most))


def best_by_mean(fold_rows: DataFrame, metric: str = "roc_auc", order: list[str] | None = None):
    """best model by mean CV metric; strict > so the first in ``order`` wins ties."""
    means = {r["model"]: r["m"] for r in small_rows(fold_rows.groupBy("model").agg(F.avg(metric).alias("m")), 1000)}
    best, best_v = None, -math.inf
    for m in order or sorted(means):
        if means.get(m) is not None and means[m] > best_v:
            best, best_v = m, means[m]
    return best, best_v


def _margin(model, col: str):
    """Makes the model write one output column only, and reads P(class 1) from it."""
    model.setPredictionCol("")
    if hasattr(model, "setProbabilityCol"):
        model.setRawPredictionCol("").setProbabilityCol(col)
        return vector_to_array(F.col(col))[1]
    model.setRawPredictionCol(col)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-vector_to_array(F.col(col))[1]))


def fold_scores(models: dict[int, object], val: DataFrame, metric: str = "auc") -> dict[int, float]:
    """AUC or accuracy of every model of a fold, in one pass over its rows."""
    wide, read = val, {}
    for t, m in models.items():
        m = m.copy()
        if metric == "accuracy":
            m.setPredictionCol(f"out_{t}").setRawPredictionCol("")
            if hasattr(m, "setProbabilityCol"):
                m.setProbabilityCol("")
            read[t] = (F.col(f"out_{t}") == F.col("label")).cast("int")
        else:
            read[t] = _margin(m, f"out_{t}")
        wide = m.transform(wide)
    if metric == "accuracy":
        row = one_row(wide.agg(*[F.avg(c).alias(str(t)) for t, c in read.items()]))
        return {t: row[str(t)] for t in read}
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("draw"), c.alias("probability")) for t, c in read.items()]))
    long = wide.select("label", each.alias("v")).select("label", "v.*")
    return {r["draw"]: r["roc_auc"] for r in small_rows(roc_auc(long, ["draw"]), len(models))}


def search_frame(df: DataFrame, *folds: str) -> DataFrame:
    """The fold columns, label and feature vector of a search's rows, worked out once."""
    return cut_lineage(MO.assembled(df, list(folds)))


def sample_params(space: dict, rng: random.Random) -> dict:
    """One draw from a mixed space: ('int', lo, hi), ('uniform', lo, hi),
    ('loguniform', lo, hi), ('choice', [..])."""
    out = {}
    for k, spec in space.items():
        kind = spec[0]
        if kind == "int":
            out[k] = rng.randint(spec[1], spec[2])
        elif kind == "uniform":
            out[k] = rng.uniform(spec[1], spec[2])
        elif kind == "loguniform":
            out[k] = math.exp(rng.uniform(math.log(spec[1]), math.log(spec[2])))
        else:
            out[k] = rng.choice(spec[1])
    return out


def svc_search(df: DataFrame, space: dict, n_draws: int, fold: str = "fold", seed: int = 42) -> DataFrame:
    """Sampled penalties of a linear margin machine scored by mean accuracy over
    the folds; the models of all draws and folds are fitted together."""
    rng = random.Random(seed)
    draws = [sample_params(space, rng) for _ in range(n_draws)]
    rows = FoldRows(search_frame(df, fold), fold)
    found = rows.accuracies(rows.fit([p["regParam"] for p in draws]))
    out = [(d, json.dumps(p, sort_keys=True), float(statistics.fmean(found[d, f] for f in rows.folds))) for d, p in enumerate(draws)]
    return df.sparkSession.createDataFrame(out, "draw int, params string, mean_score double")


# ---------------------------------------------------------------- stacking
def stacking_scores(out_of_fold: DataFrame, test: DataFrame, members: list[str]) -> DataFrame:
    """A balanced logistic meta-model of the members' out-of-fold scores
    (one column each), applied to their scores on other rows: (id, label, probability)."""
    w, n = MO.with_balanced_weight(out_of_fold)
    assembler = VectorAssembler(inputCols=members, outputCol="features")
    meta = LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", regParam=1.0 / n,
                              standardization=False, probabilityCol="scores").fit(assembler.transform(w))
    return meta.transform(assembler.transform(test)).select("id", "label", vector_to_array("scores")[1].alias("probability"))
