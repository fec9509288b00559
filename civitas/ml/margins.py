"""Kernel machines on random Fourier features (M13, M16): a classifier of
one-against-one margins with calibrated probabilities, and regression with an
epsilon-insensitive loss. ``convex`` finds the weights; prediction is a matrix
product per Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..session import written
from . import convex

FOLDS = 5
ALL = -1
#: Fewer rows than these are not worth a task.
ROWS_A_TASK = 1000


def _insensitive(y, fold, weight, epsilon: float, cost: float):
    c = np.full(len(y), cost)
    one = np.ones(len(y))
    return [(one, y - epsilon, c), (-one, -y - epsilon, c)]


def _pair(y, fold, weight, first: int, second: int, left_out: int, cost: float):
    c = np.where(((y == first) | (y == second)) & (fold != left_out), cost * weight, 0.0)
    return [(np.where(y == first, 1.0, -1.0), np.ones(len(y)), c)]


def _rows(staged: DataFrame, y: str, weight: str | None, key: str) -> DataFrame:
    rows = written(staged.where(F.col(y).isNotNull()).select(
        vector_to_array("features").alias("x"), F.col(y).cast("double").alias("y"),
        F.pmod(F.xxhash64(F.col(key)), F.lit(FOLDS)).cast("double").alias("fold"),
        (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("weight")), "margins")
    # few bytes come back in few tasks, but a pass computes much per row
    wanted = min(rows.sparkSession.sparkContext.defaultParallelism, rows.count() // ROWS_A_TASK)
    return written(rows.repartition(wanted), "margins") if wanted > rows.rdd.getNumPartitions() else rows


def fit_epsilon_regression(staged: DataFrame, y: str, key: str, lift, n_features: int, cost: float = 1.0,
                           epsilon: float = 0.1) -> MarginRegression:
    """|w|^2 / 2 + cost * sum of max(0, |y - w.z - b| - epsilon), as
    ``SVR(C=cost, epsilon=epsilon)`` has it. The smoothing falls from the
    target's deviation to 0.0003 of it. ``gap`` of the model is the
    duality gap as a share of the objective."""
    rows = _rows(staged, y, None, key)
    center, spread = rows.agg(F.avg("y"), F.stddev_pop("y")).first()
    spread = max(spread or 0.0, 1e-9)
    problem = convex.Problem(partial(_insensitive, epsilon=epsilon, cost=cost), start=center or 0.0)
    deltas = [spread * s for s in (*convex.DELTAS, 0.0003)]
    weights, = convex.solve(rows, [problem], lift, n_features, deltas)
    model = MarginRegression(featuresCol="rff", weights=weights.tolist())
    model.gap = convex.duality_gap(rows, [problem], lift, n_features, deltas[-1])[0]
    return model


def _margins(rows: DataFrame, weights: dict[tuple[int, int], np.ndarray], pairs, lift) -> DataFrame:
    """(pair, margin, y in the pair's first class) of every row of a pair, by
    the weights that were found without the row's fold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            if not rb.num_rows:
                continue
            x = rb.column("x").flatten().to_numpy(zero_copy_only=False).reshape(rb.num_rows, -1)
            z = np.concatenate([lift(x), np.ones((len(x), 1))], axis=1)
            y, fold = (rb.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold"))
            for k, (a, b) in enumerate(pairs):
                for f in range(FOLDS):
                    at = np.flatnonzero(((y == a) | (y == b)) & (fold == f))
                    yield pa.record_batch([pa.array(np.full(len(at), k, np.int32)), pa.array(z[at] @ weights[k, f]), pa.array(y[at] == a)],
                                          names=["pair", "margin", "positive"])
    return rows.mapInArrow(run, "pair int, margin double, positive boolean")


def fit_sigmoids(margins: DataFrame, pairs: int, tolerance: float = 1e-7, steps: int = 50) -> list[tuple[float, float]]:
    """(A, B) per pair: the chance of the first class is 1 / (1 + exp(A m +
    B)), most likely under targets that are drawn in by the class counts
    (Platt 1999). Newton steps, halved if they raise the loss; a step is one
    grouping of all pairs."""
    margins = written(margins, "margins")
    sizes = {r["pair"]: (r["p"], r["n"]) for r in margins.groupBy("pair").agg(
        F.count_if("positive").alias("p"), F.count_if(~F.col("positive")).alias("n")).collect()}
    counts = [sizes.get(k, (0, 0)) for k in range(pairs)]
    high, low = [(p + 1) / (p + 2) for p, _ in counts], [1 / (n + 2) for _, n in counts]
    at = np.array([[0.0, np.log((n + 1) / (p + 1))] for p, n in counts])
    trial, step, loss, done = at.copy(), np.zeros_like(at), np.full(pairs, np.inf), np.zeros(pairs, bool)

    def of(values) -> F.Column:
        return F.get(F.array(*[F.lit(float(v)) for v in values]), F.col("pair"))

    for _ in range(steps):
        u = of(trial[:, 0]) * F.col("margin") + of(trial[:, 1])
        t, chance = F.when(F.col("positive"), of(high)).otherwise(of(low)), 1 / (1 + F.exp(u))
        # log(1 + exp(u)) without overflow
        grown = F.greatest(u, F.lit(0.0)) + F.log1p(F.exp(-F.abs(u)))
        rows = margins.select("pair", "margin", (t * grown + (1 - t) * (grown - u)).alias("loss"), (t - chance).alias("d"),
                              (chance * (1 - chance)).alias("c"))
        m = F.col("margin")
        found = rows.groupBy("pair").agg(F.sum("loss"), F.sum(m * F.col("d")), F.sum("d"), F.sum(m * m * F.col("c")),
                                         F.sum(m * F.col("c")), F.sum("c")).collect()
        for k, now, ga, gb, haa, hab, hbb in found:
            if done[k]:
                continue
            if now > loss[k] * (1 + 1e-12):
                step[k] /= 2
                done[k] = np.abs(step[k]).max() < tolerance
            else:
                at[k], loss[k] = trial[k], now
                step[k] = -np.linalg.solve([[haa + 1e-9, hab], [hab, hbb + 1e-9]], [ga, gb])
                done[k] = np.abs([ga, gb]).max() < tolerance * (1 + now)
            trial[k] = at[k] + step[k]
        if done[[k for k in range(pairs) if k in sizes]].all():
            break
    return [tuple(map(float, row)) for row in at]


def fit_margin_classifier(staged: DataFrame, label: str, weight: str, key: str, classes: int, lift, n_features: int,
                          cost: float = 1.0) -> MarginClassifier:
    """A hinge margin per pair of classes, as ``SVC(C=cost,
    class_weight=...)`` has it, and a sigmoid per pair fitted to margins of
    rows that the weights have not seen: five folds by a hash of ``key``. All
    pairs and folds are solved together."""
    rows = _rows(staged, label, weight, key)
    pairs = list(combinations(range(classes), 2))
    keys = [(k, f) for k in range(len(pairs)) for f in [*range(FOLDS), ALL]]
    problems = [convex.Problem(partial(_pair, first=pairs[k][0], second=pairs[k][1], left_out=f, cost=cost)) for k, f in keys]
    weights = dict(zip(keys, convex.solve(rows, problems, lift, n_features)))
    sigmoids = fit_sigmoids(_margins(rows, weights, pairs, lift), len(pairs)) if pairs else []
    flat = [float(v) for k in range(len(pairs)) for v in weights[k, ALL]]
    return MarginClassifier(featuresCol="rff", classes=classes, weights=flat, sigmoids=[v for s in sigmoids for v in s])


def coupled(chances: np.ndarray, classes: int) -> np.ndarray:
    """Class probabilities that agree best with the pairs' (Wu, Lin and Weng
    2004): chances (rows, pairs in order) of each pair's first class."""
    n = len(chances)
    r = np.zeros((n, classes, classes))
    for k, (a, b) in enumerate(combinations(range(classes), 2)):
        r[:, a, b] = np.clip(chances[:, k], 1e-7, 1 - 1e-7)
        r[:, b, a] = 1 - r[:, a, b]
    system = np.zeros((n, classes + 1, classes + 1))
    system[:, :classes, :classes] = -r * r.transpose(0, 2, 1)
    own = np.arange(classes)
    system[:, own, own] = (r ** 2).sum(1)
    system[:, :classes, classes] = system[:, classes, :classes] = 1
    right = np.zeros((n, classes + 1, 1))
    right[:, classes] = 1
    p = np.clip(np.linalg.solve(system, right)[:, :classes, 0], 0, 1)
    return p / p.sum(1, keepdims=True)


class MarginRegression(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """``w.z + b``; weights with the intercept last."""

    weights = Param(Params._dummy(), "weights", "weights, intercept last", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, featuresCol="rff", predictionCol="prediction", weights=()):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        w = np.array(self.getOrDefault("weights"))

        @pandas_udf("double")
        def value(zs: pd.Series) -> pd.Series:
            return pd.Series(np.stack(zs.to_numpy()) @ w[:-1] + w[-1] if len(zs) else [], dtype=float)

        return dataset.withColumn(self.getOrDefault("predictionCol"), value(vector_to_array(F.col(self.getOrDefault("featuresCol")))))


class MarginClassifier(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Prediction by most votes of the pairs' margins (the first class of the
    most), probabilities by sigmoids and coupling."""

    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)
    weights = Param(Params._dummy(), "weights", "weights of all pairs, each with its intercept last", TypeConverters.toListFloat)
    sigmoids = Param(Params._dummy(), "sigmoids", "A and B of all pairs", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, featuresCol="rff", predictionCol="prediction", classes=1, weights=(), sigmoids=()):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        k = self.getOrDefault("classes")
        pairs = list(combinations(range(k), 2))
        w = np.array(self.getOrDefault("weights")).reshape(len(pairs), -1) if pairs else np.zeros((0, 1))
        s = np.array(self.getOrDefault("sigmoids")).reshape(len(pairs), 2)

        @pandas_udf("struct<prediction:double,probability:array<double>>")
        def judged(zs: pd.Series) -> pd.DataFrame:
            n = len(zs)
            if not n or not pairs:
                return pd.DataFrame({"prediction": np.zeros(n), "probability": [[1.0]] * n})
            z = np.stack(zs.to_numpy())
            margin = z @ w[:, :-1].T + w[:, -1]
            votes = np.zeros((n, k))
            for j, (a, b) in enumerate(pairs):
                votes[:, a] += margin[:, j] > 0
                votes[:, b] += margin[:, j] <= 0
            chance = 1 / (1 + np.exp(np.clip(margin * s[:, 0] + s[:, 1], -500, 500)))
            return pd.DataFrame({"prediction": votes.argmax(1).astype(float), "probability": list(coupled(chance, k))})

        rows = dataset.withColumn("__judged", judged(vector_to_array(F.col(self.getOrDefault("featuresCol")))))
        return rows.withColumn(self.getOrDefault("predictionCol"), F.col("__judged.prediction")).withColumn(
            "probability", array_to_vector(F.col("__judged.probability"))).drop("__judged")
