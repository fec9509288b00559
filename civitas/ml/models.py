"""Model factories (M10-M16) on Spark ML, with the reference's settings.

Forests and kernel machines, which Spark ML does not have in this form, are in
``forests`` and ``margins``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.regression import LinearRegression
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ..session import scratch_dir
from .forests import Forest

SEED = 42
RFF_COMPONENTS = 200


def fourier_features(gamma: float, n: int, seed: int, dim: int):
    """The feature map as a function of a matrix; its directions come from the
    seed, wherever it runs."""
    def lift(x: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng(seed)
        w = rng.normal(0.0, math.sqrt(2.0 * gamma), size=(dim, n))
        b = rng.uniform(0.0, 2.0 * math.pi, size=n)
        return math.sqrt(2.0 / n) * np.cos(x @ w + b)
    return lift


class RandomFourierFeatures(Transformer, HasInputCol, HasOutputCol,
                            DefaultParamsReadable, DefaultParamsWritable):
    """RBF-kernel feature map (Rahimi & Recht 2007):
    z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2*gamma), b ~ U(0, 2*pi).

    W and b are regenerated from the seed on every executor, so the stage
    stores only (gamma, D, seed, input dim) and survives save/load. The
    projection runs as an Arrow-batched pandas UDF (one matrix product per
    batch); Spark partitions the rows.
    """

    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    nComponents = Param(Params._dummy(), "nComponents", "output dimension", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)
    inputDim = Param(Params._dummy(), "inputDim", "input dimension", TypeConverters.toInt)

    @keyword_only
    def __init__(self, inputCol="features", outputCol="rff", gamma=1.0, nComponents=RFF_COMPONENTS,
                 seed=SEED, inputDim=1):
        super().__init__()
        self._setDefault(gamma=1.0, nComponents=RFF_COMPONENTS, seed=SEED, inputDim=1)
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        g, d, s, p = (self.getOrDefault(self.gamma), self.getOrDefault(self.nComponents),
                      self.getOrDefault(self.seed), self.getOrDefault(self.inputDim))

        lift = fourier_features(g, d, s, p)

        @pandas_udf("array<double>")
        def project(xs: pd.Series) -> pd.Series:
            return pd.Series(list(lift(np.stack(xs.to_numpy()) if len(xs) else np.zeros((0, p)))))

        arr = vector_to_array(F.col(self.getInputCol()))
        return dataset.withColumn(self.getOutputCol(), array_to_vector(project(arr)))


def gamma_scale(df, features_col: str = "features", dim: int | None = None) -> float:
    """sklearn ``gamma='scale'`` = 1 / (p * var(X)) over all feature values
    (one aggregation on the exploded values; population variance)."""
    vals = df.select(F.explode(vector_to_array(F.col(features_col))).alias("v"))
    row = vals.agg(F.var_pop("v").alias("var"), F.count(F.lit(1)).alias("n")).first()
    p = dim or 1
    var = row["var"] or 1.0
    return 1.0 / (p * var) if var > 0 else 1.0


def logistic_regression(total_weight: float, **kw):
    """Multinomial, L2 with C=1, <=2000 iterations, class-balanced
    weights: Spark's mean loss + regParam/2 |w|^2 equals the sklearn
    objective when regParam = 1 / (C * sum of weights)."""
    return LogisticRegression(featuresCol="features", labelCol="label_idx", weightCol="weight",
                              family="multinomial", maxIter=2000, regParam=1.0 / total_weight,
                              elasticNetParam=0.0, standardization=False, tol=1e-6, **kw)


def without_summary(spark: SparkSession, model):
    """``model`` written and read again, so without its training summary. A
    two-class summary holds the session, which can't go to the tasks once any
    query of the session has observed metrics."""
    folder = scratch_dir(spark, "model")
    model.write().save(folder)
    return type(model).load(folder)


def forest_classifier(n_classes: int, key: str, n_trees: int, max_rows: int, random_cuts: bool, seed: int) -> Forest:
    """All rows, sqrt(p) features per split, balanced weights, no
    limit of depth; random cuts without bootstrap for extremely randomised
    trees. ``max_rows`` of a tree are grown at once."""
    return Forest(featuresCol="features", labelCol="label_idx", weightCol="weight", keyCol=key, nClasses=n_classes,
                  nTrees=n_trees, atOnce=max_rows, randomCuts=random_cuts, seed=seed + random_cuts)


def forest_regressor(key: str, n_trees: int, max_rows: int, random_cuts: bool, seed: int) -> Forest:
    """All rows, all features at every split, no limit of depth."""
    return Forest(featuresCol="features", labelCol="y", keyCol=key, nTrees=n_trees, atOnce=max_rows,
                  randomCuts=random_cuts, seed=seed + random_cuts)


def ridge(alpha: float, n: int, y_std: float):
    """Sklearn Ridge(alpha) minimises |y - Xw|^2 + alpha |w|^2;
    Spark's normal-equation solver scales the penalty by std(y), hence
    regParam = alpha * std_pop(y) / n."""
    return LinearRegression(featuresCol="features", labelCol="y", solver="normal",
                            standardization=False, elasticNetParam=0.0,
                            regParam=alpha * (y_std or 1.0) / max(n, 1))
