"""Learning operators: preprocessing semantics (T21-T23), ridge against the
normal equations (T24), splits/folds partition the rows, metrics against
hand computation, model persistence."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from civitas.ml import compare as C
from civitas.ml import metrics as Me
from civitas.ml import models as Mo
from civitas.ml import prep


def test_median_imputation_interpolates(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    assert prep.fit_medians(df, ["x"]) == {"x": 2.5}


def test_scaling_uses_population_std(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    m, s = prep.fit_scaling(df, ["x"])["x"]
    assert m == 2.0 and s == pytest.approx(np.std([1, 2, 3]))


def test_preprocessor_imputes_scales_and_one_hot(spark):
    train = spark.createDataFrame([(1.0, "b"), (None, "a"), (3.0, None), (5.0, "b")], "x double, c string")
    pre = prep.fit_preprocessor(train, ["x"], ["c"])
    test = spark.createDataFrame([(None, "zzz"), (3.0, "a")], "x double, c string")
    out = [r["a"] for r in pre.transform(test).select(vector_to_array("features").alias("a")).collect()]
    vals = np.array([1.0, 3.0, 3.0, 5.0])  # median 3 imputed
    z = (3.0 - vals.mean()) / vals.std()
    assert out[0] == pytest.approx([z, 0.0, 0.0])      # unseen category -> zero vector
    assert out[1] == pytest.approx([z, 1.0, 0.0])      # alphabetical slots: a, b


def test_ridge_matches_normal_equations(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(60, 3))
    y = X @ np.array([1.0, -2.0, 0.5]) + 3 + rng.normal(scale=0.1, size=60)
    rows = [(int(i), *map(float, X[i]), float(y[i])) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double")
    from pyspark.ml.feature import VectorAssembler
    feats = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    model = Mo.ridge(1.0, 60, float(np.std(y))).fit(feats)
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.linalg.solve(Xc.T @ Xc + np.eye(3), Xc.T @ yc)
    assert np.allclose(model.coefficients.toArray(), w, atol=1e-6)


def test_split_and_folds_partition_rows(spark, sf_dir):
    lab = spark.read.parquet(f"{sf_dir}/labels.parquet")
    n = lab.count()
    s = prep.stratified_split(lab, "quality", 0.2, 42, "doc_id")
    f = prep.folds(lab, 5, 42, "doc_id", label="quality")
    assert s.count() == n and f.count() == n
    assert f.select("doc_id").distinct().count() == n
    sizes = [r["count"] for r in f.groupBy("fold").count().collect()]
    assert max(sizes) - min(sizes) <= 2


def test_exact_rank_is_a_permutation(spark):
    from civitas.operators.ranking import exact_rank, hash_key
    df = spark.range(5000).withColumn("g", F.col("id") % 3).withColumn("h", hash_key(7, "id"))
    r = exact_rank(df, ["g"], "h", "id")
    per = r.groupBy("g").agg(F.min("rank").alias("lo"), F.max("rank").alias("hi"),
                             F.count_distinct("rank").alias("nd"), F.count(F.lit(1)).alias("n")).collect()
    for row in per:
        assert row["lo"] == 1 and row["hi"] == row["n"] == row["nd"]


def test_classification_metrics_by_hand(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 1)], "y int, p int")
    m = Me.classification_metrics(df, "y", "p").first()
    # class0: tp1 sup2 pred1; class1: tp2 sup2 pred4; class2: tp0 sup1 pred0
    assert m["accuracy"] == pytest.approx(3 / 5)
    assert m["precision_weighted"] == pytest.approx((1 * 2 + 0.5 * 2 + 0) / 5)
    assert m["recall_weighted"] == pytest.approx((0.5 * 2 + 1 * 2 + 0) / 5)
    assert m["f1_weighted"] == pytest.approx((2 / 3 * 2 + 2 * 2 / 6 * 2) / 5)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.0)], "y double, p double")
    m = Me.regression_metrics(df, "y", "p").first()
    assert m["mae"] == pytest.approx(0.5)
    assert m["rmse"] == pytest.approx(np.sqrt((0.25 + 0 + 1) / 3))
    assert m["r2"] == pytest.approx(1 - 1.25 / 2)


def test_compare_and_persist(spark, sf_dir, tmp_path):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    df = e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(8)],
                  (F.col("label") % 2).cast("string").alias("target"))
    cfg = C.Config(target="target", id_col="vec_id", k_folds=2, n_trees=5, parallelism=2,
                   models=("logistic_regression", "random_forest"))
    res = C.compare_classifiers(df, cfg)
    board = res["leaderboard"].collect()
    assert [r["model"] for r in board] and len(board) == 2
    assert board[0]["f1_weighted_test"] >= board[1]["f1_weighted_test"]
    preds = res["predictions"]
    assert {"proba_0", "proba_1", "y_true", "y_pred"} <= set(preds.columns)
    path = str(tmp_path / "model")
    C.save_model(res["models"]["random_forest"], path)
    before = res["models"]["random_forest"].transform(df.withColumn("__target", F.col("target")))
    again = C.load_model(path).transform(df.withColumn("__target", F.col("target")))
    assert again.count() == df.count()
    assert dict(again.select("vec_id", "prediction").collect()) == dict(before.select("vec_id", "prediction").collect())


def test_two_class_models_go_to_tasks_after_observed_metrics(spark):
    """A session that has observed metrics can't be sent to tasks, so a model
    must not hold it."""
    from pyspark.sql import Observation
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    df = spark.createDataFrame([(i, float(i), i // 2 % 2 + 0.0) for i in range(20)], "id long, x double, label_idx double")
    model = C.fit_classifier("logistic_regression", df, ["x"], [], C.Config(target="label_idx", id_col="id"), 2)
    assert not model.stages[-1].hasSummary
    assert model.transform(df).repartition(2).select("prediction").distinct().count() <= 2


def test_rff_transformer_roundtrip(spark, tmp_path):
    df = spark.createDataFrame([(i, float(i), float(-i)) for i in range(20)], "id long, a double, b double")
    from pyspark.ml.feature import VectorAssembler
    feats = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    rff = Mo.RandomFourierFeatures(inputCol="features", outputCol="rff", gamma=0.5, nComponents=16,
                                   inputDim=2, seed=3)
    a = rff.transform(feats).select(vector_to_array("rff").alias("z")).collect()
    path = str(tmp_path / "rff")
    rff.save(path)
    b = Mo.RandomFourierFeatures.load(path).transform(feats).select(vector_to_array("rff").alias("z")).collect()
    assert [r["z"] for r in a] == [r["z"] for r in b]
    assert len(a[0]["z"]) == 16


def test_quantiles_match_numpy(spark):
    from civitas.operators import profile as Pr
    rng = np.random.default_rng(1)
    vals = np.concatenate([rng.exponential(1e6, 3000), np.full(2000, 7.0), rng.normal(0, 1e-6, 1000)])
    rows = [(float(x), 1.0) for x in vals] + [(float("nan"), None), (None, float("inf"))]
    df = spark.createDataFrame(rows, "x double, y double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0, 0.3337]
    got = {(r["column"], r["prob"]): r["value"] for r in Pr.quantiles(df, ["x", "y"], probs).collect()}
    assert [got[("x", p)] for p in probs] == pytest.approx(list(np.quantile(vals, probs)), rel=1e-12, abs=1e-15)
    assert got[("y", 0.5)] == 1.0 and got[("y", 1.0)] == float("inf")
    box = Pr.box_stats(df, "x").first()
    assert box["median"] == pytest.approx(np.median(vals)) and box["n_outliers"] > 0
    stats = {(r["column"], r["statistic"]): r["value"] for r in Pr.describe(df, ["x"]).collect()}
    assert stats[("x", "count")] == 6000 and stats[("x", "50%")] == box["median"] and stats[("x", "max")] == vals.max()


def test_moments_of_large_values_and_missing_classes(spark):
    df = spark.createDataFrame([(i, 1e9 + i / 1000, None if i % 10 == 0 else "a") for i in range(1000)], "id long, x double, c string")
    median, mean, std = prep.fit_numeric_stats(df, ["x"])["x"]
    assert std == pytest.approx(np.std(np.arange(1000) / 1000), rel=1e-4) and median == pytest.approx(1e9 + 0.4995)
    split = prep.stratified_split(df, "c", 0.2, 42, "id")
    assert split.count() == 1000 and split.filter("is_test and c is null").count() == 20
    assert prep.folds(df, 5, 42, "id", label="c").count() == 1000


def test_registered_forests_have_full_size():
    from civitas.plans import bind_ml
    for registered in (bind_ml.CLS_CFG, bind_ml.REG_CFG):
        cfg = C.Config(**registered)
        assert (cfg.n_trees, cfg.max_rows) == (300, 16_384)
