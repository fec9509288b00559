"""Forests, margin models and fold statistics against plain versions."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from civitas.ml import compare as C
from civitas.ml import convex, forests, margins, models, prep
from civitas.ml.forests import Forest, grow_tree


def made(spark, x, y, **extra):
    names = [f"x{j}" for j in range(x.shape[1])]
    rows = [(k, *map(float, v), float(t)) for k, (v, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{n} double" for n in names) + ", y double")
    return VectorAssembler(inputCols=names, outputCol="features").transform(df)


def best_cut(x, y, w):
    """(score, feature, threshold) by trying every cut."""
    found = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for a, b in zip(values, values[1:]):
            left = x[:, f] <= a
            score = sum((w[s] * y[s]).sum() ** 2 / w[s].sum() for s in (left, ~left))
            found.append((score, f, (a + b) / 2))
    return max(found, key=lambda t: t[0])


def test_a_tree_takes_the_best_cut_and_fits_its_rows():
    r = np.random.default_rng(0)
    x, w = np.round(r.normal(size=(80, 3)), 1), r.integers(1, 4, 80).astype(float)
    y = np.round(np.sin(3 * x[:, 0]) + x[:, 1], 2)
    stats = np.stack([w, w * y], axis=1)
    tree = grow_tree(x, stats, y, 3, False, np.random.default_rng(1))
    _, f, threshold = best_cut(x, y, w)
    assert (tree["feature"][0], tree["threshold"][0]) == (f, pytest.approx(threshold))
    at = np.zeros(len(x), int)
    for _ in range(80):
        inner = tree["feature"][at] >= 0
        go = x[np.arange(len(x)), tree["feature"][at]] > tree["threshold"][at]
        at = np.where(inner, tree["left"][at] + go, at)
    for k in range(len(x)):  # a leaf holds the mean of the rows that can't be told apart
        same = (x == x[k]).all(1)
        assert tree["value"][at[k], 0] == pytest.approx((w[same] * y[same]).sum() / w[same].sum())


def test_random_cuts_differ_by_seed_and_lie_inside():
    x = np.random.default_rng(0).normal(size=(200, 2))
    y = x[:, 0] + x[:, 1]
    stats = np.stack([np.ones(200), y], axis=1)
    first, second = (grow_tree(x, stats, y, 2, True, np.random.default_rng(s)) for s in (1, 2))
    assert first["threshold"][0] != second["threshold"][0]
    for tree in (first, second):
        f = tree["feature"][0]
        assert x[:, f].min() <= tree["threshold"][0] < x[:, f].max()


@pytest.mark.parametrize("cuts", [False, True])
def test_averaging_trees_lowers_the_error(spark, cuts):
    r = np.random.default_rng(2)
    x = r.normal(size=(900, 4))
    y = np.sin(2 * x[:, 0]) + x[:, 1] ** 2 + 0.3 * r.normal(size=900)
    df = made(spark, x, y)
    train, test = df.where("id < 600").repartition(5), df.where("id >= 600")

    def error(trees, **more):
        model = Forest(labelCol="y", keyCol="id", nTrees=trees, randomCuts=cuts, **more).fit(train)
        return model, model.transform(test).agg(F.avg(F.pow(F.col("prediction") - F.col("y"), 2))).first()[0]
    _, one = error(1)
    model, many = error(40)
    assert many < 0.7 * one and model.trees.count() == 40
    bounded, few = error(40, maxRows=100)  # every tree draws its own rows
    nodes = [r.n for r in bounded.trees.select(F.size("feature").alias("n")).collect()]
    assert max(nodes) < 2 * 160 and few < np.var(y)
    again = Forest(labelCol="y", keyCol="id", nTrees=40, randomCuts=cuts).fit(train.repartition(3))
    assert again.transform(test).agg(F.avg("prediction")).first()[0] == pytest.approx(model.transform(test).agg(F.avg("prediction")).first()[0], rel=1e-9)


def test_solver_reaches_the_least_objective(spark):
    r = np.random.default_rng(3)
    x, n = r.normal(size=(200, 3)), 3
    y = 2 * x[:, 0] - x[:, 2] + r.normal(size=200)
    rows = made(spark, x, y).repartition(4).select(vector_to_array("features").alias("x"), "y", F.lit(0.0).alias("fold"), F.lit(1.0).alias("weight"))
    problem = convex.Problem(lambda y, f, w: margins._insensitive(y, f, w, 0.1, 1.0))
    w, = convex.solve(rows, [problem], lambda v: v, n)
    assert convex.duality_gap(rows, [problem], lambda v: v, n)[0] < 1e-4

    def objective(v):
        return (v[:-1] ** 2).sum() / 2 + np.maximum(0, np.abs(y - x @ v[:-1] - v[-1]) - 0.1).sum()
    least = objective(w)
    for scale in (1.0, 0.1, 0.01, 0.001):  # nothing around is lower
        for _ in range(500):
            assert objective(w + scale * r.normal(size=4)) > least * (1 - 1e-4)


def test_hinge_separates_and_leaves_folds_out(spark):
    r = np.random.default_rng(4)
    x = r.normal(size=(200, 2))
    label = (x[:, 0] + 0.2 * r.normal(size=200) > 0).astype(float)
    rows = made(spark, x, label).select(vector_to_array("features").alias("x"), "y", (F.col("id") % 5).cast("double").alias("fold"), F.lit(1.0).alias("weight"))
    problems = [convex.Problem(lambda y, f, w, k=k: margins._pair(y, f, w, 1, 0, k, 1.0)) for k in (-1, 0)]
    whole, part = convex.solve(rows, problems, lambda v: v, 2)
    assert ((x @ whole[:-1] + whole[-1] > 0) == (label == 1)).mean() > 0.9
    kept = rows.where("fold <> 0")
    alone = convex.Problem(lambda y, f, w: margins._pair(y, f, w, 1, 0, -1, 1.0))
    assert np.allclose(part, convex.solve(kept, [alone], lambda v: v, 2)[0], atol=1e-3)


def test_coupled_probabilities():
    p = np.array([[0.5, 0.3, 0.2], [0.1, 0.1, 0.8]])
    pairs = np.stack([p[:, a] / (p[:, a] + p[:, b]) for a, b in ((0, 1), (0, 2), (1, 2))], axis=1)
    assert np.allclose(margins.coupled(pairs, 3), p, atol=1e-6)


def test_calibrated_classifier(spark, tmp_path):
    r = np.random.default_rng(5)
    x = r.normal(size=(500, 4))
    label = np.argmax(np.stack([x[:, 0], x[:, 1], x[:, 2]]) + 0.8 * r.normal(size=(3, 500)), axis=0)
    staged = made(spark, x, label).withColumn("w", F.lit(1.0))
    train, test = staged.where("id < 350"), staged.where("id >= 350")
    rff = models.RandomFourierFeatures(inputCol="features", outputCol="rff", gamma=0.25, inputDim=4, nComponents=60)
    lift = models.fourier_features(0.25, 60, 42, 4)
    model = margins.fit_margin_classifier(train, "y", "w", "id", 3, lift, 60)
    rows = model.transform(rff.transform(test)).select("y", "prediction", vector_to_array("probability").alias("p")).toPandas()
    p = np.stack(rows.p)
    assert np.allclose(p.sum(1), 1)
    plain = margins.MarginClassifier(featuresCol="rff", classes=3, weights=model.getOrDefault("weights"), sigmoids=[-5.0, 0.0] * 3)
    raw = np.stack(plain.transform(rff.transform(test)).select(vector_to_array("probability").alias("p")).toPandas().p)
    loss = [-np.log(np.clip(q[np.arange(len(rows)), rows.y.astype(int)], 1e-9, 1)).mean() for q in (p, raw)]
    assert loss[0] < loss[1] and (rows.prediction == rows.y).mean() > 0.5
    model.save(str(tmp_path / "m"))
    again = margins.MarginClassifier.load(str(tmp_path / "m")).transform(rff.transform(test)).toPandas()
    assert list(again.prediction) == list(rows.prediction)


def test_fold_statistics_equal_refitting(spark):
    r = np.random.default_rng(6)
    rows = [(k, float(r.normal()) if k % 7 else None, float(r.integers(0, 5)) + 1e6, "abc"[int(r.integers(0, 3))] if k % 11 else None, "de"[k % 2], int(k % 3))
            for k in range(200)] + [(200, float("nan"), 3.0, "rare", "d", 1)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c string, d string, fold int").repartition(4)
    for k, pre in enumerate(prep.fold_preprocessors(df, ["a", "b"], ["c", "d"], 3)):
        part = df.where(F.col("fold") != k)
        want = prep.fit_preprocessor(part, ["a", "b"], ["c", "d"])
        got = [np.array([v.a for v in p.transform(df.orderBy("id")).select(vector_to_array("features").alias("a")).collect()]) for p in (pre, want)]
        assert np.allclose(*got, atol=1e-6)


def test_fold_statistics_read_the_rows_once(spark, tmp_path):
    spark.range(100).select("id", (F.col("id") % 9).cast("double").alias("a"), F.lit("x").alias("c"), (F.col("id") % 5).cast("int").alias("fold")
                            ).write.parquet(str(tmp_path / "rows"))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.read.parquet(str(tmp_path / "rows"))
    prep.fold_preprocessors(df.mapInArrow(count, df.schema), ["a"], ["c"], 5)
    assert seen.value == 100


def test_cross_validation_covers_every_row(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    df = e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(4)], (F.col("label") % 2).cast("string").alias("target"))
    cfg = C.Config(target="target", id_col="vec_id", k_folds=2, n_trees=4, parallelism=2)
    prepared = C.prepare_classification(df, cfg)
    oof = C.cross_validate(prepared, C.CLASSIFIERS)
    assert oof.groupBy("model").count().select("count").distinct().first()[0] == prepared["train"].count()
    scores = C.cv_scores(oof).toPandas()
    assert len(scores) == 8 and scores.accuracy.between(0, 1).all() and not math.isnan(scores.accuracy.sum())


def test_solver_takes_few_passes_and_collects_vectors_only(spark, monkeypatch):
    r = np.random.default_rng(7)
    x = r.normal(size=(400, 6))
    label = r.integers(0, 3, 400).astype(float)  # no pair can be told apart
    lift = models.fourier_features(0.2, 60, 42, 6)
    staged = made(spark, x, label)
    passes, rows, plain = [], [], convex._summed

    def counted(*args):
        passes.append(args)
        return plain(*args)
    monkeypatch.setattr(convex, "_summed", counted)
    arrow = type(staged).toArrow
    monkeypatch.setattr(type(staged), "toArrow", lambda df: rows.append(arrow(df)) or rows[-1])
    margins.fit_margin_classifier(staged.withColumn("w", F.lit(1.0)), "y", "w", "id", 3, lift, 60)
    assert len(passes) <= 60 and max(t.nbytes for t in rows) < 18 * 8 * 4 * 61


def test_many_rows_start_from_a_sample_and_end_with_all(spark, monkeypatch):
    r = np.random.default_rng(8)
    x = r.normal(size=(900, 3))
    y = x[:, 0] - 2 * x[:, 1] + 0.5 * r.normal(size=900)
    rows = made(spark, x, y).repartition(3).select(vector_to_array("features").alias("x"), "y", F.lit(0.0).alias("fold"), F.lit(1.0).alias("weight"))

    def solved():
        problem = convex.Problem(lambda y, f, w: margins._insensitive(y, f, w, 0.1, 1.0))
        return convex.solve(rows, [problem], lambda v: v, 3)[0]
    whole = solved()
    monkeypatch.setattr(convex, "START_ROWS", 100)
    monkeypatch.setattr(convex, "BUCKETS", 2)
    assert np.allclose(solved(), whole, atol=1e-4)


def test_random_cuts_of_all_features_at_once_are_those_one_by_one(monkeypatch):
    r = np.random.default_rng(9)
    x = np.round(r.normal(size=(300, 7)), 1)
    y = r.integers(0, 3, 300).astype(float)
    w = r.random(300)[:, None]
    stats = np.concatenate([w, w * (y[:, None] == np.arange(3))], axis=1)
    whole = grow_tree(x, stats, y, 3, True, np.random.default_rng(1))
    monkeypatch.setattr(forests, "PAIR_ROWS", 1)
    alone = grow_tree(x, stats, y, 3, True, np.random.default_rng(1))
    assert all(np.array_equal(whole[k], alone[k]) for k in whole)


@pytest.mark.parametrize("cuts", [False, True])
def test_many_rows_give_the_same_trees_dealt_to_each_alone(spark, monkeypatch, cuts):
    r = np.random.default_rng(10)
    x = r.normal(size=(1000, 3))
    df = made(spark, x, (x[:, 0] > 0).astype(float) + (x[:, 1] > 0))
    kinds, found = [], []
    for shared in (1000, 1):
        monkeypatch.setattr(forests, "SHARED", shared)
        forest = Forest(labelCol="y", keyCol="id", nClasses=3, nTrees=10, randomCuts=cuts, maxRows=100)
        kinds.append(forest._drawn(df)[0])
        found.append([r.asDict() for r in forest.fit(df).trees.orderBy("tree").collect()])
    assert found[0] == found[1] and len(found[0]) == 10
    assert kinds[1].count() < 10 * 200  # a row is copied for the trees that take it only


def test_compact_trees_hold_values_of_leaves_only():
    r = np.random.default_rng(11)
    x = r.normal(size=(200, 3))
    y = r.integers(0, 2, 200).astype(float)
    stats = np.stack([np.ones(200), y == 0, y == 1], axis=1).astype(float)
    tree = grow_tree(x, stats, y, 2, False, np.random.default_rng(1))
    small = forests.compact(*(tree[k] for k in ("feature", "threshold", "left")), tree["value"].reshape(-1), 2)
    assert len(small[3]) == (tree["feature"] < 0).sum()
    assert np.array_equal(forests.leaf_values([small], x, 2).argmax(1), y)
    assert sum(a.nbytes for a in small) < 0.8 * sum(tree[k].nbytes for k in tree)


def leaves(tree):
    return (np.array(tree["left"]) < 0).sum()


@pytest.mark.parametrize("name", ["random_forest", "extra_trees"])
def test_regression_trees_are_grown_from_all_rows(spark, name):
    n = 40_000
    df = spark.range(n).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), F.col("id").cast("double").alias("y")).repartition(4)
    model = C.fit_regressor(name, df, ["a", "b"], [], C.Config(target="y", id_col="id", n_trees=2))
    for tree in model.stages[-1].trees.collect():  # no two rows agree, so every row a tree has taken is a leaf
        assert leaves(tree) == n if name == "extra_trees" else abs(leaves(tree) / n - (1 - math.exp(-1))) < 0.01


@pytest.mark.parametrize("cuts", [False, True])
def test_lots_of_nodes_make_a_whole_tree(cuts):
    r = np.random.default_rng(12)
    x = r.normal(size=(500, 1))
    y = r.normal(size=500)
    stats = np.stack([np.ones(500), y], axis=1)
    whole, lots = (grow_tree(x, stats, y, 1, cuts, np.random.default_rng(1), k) for k in (0, 40))
    assert len(whole["left"]) == len(lots["left"]) == 999
    if not cuts:  # of one feature the best cuts are the same wherever they are looked for
        assert np.allclose(np.sort(whole["threshold"]), np.sort(lots["threshold"]))
    small = forests.compact(lots["feature"], lots["threshold"], lots["left"], lots["value"].reshape(-1), 1)
    assert np.allclose(forests.leaf_values([small], x, 1)[:, 0], y)


@pytest.mark.parametrize("classes", [0, 3])
def test_stored_trees_predict_what_trees_grown_beside_the_rows_do(spark, classes, monkeypatch):
    r = np.random.default_rng(13)
    x = r.normal(size=(300, 3))
    df = made(spark, x, r.integers(0, 3, 300)).repartition(3)
    twice = df.unionAll(df.where("id < 20"))  # rows to predict may repeat
    model = Forest(labelCol="y", keyCol="id", nTrees=20, nClasses=classes, atOnce=64).fit(df)

    def told():
        return sorted((r.id, r.prediction) for r in model.transform(twice).select("id", "prediction").collect())
    fresh = told()
    monkeypatch.setattr(forests, "NODES_AT_ONCE", 1000)
    assert model.trees.count() == 20
    assert len(fresh) == 320 and np.allclose(fresh, told())


def test_trees_of_a_classifier_learn_every_row(spark):
    n = 40_000
    df = spark.range(n).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), (F.rand(3) > 0.5).cast("double").alias("label_idx")).repartition(4)
    model = C.fit_classifier("extra_trees", df, ["a", "b"], [], C.Config(target="label_idx", id_col="id", n_trees=2), 2)
    assert model.transform(df).where("prediction <> label_idx").count() == 0


@pytest.fixture
def rows_of_trees(monkeypatch):
    """(rows to learn from, least and most rows of a tree) of every forest."""
    seen, dealt = [], Forest._dealt

    def watched(self, rows):
        table, together = dealt(self, rows)
        per = table.select(F.col("group"), F.posexplode("times").alias("j", "k")).where("k > 0").groupBy((F.col("group") * together + F.col("j")).alias("tree")).count()
        low, high = per.where(F.col("tree") < self.getOrDefault("nTrees")).agg(F.min("count"), F.max("count")).first()
        seen.append((rows.count(), low, high))
        return table, together
    monkeypatch.setattr(Forest, "_dealt", watched)
    return seen


def whole(seen, train, folds):
    """Every forest had all rows of its part, every tree without bootstrap all of them."""
    assert {n for n, _, _ in seen} == {train, *folds}
    assert all(low == high == n for n, low, high in seen)


def odd_rows(spark, classes):
    y = F.col("id") % 2 if classes else F.sqrt("id")
    return spark.range(1000).select("id", F.rand(1).alias("a"), F.rand(2).alias("b"), y.cast("string" if classes else "double").alias("target"))


SMALL_LOTS = dict(target="target", id_col="id", k_folds=2, n_trees=3, max_rows=50, models=("extra_trees",))


def test_cross_validation_learns_all_rows_of_the_other_folds(spark, rows_of_trees):
    prepared = C.prepare_classification(odd_rows(spark, True), C.Config(**SMALL_LOTS))
    assert C.cv_scores(C.cross_validate(prepared, ("extra_trees",))).count() == 2
    whole(rows_of_trees, 400, {400})


def test_a_comparison_of_classifiers_learns_all_rows(spark, rows_of_trees):
    result = C.compare_classifiers(odd_rows(spark, True), C.Config(**SMALL_LOTS))
    assert result["leaderboard"].count() == 1 and result["predictions"].count() == 200
    whole(rows_of_trees, 800, {400})


def test_a_comparison_of_regressors_learns_all_rows(spark, rows_of_trees):
    result = C.compare_regressors(odd_rows(spark, False), C.Config(**SMALL_LOTS))
    assert result["leaderboard"].count() == 1 and result["predictions"].count() == 200
    whole(rows_of_trees, 800, {400})
