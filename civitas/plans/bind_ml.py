"""Learning operators M1-M25 and the comparison jobs J-18...J-20 on the
fixtures (embeddings as the classification table, orders with their line
measures as the regression table, labels as a predictions fixture)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..ml import compare as C
from ..ml import metrics as Me
from ..ml import prep
from ..ml.report import comparison_tables
from ..session import scratch_dir
from .fixtures import DL_SQL, T, documents_labels
from .registry import register

EMB_DIM = 64


def md5_key(col: str) -> str:
    return f"md5('42:' || CAST({col} AS VARCHAR))"


def embedding_table(spark, d):
    """vec_id, 64 numeric features, a categorical feature and a string class
    target (label mod 3 gives a 3-class problem)."""
    e = T(spark, d, "embeddings")
    return e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(EMB_DIM)],
                    F.when(F.col("label") < 5, "low").otherwise("high").alias("band"),
                    F.concat(F.lit("c"), (F.col("label") % 3).cast("string")).alias("target"))


def order_table(spark, d):
    """Per order: line measures as features, the order price as target."""
    li = T(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum("l_quantity").alias("sum_qty"),
        F.avg("l_discount").alias("avg_disc"), F.avg("l_tax").alias("avg_tax"),
        F.sum("l_extendedprice").alias("sum_ext"))
    o = T(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority",
                                     "o_orderstatus", "o_totalprice")
    return o.join(li, "l_orderkey", "left")


# Forests have the Config defaults' size (300 trees, grown out).
CLS_CFG = dict(target="target", id_col="vec_id")
REG_CFG = dict(target="o_totalprice", id_col="l_orderkey")


@register("m01_stratified_split", f"""
WITH r AS (SELECT doc_id, quality,
                  row_number() OVER (PARTITION BY quality ORDER BY {md5_key('doc_id')}, doc_id) AS rk,
                  count(*) OVER (PARTITION BY quality) AS n FROM labels)
SELECT quality, rk <= round_even(0.2 * n, 0) AS is_test, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS id_sum
FROM r GROUP BY ALL""")
def m01_stratified_split(spark, d):
    s = prep.stratified_split(T(spark, d, "labels"), "quality", 0.2, 42, "doc_id")
    return s.groupBy("quality", "is_test").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("id_sum"))


@register("m02_random_split", f"""
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY {md5_key('o_orderkey')}, o_orderkey) AS rk,
                  count(*) OVER () AS n FROM orders)
SELECT rk <= ceil(0.2 * n) AS is_test, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS id_sum
FROM r GROUP BY ALL""")
def m02_random_split(spark, d):
    s = prep.random_split(T(spark, d, "orders").select("o_orderkey"), 0.2, 42, "o_orderkey")
    return s.groupBy("is_test").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("id_sum"))


@register("m03_stratified_folds", f"""
WITH r AS (SELECT doc_id, quality,
                  row_number() OVER (PARTITION BY quality ORDER BY {md5_key('doc_id')}, doc_id) AS rk FROM labels)
SELECT quality, CAST((rk - 1) % 5 AS INTEGER) AS fold, count(*) AS n, CAST(sum(doc_id) AS BIGINT) AS id_sum
FROM r GROUP BY ALL""")
def m03_stratified_folds(spark, d):
    f = prep.folds(T(spark, d, "labels"), 5, 42, "doc_id", label="quality")
    return f.groupBy("quality", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("doc_id").alias("id_sum"))


@register("m04_impute_median", f"""
WITH dl AS {DL_SQL}
SELECT doc_id, coalesce(CAST(quality AS DOUBLE), (SELECT quantile_cont(quality, 0.5) FROM dl)) AS quality,
       coalesce(CAST(n_chars AS DOUBLE), (SELECT quantile_cont(n_chars, 0.5) FROM dl)) AS n_chars
FROM dl""")
def m04_impute_median(spark, d):
    dl = documents_labels(spark, d).select("doc_id", F.col("quality").cast("double").alias("quality"),
                                           F.col("n_chars").cast("double").alias("n_chars"))
    return prep.impute_median(dl, {c: s[0] for c, s in prep.fit_numeric_stats(dl, ["quality", "n_chars"]).items()})


@register("m05_impute_mode", f"""
WITH dl AS {DL_SQL}
SELECT doc_id, coalesce(CAST(toxic AS VARCHAR),
  (SELECT CAST(toxic AS VARCHAR) FROM dl WHERE toxic IS NOT NULL GROUP BY toxic
   ORDER BY count(*) DESC, toxic LIMIT 1)) AS toxic FROM dl""")
def m05_impute_mode(spark, d):
    dl = documents_labels(spark, d).select("doc_id", F.col("toxic").cast("string").alias("toxic"))
    return prep.impute_mode(dl, prep.fit_modes(dl, ["toxic"]))


@register("m06_standardize", """
SELECT p_partkey,
  round((p_size - (SELECT avg(p_size) FROM part)) / (SELECT stddev_pop(p_size) FROM part), 6) AS p_size,
  round((p_retailprice - (SELECT avg(p_retailprice) FROM part))
        / (SELECT stddev_pop(p_retailprice) FROM part), 6) AS p_retailprice
FROM part""")
def m06_standardize(spark, d):
    p = T(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("p_size"),
                                   "p_retailprice")
    z = prep.standardize(p, {c: s[1:] for c, s in prep.fit_numeric_stats(p, ["p_size", "p_retailprice"]).items()})
    return z.select("p_partkey", *[F.round(c, 6).alias(c) for c in ("p_size", "p_retailprice")])


@register("m07_one_hot", """
SELECT c_custkey, CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS INTEGER) AS hot_index,
       CAST((SELECT count(DISTINCT c_mktsegment) FROM customer) AS INTEGER) AS vec_size
FROM customer""")
def m07_one_hot(spark, d):
    c = T(spark, d, "customer").select("c_custkey", "c_mktsegment")
    pre = prep.fit_preprocessor(c, [], ["c_mktsegment"])
    arr = vector_to_array("features")
    out = pre.transform(c).select("c_custkey", arr.alias("a"))
    return out.select("c_custkey", (F.array_position("a", 1.0) - 1).cast("int").alias("hot_index"),
                      F.size("a").cast("int").alias("vec_size"))


@register("m08_assemble", """
WITH s AS (SELECT avg(c_acctbal) AS ma, stddev_pop(c_acctbal) AS sa, avg(c_nationkey) AS mn, stddev_pop(c_nationkey) AS sn FROM customer),
k AS (SELECT c_mktsegment, dense_rank() OVER (ORDER BY c_mktsegment) + 2 AS slot FROM (SELECT DISTINCT c_mktsegment FROM customer))
SELECT c_custkey, CAST(2 + (SELECT count(*) FROM k) AS INTEGER) AS n_features, round((c_acctbal - ma) / sa, 6) AS first,
       round((c_nationkey - mn) / sn, 6) AS second, CAST(slot AS INTEGER) AS hot_slot, CAST(1 AS DOUBLE) AS hot_total
FROM customer JOIN k USING (c_mktsegment), s""")
def m08_assemble(spark, d):
    c = T(spark, d, "customer")
    pre = prep.fit_preprocessor(c, ["c_acctbal", "c_nationkey"], ["c_mktsegment"])
    rows = pre.transform(c).select("c_custkey", vector_to_array("features").alias("a"))
    hot = F.slice("a", F.lit(3), F.size("a") - 2)
    return rows.select("c_custkey", F.size("a").alias("n_features"), F.round(F.get("a", F.lit(0)), 6).alias("first"),
                       F.round(F.get("a", F.lit(1)), 6).alias("second"), (F.array_position(hot, 1.0) + 2).cast("int").alias("hot_slot"),
                       F.aggregate(hot, F.lit(0.0), lambda x, y: x + y).alias("hot_total"))


@register("m09_balanced_weights", """
SELECT doc_id, quality,
       CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY quality)) AS weight
FROM labels""")
def m09_balanced_weights(spark, d):
    lab = T(spark, d, "labels").select("doc_id", "quality")
    return prep.balanced_weights(lab, "quality").select("doc_id", "quality", "weight")


def _single_classifier(spark, d, name):
    """Fit one classifier (with its preprocessing) on the stratified
    training part, return its prediction table on the test part."""
    cfg = C.Config(**CLS_CFG)
    split = C.prepare_classification(embedding_table(spark, d), cfg)
    model = C.fit_classifier(name, split["train"], split["numeric"], split["categorical"], split["cfg"],
                             len(split["labels"]))
    return C.prediction_table(model.transform(split["test"]), cfg, split["labels"], name)


def _single_regressor(spark, d, name):
    """Fit one regressor on the random training part, predict the test part."""
    cfg = C.Config(**REG_CFG)
    split = C.prepare_regression(order_table(spark, d), cfg)
    model = C.fit_regressor(name, split["train"], split["numeric"], split["categorical"], split["cfg"])
    return model.transform(split["test"]).select(
        F.lit(name).alias("model"), cfg.id_col, F.col("y").alias("y_true"), F.col("prediction").alias("y_pred"))


@register("m10_logistic_regression")
def m10_logistic_regression(spark, d):
    return _single_classifier(spark, d, "logistic_regression")


@register("m11_random_forest_classifier")
def m11_random_forest_classifier(spark, d):
    return _single_classifier(spark, d, "random_forest")


@register("m12_extra_trees_classifier")
def m12_extra_trees_classifier(spark, d):
    return _single_classifier(spark, d, "extra_trees")


@register("m12_extra_trees_regressor")
def m12_extra_trees_regressor(spark, d):
    return _single_regressor(spark, d, "extra_trees")


@register("m13_rbf_classifier")
def m13_rbf_classifier(spark, d):
    return _single_classifier(spark, d, "rbf_svm")


@register("m14_ridge")
def m14_ridge(spark, d):
    return _single_regressor(spark, d, "ridge")


@register("m15_random_forest_regressor")
def m15_random_forest_regressor(spark, d):
    return _single_regressor(spark, d, "random_forest")


@register("m16_rbf_regressor")
def m16_rbf_regressor(spark, d):
    return _single_regressor(spark, d, "rbf_svr")


@register("m17_cross_validate")
def m17_cross_validate(spark, d):
    """All four classifiers over all folds."""
    prepared = C.prepare_classification(embedding_table(spark, d), C.Config(**CLS_CFG))
    return C.cv_scores(C.cross_validate(prepared, C.CLASSIFIERS))


def label_predictions(spark, d):
    """labels as a predictions fixture: y_true = quality, two rule models."""
    lab = T(spark, d, "labels")
    a = lab.select(F.lit("rule_toxic").alias("model"), "doc_id", F.col("quality").alias("y_true"),
                   (1 - F.col("toxic")).alias("y_pred"))
    b = lab.select(F.lit("rule_const").alias("model"), "doc_id", F.col("quality").alias("y_true"),
                   F.lit(1).alias("y_pred"))
    return a.unionByName(b)


LP_SQL = """(SELECT 'rule_toxic' AS model, doc_id, quality AS y_true, 1 - toxic AS y_pred FROM labels
  UNION ALL SELECT 'rule_const', doc_id, quality, 1 FROM labels)"""

PER_CLASS_SQL = f"""
cells AS (SELECT model, y_true, y_pred, count(*) AS n FROM {LP_SQL} GROUP BY ALL),
cls AS (SELECT DISTINCT model, c FROM (SELECT model, y_true AS c FROM cells
                                       UNION ALL SELECT model, y_pred FROM cells)),
per AS (SELECT k.model, k.c,
               coalesce(sum(n) FILTER (WHERE y_true = k.c AND y_pred = k.c), 0) AS tp,
               coalesce(sum(n) FILTER (WHERE y_true = k.c), 0) AS support,
               coalesce(sum(n) FILTER (WHERE y_pred = k.c), 0) AS predicted
        FROM cls k JOIN cells USING (model) GROUP BY k.model, k.c),
m AS (SELECT model, sum(tp) / sum(support) AS accuracy,
        sum(CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END * support) / sum(support) AS precision_weighted,
        sum(CASE WHEN support > 0 THEN tp / support ELSE 0 END * support) / sum(support) AS recall_weighted,
        sum(CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0 END * support)
          / sum(support) AS f1_weighted
      FROM per GROUP BY model)"""

METRIC_COLS = ["accuracy", "precision_weighted", "recall_weighted", "f1_weighted"]


def _r(cols, digits=10):
    return [F.round(c, digits).alias(c) for c in cols]


def _sql_r(cols, digits=10):
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in cols)


@register("m18_leaderboard", f"WITH {PER_CLASS_SQL} SELECT model, {_sql_r(METRIC_COLS)} FROM m")
def m18_leaderboard(spark, d):
    m = Me.classification_metrics(label_predictions(spark, d), "y_true", "y_pred", "model")
    return C.leaderboard(m.select("model", *_r(METRIC_COLS)), "f1_weighted")


@register("m18_best_model", f"""
WITH {PER_CLASS_SQL} SELECT model, round(f1_weighted, 10) AS f1_weighted FROM m
ORDER BY f1_weighted DESC, model LIMIT 1""")
def m18_best_model(spark, d):
    m = Me.classification_metrics(label_predictions(spark, d), "y_true", "y_pred", "model")
    return C.best_model(C.leaderboard(m.select("model", *_r(["f1_weighted"])), "f1_weighted"))


@register("m19_classification_metrics", f"""
WITH {PER_CLASS_SQL} SELECT {_sql_r(METRIC_COLS)} FROM m WHERE model = 'rule_toxic'""")
def m19_classification_metrics(spark, d):
    p = label_predictions(spark, d).filter(F.col("model") == "rule_toxic")
    return Me.classification_metrics(p, "y_true", "y_pred").select(*_r(METRIC_COLS))


@register("m20_classification_report", f"""
WITH {PER_CLASS_SQL},
rows AS (SELECT model, CAST(c AS VARCHAR) AS class,
                CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS precision,
                CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall,
                CASE WHEN predicted + support > 0 THEN 2 * tp / (predicted + support) ELSE 0 END AS f1,
                CAST(support AS BIGINT) AS support FROM per),
allr AS (
  SELECT * FROM rows
  UNION ALL SELECT model, 'accuracy', accuracy, accuracy, accuracy,
                   (SELECT CAST(sum(support) AS BIGINT) FROM per WHERE per.model = m.model) FROM m
  UNION ALL SELECT model, 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT)
            FROM rows GROUP BY model
  UNION ALL SELECT model, 'weighted avg', sum(precision * support) / sum(support),
                   sum(recall * support) / sum(support), sum(f1 * support) / sum(support),
                   CAST(sum(support) AS BIGINT) FROM rows GROUP BY model)
SELECT model, class, {_sql_r(["precision", "recall", "f1"])}, support FROM allr""")
def m20_classification_report(spark, d):
    r = Me.classification_report(label_predictions(spark, d), "y_true", "y_pred", "model")
    return r.select("model", "class", *_r(["precision", "recall", "f1"]), "support")


ORDER_PRED_SQL = """(SELECT o.o_orderkey, year(o.o_orderdate) AS annee, o.o_totalprice AS y,
       l.y_hat FROM orders o JOIN (SELECT l_orderkey,
         CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2)) * (1 - CAST(l_discount AS DECIMAL(4, 2)))
                  * (1 + CAST(l_tax AS DECIMAL(4, 2)))) AS DOUBLE) AS y_hat
         FROM lineitem GROUP BY 1) l
       ON o.o_orderkey = l.l_orderkey)"""


def order_predictions(spark, d):
    li = T(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(18,2)")
              * (1 - F.col("l_discount").cast("decimal(4,2)"))
              * (1 + F.col("l_tax").cast("decimal(4,2)"))).cast("double").alias("y_hat"))
    o = T(spark, d, "orders").select("o_orderkey", F.year("o_orderdate").alias("annee"),
                                     F.col("o_totalprice").alias("y"))
    return o.join(li, o.o_orderkey == li.l_orderkey).drop("l_orderkey")


@register("m21_regression_metrics", f"""
WITH p AS {ORDER_PRED_SQL}, mu AS (SELECT avg(y) AS m FROM p)
SELECT round(1 - sum((y - y_hat) ^ 2) / sum((y - m) ^ 2), 6) AS r2,
       round(avg(abs(y - y_hat)), 4) AS mae, round(sqrt(avg((y - y_hat) ^ 2)), 4) AS rmse
FROM p, mu""")
def m21_regression_metrics(spark, d):
    m = Me.regression_metrics(order_predictions(spark, d), "y", "y_hat")
    return m.select(F.round("r2", 6).alias("r2"), F.round("mae", 4).alias("mae"),
                    F.round("rmse", 4).alias("rmse"))


@register("m22_prediction_table", f"""
WITH r AS (SELECT vec_id, 'c' || (label % 3) AS y_true,
                  row_number() OVER (PARTITION BY label % 3 ORDER BY {md5_key('vec_id')}, vec_id) AS rk,
                  count(*) OVER (PARTITION BY label % 3) AS n FROM embeddings)
SELECT vec_id, y_true, CAST(1 AS DOUBLE) AS proba_total, true AS takes_the_likeliest FROM r WHERE rk <= round_even(0.2 * n, 0)""")
def m22_prediction_table(spark, d):
    """The test part's rows with their labels; class probabilities add up to
    1 and the predicted class is the likeliest one."""
    table = _single_classifier(spark, d, "logistic_regression")
    proba = [c for c in table.columns if c.startswith("proba_")]
    best = F.greatest(*proba)
    picked = F.coalesce(*[F.when(F.concat(F.lit("proba_"), F.col("y_pred")) == c, F.col(c)) for c in proba])
    return table.select("vec_id", "y_true", F.round(sum(F.col(c) for c in proba), 6).alias("proba_total"),
                        (picked == best).alias("takes_the_likeliest"))


@register("m23_save_load_model", """
SELECT vec_id, 'c' || (label % 3) AS target, true AS same FROM embeddings""")
def m23_save_load_model(spark, d):
    """A saved and loaded model predicts what the fitted one does."""
    df = embedding_table(spark, d)
    cfg = C.Config(**CLS_CFG)
    split = C.prepare_classification(df, cfg)
    model = C.fit_classifier("logistic_regression", split["train"], split["numeric"], split["categorical"],
                             split["cfg"], len(split["labels"]))
    path = scratch_dir(spark, "model")
    C.save_model(model, path)
    rows = df.withColumn("__target", F.col("target"))
    fitted = model.transform(rows).select("vec_id", "target", F.col("prediction").alias("before"))
    loaded = C.load_model(path).transform(rows).select(F.col("vec_id").alias("v"), F.col("prediction").alias("after"))
    return fitted.join(loaded, fitted.vec_id == loaded.v).select("vec_id", "target", (F.col("before") == F.col("after")).alias("same"))


@register("m24_residual_table", f"""
SELECT o_orderkey, y, y_hat, y - y_hat AS residual
FROM {ORDER_PRED_SQL} WHERE annee = 1997""")
def m24_residual_table(spark, d):
    r = C.residual_table(order_predictions(spark, d), "y", "y_hat", "annee", 1997)
    return r.select("o_orderkey", "y", "y_hat", "residual")


@register("m25_metric_comparison", f"""
WITH {PER_CLASS_SQL}
SELECT model, metric, round(score, 10) AS score FROM (
  SELECT model, 'accuracy' AS metric, accuracy AS score FROM m
  UNION ALL SELECT model, 'f1_weighted', f1_weighted FROM m)""")
def m25_metric_comparison(spark, d):
    m = Me.classification_metrics(label_predictions(spark, d), "y_true", "y_pred", "model")
    long = C.metric_comparison(m, ["accuracy", "f1_weighted", "missing_metric"])
    return long.withColumn("score", F.round("score", 10))


def _published(spark, result, by):
    """The leaderboard as published: written, then read by its manifest."""
    folder = scratch_dir(spark, "runs")
    C.publish_run(result, by, folder)
    return C.published_run(spark, folder)["leaderboard"]


@register("job18_compare_classifiers")
def job18_compare_classifiers(spark, d):
    return _published(spark, C.compare_classifiers(embedding_table(spark, d), C.Config(**CLS_CFG)), "f1_weighted_test")


@register("job19_compare_regressors")
def job19_compare_regressors(spark, d):
    return _published(spark, C.compare_regressors(order_table(spark, d), C.Config(**REG_CFG)), "rmse_test")


@register("job20_confusion_matrix", """
WITH p AS (SELECT quality AS y, 1 - toxic AS p FROM labels),
labs AS (SELECT DISTINCT v AS label FROM (SELECT y AS v FROM p UNION ALL SELECT p FROM p))
SELECT labs.label, count(p.p) FILTER (WHERE p.p = 0) AS "0", count(p.p) FILTER (WHERE p.p = 1) AS "1"
FROM labs LEFT JOIN p ON p.y = labs.label GROUP BY labs.label""")
def job20_confusion_matrix(spark, d):
    return _page(spark, d)["confusion"]()


def _page(spark, d, year=None):
    """The comparison page over the rule models' metrics, their classes and
    the orders' predictions."""
    board = Me.classification_metrics(label_predictions(spark, d), "y_true", "y_pred", "model")
    board = board.select("model", *[F.col(c).alias(f"{c}_test") for c in METRIC_COLS])
    classes = T(spark, d, "labels").select(F.col("quality").alias("y_true"), (1 - F.col("toxic")).alias("y_pred"))
    values = order_predictions(spark, d).withColumnsRenamed({"y": "y_true", "y_hat": "y_pred"})
    return comparison_tables(board, classes, values, "annee", year, [0, 1])


@register("job20_metrics", f"WITH {PER_CLASS_SQL} " + " UNION ALL ".join(
    f"SELECT model, '{c}_test' AS metric, round({c}, 10) AS score FROM m" for c in METRIC_COLS))
def job20_metrics(spark, d):
    return _page(spark, d)["metrics"]().withColumn("score", F.round("score", 10))


@register("job20_residuals", f"""
SELECT o_orderkey, CAST(annee AS INTEGER) AS annee, y AS y_true, y_hat AS y_pred, y - y_hat AS residual FROM {ORDER_PRED_SQL} WHERE annee = 1996""")
def job20_residuals(spark, d):
    return _page(spark, d, 1996)["residuals"]()


@register("job20_limits", f"""
SELECT least(min(y), min(y_hat)) AS lo, greatest(max(y), max(y_hat)) AS hi FROM {ORDER_PRED_SQL}""")
def job20_limits(spark, d):
    return _page(spark, d)["limits"]()


@register("job20_years", f"SELECT DISTINCT CAST(annee AS VARCHAR) AS annee FROM {ORDER_PRED_SQL}")
def job20_years(spark, d):
    return _page(spark, d)["years"]()


@register("m16_optimality", f"""
WITH r AS (SELECT row_number() OVER (ORDER BY {md5_key('o_orderkey')}, o_orderkey) AS rk, count(*) OVER () AS n FROM orders)
SELECT count(*) AS n_train, true AS gap_closed FROM r WHERE rk > ceil(0.2 * n)""")
def m16_optimality(spark, d):
    """The regression's duality gap on the training part is under a
    thousandth of its objective."""
    cfg = C.Config(**REG_CFG)
    split = C.prepare_regression(order_table(spark, d), cfg)
    model = C.fit_regressor("rbf_svr", split["train"], split["numeric"], split["categorical"], split["cfg"])
    return split["train"].agg(F.count(F.lit(1)).alias("n_train")).withColumn("gap_closed", F.lit(abs(model.stages[-1].gap) < 1e-3))


@register("m14_normal_equations", f"""
WITH r AS (SELECT row_number() OVER (ORDER BY {md5_key('o_orderkey')}, o_orderkey) AS rk, count(*) OVER () AS n FROM orders)
SELECT count(*) AS n_train, true AS gradient_is_zero FROM r WHERE rk > ceil(0.2 * n)""")
def m14_normal_equations(spark, d):
    """The ridge solution's gradient, X'(Xw + b - y) + w, against the size of
    its terms."""
    cfg = C.Config(**REG_CFG)
    split = C.prepare_regression(order_table(spark, d), cfg)
    model = C.fit_regressor("ridge", split["train"], split["numeric"], split["categorical"], split["cfg"])
    w = model.stages[-1].coefficients.toArray()
    rows = model.transform(split["train"]).select((F.col("prediction") - F.col("y")).alias("e"), vector_to_array("features").alias("x"))
    found = rows.select("e", F.posexplode("x").alias("j", "x")).groupBy("j").agg(
        F.sum(F.col("e") * F.col("x")).alias("g"), F.sum(F.abs(F.col("e") * F.col("x"))).alias("size"))
    slope = F.get(F.array(*[F.lit(float(v)) for v in w]), F.col("j"))
    flat = found.agg(F.max(F.abs(F.col("g") + slope) / F.greatest("size", F.lit(1.0))).alias("most"))
    n = split["train"].agg(F.count(F.lit(1)).alias("n_train"))
    return n.withColumn("gradient_is_zero", flat.select(F.col("most") < 1e-6).scalar())


@register("m10_gradient", f"""
WITH r AS (SELECT row_number() OVER (PARTITION BY label % 3 ORDER BY {md5_key('vec_id')}, vec_id) AS rk,
                  count(*) OVER (PARTITION BY label % 3) AS n FROM embeddings)
SELECT count(*) AS n_train, true AS gradient_is_zero FROM r WHERE rk > round_even(0.2 * n, 0)""")
def m10_gradient(spark, d):
    """The weighted multinomial loss has no slope left in any coefficient:
    sum of weight * (p - [y = k]) * x, plus the coefficient, per class."""
    cfg = C.Config(**CLS_CFG)
    split = C.prepare_classification(embedding_table(spark, d), cfg)
    model = C.fit_classifier("logistic_regression", split["train"], split["numeric"], split["categorical"], split["cfg"], len(split["labels"]))
    w = model.stages[-1].coefficientMatrix.toArray()
    rows = model.transform(prep.balanced_weights(split["train"], "label_idx")).select(
        "weight", "label_idx", vector_to_array("probability").alias("p"), vector_to_array("features").alias("x"))
    per = rows.select("weight", "label_idx", "x", F.posexplode("p").alias("k", "p"))
    error = F.col("weight") * (F.col("p") - (F.col("label_idx") == F.col("k")).cast("double"))
    cells = per.select("k", error.alias("e"), F.posexplode("x").alias("j", "x")).groupBy("k", "j").agg(
        F.sum(F.col("e") * F.col("x")).alias("g"), F.sum(F.abs(F.col("e") * F.col("x"))).alias("size"))
    slope = F.get(F.get(F.array(*[F.array(*[F.lit(float(v)) for v in r]) for r in w]), F.col("k")), F.col("j"))
    flat = cells.agg(F.max(F.abs(F.col("g") + slope) / F.greatest("size", F.lit(1.0))).alias("most"))
    n = split["train"].agg(F.count(F.lit(1)).alias("n_train"))
    return n.withColumn("gradient_is_zero", flat.select(F.col("most") < 1e-2).scalar())
