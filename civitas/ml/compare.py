"""Model comparison (M17, M18, M22-M25, J-18, J-19): seeded split, k-fold
cross-validation with preprocessing refitted inside every fold, test
metrics, leaderboard and prediction tables.

Every fit and metric is a Spark job; the driver only loops over
(model, fold) pairs — in a thread pool, like ``CrossValidator(parallelism)``
— and receives the per-column statistics and the small leaderboard. The
prepared frame is checkpointed to the shared checkpoint folder so a lost
executor does not replay the split.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.ml import PipelineModel
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.columns import require_columns, split_feature_types
from ..operators.reshape import melt
from ..session import cut_lineage, written
from ..sources.readers import read_optional
from ..sources.sinks import write_json_summary
from . import forests as Fo
from . import margins as Ma
from . import metrics as Me
from . import models as Mo
from . import prep

CLASS_METRICS = ["accuracy", "f1_weighted", "precision_weighted", "recall_weighted"]
REG_METRICS = ["r2", "mae", "rmse"]
CLASSIFIERS = ("logistic_regression", "random_forest", "extra_trees", "rbf_svm")
REGRESSORS = ("ridge", "random_forest", "extra_trees", "rbf_svr")


@dataclass(frozen=True)
class Config:
    target: str
    id_col: str
    id_cols: tuple = ()
    drop_cols: tuple = ()
    numeric: tuple | None = None
    categorical: tuple | None = None
    test_size: float = 0.2
    seed: int = prep.SEED
    k_folds: int = 5
    n_trees: int = Fo.N_TREES
    max_rows: int = Fo.AT_ONCE  # rows of a tree that are grown at once; trees are of all rows
    parallelism: int = 4
    models: tuple = field(default=())


def _features(df: DataFrame, cfg: Config):
    require_columns(df, [cfg.target, cfg.id_col, *cfg.id_cols])
    excluded = {cfg.target, cfg.id_col, *cfg.id_cols, *cfg.drop_cols, "is_test", "fold", "label_idx",
                "weight", "y"}
    return split_feature_types(df, excluded, cfg.numeric, cfg.categorical)


def _vector_size(df: DataFrame) -> int:
    """Length of the assembled vectors, from the column's metadata."""
    return df.schema["features"].metadata["ml_attr"]["num_attrs"]


def _lifted(staged: DataFrame, cfg: Config):
    """(Fourier feature stage, the same map for numpy, its width)."""
    dim = _vector_size(staged)
    gamma = Mo.gamma_scale(staged, dim=dim)
    stage = Mo.RandomFourierFeatures(inputCol="features", outputCol="rff", gamma=gamma, inputDim=dim, seed=cfg.seed)
    return stage, Mo.fourier_features(gamma, Mo.RFF_COMPONENTS, cfg.seed, dim), Mo.RFF_COMPONENTS


def fit_classifier(name: str, train: DataFrame, numeric, categorical, cfg: Config, classes: int,
                   pre: PipelineModel | None = None) -> PipelineModel:
    """Preprocessing (``pre`` where it is fitted already) and one model."""
    pre = pre or prep.fit_preprocessor(train, numeric, categorical)
    staged = pre.transform(prep.balanced_weights(train, "label_idx"))
    stages = list(pre.stages)
    if name == "logistic_regression":
        total_w = float(train.count())  # balanced weights add up to the rows
        stages.append(Mo.without_summary(train.sparkSession, Mo.logistic_regression(total_w).fit(staged)))
    elif name in ("random_forest", "extra_trees"):
        forest = Mo.forest_classifier(classes, cfg.id_col, cfg.n_trees, cfg.max_rows, name == "extra_trees", cfg.seed)
        stages.append(forest.fit(staged))
    elif name == "rbf_svm":
        rff, lift, width = _lifted(staged, cfg)
        stages += [rff, Ma.fit_margin_classifier(staged, "label_idx", "weight", cfg.id_col, classes, lift, width)]
    else:
        raise ValueError(name)
    return PipelineModel(stages)


def fit_regressor(name: str, train: DataFrame, numeric, categorical, cfg: Config,
                  pre: PipelineModel | None = None) -> PipelineModel:
    pre = pre or prep.fit_preprocessor(train, numeric, categorical)
    staged = pre.transform(train)
    stages = list(pre.stages)
    if name == "ridge":
        row = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("y").alias("s")).first()
        stages.append(Mo.ridge(1.0, row["n"], row["s"]).fit(staged))
    elif name in ("random_forest", "extra_trees"):
        stages.append(Mo.forest_regressor(cfg.id_col, cfg.n_trees, cfg.max_rows, name == "extra_trees", cfg.seed).fit(staged))
    elif name == "rbf_svr":
        rff, lift, width = _lifted(staged, cfg)
        stages += [rff, Ma.fit_epsilon_regression(staged, "y", cfg.id_col, lift, width)]
    else:
        raise ValueError(name)
    return PipelineModel(stages)


def _run_parallel(tasks, parallelism):
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        return list(pool.map(lambda t: t(), tasks))


def _cv_table(scores: DataFrame, metric_names, by="model") -> DataFrame:
    """mean and population std of each metric over folds."""
    aggs = []
    for m in metric_names:
        aggs += [F.avg(m).alias(f"cv_{m}_mean"), F.stddev_pop(m).alias(f"cv_{m}_std")]
    return scores.groupBy(by).agg(*aggs)


def prepare_classification(df: DataFrame, cfg: Config) -> dict:
    """Label index (alphabetical classes), stratified seeded split, stratified
    folds of the rows, checkpointed to the shared folder."""
    numeric, categorical = _features(df, cfg)
    base = df.withColumn("__target", F.col(cfg.target).cast("string"))
    indexer = StringIndexer(inputCol="__target", outputCol="label_idx",
                            stringOrderType="alphabetAsc").fit(base)
    data = prep.split_and_folds(indexer.transform(base), lambda n: F.rint(n * F.lit(cfg.test_size)), cfg.k_folds, cfg.seed,
                                cfg.id_col, label="label_idx")
    data = cut_lineage(data)
    train, test = data.filter(~F.col("is_test")), data.filter(F.col("is_test"))
    return {"train": train, "test": test, "labels": list(indexer.labels), "numeric": numeric,
            "categorical": categorical, "cfg": cfg}


def prepare_regression(df: DataFrame, cfg: Config) -> dict:
    """Numeric target ``y``, seeded random split, plain folds, checkpointed."""
    numeric, categorical = _features(df, cfg)
    data = df.withColumn("y", F.col(cfg.target).cast("double"))
    data = prep.split_and_folds(data, lambda n: F.ceil(n * F.lit(cfg.test_size)), cfg.k_folds, cfg.seed, cfg.id_col)
    data = cut_lineage(data)
    train, test = data.filter(~F.col("is_test")), data.filter(F.col("is_test"))
    return {"train": train, "test": test, "numeric": numeric, "categorical": categorical,
            "cfg": cfg}


def cross_validate(prepared: dict, names, pres: list[PipelineModel] | None = None) -> DataFrame:
    """Out-of-fold predictions (model, fold, label_idx or y, prediction)
    of ``names`` on a prepared training part. The preprocessing of every fold
    comes from one pass over the rows (``prep.fold_preprocessors``); the
    driver only walks over (model, fold)."""
    train, cfg, labels = prepared["train"], prepared["cfg"], prepared.get("labels")
    numeric, categorical = prepared["numeric"], prepared["categorical"]
    pres = pres or prep.fold_preprocessors(train, numeric, categorical, cfg.k_folds)
    truth = "y" if labels is None else "label_idx"

    def task(name, k):
        def run():
            rows = train.filter(F.col("fold") != k)
            model = (fit_regressor(name, rows, numeric, categorical, cfg, pres[k]) if labels is None else
                     fit_classifier(name, rows, numeric, categorical, cfg, len(labels), pres[k]))
            return model.transform(train.filter(F.col("fold") == k)).select(
                F.lit(name).alias("model"), F.lit(k).alias("fold"), cfg.id_col, truth, "prediction")
        return run

    # models of a fold side by side: some keep the cores busy, some wait for many short jobs
    return _union(_run_parallel([task(n, k) for k in range(cfg.k_folds) for n in names], cfg.parallelism))


def cv_scores(oof: DataFrame) -> DataFrame:
    """Metrics per model and fold of out-of-fold predictions."""
    if "y" in oof.columns:
        return Me.regression_metrics(oof, "y", "prediction", ["model", "fold"])
    return Me.classification_metrics(oof, "label_idx", "prediction", ["model", "fold"])


def compare_classifiers(df: DataFrame, cfg: Config) -> dict:
    """J-18: the four classifiers, CV + test metrics, leaderboard sorted by
    test F1 (desc), predictions of every model, best model."""
    names = list(cfg.models or CLASSIFIERS)
    prepared = prepare_classification(df, cfg)
    train, test, labels = prepared["train"], prepared["test"], prepared["labels"]
    pres = prep.fold_preprocessors(train, prepared["numeric"], prepared["categorical"], cfg.k_folds)
    scores = written(cv_scores(cross_validate(prepared, names, pres)), "scores")  # read by several outputs
    def told(name):
        model = fit_classifier(name, train, prepared["numeric"], prepared["categorical"], cfg, len(labels), pres[-1])
        return model, prediction_table(model.transform(test), cfg, labels, name)

    fitted, tables = zip(*_run_parallel([lambda n=n: told(n) for n in names], cfg.parallelism))
    preds = written(_union(tables), "predictions")
    test_m = Me.classification_metrics(preds, "y_true", "y_pred", "model")
    test_m = test_m.select("model", *[F.col(m).alias(f"{m}_test") for m in CLASS_METRICS])
    board = leaderboard(_cv_table(scores, CLASS_METRICS).join(test_m, "model"), "f1_weighted_test", descending=True)
    report = Me.classification_report(preds, "y_true", "y_pred", "model")
    return {"leaderboard": board, "predictions": preds, "report": report, "models": dict(zip(names, fitted)),
            "labels": labels, "cv_scores": scores}


def compare_regressors(df: DataFrame, cfg: Config) -> dict:
    """J-19: the four regressors, leaderboard sorted by test RMSE (asc)."""
    names = list(cfg.models or REGRESSORS)
    prepared = prepare_regression(df, cfg)
    train, test = prepared["train"], prepared["test"]
    pres = prep.fold_preprocessors(train, prepared["numeric"], prepared["categorical"], cfg.k_folds)
    scores = written(cv_scores(cross_validate(prepared, names, pres)), "scores")  # read by several outputs
    def told(name):
        model = fit_regressor(name, train, prepared["numeric"], prepared["categorical"], cfg, pres[-1])
        return model, model.transform(test).select(
            F.lit(name).alias("model"), *[F.col(c) for c in (cfg.id_col, *cfg.id_cols)],
            F.col("y").alias("y_true"), F.col("prediction").alias("y_pred"))

    fitted, tables = zip(*_run_parallel([lambda n=n: told(n) for n in names], cfg.parallelism))
    preds = written(_union(tables), "predictions")
    test_m = Me.regression_metrics(preds, "y_true", "y_pred", "model") \
        .select("model", *[F.col(m).alias(f"{m}_test") for m in REG_METRICS])
    board = leaderboard(_cv_table(scores, REG_METRICS).join(test_m, "model"), "rmse_test", descending=False)
    return {"leaderboard": board, "predictions": preds, "models": dict(zip(names, fitted)), "cv_scores": scores}


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def prediction_table(scored: DataFrame, cfg: Config, labels, model_name: str | None = None) -> DataFrame:
    """Ids, y_true, y_pred and one ``proba_<class>`` column per class."""
    to_label = IndexToString(inputCol="prediction", outputCol="__pred_label", labels=labels)
    s = to_label.transform(scored)
    proba = vector_to_array("probability")
    cols = ([F.lit(model_name).alias("model")] if model_name else []) + \
        [F.col(c) for c in (cfg.id_col, *cfg.id_cols)] + \
        [F.col("__target").alias("y_true"), F.col("__pred_label").alias("y_pred")] + \
        [proba[i].alias(f"proba_{lab}") for i, lab in enumerate(labels)]
    return s.select(*cols)


def leaderboard(table: DataFrame, by: str, descending: bool = True) -> DataFrame:
    """One row per model sorted by the chosen test metric; the
    model name breaks ties so the first row (the winner) is deterministic."""
    order = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
    return table.orderBy(order, F.asc("model"))


def best_model(board: DataFrame) -> DataFrame:
    """The winning row."""
    return board.limit(1)


def save_model(model: PipelineModel, path: str) -> None:
    """M23."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def publish_run(result: dict, by: str, folder: str) -> str:
    """Write a comparison's outputs - leaderboard, predictions, scores of the
    folds, summary (the best row as JSON, with its report) and the winning
    model - into a fresh run folder under ``folder``, and last its manifest.
    Readers go by manifests, so a run that stops in between is never seen and
    the runs before it stay readable."""
    board = result["leaderboard"]
    spark = board.sparkSession
    run = uuid.uuid4().hex
    base = f"{folder.rstrip('/')}/runs/{run}"
    tables = {"leaderboard": board, "predictions": result["predictions"], "cv_scores": result["cv_scores"]}
    if "report" in result:
        tables["report"] = result["report"]
    for name, table in tables.items():
        table.write.parquet(f"{base}/{name}")
    best = best_model(leaderboard(spark.read.parquet(f"{base}/leaderboard"), by, descending=by != "rmse_test"))
    winner = best.first()["model"]
    write_json_summary(best, f"{base}/summary")
    save_model(result["models"][winner], f"{base}/model")
    row = [(run, winner, by, sorted(tables), datetime.now(timezone.utc))]
    spark.createDataFrame(row, MANIFEST).coalesce(1).write.json(f"{folder.rstrip('/')}/manifests/{run}")
    return run


MANIFEST = "run string, winner string, by string, tables array<string>, published timestamp"


def published_run(spark: SparkSession, folder: str) -> dict | None:
    """The latest published run of ``folder``: its manifest's fields, its
    tables, its summary and a function that loads the model."""
    base = folder.rstrip("/")
    found = read_optional(spark, f"{base}/manifests/*", StructType.fromDDL(MANIFEST), fmt="json")
    last = found.orderBy(F.desc("published"), F.desc("run")).first()
    if last is None:
        return None
    run = f"{base}/runs/{last['run']}"
    return {**last.asDict(), "summary": spark.read.json(f"{run}/summary"), "load_model": lambda: load_model(f"{run}/model"),
            **{name: spark.read.parquet(f"{run}/{name}") for name in last["tables"]}}


def residual_table(pred: DataFrame, y: str, y_hat: str, year_col: str | None = None, year=None) -> DataFrame:
    """Predicted vs residual, optionally for one year."""
    p = pred if year is None or year_col is None else pred.filter(F.col(year_col) == F.lit(year))
    return p.withColumn("residual", F.col(y) - F.col(y_hat))


def metric_comparison(board: DataFrame, metrics) -> DataFrame:
    """The test metrics present in the leaderboard, long form."""
    present = [m for m in metrics if m in board.columns]
    return melt(board, "model", present, "metric", "score")
