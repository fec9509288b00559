"""Learning preparation (M1-M9): seeded splits and folds, imputation,
standardisation, one-hot encoding, assembly, balanced class weights.

Fitted statistics are one value per column (a bounded row collected once)
and are frozen into ``SQLTransformer`` stages, so the whole preprocessing
is a ``PipelineModel`` that can be saved, loaded and applied to the test
part or to new data.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.profile import count_quantiles, mode_of, quantiles
from ..operators.ranking import exact_rank, hash_key
from ..session import written

SEED = 42


def _ranked(df: DataFrame, id_col: str, seed: int, by=()) -> DataFrame:
    keyed = df.withColumn("__h", hash_key(seed, id_col))
    return exact_rank(keyed, list(by), "__h", id_col, alias="__rank")


def first_rows(keyed: DataFrame, key: str, id_col: str, count, label: str | None = None, bits: int = 16) -> DataFrame:
    """(__class, __lh, __lid): per class the last of the first ``count(rows)``
    rows in the order of (``key``, id), ``key`` a lowercase hex string; a
    class of which no row is among them has no row here.

    A selection, not a sort: rows are counted per class and leading ``bits`` of
    the key, running counts of at most 2**bits rows find the class's border
    bucket, and only that bucket's rows are ranked."""
    classes = keyed.select((F.col(label) if label else F.lit(0)).alias("__class"), F.col(key).alias("__lh"), F.col(id_col).alias("__lid"))
    rows = classes.withColumn("__bucket", F.substring("__lh", 1, bits // 4))
    counts = rows.groupBy("__class", "__bucket").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("__class").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0))) \
        .withColumn("wanted", count(F.sum("n").over(Window.partitionBy("__class"))))
    border = counts.where("before < wanted and before + n >= wanted").select(
        F.col("__class").alias("__c"), F.col("__bucket").alias("__b"), (F.col("wanted") - F.col("before")).alias("place"))
    inside = rows.join(border, F.col("__class").eqNullSafe(F.col("__c")) & (F.col("__bucket") == F.col("__b")))
    ranked = inside.withColumn("rank", F.row_number().over(Window.partitionBy("__class", "__bucket").orderBy("__lh", "__lid")))
    return ranked.where("rank = place").select("__class", "__lh", "__lid")


def stratified_split(df: DataFrame, label: str, test_size: float = 0.2, seed: int = SEED,
                     id_col: str = "id", flag: str = "is_test") -> DataFrame:
    """M1: per class, the first ``round(test_size * n_class)`` rows of the
    seeded shuffle go to the test part (half-even rounding)."""
    keyed = df.withColumn("__h", hash_key(seed, id_col))
    last = first_rows(keyed, "__h", id_col, lambda n: F.rint(n * F.lit(test_size)), label)
    out = keyed.join(last, F.col(label).eqNullSafe(F.col("__class")), "left")  # a missing class is a class of its own
    return out.withColumn(flag, _up_to(id_col, F.col("__lh"), F.col("__lid"))).drop("__h", "__lh", "__lid", "__class")


def random_split(df: DataFrame, test_size: float = 0.2, seed: int = SEED, id_col: str = "id",
                 flag: str = "is_test") -> DataFrame:
    """M2: the first ``ceil(test_size * n)`` rows of the seeded shuffle are
    the test part."""
    keyed = df.withColumn("__h", hash_key(seed, id_col))
    last = first_rows(keyed, "__h", id_col, lambda n: F.ceil(n * F.lit(test_size)))
    edge = last.agg(F.first(F.struct("__lh", "__lid"))).scalar()  # one row
    return keyed.withColumn(flag, _up_to(id_col, edge["__lh"], edge["__lid"])).drop("__h")


def _up_to(id_col: str, key, last_id):
    """Rows that come no later than the one with ``key`` and ``last_id``."""
    return F.coalesce((F.col("__h") < key) | ((F.col("__h") == key) & (F.col(id_col) <= last_id)), F.lit(False))


def split_and_folds(df: DataFrame, count, k: int = 5, seed: int = SEED, id_col: str = "id", label: str | None = None,
                    flag: str = "is_test", fold_col: str = "fold") -> DataFrame:
    """``stratified_split`` (with a ``label``) or ``random_split``, and
    ``folds``, of one seeded shuffle: it is ranked once for both. ``count``
    gives the test rows of a class from its rows."""
    r = _ranked(df, id_col, seed, [label] if label else [])
    if label:
        sizes = df.groupBy(F.col(label).alias("__class")).agg(count(F.count(F.lit(1))).alias("__ntest"))
        r = r.join(sizes, F.col(label).eqNullSafe(F.col("__class"))).drop("__class")
    else:
        r = r.withColumn("__ntest", df.agg(count(F.count(F.lit(1))).alias("n")).select("n").scalar())
    return r.withColumn(flag, F.col("__rank") <= F.col("__ntest")).withColumn(
        fold_col, ((F.col("__rank") - 1) % k).cast("int")).drop("__h", "__rank", "__ntest")


def folds(df: DataFrame, k: int = 5, seed: int = SEED, id_col: str = "id", label: str | None = None,
          fold_col: str = "fold") -> DataFrame:
    """M3: ``(rank - 1) % k`` over the seeded shuffle, per class when
    stratified; usable as ``CrossValidator(foldCol=...)``."""
    r = _ranked(df, id_col, seed, [label] if label else [])
    return r.withColumn(fold_col, ((F.col("__rank") - 1) % k).cast("int")).drop("__h", "__rank")


def fit_medians(df: DataFrame, cols) -> dict:
    """Exact interpolated median of each column (NaN is missing)."""
    if not cols:
        return {}
    found = {r["column"]: r["value"] for r in quantiles(df, list(cols), [0.5]).collect()}
    return {c: found.get(c) for c in cols}


def fit_modes(df: DataFrame, cols) -> dict:
    """Most frequent value of each column, smallest on ties.

    Counts per value are partially aggregated and the winner is the
    ``min_by`` of (-count, value), so no value->count map sits in one task.
    Text columns are done together in long form (column, value); other
    types one column at a time so ties compare in their own type.
    """
    if not cols:
        return {}
    types = dict(df.dtypes)
    text = [c for c in cols if types[c] == "string"]
    out = {}
    if text:
        long = df.select(*text).unpivot([], text, "c", "v").filter(F.col("v").isNotNull())
        counts = long.groupBy("c", "v").agg(F.count(F.lit(1)).alias("n"))
        out.update({r["c"]: r["m"] for r in counts.groupBy("c").agg(
            F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("m")).collect()})
    for c in cols:
        if c not in text:
            out[c] = mode_of(df, c, "m").first()["m"]
    return {c: out.get(c) for c in cols}


def fit_scaling(df: DataFrame, cols, medians: dict | None = None) -> dict:
    """Mean and population std, of the imputed values where medians
    are given; constant column -> std 1. ``avg`` and ``stddev_pop`` keep
    running centred moments, so large values with a small spread are safe."""
    if not cols:
        return {}
    x = {c: F.col(c).cast("double") for c in cols}
    for c in cols:
        x[c] = F.when(~F.isnan(x[c]), x[c])
        if medians is not None:
            x[c] = F.coalesce(x[c], F.lit(0.0 if medians[c] is None else medians[c]))
    row = df.agg(*[F.avg(x[c]).alias(f"{c}__m") for c in cols],
                 *[F.stddev_pop(x[c]).alias(f"{c}__s") for c in cols]).first()
    out = {}
    for c in cols:
        s = row[f"{c}__s"]
        out[c] = (row[f"{c}__m"] or 0.0, s if s not in (None, 0.0) else 1.0)
    return out


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(float(v))


def impute_median(df: DataFrame, values: dict) -> DataFrame:
    return df.fillna({c: v for c, v in values.items() if v is not None})


def impute_mode(df: DataFrame, values: dict) -> DataFrame:
    return df.fillna({c: v for c, v in values.items() if v is not None})


def standardize(df: DataFrame, stats: dict) -> DataFrame:
    return df.select(*[((F.col(c) - m) / s).alias(c) if c in stats else F.col(c)
                       for c in df.columns for m, s in [stats.get(c, (0.0, 1.0))]])


def balanced_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """M9: weight = n / (k * n_class); rows without a class are one class."""
    counts = df.groupBy(F.col(label).alias("__class")).agg(F.count(F.lit(1)).alias("__nc"))
    totals = counts.agg(F.sum("__nc").alias("n"), F.count(F.lit(1)).alias("k"))
    n, k = totals.select("n").scalar(), totals.select("k").scalar()
    w = counts.select("__class", (n / (k * F.col("__nc"))).cast("double").alias(weight_col))
    return df.join(w, F.col(label).eqNullSafe(F.col("__class"))).drop("__class")


def fit_numeric_stats(df: DataFrame, cols) -> dict:
    """(median, mean, std) per numeric column, the moments *after* median
    imputation: one quantile run and one aggregation for all columns."""
    medians = fit_medians(df, cols)
    scaling = fit_scaling(df, cols, medians)
    return {c: (medians[c], *scaling[c]) for c in cols}


def fit_preprocessor(train: DataFrame, numeric, categorical, features_col: str = "features") -> PipelineModel:
    """M4-M8 fitted on the training part only: median imputation and
    standardisation of numeric columns, mode imputation and one-hot
    encoding (alphabetical categories, unseen -> zero vector) of
    categorical ones, then assembly into one vector."""
    numeric, categorical = list(numeric), list(categorical)
    stats = fit_numeric_stats(train, numeric)
    med = {c: stats[c][0] for c in numeric}
    scale = {c: (stats[c][1], stats[c][2]) for c in numeric}
    modes = fit_modes(train, categorical)
    return _pipeline(train, numeric, categorical, med, scale, modes, None, features_col)


def _pipeline(train: DataFrame, numeric, categorical, med: dict, scale: dict, modes: dict, labels: dict | None,
              features_col: str) -> PipelineModel:
    """The preprocessing of fitted statistics; categories are read from
    ``train`` unless their ``labels`` are given."""
    num_exprs = [f"(coalesce(nanvl(CAST(`{c}` AS DOUBLE), NULL), {_lit(med[c] if med[c] is not None else 0.0)}) - {_lit(scale[c][0])}) / "
                 f"{_lit(scale[c][1])} AS `__n_{c}`" for c in numeric]
    cat_exprs = [f"coalesce(CAST(`{c}` AS STRING), {_lit(modes[c])}) AS `__c_{c}`" for c in categorical]
    sql = SQLTransformer(statement="SELECT *" + "".join(", " + e for e in num_exprs + cat_exprs)
                         + " FROM __THIS__")
    stages = [sql]
    vec_inputs = [f"__n_{c}" for c in numeric]
    if categorical:
        staged = sql.transform(train)
        names = [(f"__c_{c}", f"__i_{c}") for c in categorical]
        if labels is None:
            indexers = [StringIndexer(inputCols=[a for a, _ in names], outputCols=[b for _, b in names], handleInvalid="keep",
                                      stringOrderType="alphabetAsc").fit(staged)]
        else:  # one model a column: several lists of labels in one must have one length
            indexers = [StringIndexerModel.from_labels(labels[c], a, b, handleInvalid="keep") for c, (a, b) in zip(categorical, names)]
        ohe = OneHotEncoder(inputCols=[f"__i_{c}" for c in categorical],
                            outputCols=[f"__o_{c}" for c in categorical],
                            dropLast=True).fit(PipelineModel(indexers).transform(staged))
        stages += [*indexers, ohe]
        vec_inputs += [f"__o_{c}" for c in categorical]
    stages.append(VectorAssembler(inputCols=vec_inputs, outputCol=features_col, handleInvalid="keep"))
    return PipelineModel(stages)


def fold_counts(df: DataFrame, numeric, categorical, folds: int, fold_col: str = "fold") -> DataFrame:
    """(model, column, v, text, n): how often every value occurs in the rows
    that a model is fitted to - model k leaves out fold k, model ``folds``
    none. One scan of ``df``; a missing value (NaN included) is a row with
    neither v nor text."""
    x = {c: F.col(c).cast("double") for c in numeric}
    values = [F.struct(F.lit(c).alias("column"), F.when(~F.isnan(x[c]), x[c]).alias("v"), F.lit(None).cast("string").alias("text")) for c in numeric]
    values += [F.struct(F.lit(c).alias("column"), F.lit(None).cast("double").alias("v"), F.col(c).cast("string").alias("text")) for c in categorical]
    counts = df.select(fold_col, F.explode(F.array(*values)).alias("x")).groupBy(
        F.col("x.column").alias("column"), F.col("x.v").alias("v"), F.col("x.text").alias("text"), fold_col).agg(F.count(F.lit(1)).alias("n"))
    models = F.filter(F.sequence(F.lit(0), F.lit(folds)), lambda m: ~m.eqNullSafe(F.col(fold_col)))
    return written(counts.withColumn("model", F.explode(models)).groupBy("model", "column", "v", "text").agg(F.sum("n").alias("n")), "fold-counts")


def fold_preprocessors(train: DataFrame, numeric, categorical, folds: int, fold_col: str = "fold",
                       features_col: str = "features") -> list[PipelineModel]:
    """``fit_preprocessor`` for every left-out fold, and last for all rows,
    from one pass over the rows: medians, modes, categories and the moments
    after imputation all follow from counts of values. One value per model,
    column (and category) reaches the driver."""
    numeric, categorical = list(numeric), list(categorical)
    counts = fold_counts(train, numeric, categorical, folds, fold_col)
    numbers = counts.where(F.col("column").isin(numeric)) if numeric else counts.limit(0)
    named = numbers.where("v is not null").select(F.concat_ws(":", "model", "column").alias("column"), "v", "n")
    found = count_quantiles(named, [0.5]) if numeric else None
    medians = {r["column"]: r["value"] for r in found.collect()} if numeric else {}
    middle = train.sparkSession.createDataFrame([(k, float(v)) for k, v in medians.items()], "name string, middle double")
    shifted = numbers.join(middle, F.concat_ws(":", "model", "column") == F.col("name"), "left").select(
        "model", "column", "n", (F.coalesce("v", "middle", F.lit(0.0)) - F.coalesce("middle", F.lit(0.0))).alias("x"))
    moments = {(r["model"], r["column"]): r for r in shifted.groupBy("model", "column").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("x")).alias("s"), F.sum(F.col("n") * F.col("x") * F.col("x")).alias("q")).collect()}
    texts = counts.where(F.col("column").isin(categorical) & F.col("text").isNotNull()) if categorical else counts.limit(0)
    kinds = {(r["model"], r["column"]): r for r in texts.groupBy("model", "column").agg(
        F.min_by("text", F.struct(-F.col("n"), F.col("text"))).alias("mode"), F.sort_array(F.collect_set("text")).alias("labels")).collect()}
    out = []
    for m in range(folds + 1):
        med = {c: medians.get(f"{m}:{c}") for c in numeric}
        scale = {}
        for c in numeric:
            r = moments.get((m, c))
            mean = r["s"] / r["n"] if r else 0.0
            std = max(r["q"] / r["n"] - mean * mean, 0.0) ** 0.5 if r else 0.0
            scale[c] = ((med[c] or 0.0) + mean, std or 1.0)
        modes = {c: kinds[m, c]["mode"] if (m, c) in kinds else None for c in categorical}
        labels = {c: list(kinds[m, c]["labels"]) if (m, c) in kinds else [] for c in categorical}
        out.append(_pipeline(train, numeric, categorical, med, scale, modes, labels, features_col))
    return out
