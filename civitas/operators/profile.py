"""Profiling operators (G9-G17): describe, mode, value counts, crosstab,
histogram, box statistics, missing-value patterns.

Results are tidy DataFrames. Global statistics that a later step needs
(histogram range, box fences) stay in the plan, as a scalar subquery or a
joined one-row frame; no data reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

QUARTILES = [0.25, 0.5, 0.75]


def _number(col: str):
    """A column as double with NaN missing."""
    x = F.col(col).cast("double")
    return F.when(~F.isnan(x), x)


def quantiles(df: DataFrame, cols, probs) -> DataFrame:
    """Exact, linearly interpolated quantiles as (column, prob, value); NaN is
    missing, infinities are the smallest and largest values.

    One path at any size: rows are counted per (column, value), the counts
    are written in range partitions of that order, and a running count over
    partitions finds the one partition that holds each wanted rank; only
    those are ranked inside. The written table is the one action. A column
    without values has no rows."""
    long = df.select(*[_number(c).alias(c) for c in cols]).unpivot([], list(cols), "column", "v").where("v is not null")
    return count_quantiles(long.groupBy("column", "v").agg(F.count(F.lit(1)).alias("n")), probs)


def count_quantiles(counts: DataFrame, probs) -> DataFrame:
    """``quantiles`` of values that are counted already: (column, v, n)."""
    counts = written(counts.repartitionByRange("column", "v").withColumn("part", F.spark_partition_id()), "quantiles")
    per = counts.groupBy("column", "part").agg(F.sum("n").alias("n"))  # a row per column and partition
    running = Window.partitionBy("column").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0))) \
        .withColumn("total", F.sum("n").over(Window.partitionBy("column")))
    rank = (F.col("total") - 1) * F.col("prob")
    wanted = per.select("*", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob")) \
        .withColumn("rank", rank).withColumn("at", F.explode(F.array(F.floor("rank"), F.ceil("rank")))) \
        .where("at >= before and at < before + n") \
        .select("column", "part", "prob", "rank", "at", "before").distinct()
    inside = Window.partitionBy("column", "part").orderBy("v")
    ranked = counts.join(wanted.select("column", "part").distinct(), ["column", "part"], "left_semi") \
        .withColumn("upto", F.sum("n").over(inside))
    hit = ranked.join(wanted, ["column", "part"]).where("at - before < upto and at - before >= upto - n")
    ends = hit.groupBy("column", "prob", "rank").agg(F.min_by("v", "at").alias("lo"), F.max_by("v", "at").alias("hi"))
    between = F.col("lo") + (F.col("hi") - F.col("lo")) * (F.col("rank") - F.floor("rank"))
    return ends.select("column", "prob", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(between).alias("value"))


def describe(df: DataFrame, cols) -> DataFrame:
    """Count, mean, std (n-1), min, 25%, 50%, 75%, max per column,
    linear-interpolated quartiles, as (column, statistic, value); NaN is
    missing. One aggregation for every column, and one quantile run."""
    aggs = []
    for c in cols:
        x = _number(c)
        aggs += [F.count(x).cast("double").alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    stats = ["count", "mean", "std", "min", "max"]
    long = df.agg(*aggs).unpivot([], [f"`{c}__{s}`" for c in cols for s in stats], "__name", "value")
    parts = F.split(F.col("__name"), "__(?=[a-z]+$)")
    moments = long.select(parts[0].alias("column"), parts[1].alias("statistic"), "value")
    names = F.create_map(*[F.lit(x) for p in QUARTILES for x in (p, f"{p:.0%}")])
    every = df.sparkSession.createDataFrame([(c, p) for c in cols for p in QUARTILES], "column string, prob double")
    found = every.join(quantiles(df, cols, QUARTILES), ["column", "prob"], "left")  # a column without values: missing
    return moments.unionByName(found.select("column", names[F.col("prob")].alias("statistic"), "value"))


def mode_of(df: DataFrame, col: str, alias: str = "mode") -> DataFrame:
    """Most frequent non-missing value, smallest on ties.

    Counted per value with a partial aggregation, then the winner is the
    ``min_by`` of (-count, value) — no value->count map in one task, so a
    high-cardinality column scales like any group-by.
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
    return counts.agg(F.min_by(F.col(col), F.struct(-F.col("__n"), F.col(col))).alias(alias))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, descending count, value as tie-break."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")) \
        .orderBy(F.desc("count"), F.asc_nulls_last(col))


def column_means_long(df: DataFrame, cols) -> DataFrame:
    """Mean of several columns as (column, mean) rows."""
    wide = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols])
    return wide.unpivot([], list(cols), "column", "mean")


def duplicate_count(df: DataFrame, keys) -> DataFrame:
    """Rows beyond the first per key; NULL keys count as one value."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.agg((F.count(F.lit(1)) - F.count_distinct(F.struct(*keys))).alias("n_duplicates"))


def crosstab(df: DataFrame, rows: str, cols: str, labels=None) -> DataFrame:
    """Counts per pair of labels in long form (row, column, count); with
    a list of ``labels`` the square matrix over them, zero-filled."""
    counts = df.groupBy(F.col(rows).alias("row"), F.col(cols).alias("column")).agg(F.count(F.lit(1)).alias("count"))
    if labels is None:
        return counts
    wide = counts.groupBy(F.col("row").alias("label")).agg(
        *[F.sum(F.when(F.col("column") == F.lit(x), F.col("count"))).alias(str(x)) for x in labels])
    frame = df.sparkSession.createDataFrame([(x,) for x in labels], ["label"]) \
        .withColumn("label", F.col("label").cast(df.schema[rows].dataType))
    out = frame.join(wide, "label", "left").fillna(0)
    return out.select("label", *[F.col(f"`{x}`").cast("long").alias(str(x)) for x in labels])


def _long(df: DataFrame, cols) -> DataFrame:
    """(column, x) of all values; NaN is missing."""
    return df.select(*[_number(c).alias(c) for c in cols]).unpivot([], list(cols), "column", "x").where("x is not null")


def histograms(df: DataFrame, cols, n_bins: int) -> DataFrame:
    """Per column equal-width bins between its least and greatest
    finite value, last bin closed, empty bins 0: (column, bin, lo, hi, count).
    Infinite values are in no bin. One pass finds all ranges, one counts; a
    column without finite values has bins without edges."""
    long = _long(df, cols).where(F.abs("x") < float("inf"))
    ranges = long.groupBy("column").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    place = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col("x") - F.col("lo")) * n_bins / (F.col("hi") - F.col("lo"))) + 1, F.lit(n_bins)))
    counts = long.join(ranges, "column").groupBy("column", F.coalesce(place, F.lit(1)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "column string").withColumn(
        "bin", F.explode(F.sequence(F.lit(1), F.lit(n_bins))))
    width = (F.col("hi") - F.col("lo")) / n_bins
    return every.join(ranges, "column", "left").join(counts, ["column", "bin"], "left").select(
        "column", "bin", (F.col("lo") + (F.col("bin") - 1) * width).alias("lo"), (F.col("lo") + F.col("bin") * width).alias("hi"),
        F.coalesce("count", F.lit(0)).alias("count"))


def histogram(df: DataFrame, col: str, n_bins: int) -> DataFrame:
    """``histograms`` of one column: (bin, lo, hi, count)."""
    return histograms(df, [col], n_bins).drop("column")


def fences(df: DataFrame, cols, whisker: float = 1.5) -> DataFrame:
    """A row per column: quartiles, interquartile range, lower and upper
    fence; written, so that what uses them twice finds them once."""
    q = [F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n) for p, n in zip(QUARTILES, ("q1", "median", "q3"))]
    rows = quantiles(df, cols, QUARTILES).groupBy("column").agg(*q).withColumn("iqr", F.col("q3") - F.col("q1"))
    return written(rows.withColumn("__lo", F.col("q1") - whisker * F.col("iqr")).withColumn("__hi", F.col("q3") + whisker * F.col("iqr")), "fences")


def box_table(df: DataFrame, cols, whisker: float = 1.5) -> DataFrame:
    """G16 for several columns, one quantile run and one further pass for all
    of them: column, quartiles, range, whiskers at the furthest points inside
    the fences, and the outlier count; NaN is missing."""
    x, found = F.col("x"), fences(df, cols, whisker)
    ends = _long(df, cols).join(found.select("column", "__lo", "__hi"), "column").groupBy("column").agg(
        F.min(F.when(x >= F.col("__lo"), x)).alias("lower_whisker"), F.max(F.when(x <= F.col("__hi"), x)).alias("upper_whisker"),
        F.count_if((x < F.col("__lo")) | (x > F.col("__hi"))).alias("n_outliers"))
    return found.drop("__lo", "__hi").join(ends, "column")


def box_stats(df: DataFrame, col: str, whisker: float = 1.5) -> DataFrame:
    """``box_table`` of one column."""
    return box_table(df, [col], whisker).drop("column")


def outliers(df: DataFrame, col: str, whisker: float = 1.5) -> DataFrame:
    """The outlier rows themselves."""
    x, ends = _number(col), fences(df, [col], whisker).select("__lo", "__hi")
    return df.join(F.broadcast(ends), (x < F.col("__lo")) | (x > F.col("__hi"))).drop("__lo", "__hi")  # one row


def missing_patterns(df: DataFrame, cols=None) -> DataFrame:
    """Which columns are missing together, with the row count of each
    pattern — the information of a nullity matrix at any data size."""
    cols = list(cols or df.columns)
    return df.groupBy(*[F.col(c).isNull().alias(c) for c in cols]) \
        .agg(F.count(F.lit(1)).alias("count"))
