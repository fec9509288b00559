"""Aggregations (G1-G8, G18-G26 and the wide-band median G25/W1).

Every grouped aggregate here is algebraic or has a bounded partial state, so
Spark runs a map-side partial aggregate before the shuffle: a key holding a
third of all rows costs one partial row per input partition, not a third of
the data in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import round_even


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def group_mean(df: DataFrame, keys, value: str, alias: str | None = None) -> DataFrame:
    """Mean per key; rows with a missing key are dropped (pandas
    ``groupby`` default), missing values are skipped."""
    ks = _keys(keys)
    return df.dropna(subset=ks).groupBy(*ks).agg(F.avg(value).alias(alias or value))


def group_sums(df: DataFrame, keys, values, aliases=None) -> DataFrame:
    """Per-key sums, missing counted as 0 (sum of all-missing = 0)."""
    ks = _keys(keys)
    aliases = aliases or values
    return df.dropna(subset=ks).groupBy(*ks).agg(
        *[F.coalesce(F.sum(v), F.lit(0)).alias(a) for v, a in zip(values, aliases)])


def kpis(df: DataFrame, col: str) -> DataFrame:
    """Global mean, min, max and the integer-truncated mean."""
    return df.agg(F.avg(col).alias("mean"), F.min(col).alias("min"),
                  F.max(col).alias("max")) \
        .withColumn("mean_int", F.col("mean").cast("long"))


def row_count(df: DataFrame, alias: str = "n_rows") -> DataFrame:
    """G4."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def distinct_count(df: DataFrame, col: str, approx: bool = False, rsd: float = 0.01) -> DataFrame:
    """Exact distinct non-missing values (HyperLogLog++ on request)."""
    fn = (lambda c: F.approx_count_distinct(c, rsd)) if approx else F.count_distinct
    return df.agg(fn(F.col(col)).alias("n_distinct"))


def missing_counts(df: DataFrame, cols=None) -> DataFrame:
    """Missing count per column as a tidy (column, n_missing) table —
    one pass over the data, then ``unpivot`` of the single result row."""
    cols = list(cols or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_missing")


def missing_ratio(df: DataFrame, cols=None, digits: int = 2) -> DataFrame:
    """Missing percentage per column, rounded half-even."""
    cols = list(cols or df.columns)
    wide = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in cols])
    long = wide.unpivot([], cols, "column", "pct_missing")
    return long.withColumn("pct_missing", round_even("pct_missing", digits))


def count_where(df: DataFrame, predicates: dict[str, Column]) -> DataFrame:
    """Named conditional counts in one pass."""
    return df.agg(*[F.count_if(p).alias(name) for name, p in predicates.items()])


def first_per_key(df: DataFrame, keys, order_cols) -> DataFrame:
    """Keep the first row per key under an explicit total order.

    Expressed as ``min_by(row, order)`` aggregation rather than a window:
    the partial aggregate keeps one candidate per key per partition, so a
    hot key never puts its rows into a single sorted task.
    """
    ks = _keys(keys)
    others = [c for c in df.columns if c not in ks]
    best = F.min_by(F.struct(*others), F.struct(*order_cols)).alias("__row")
    return df.groupBy(*ks).agg(best).select(*ks, "__row.*")


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct non-missing values."""
    return df.select(col).dropna().distinct().orderBy(col)


def mean_row_max(df: DataFrame, cols, alias: str = "mean_row_max") -> DataFrame:
    """Mean over rows of the largest column (``greatest`` skips NULL)."""
    return df.agg(F.avg(F.greatest(*[F.col(c) for c in cols])).alias(alias))


def banded_median_expr(counts, midpoints) -> Column:
    """G25 / W1 on a wide row: midpoint of the first band whose running
    total reaches half the total; NULL if the total is 0 or missing.

    Pure expression (``aggregate`` over an array of structs) — the running
    sum W1 is folded left to right, no Python UDF.
    """
    arr = F.array(*[F.struct(F.coalesce(c if isinstance(c, Column) else F.col(c),
                                        F.lit(0.0)).cast("double").alias("n"),
                             F.lit(float(m)).alias("mid"))
                    for c, m in zip(counts, midpoints)])
    total = F.aggregate(arr, F.lit(0.0), lambda acc, x: acc + x["n"])
    init = F.struct(F.lit(0.0).alias("cum"), F.lit(None).cast("double").alias("med"))

    def step(acc, x):
        cum = acc["cum"] + x["n"]
        med = F.when(acc["med"].isNull() & (cum >= total / 2), x["mid"]).otherwise(acc["med"])
        return F.struct(cum.alias("cum"), med.alias("med"))

    med = F.aggregate(arr, init, step)["med"]
    return F.when(total != 0, med)


def banded_median(df: DataFrame, keys, band_col: str, count_col: str, bands, midpoints,
                  alias: str = "median") -> DataFrame:
    """G25 on long input (key, band, count): one grouped aggregation with a
    conditional sum per band (partial aggregation, one shuffle on the key),
    then the wide expression per key."""
    ks = _keys(keys)
    sums = [F.sum(F.when(F.col(band_col) == F.lit(b), F.col(count_col))).alias(f"__b{i}")
            for i, b in enumerate(bands)]
    wide = df.dropna(subset=ks).groupBy(*ks).agg(*sums)
    return wide.select(*ks, banded_median_expr([f"__b{i}" for i in range(len(bands))],
                                               midpoints).alias(alias))


def axis_limits(df: DataFrame, a: str, b: str) -> DataFrame:
    """Common min and max of two columns."""
    return df.agg(F.least(F.min(a), F.min(b)).alias("lo"),
                  F.greatest(F.max(a), F.max(b)).alias("hi"))


def wide_counts(df: DataFrame, keys, col: str, values, names=None, zero_fill: bool = False) -> DataFrame:
    """Rows per key and per listed value of ``col``, one column per value.

    Conditional sums in a single grouped aggregation (one shuffle, partial
    aggregation before it) instead of ``pivot``, which plans two
    aggregations. Like ``pivot``, a value absent for a key gives NULL
    unless ``zero_fill``.
    """
    ks = _keys(keys)
    names = list(names or [str(v) for v in values])
    one = F.lit(1).cast("long")
    if zero_fill:
        aggs = [F.count_if(F.col(col) == F.lit(v)).alias(n) for v, n in zip(values, names)]
    else:
        aggs = [F.sum(F.when(F.col(col) == F.lit(v), one)).alias(n) for v, n in zip(values, names)]
    return df.groupBy(*ks).agg(*aggs)


def running_sum(df: DataFrame, keys, order: str, value: str, alias: str = "cum") -> DataFrame:
    """Running total of ``value`` along ``order`` within each key. Meant
    for rows that are already one per key and band: a key is one window."""
    w = Window.partitionBy(*_keys(keys)).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(alias, F.sum(value).over(w))
