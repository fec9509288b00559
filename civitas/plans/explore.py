"""Exploration jobs (J-13 ... J-17): the tables behind the profiling and
dashboard pages, as parameterised DataFrame functions (no UI)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import row_sum_min_count
from ..operators import aggregates as G
from ..operators import filters as Fl
from ..operators import profile as Pr
from ..operators import ranking as K


def profile_table(df: DataFrame, cols, every=None) -> DataFrame:
    """J-13: describe of the number columns ``cols``, missing count and
    percentage of ``every`` column (all of ``df`` unless given), tidy
    (column, statistic, value)."""
    every = list(every or df.columns)
    miss = G.missing_counts(df, every).select(
        "column", F.lit("missing").alias("statistic"), F.col("n_missing").cast("double").alias("value"))
    pct = G.missing_ratio(df, every).select("column", F.lit("missing_pct").alias("statistic"), F.col("pct_missing").alias("value"))
    return Pr.describe(df, cols).unionByName(miss).unionByName(pct)


def profile_tables(df: DataFrame, cols, bins: int = 50) -> dict[str, Callable[[], DataFrame]]:
    """J-13: the tables of a profile by name, each planned only when asked
    for: row count, statistics, histogram and box statistics of all number
    columns ``cols`` at once, and which columns are missing together."""
    return {"rows": lambda: G.row_count(df), "statistics": lambda: profile_table(df, cols),
            "histograms": lambda: Pr.histograms(df, cols, bins), "boxes": lambda: Pr.box_table(df, cols),
            "patterns": lambda: Pr.missing_patterns(df)}


def share_report(df: DataFrame, share_cols, key: str, n: int = 20) -> dict:
    """J-14: the counts of ``share_consistency``, a description of the shares'
    sum, and the first ``n`` rows that miss a share."""
    total = df.withColumn("total", row_sum_min_count(share_cols))
    return {"counts": share_consistency(df, share_cols), "sum": Pr.describe(total, ["total"]),
            "incomplete": Fl.rows_with_missing(df, share_cols, [key], n)}


def share_consistency(df: DataFrame, share_cols, hi: float = 100.5, lo: float = 99.5) -> DataFrame:
    """J-14: rows whose shares sum above ``hi`` / below ``lo``, rows with a
    missing share."""
    total = row_sum_min_count(share_cols)
    return G.count_where(df, {"n_above": total > hi, "n_below": total < lo,
                              "n_missing": Fl.missing_any(share_cols)})


def explore_indicator(df: DataFrame, value: str, key: str, filters: dict | None = None,
                      k: int = 10, bins: int = 30) -> dict:
    """J-15: KPI, top and bottom k (the filter is honoured everywhere) and
    histogram of one indicator."""
    f = df
    for col, v in (filters or {}).items():
        f = Fl.filter_equals(f, col, v)
    f = Fl.drop_missing(f, [value])
    return {"kpis": G.kpis(f, value), "top": K.top_k(f, value, k, True, [key]),
            "bottom": K.top_k(f, value, k, False, [key]), "histogram": Pr.histogram(f, value, bins)}


def explore_register(df: DataFrame, text_col: str, pattern: str, filters: dict | None = None) -> dict:
    """J-16: filtered rows of the register (to show or export) and their
    counts."""
    f = df
    for col, v in (filters or {}).items():
        f = Fl.filter_equals(f, col, v)
    f = Fl.search_text(f, text_col, pattern)
    return {"rows": f, "counts": f.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(text_col).alias("n_distinct"))}


def explore_election(df: DataFrame, class_col: str, score_cols, filters: dict | None = None) -> dict:
    """J-17: KPI (rows, dominant class, mean winning score), distribution of
    the classes and mean score per bloc."""
    f = df
    for col, v in (filters or {}).items():
        f = Fl.filter_equals(f, col, v)
    best = F.greatest(*[F.col(c) for c in score_cols])
    per = f.groupBy(class_col).agg(F.count(F.lit(1)).alias("n"), F.sum(best).alias("s"), F.count(best).alias("k"))
    known = F.when(F.col(class_col).isNotNull(), F.struct(-F.col("n"), F.col(class_col)))
    kpi = per.agg(F.sum("n").alias("n_rows"), F.min_by(class_col, known).alias("dominant"),
                  (F.sum("s") / F.sum("k")).alias("mean_winning_score"))
    return {"kpi": kpi, "distribution": Pr.value_counts(f, class_col),
            "mean_scores": Pr.column_means_long(f, score_cols)}
