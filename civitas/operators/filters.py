"""Row filters (F1-F8). No actions; every predicate reaches the scan when
the column comes straight from parquet (``PushedFilters``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import search_regex, strip

ALL = "Toutes"  # fixed value: the "no filter" sentinel of the selection widgets


def filter_equals(df: DataFrame, col: str, value, all_sentinel=ALL) -> DataFrame:
    """equality, disabled by the sentinel. The chosen value, a text in a
    page's widget, takes the column's type, so the predicate reaches the
    scan; a value that the type can't hold matches no row."""
    if value is None or value == all_sentinel:
        return df
    return df.filter(F.col(col) == F.lit(str(value)).try_cast(df.schema[col].dataType))


def filter_flag(df: DataFrame, col: str, value: str = "1") -> DataFrame:
    """trim then compare (stable communes only)."""
    return df.filter(strip(F.col(col).cast("string")) == F.lit(value))


def drop_blank(df: DataFrame, col: str) -> DataFrame:
    """remove empty or blank text (NULL handled by ``drop_missing``)."""
    return df.filter(strip(F.col(col)) != F.lit(""))


def drop_missing(df: DataFrame, subset) -> DataFrame:
    """F4."""
    return df.dropna(how="any", subset=list(subset))


def search_text(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """case-insensitive regex search; missing never matches."""
    if not pattern:
        return df
    return df.filter(search_regex(col, pattern))


def missing_any(cols):
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def rows_with_missing(df: DataFrame, cols, order_by, n: int = 20) -> DataFrame:
    """first ``n`` rows missing at least one of ``cols`` (ordered)."""
    return df.filter(missing_any(cols)).orderBy(*order_by).limit(n)


_OPS = {
    ">": lambda c, v: c > v, ">=": lambda c, v: c >= v, "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v, "==": lambda c, v: c == v, "!=": lambda c, v: c != v,
}


def filter_threshold(df: DataFrame, col: str, op: str, value) -> DataFrame:
    """suspicious values (exactly 100 %, above 70 %)."""
    return df.filter(_OPS[op](F.col(col), F.lit(value)))


def filter_in_keys(df: DataFrame, keys: DataFrame, key: str, keys_key: str | None = None) -> DataFrame:
    """F8: keep rows whose key appears in ``keys`` (semi join, never ``isin``
    of a collected list). Spark builds the hash side from the smaller input
    when statistics allow, otherwise shuffles both on the key."""
    kk = keys_key or key
    k = keys.select(F.col(kk).alias("__k"))
    return df.join(k, F.col(key) == F.col("__k"), "left_semi")
