"""Reshape operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, ids, values, var_name: str = "metric", value_name: str = "score") -> DataFrame:
    """Wide metrics to long (id..., metric, score). Values are cast to a
    common double type first so ``unpivot`` accepts mixed numeric columns."""
    ids = [ids] if isinstance(ids, str) else list(ids)
    cast = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    return cast.unpivot(ids, list(values), var_name, value_name)


def reindex_zero(df: DataFrame, labels: DataFrame, key: str, fill_cols) -> DataFrame:
    """R2: complete missing labels with 0 (label frame left join + fill)."""
    return labels.select(key).join(df, key, "left").fillna(0, subset=list(fill_cols))


def bands_to_long(df: DataFrame, keys, layout) -> DataFrame:
    """Wide (male, female) band columns to (key..., band, n, midpoint)
    with n = male + female, missing counted as 0.

    ``layout`` is a list of (band, male_col, female_col, midpoint).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    structs = [F.struct(F.lit(band).alias("band"),
                        (F.coalesce(F.col(m).cast("double"), F.lit(0.0))
                         + F.coalesce(F.col(f).cast("double"), F.lit(0.0))).alias("n"),
                        F.lit(float(mid)).alias("midpoint"))
               for band, m, f, mid in layout]
    return df.select(*keys, F.explode(F.array(*structs)).alias("__b")).select(*keys, "__b.*")
