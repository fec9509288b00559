"""Projection and schema operators (P1-P8). Pure DataFrame -> DataFrame,
metadata-only where possible so Catalyst prunes unused columns at the scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.scalars import zfill


class SchemaError(ValueError):
    pass


def select_rename(df: DataFrame, mapping: dict[str, str], strict: bool = True) -> DataFrame:
    """Keep the mapped columns under their clean names.

    ``strict`` fails with the list of absent source columns; lenient keeps
    only those present.
    """
    present = [c for c in mapping if c in df.columns]
    if strict:
        require_columns(df, list(mapping))
    return df.select(*[F.col(f"`{src}`").alias(mapping[src]) for src in present])


def clean_name(name: str, drop_chars: str = "\n\r \"'") -> str:
    out = str(name).strip()
    for ch in drop_chars:
        out = out.replace(ch, "")
    return out


def normalize_column_names(df: DataFrame, drop_chars: str = "\n\r \"'") -> DataFrame:
    """Strip names and remove newlines, blanks and quotes (metadata only)."""
    return df.toDF(*[clean_name(c, drop_chars) for c in df.columns])


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fail with the list of missing columns."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise SchemaError(f"missing columns: {missing}; available: {df.columns}")
    return df


def require_rows(df: DataFrame) -> DataFrame:
    """Fail on empty input (one bounded ``isEmpty`` probe)."""
    if df.isEmpty():
        raise SchemaError("input has no rows")
    return df


def columns_with_prefix(df: DataFrame, prefixes) -> list[str]:
    """Measure columns chosen by name prefix; fail if none."""
    if isinstance(prefixes, str):
        prefixes = [prefixes]
    cols = [c for c in df.columns if any(c.startswith(p) for p in prefixes)]
    if not cols:
        raise SchemaError(f"no column starts with {prefixes}")
    return cols


def split_feature_types(df: DataFrame, exclude=(), numeric_override=None,
                        categorical_override=None) -> tuple[list[str], list[str]]:
    """P5: numeric columns, and every other column of one value (text,
    boolean, date, timestamp) as categorical, minus excluded ones. Arrays,
    maps, structs and binary values are no features."""
    excluded = set(exclude)
    numeric = [f.name for f in df.schema.fields
               if isinstance(f.dataType, NumericType) and f.name not in excluded]
    categorical = [f.name for f in df.schema.fields
                   if not isinstance(f.dataType, NumericType) and f.name not in excluded
                   and f.dataType.typeName() not in ("array", "map", "struct", "binary", "variant")]
    if numeric_override is not None:
        numeric = [c for c in numeric_override if c in df.columns]
    if categorical_override is not None:
        categorical = [c for c in categorical_override if c in df.columns]
    return numeric, categorical


def with_literal(df: DataFrame, name: str, value, dtype: str = "int") -> DataFrame:
    """Add the year (or any constant) as a typed literal."""
    return df.withColumn(name, F.lit(value).cast(dtype))


def with_formula(df: DataFrame, name: str, expr) -> DataFrame:
    """Column arithmetic."""
    return df.withColumn(name, F.expr(expr) if isinstance(expr, str) else expr)


def compose_key(df: DataFrame, name: str, parts: list[str], widths: list[int]) -> DataFrame:
    """Zero-pad every part to its width and concatenate (code = DR + CR)."""
    return df.withColumn(name, F.concat(*[zfill(F.col(p).cast("string"), w)
                                          for p, w in zip(parts, widths)]))

