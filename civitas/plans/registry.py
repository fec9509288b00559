"""Registry of checked queries: each operator of the inventory bound to the
fixture tables, with its DuckDB oracle SQL (or None for rows-only checks).

Keys follow ``<id>_<operator>``; every callable takes (spark, sf_dir) and
returns a lazy DataFrame whose column names equal the oracle's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        if key in QUERIES:
            raise KeyError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every binding module (each registers on import)."""
    from . import (bind_aggregates, bind_columns, bind_jobs, bind_ml, bind_profile,  # noqa: F401
                   bind_ranking, bind_scalars, bind_sources)
