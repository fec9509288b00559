"""The fixture tables that the checks read."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

FIXTURE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                  "events", "documents", "embeddings", "pages", "benchmark", "labels",
                  "conversations")

DEFAULT_SF_DIR = "/root/testdata/sf0.01"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One fixture table (parquet; filters and projections reach the scan)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
