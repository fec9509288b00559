"""Shared fixture frames for the checked queries (TPC-H-like tables standing
in for communes, registers and indicator files)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import load
from ..functions.scalars import zfill
from ..operators.aggregates import wide_counts


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, sf_dir, name)


def nation_register(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as a commune register: code_insee = zero-padded key."""
    return T(spark, sf_dir, "nation").select(
        zfill(F.col("n_nationkey").cast("string"), 5).alias("code_insee"),
        F.col("n_name").alias("nom_commune"))


def returnflag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per supplier: count of lines by return flag (wide; NULL when a flag
    is absent, like a pivot)."""
    li = T(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag")
    return wide_counts(li, "l_suppkey", "l_returnflag", ["A", "N", "R"])


def documents_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents left join labels: the fixture pair that has NULLs."""
    d = T(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    lab = T(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left")


DL_SQL = "(SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic " \
         "FROM documents d LEFT JOIN labels l USING (doc_id))"
