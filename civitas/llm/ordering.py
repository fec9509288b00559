"""Places of rows in a total order, without one task ranking them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import stored


def in_order(rows: DataFrame, keys: list[str], folder: str) -> DataFrame:
    """``rows`` with ``at``, their place from 0 in ascending order of ``keys``
    (nulls first; rows with equal keys in any order, each with its own place).

    One range sort, written to ``folder``; a place is the row's place in its
    partition plus the rows of all partitions before. Rows with equal keys may
    be dealt over partitions, so a key may hold any share of the rows. The
    only thing ranked in one task is one count per partition. ``rows`` is read
    twice (the range sort samples it): give it a written table."""
    salted = rows.withColumn("_salt", F.monotonically_increasing_id())
    ordered = salted.repartitionByRange(*keys, "_salt").sortWithinPartitions(*keys, "_salt").drop("_salt")
    ordered = stored(ordered.withColumn("_row", F.monotonically_increasing_id()), folder)
    ordered = ordered.withColumn("_part", F.shiftright("_row", 33)).withColumn("_row", F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)))
    counts = ordered.groupBy("_part").agg(F.count("*").alias("_n"))
    starts = counts.selectExpr("_part", "sum(_n) OVER (ORDER BY _part) - _n AS _start")
    return ordered.join(starts, "_part").withColumn("at", F.col("_start") + F.col("_row")).drop("_part", "_start", "_row")
