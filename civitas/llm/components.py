"""Connected components of an edge table, all in joins and groupings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir


def stored(df: DataFrame, folder: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends
    there, and a lost executor costs no recomputation."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def dropped(spark: SparkSession, *folders: str) -> None:
    """Delete tables that nothing lazy reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def connected_components(spark: SparkSession, edges: DataFrame, folder: str | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b): the smallest node
    reachable. Alternates large-star and small-star steps until the edges
    stay the same; a step is one grouping and one join, and a node with very
    many neighbours is one key of a join that AQE may split. Rows with a
    null or with a = b link nothing and are left out."""
    folder = folder or scratch_dir(spark, "components")
    pairs = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = stored(pairs, f"{folder}/edges-0")
    seen, step = None, 0
    while True:
        state = pairs.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                          F.sum(F.xxhash64("v", "u") % 1000003).alias("s")).first()
        if state == seen:
            break
        seen, step = state, step + 1
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = (both.join(low, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())
        large = stored(large, f"{folder}/large-{step}")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        pairs = stored(small, f"{folder}/edges-{step}")
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
