"""Aggregations G1-G8, G18-G26 and W1 on the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import aggregates as G
from . import sqlfrag as Q
from .fixtures import DL_SQL, T, documents_labels
from .registry import register

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
BLOCS = ["urgent", "high", "medium", "unspecified", "low"]
QTY_BANDS = list(range(11))  # band b = floor(quantity / 5), quantities 1..50


def qty_midpoint(b):
    return 5 * b + 2.5


@register("g01_group_mean", f"""
SELECT o_custkey, {Q.round_even("avg(o_totalprice)", 4)} AS avg_price FROM orders GROUP BY o_custkey""")
def g01_group_mean(spark, d):
    o = T(spark, d, "orders")
    m = G.group_mean(o, "o_custkey", "o_totalprice", "avg_price")
    return m.select("o_custkey", X.round_even("avg_price", 4).alias("avg_price"))


@register("g02_group_sums", """
SELECT l_suppkey, CAST(coalesce(sum(CAST(l_quantity AS DECIMAL(18, 2))), 0) AS DOUBLE) AS qty,
       CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18, 2))), 0) AS DOUBLE) AS price
FROM lineitem GROUP BY l_suppkey""")
def g02_group_sums(spark, d):
    li = T(spark, d, "lineitem").select(
        "l_suppkey", F.col("l_quantity").cast("decimal(18,2)").alias("q"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("p"))
    s = G.group_sums(li, "l_suppkey", ["q", "p"], ["qty", "price"])
    return s.select("l_suppkey", F.col("qty").cast("double").alias("qty"),
                    F.col("price").cast("double").alias("price"))


@register("g03_kpis", """
SELECT round(avg(value), 6) AS mean, min(value) AS min, max(value) AS max,
       CAST(trunc(avg(value)) AS BIGINT) AS mean_int
FROM events""")
def g03_kpis(spark, d):
    k = G.kpis(T(spark, d, "events"), "value")
    return k.withColumn("mean", F.round("mean", 6))


@register("g04_row_count", "SELECT count(*) AS n_rows FROM lineitem")
def g04_row_count(spark, d):
    return G.row_count(T(spark, d, "lineitem"))


@register("g05_distinct_count", "SELECT count(DISTINCT p_brand) AS n_distinct FROM part")
def g05_distinct_count(spark, d):
    return G.distinct_count(T(spark, d, "part"), "p_brand")


def _dl_cols():
    return ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


@register("g06_missing_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS n_missing FROM {DL_SQL}"
    for c in ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]))
def g06_missing_counts(spark, d):
    return G.missing_counts(documents_labels(spark, d))


@register("g07_missing_ratio", " UNION ALL ".join(
    f"SELECT '{c}' AS column, "
    f"{Q.round_even(f'avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END) * 100', 2)} AS pct_missing "
    f"FROM {DL_SQL}" for c in ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]))
def g07_missing_ratio(spark, d):
    return G.missing_ratio(documents_labels(spark, d))


@register("g08_count_where", """
SELECT count(*) FILTER (WHERE l_discount > 0.07) AS above_7pct,
       count(*) FILTER (WHERE l_discount = 0.1) AS at_10pct,
       count(*) FILTER (WHERE l_quantity + l_discount * 100 > 50.5) AS sum_above,
       count(*) FILTER (WHERE l_returnflag = 'R') AS returned
FROM lineitem""")
def g08_count_where(spark, d):
    li = T(spark, d, "lineitem")
    return G.count_where(li, {
        "above_7pct": F.col("l_discount") > 0.07,
        "at_10pct": F.col("l_discount") == 0.1,
        "sum_above": F.col("l_quantity") + F.col("l_discount") * 100 > 50.5,
        "returned": F.col("l_returnflag") == "R"})


@register("g18_first_per_key", """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                   ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice) AS rn
      FROM lineitem) WHERE rn = 1""")
def g18_first_per_key(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey",
                                        "l_suppkey", "l_extendedprice", "l_quantity")
    return G.first_per_key(li, ["l_orderkey", "l_linenumber"],
                           ["l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice"])


@register("g19_distinct_values", "SELECT DISTINCT p_type FROM part WHERE p_type IS NOT NULL ORDER BY 1")
def g19_distinct_values(spark, d):
    return G.distinct_values(T(spark, d, "part"), "p_type")


@register("g20_row_sum", f"""
SELECT doc_id, {Q.min_count_sum(["CAST(quality AS DOUBLE)", "CAST(toxic AS DOUBLE)"])} AS total
FROM {DL_SQL}""")
def g20_row_sum(spark, d):
    dl = documents_labels(spark, d)
    return dl.select("doc_id", X.row_sum_min_count([F.col("quality").cast("double"),
                                                     F.col("toxic").cast("double")]).alias("total"))


@register("g21_row_sum_zero", f"""
SELECT doc_id, {Q.zero_sum(["CAST(quality AS DOUBLE)", "CAST(toxic AS DOUBLE)"])} AS total
FROM {DL_SQL}""")
def g21_row_sum_zero(spark, d):
    dl = documents_labels(spark, d)
    return dl.select("doc_id", X.row_sum_zero([F.col("quality").cast("double"),
                                                F.col("toxic").cast("double")]).alias("total"))


def priority_sums(spark, d):
    """Order value per nation and priority (the 5 'blocs'), decimal sums."""
    o = T(spark, d, "orders").select("o_custkey", "o_orderpriority",
                                     F.col("o_totalprice").cast("decimal(18,2)").alias("p"))
    c = T(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    oc = o.join(c, "o_custkey")
    aggs = [F.coalesce(F.sum(F.when(F.col("o_orderpriority") == p, F.col("p"))), F.lit(0))
            .cast("double").alias(b) for p, b in zip(PRIORITIES, BLOCS)]
    return oc.groupBy("c_nationkey").agg(*aggs, F.sum("p").cast("double").alias("expressed"))


PRIORITY_SUMS_SQL = "(SELECT c.c_nationkey, " + ", ".join(
    f"CAST(coalesce(sum(CAST(o.o_totalprice AS DECIMAL(18, 2))) FILTER (WHERE o.o_orderpriority = '{p}'), 0)"
    f" AS DOUBLE) AS {b}" for p, b in zip(PRIORITIES, BLOCS)) + \
    ", CAST(sum(CAST(o.o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS expressed " \
    "FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY c.c_nationkey)"


@register("g22_mean_row_max", f"""
SELECT round(avg(greatest({", ".join(BLOCS)})), 4) AS mean_row_max FROM {PRIORITY_SUMS_SQL}""")
def g22_mean_row_max(spark, d):
    return G.mean_row_max(priority_sums(spark, d), BLOCS).select(
        F.round("mean_row_max", 4).alias("mean_row_max"))


@register("g23_argmax_label", f"""
SELECT c_nationkey, CASE greatest({", ".join(BLOCS)}) """ + " ".join(
    f"WHEN {b} THEN '{b}'" for b in BLOCS) + f""" END AS dominant FROM {PRIORITY_SUMS_SQL}""")
def g23_argmax_label(spark, d):
    s = priority_sums(spark, d)
    return s.select("c_nationkey", X.argmax_label(BLOCS).alias("dominant"))


@register("g24_share", f"""
WITH w AS (SELECT l_suppkey, CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS r,
                  CAST(count(*) AS DOUBLE) AS n,
                  CAST(count(*) FILTER (WHERE l_quantity > 100) AS DOUBLE) AS zero
           FROM lineitem GROUP BY l_suppkey)
SELECT l_suppkey, {Q.round_even(Q.share("r", "n"), 4)} AS pct_returned,
       {Q.share("r", "zero")} AS guarded_zero,
       TRY_CAST(r / nullif(zero, 0) * 100 AS DOUBLE) AS unguarded_zero
FROM w""")
def g24_share(spark, d):
    li = T(spark, d, "lineitem")
    w = li.groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").cast("double").alias("r"),
        F.count(F.lit(1)).cast("double").alias("n"),
        F.count_if(F.col("l_quantity") > 100).cast("double").alias("zero"))
    return w.select("l_suppkey", X.round_even(X.share("r", "n"), 4).alias("pct_returned"),
                    X.share("r", "zero").alias("guarded_zero"),
                    X.share_unguarded("r", "zero").alias("unguarded_zero"))


BAND_SQL = "CAST(floor(l_quantity / 5) AS INTEGER)"


def _banded_median_sql():
    """Reference form: running total per supplier over bands, first band
    whose running total reaches half the supplier's total."""
    return f"""
WITH b AS (SELECT l_suppkey, {BAND_SQL} AS band, CAST(count(*) AS DOUBLE) AS n
           FROM lineitem GROUP BY l_suppkey, band),
r AS (SELECT l_suppkey, band, CAST(5 * band + 2.5 AS DOUBLE) AS mid,
             sum(n) OVER (PARTITION BY l_suppkey ORDER BY band ROWS UNBOUNDED PRECEDING) AS cum,
             sum(n) OVER (PARTITION BY l_suppkey) AS total FROM b)
SELECT l_suppkey, min_by(mid, band) FILTER (WHERE cum >= total / 2) AS median_qty
FROM r GROUP BY l_suppkey"""


@register("g25_banded_median", _banded_median_sql())
def g25_banded_median(spark, d):
    li = T(spark, d, "lineitem").select(
        "l_suppkey", F.floor(F.col("l_quantity") / 5).cast("int").alias("band"),
        F.lit(1.0).alias("n"))
    return G.banded_median(li, "l_suppkey", "band", "n", QTY_BANDS,
                           [qty_midpoint(b) for b in QTY_BANDS], "median_qty")


@register("g26_axis_limits", """
SELECT least(min(l_extendedprice), min(l_extendedprice * (1 - l_discount))) AS lo,
       greatest(max(l_extendedprice), max(l_extendedprice * (1 - l_discount))) AS hi FROM lineitem""")
def g26_axis_limits(spark, d):
    li = T(spark, d, "lineitem").withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return G.axis_limits(li, "l_extendedprice", "net")


@register("w1_running_band_sum", f"""
WITH b AS (SELECT l_suppkey, {BAND_SQL} AS band, count(*) AS n FROM lineitem GROUP BY l_suppkey, band)
SELECT l_suppkey, band, n,
       CAST(sum(n) OVER (PARTITION BY l_suppkey ORDER BY band ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cum
FROM b""")
def w1_running_band_sum(spark, d):
    li = T(spark, d, "lineitem")
    b = li.groupBy("l_suppkey", F.floor(F.col("l_quantity") / 5).cast("int").alias("band")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return G.running_sum(b, "l_suppkey", "band", "n")
