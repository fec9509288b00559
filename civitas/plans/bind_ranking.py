"""Top-k, sort, head (K1-K4) and reshape (R1-R3) on the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ranking as K
from ..operators import reshape as R
from .fixtures import T
from .registry import register


@register("k1_top_k", """
(SELECT 'top' AS side, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST,
 o_orderkey LIMIT 10)
UNION ALL
(SELECT 'bottom' AS side, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice ASC NULLS LAST,
 o_orderkey LIMIT 10)""")
def k1_top_k(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_totalprice")
    top = K.top_k(o, "o_totalprice", 10, True, ["o_orderkey"]).select(F.lit("top").alias("side"), "*")
    bot = K.top_k(o, "o_totalprice", 10, False, ["o_orderkey"]).select(F.lit("bottom").alias("side"), "*")
    return top.unionByName(bot)


@register("k2_top_k_reversed", """
SELECT o_orderkey, o_totalprice, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS INTEGER)
       AS rank
FROM (SELECT * FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 10)""")
def k2_top_k_reversed(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return K.top_k_reversed(o, "o_totalprice", 10, True, ["o_orderkey"])


@register("k3_sort_table", "SELECT c_custkey, c_acctbal FROM customer")
def k3_sort_table(spark, d):
    c = T(spark, d, "customer").select("c_custkey", "c_acctbal")
    return K.sort_table(c, ["c_acctbal", "c_custkey"], [False, True])


@register("k4_head", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem
ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice LIMIT 20""")
def k4_head(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return K.head(li, 20, ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"])


@register("r1_melt", """
SELECT c_custkey AS id, 'c_acctbal' AS metric, c_acctbal AS score FROM customer
UNION ALL SELECT c_custkey, 'c_nationkey', CAST(c_nationkey AS DOUBLE) FROM customer
UNION ALL SELECT s_suppkey, 's_acctbal', s_acctbal FROM supplier
UNION ALL SELECT s_suppkey, 's_nationkey', CAST(s_nationkey AS DOUBLE) FROM supplier""")
def r1_melt(spark, d):
    c = T(spark, d, "customer").withColumnRenamed("c_custkey", "id")
    s = T(spark, d, "supplier").withColumnRenamed("s_suppkey", "id")
    return R.melt(c, "id", ["c_acctbal", "c_nationkey"]).unionByName(
        R.melt(s, "id", ["s_acctbal", "s_nationkey"]))


@register("r2_reindex_zero", """
SELECT n.n_nationkey, coalesce(c.n_building, 0) AS n_building
FROM nation n LEFT JOIN (SELECT c_nationkey AS n_nationkey, count(*) AS n_building FROM customer
                         WHERE c_mktsegment = 'BUILDING' AND c_acctbal > 9000 GROUP BY 1) c
USING (n_nationkey)""")
def r2_reindex_zero(spark, d):
    c = T(spark, d, "customer").filter((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") > 9000))
    counts = c.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n_building"))
    return R.reindex_zero(counts, T(spark, d, "nation"), "n_nationkey", ["n_building"])


N_BANDS = 10


def band_layout():
    return [(f"b{b}", f"m{b}", f"f{b}", 5 * b + 2.5) for b in range(N_BANDS)]


@register("r3_bands_to_long", """
WITH w AS (SELECT l_suppkey, CAST(floor((l_quantity - 1) / 5) AS INTEGER) AS b,
                  count(*) FILTER (WHERE l_returnflag = 'R') AS m,
                  count(*) FILTER (WHERE l_returnflag <> 'R') AS f
           FROM lineitem GROUP BY 1, 2),
s AS (SELECT DISTINCT l_suppkey FROM lineitem),
g AS (SELECT s.l_suppkey, CAST(r.range AS INTEGER) AS b FROM s CROSS JOIN range(0, 10) r)
SELECT g.l_suppkey, 'b' || g.b AS band, CAST(coalesce(w.m, 0) + coalesce(w.f, 0) AS DOUBLE) AS n,
       CAST(5 * g.b + 2.5 AS DOUBLE) AS midpoint
FROM g LEFT JOIN w USING (l_suppkey, b)""")
def r3_bands_to_long(spark, d):
    li = T(spark, d, "lineitem").withColumn("b", F.floor((F.col("l_quantity") - 1) / 5).cast("int"))
    aggs = []
    for b in range(N_BANDS):
        in_b = F.col("b") == b
        aggs += [F.count_if(in_b & (F.col("l_returnflag") == "R")).alias(f"m{b}"),
                 F.count_if(in_b & (F.col("l_returnflag") != "R")).alias(f"f{b}")]
    wide = li.groupBy("l_suppkey").agg(*aggs)
    return R.bands_to_long(wide, "l_suppkey", band_layout())
