"""Projection, filter, join and set operators (P, F, J, U) on the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import columns as P
from ..operators import filters as Fl
from ..operators import joins as J
from . import sqlfrag as Q
from .fixtures import DL_SQL, T, documents_labels
from .registry import register


@register("p1_select_rename", """
SELECT c_custkey AS code_insee, c_name AS nom_commune, c_nationkey AS code_departement FROM customer""")
def p1_select_rename(spark, d):
    c = T(spark, d, "customer")
    return P.select_rename(c, {"c_custkey": "code_insee", "c_name": "nom_commune",
                               "c_nationkey": "code_departement"})


@register("p2_normalize_column_names", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def p2_normalize_column_names(spark, d):
    n = T(spark, d, "nation")
    dirty = n.toDF(" n_nation\nkey ", "'n_name'", 'n_region "key"')
    return P.normalize_column_names(dirty)


@register("p3_require_columns", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def p3_require_columns(spark, d):
    c = T(spark, d, "customer")
    P.require_columns(c, ["c_custkey", "c_nationkey", "c_acctbal"])
    return P.require_rows(c.select("c_custkey", "c_nationkey", "c_acctbal"))


@register("p4_columns_with_prefix", """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount,
       l_extendedprice + l_discount AS measure_sum FROM lineitem""")
def p4_columns_with_prefix(spark, d):
    li = T(spark, d, "lineitem")
    cols = P.columns_with_prefix(li, ["l_ext", "l_dis"])
    total = F.col(cols[0])
    for c in cols[1:]:
        total = total + F.col(c)
    return li.select("l_orderkey", "l_linenumber", *cols, total.alias("measure_sum"))


@register("p5_split_feature_types", "SELECT c_nationkey, c_acctbal, c_mktsegment FROM customer")
def p5_split_feature_types(spark, d):
    c = T(spark, d, "customer")
    numeric, categorical = P.split_feature_types(c, exclude=["c_custkey", "c_name"])
    return c.select(*numeric, *categorical)


@register("p6_with_literal", "SELECT c_custkey, c_name, CAST(2022 AS INTEGER) AS annee FROM customer")
def p6_with_literal(spark, d):
    c = T(spark, d, "customer").select("c_custkey", "c_name")
    return P.with_literal(c, "annee", 2022)


@register("p7_with_formula", """
SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS disc_price FROM lineitem""")
def p7_with_formula(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    return P.with_formula(li, "disc_price", "l_extendedprice * (1 - l_discount)") \
        .select("l_orderkey", "l_linenumber", "disc_price")


@register("p8_compose_key", f"""
SELECT s_suppkey, {Q.zfill("CAST(s_nationkey AS VARCHAR)", 2)} || {Q.zfill("CAST(s_suppkey AS VARCHAR)", 3)}
       AS code_insee FROM supplier""")
def p8_compose_key(spark, d):
    s = T(spark, d, "supplier")
    return P.compose_key(s, "code_insee", ["s_nationkey", "s_suppkey"], [2, 3]) \
        .select("s_suppkey", "code_insee")


@register("f1_filter_equals", """
SELECT o_orderkey, o_custkey, o_orderpriority FROM orders
WHERE CAST(year(o_orderdate) AS VARCHAR) = '1997' AND o_orderpriority = '1-URGENT'""")
def f1_filter_equals(spark, d):
    o = T(spark, d, "orders").withColumn("annee", F.year("o_orderdate"))
    o = Fl.filter_equals(o, "annee", 1997)
    o = Fl.filter_equals(o, "o_orderpriority", "1-URGENT")
    o = Fl.filter_equals(o, "o_orderstatus", Fl.ALL)  # sentinel: no predicate
    return o.select("o_orderkey", "o_custkey", "o_orderpriority")


@register("f2_filter_flag", f"""
SELECT o_orderkey FROM orders WHERE {Q.strip("' ' || o_orderstatus || chr(160)")} = 'F'""")
def f2_filter_flag(spark, d):
    o = T(spark, d, "orders")
    o = o.withColumn("flag", F.concat(F.lit(" "), "o_orderstatus", F.lit(" ")))
    return Fl.filter_flag(o, "flag", "F").select("o_orderkey")


@register("f3_drop_blank", f"""
SELECT p_partkey, name FROM (
  SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN chr(160) || ' ' ELSE p_name END AS name FROM part)
WHERE {Q.strip("name")} <> ''""")
def f3_drop_blank(spark, d):
    p = T(spark, d, "part")
    p = p.select("p_partkey", F.when(F.col("p_type") == "PROMO", F.lit("  "))
                 .otherwise(F.col("p_name")).alias("name"))
    return Fl.drop_blank(p, "name")


@register("f4_drop_missing", f"SELECT * FROM {DL_SQL} WHERE quality IS NOT NULL AND toxic IS NOT NULL")
def f4_drop_missing(spark, d):
    return Fl.drop_missing(documents_labels(spark, d), ["quality", "toxic"])


@register("f5_search_text", """
SELECT p_partkey, p_name FROM part WHERE coalesce(regexp_matches(p_name, '(?i)RE+D|g[a-z]ar'), false)""")
def f5_search_text(spark, d):
    p = T(spark, d, "part").select("p_partkey", "p_name")
    return Fl.search_text(p, "p_name", "RE+D|g[a-z]ar")


@register("f6_rows_with_missing", f"""
SELECT * FROM {DL_SQL} WHERE quality IS NULL OR toxic IS NULL ORDER BY doc_id LIMIT 20""")
def f6_rows_with_missing(spark, d):
    return Fl.rows_with_missing(documents_labels(spark, d), ["quality", "toxic"], ["doc_id"], 20)


@register("f7_filter_threshold", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45""")
def f7_filter_threshold(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return Fl.filter_threshold(li, "l_quantity", ">", 45)


@register("f8_filter_in_keys", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1997)""")
def f8_filter_in_keys(spark, d):
    c = T(spark, d, "customer").select("c_custkey", "c_name")
    o = T(spark, d, "orders").filter(F.year("o_orderdate") == 1997)
    return Fl.filter_in_keys(c, o, "c_custkey", "o_custkey")


@register("j1_enrich", f"SELECT * FROM {DL_SQL}")
def j1_enrich(spark, d):
    docs = T(spark, d, "documents").select("doc_id", "lang", "source", "n_chars")
    return J.enrich(docs, T(spark, d, "labels"), "doc_id")


@register("j2_enrich_strict", """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, p.p_name
FROM lineitem l LEFT JOIN (SELECT p_partkey AS l_partkey, p_name FROM part WHERE p_size < 10) p
  USING (l_partkey)
WHERE p.p_name IS NOT NULL""")
def j2_enrich_strict(spark, d):
    li = T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    p = T(spark, d, "part").filter("p_size < 10").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return J.enrich_strict(li, p, "l_partkey", "p_name") \
        .select("l_orderkey", "l_linenumber", "l_partkey", "p_name")


@register("j3_join_on_pair", """
SELECT o.o_orderkey, o.o_custkey, c.c_name FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def j3_join_on_pair(spark, d):
    o = T(spark, d, "orders").select("o_orderkey", "o_custkey")
    c = T(spark, d, "customer").select("c_custkey", "c_name")
    return J.join_on_pair(o, c, "o_custkey", "c_custkey")


@register("j4_join_on_key", """
SELECT s.s_suppkey, s.s_nationkey, n.n_name FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""")
def j4_join_on_key(spark, d):
    s = T(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    n = T(spark, d, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    return J.join_on_key(s, n, "s_nationkey", ["n_name"])


# Two register years from supplier: the name drops its last digit, so about
# ten suppliers share a name and a few of them a nation too — homonyms with
# a bounded fan-out, like commune names within a department. Nation 0 has a
# missing department on both sides (missing matches missing).
BRIDGE_SIDES_SQL = """
old AS (SELECT s_suppkey AS key_old, substr(s_name, 1, length(s_name) - 1) AS name,
               CASE WHEN s_nationkey <> 0 THEN s_nationkey END AS kind FROM supplier),
new AS (SELECT s_suppkey AS key_new, substr(s_name, 1, length(s_name) - 1) AS name,
               CASE WHEN s_nationkey <> 0 THEN s_nationkey END AS kind FROM supplier)"""


def bridge_sides(spark, d):
    s = T(spark, d, "supplier")
    name = F.col("s_name").substr(F.lit(1), F.length("s_name") - 1)
    kind = F.when(F.col("s_nationkey") != 0, F.col("s_nationkey"))
    old = s.select(F.col("s_suppkey").alias("key_old"), name.alias("name"), kind.alias("kind"))
    new = s.select(F.col("s_suppkey").alias("key_new"), name.alias("name"), kind.alias("kind"))
    return old, new


@register("j5_bridge_by_name", f"""
WITH {BRIDGE_SIDES_SQL}
SELECT old.name, old.kind, key_old, key_new
FROM old JOIN new ON old.name IS NOT DISTINCT FROM new.name AND old.kind IS NOT DISTINCT FROM new.kind""")
def j5_bridge_by_name(spark, d):
    old, new = bridge_sides(spark, d)
    return J.null_safe_join(old, new, ["name", "kind"])


@register("j5_fan_out", f"""
WITH {BRIDGE_SIDES_SQL}, l AS (SELECT name, kind, count(*) AS n_left FROM old GROUP BY ALL), r AS (SELECT name, kind, count(*) AS n_right FROM new GROUP BY ALL)
SELECT l.name, l.kind, n_left, n_right, n_left * n_right AS n_pairs
FROM l JOIN r ON l.name IS NOT DISTINCT FROM r.name AND l.kind IS NOT DISTINCT FROM r.kind""")
def j5_fan_out(spark, d):
    return J.fan_out(*bridge_sides(spark, d), ["name", "kind"])


@register("j6_added_removed", """
SELECT doc_id, lang, CAST(NULL AS INTEGER) AS quality, 'removed' AS change FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL
SELECT doc_id, CAST(NULL AS VARCHAR) AS lang, quality, 'added' AS change FROM labels
WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def j6_added_removed(spark, d):
    old = T(spark, d, "documents").select("doc_id", "lang")
    new = T(spark, d, "labels").select("doc_id", "quality")
    return J.added_removed(old, new, "doc_id")


J7_SQL = """
WITH o AS (SELECT o_custkey AS c_custkey, count(*) AS n_orders,
                  CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_price
           FROM orders GROUP BY o_custkey),
u AS (SELECT o_custkey AS c_custkey, count(*) AS n_urgent
      FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY o_custkey)
SELECT c.c_custkey, c.c_acctbal, o.n_orders, o.total_price, u.n_urgent
FROM customer c LEFT JOIN o USING (c_custkey) LEFT JOIN u USING (c_custkey)"""


def _indicators(spark, d):
    c = T(spark, d, "customer").select("c_custkey", "c_acctbal")
    orders = T(spark, d, "orders").withColumnRenamed("o_custkey", "c_custkey")
    o = orders.groupBy("c_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total_price"))
    u = orders.filter(F.col("o_orderpriority") == "1-URGENT").groupBy("c_custkey") \
        .agg(F.count(F.lit(1)).alias("n_urgent"))
    return [c, o, u]


@register("j7_assemble_features", J7_SQL)
def j7_assemble_features(spark, d):
    return J.assemble_features(_indicators(spark, d), "c_custkey")


@register("j7_bucketed_features", J7_SQL)
def j7_bucketed_features(spark, d):
    """The same from indicator tables that are written in buckets of the key."""
    names = [J.write_bucketed(t, f"indicator_{k}", "c_custkey", 8) for k, t in enumerate(_indicators(spark, d))]
    return J.assemble_bucketed(spark, names, "c_custkey")


@register("j8_join_audit", """
SELECT 'rows_before' AS metric, count(*) AS value FROM documents
UNION ALL SELECT 'rows_after', count(*) FROM documents d LEFT JOIN labels l USING (doc_id)
UNION ALL SELECT 'unmatched', count(*) FILTER (WHERE l.quality IS NULL)
          FROM documents d LEFT JOIN labels l USING (doc_id)
UNION ALL SELECT 'ref_duplicates', count(*) - count(DISTINCT doc_id) FROM labels""")
def j8_join_audit(spark, d):
    docs = T(spark, d, "documents").select("doc_id")
    return J.join_audit(docs, T(spark, d, "labels"), "doc_id", "quality")


@register("u1_key_difference", """
SELECT DISTINCT doc_id FROM documents EXCEPT SELECT doc_id FROM labels""")
def u1_key_difference(spark, d):
    return J.key_difference(T(spark, d, "documents"), T(spark, d, "labels"), "doc_id")


@register("u2_distinct_union", """
SELECT DISTINCT nationkey FROM (SELECT c_nationkey AS nationkey FROM customer
                                UNION ALL SELECT s_nationkey FROM supplier) ORDER BY 1""")
def u2_distinct_union(spark, d):
    return J.distinct_union([T(spark, d, "customer").withColumnRenamed("c_nationkey", "k"),
                             T(spark, d, "supplier").withColumnRenamed("s_nationkey", "k")],
                            "k", "nationkey")
