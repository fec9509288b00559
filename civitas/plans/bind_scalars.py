"""Scalar functions X1-X11 bound to the fixture tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as X
from . import sqlfrag as Q
from .fixtures import DL_SQL, T, documents_labels
from .registry import register

NBSP, NNBSP = " ", " "


def _french_price(cents):
    """Render integer cents as French text: NBSP, first digit, NNBSP, the
    rest, decimal comma (thousands blanks of the public files)."""
    s = cents.cast("string")
    n = F.length(s)
    return F.concat(F.lit(NBSP), s.substr(F.lit(1), F.lit(1)), F.lit(NNBSP),
                    s.substr(F.lit(2), n - 3), F.lit(","), s.substr(n - 1, F.lit(2)), F.lit(" "))


def dirty_prices(spark, d):
    """Orders price as dirty text: secrets ``s``, blanks and ``12d``
    suffixes chosen by priority/status, otherwise French formatting."""
    o = T(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority",
                                                  "o_orderstatus", "o_totalprice")
    txt = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit("s"))
           .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(" "))
           .when(F.col("o_orderstatus") == "P", F.lit("12d"))
           .otherwise(_french_price(F.round(F.col("o_totalprice") * 100).cast("long"))))
    return o.withColumn("raw", txt)


DIRTY_SQL = f"""(SELECT o_orderkey, o_custkey, o_totalprice,
  CASE WHEN o_orderpriority = '5-LOW' THEN 's'
       WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ' '
       WHEN o_orderstatus = 'P' THEN '12d'
       ELSE chr(160) || substr(c, 1, 1) || chr(8239) || substr(substr(c, 1, length(c) - 2), 2)
            || ',' || substr(c, length(c) - 1, 2) || ' ' END AS raw
  FROM (SELECT *, CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR) AS c FROM orders))"""


@register("x01_zfill", f"""
SELECT s_suppkey, {Q.zfill("CAST(s_suppkey AS VARCHAR)", 5)} AS code,
       {Q.zfill("CAST(s_suppkey * 10000 AS VARCHAR)", 5)} AS code_wide
FROM supplier""")
def x01_zfill(spark, d):
    s = T(spark, d, "supplier")
    return s.select("s_suppkey", X.zfill(F.col("s_suppkey").cast("string"), 5).alias("code"),
                    X.zfill((F.col("s_suppkey") * 10000).cast("string"), 5).alias("code_wide"))


@register("x02_strip", f"""
SELECT n_nationkey, {Q.strip("chr(160) || ' ' || n_name || chr(8239) || chr(9)")} AS name
FROM nation""")
def x02_strip(spark, d):
    n = T(spark, d, "nation")
    raw = F.concat(F.lit(NBSP + " "), F.col("n_name"), F.lit(NNBSP + "\t"))
    return n.select("n_nationkey", X.strip(raw).alias("name"))


@register("x03_parse_number", f"""
SELECT o_orderkey, raw, {Q.parse_number("raw")} AS value FROM {DIRTY_SQL}""")
def x03_parse_number(spark, d):
    o = dirty_prices(spark, d)
    return o.select("o_orderkey", "raw", X.parse_number("raw").alias("value"))


@register("x04_fill_missing", f"""
SELECT doc_id, coalesce(quality, 0) AS quality,
       coalesce(CAST(toxic AS VARCHAR), 'inconnu') AS toxic FROM {DL_SQL}""")
def x04_fill_missing(spark, d):
    dl = documents_labels(spark, d)
    return dl.select("doc_id", X.fill_missing("quality", 0).alias("quality"),
                     X.fill_missing(F.col("toxic").cast("string"), "inconnu").alias("toxic"))


@register("x05_round_even", f"""
SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount,
       {Q.round_even("l_extendedprice * l_discount", 2)} AS disc_amount,
       {Q.round_even("l_extendedprice / 7", 0)} AS sevenths
FROM lineitem""")
def x05_round_even(spark, d):
    li = T(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount",
                     X.round_even(F.col("l_extendedprice") * F.col("l_discount"), 2).alias("disc_amount"),
                     X.round_even(F.col("l_extendedprice") / 7, 0).alias("sevenths"))


@register("x06_remove_accents", f"""
SELECT doc_id, md5({Q.remove_accents("text")}) AS text_md5 FROM documents""")
def x06_remove_accents(spark, d):
    docs = T(spark, d, "documents")
    return docs.select("doc_id", F.md5(X.remove_accents("text")).alias("text_md5"))


@register("x07_normalize_place_name", f"""
SELECT doc_id, {Q.normalize_place_name("text")} AS name FROM documents""")
def x07_normalize_place_name(spark, d):
    docs = T(spark, d, "documents")
    return docs.select("doc_id", X.normalize_place_name("text").alias("name"))


@register("x08_if_else", """
SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN p_brand ELSE CAST(p_partkey AS VARCHAR) END AS code
FROM part""")
def x08_if_else(spark, d):
    p = T(spark, d, "part")
    return p.select("p_partkey", X.if_else(F.col("p_type") == "PROMO", F.col("p_brand"),
                                           F.col("p_partkey").cast("string")).alias("code"))


@register("x09_as_int", """
SELECT o_orderkey, CAST(trunc(o_totalprice) AS BIGINT) AS price_int,
       CAST(o_custkey AS VARCHAR) AS cust_text FROM orders""")
def x09_as_int(spark, d):
    o = T(spark, d, "orders")
    return o.select("o_orderkey", X.as_int("o_totalprice").alias("price_int"),
                    X.as_text("o_custkey").alias("cust_text"))


@register("x10_contains_any", """
SELECT doc_id, coalesce(contains(lang, 'de'), false) OR coalesce(contains(source, '1'), false)
       OR coalesce(contains(text, 'Der'), false) AS has_marker
FROM documents""")
def x10_contains_any(spark, d):
    docs = T(spark, d, "documents")
    # one marker per call, as in the header search; two calls OR-ed
    m = X.contains_any(["lang"], "de") | X.contains_any(["source"], "1") | \
        X.contains_any(["text"], "Der")
    return docs.select("doc_id", m.alias("has_marker"))


@register("x11_residual", """
SELECT doc_id, quality - (1 - toxic) AS residual FROM labels""")
def x11_residual(spark, d):
    lab = T(spark, d, "labels")
    return lab.select("doc_id", X.residual("quality", 1 - F.col("toxic")).alias("residual"))
