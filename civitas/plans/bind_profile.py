"""Profiling operators G9-G17 on the fixtures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as Pr
from .fixtures import DL_SQL, T, documents_labels
from .registry import register

STATS = ["count", "mean", "std", "min", "25%", "50%", "75%", "max"]


def _describe_sql(table: str, col: str) -> str:
    exprs = {"count": f"CAST(count({col}) AS DOUBLE)", "mean": f"avg({col})",
             "std": f"stddev_samp({col})", "min": f"min({col})",
             "25%": f"quantile_cont({col}, 0.25)", "50%": f"quantile_cont({col}, 0.5)",
             "75%": f"quantile_cont({col}, 0.75)", "max": f"max({col})"}
    return " UNION ALL ".join(
        f"SELECT '{col}' AS column, '{s}' AS statistic, round(CAST({e} AS DOUBLE), 4) AS value "
        f"FROM {table}" for s, e in exprs.items())


@register("g09_describe", _describe_sql("customer", "c_acctbal") + " UNION ALL "
          + _describe_sql("supplier", "s_acctbal"))
def g09_describe(spark, d):
    c = Pr.describe(T(spark, d, "customer"), ["c_acctbal"])
    s = Pr.describe(T(spark, d, "supplier"), ["s_acctbal"])
    return c.unionByName(s).withColumn("value", F.round("value", 4))


@register("g10_mode", """
SELECT event_type AS mode FROM events GROUP BY event_type ORDER BY count(*) DESC, event_type LIMIT 1""")
def g10_mode(spark, d):
    return Pr.mode_of(T(spark, d, "events"), "event_type")


@register("g11_value_counts", "SELECT o_orderpriority, count(*) AS count FROM orders GROUP BY 1")
def g11_value_counts(spark, d):
    return Pr.value_counts(T(spark, d, "orders"), "o_orderpriority")


@register("g12_column_means_long", " UNION ALL ".join(
    f"SELECT '{c}' AS column, round(avg({c}), 6) AS mean FROM lineitem"
    for c in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))
def g12_column_means_long(spark, d):
    m = Pr.column_means_long(T(spark, d, "lineitem"),
                             ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    return m.withColumn("mean", F.round("mean", 6))


@register("g13_duplicate_count", """
SELECT count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS n_duplicates FROM lineitem""")
def g13_duplicate_count(spark, d):
    return Pr.duplicate_count(T(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


LABELS5 = ["A", "F", "N", "O", "R"]


@register("g14_crosstab", """
WITH labs AS (SELECT DISTINCT v AS label FROM (SELECT l_returnflag AS v FROM lineitem
                                               UNION ALL SELECT l_linestatus FROM lineitem))
SELECT labs.label, """ + ", ".join(
    f"CAST(count(l.l_linestatus) FILTER (WHERE l.l_linestatus = '{x}') AS BIGINT) AS \"{x}\""
    for x in LABELS5) + """
FROM labs LEFT JOIN lineitem l ON l.l_returnflag = labs.label GROUP BY labs.label""")
def g14_crosstab(spark, d):
    li = T(spark, d, "lineitem")
    return Pr.crosstab(li, "l_returnflag", "l_linestatus", LABELS5)


@register("g15_histogram", """
WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
c AS (SELECT CAST(least(floor((o_totalprice - lo) * 50 / (hi - lo)) + 1, 50) AS INTEGER) AS bin,
             count(*) AS count FROM orders, r GROUP BY 1),
b AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, 51))
SELECT b.bin, lo + (b.bin - 1) * ((hi - lo) / 50) AS lo, lo + b.bin * ((hi - lo) / 50) AS hi,
       coalesce(c.count, 0) AS count
FROM b CROSS JOIN r LEFT JOIN c USING (bin)""")
def g15_histogram(spark, d):
    return Pr.histogram(T(spark, d, "orders"), "o_totalprice", 50)


@register("g16_box_stats", """
WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS med,
                  quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
SELECT q1, med AS median, q3, q3 - q1 AS iqr,
       min(l_extendedprice) FILTER (WHERE l_extendedprice >= q1 - 1.5 * (q3 - q1)) AS lower_whisker,
       max(l_extendedprice) FILTER (WHERE l_extendedprice <= q3 + 1.5 * (q3 - q1)) AS upper_whisker,
       count(*) FILTER (WHERE l_extendedprice < q1 - 1.5 * (q3 - q1)
                           OR l_extendedprice > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM lineitem, q GROUP BY q1, med, q3""")
def g16_box_stats(spark, d):
    return Pr.box_stats(T(spark, d, "lineitem"), "l_extendedprice")


@register("g16_outliers", """
WITH q AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, value FROM events, q
WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)""")
def g16_outliers(spark, d):
    ev = T(spark, d, "events").select("event_id", "value")
    return Pr.outliers(ev, "value")


@register("g17_missing_patterns", f"""
SELECT lang IS NULL AS lang, quality IS NULL AS quality, toxic IS NULL AS toxic, count(*) AS count
FROM {DL_SQL} GROUP BY ALL""")
def g17_missing_patterns(spark, d):
    return Pr.missing_patterns(documents_labels(spark, d), ["lang", "quality", "toxic"])
