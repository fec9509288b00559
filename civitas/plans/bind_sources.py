"""Sources and sinks S1-S13: fixture tables written to the shared scratch
folder in the formats the jobs read, then read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, LongType, MapType, StringType, StructField, StructType,
                               ArrayType)

from ..session import scratch_dir, written
from ..sources import readers as S
from ..sources import sinks as W
from .fixtures import DL_SQL, T, documents_labels
from .registry import register


@register("s1_read_text_table", """
SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey
FROM supplier""")
def s1_read_text_table(spark, d):
    path = scratch_dir(spark, "s1")
    W.write_delimited(T(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), path, ";")
    return S.read_text_table(spark, path, sep=";")


ORDERS_SCHEMA = StructType([StructField("o_orderkey", LongType()), StructField("o_custkey", LongType()),
                            StructField("o_orderstatus", StringType()),
                            StructField("o_totalprice", DoubleType()),
                            StructField("o_orderpriority", StringType())])


@register("s2_read_typed_table", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""")
def s2_read_typed_table(spark, d):
    path = scratch_dir(spark, "s2")
    W.write_plain_csv(T(spark, d, "orders").select(*ORDERS_SCHEMA.fieldNames()), path)
    return S.read_typed_table(spark, path, ORDERS_SCHEMA)


@register("s3_encoding_fallback", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, text FROM documents""")
def s3_encoding_fallback(spark, d):
    """Whole texts, quotes and line breaks included, in two encodings."""
    base = scratch_dir(spark, "s3")
    docs = T(spark, d, "documents").select("doc_id", "lang", "text")
    latin = F.col("lang").isin("fr", "es")
    W.write_delimited(docs.filter(~latin), f"{base}/utf8 part")
    W.write_delimited(docs.filter(latin), f"{base}/latin1 part", encoding="ISO-8859-1")
    return S.read_with_encoding_fallback(spark, [f"{base}/utf8 part", f"{base}/latin1 part"], sep=";",
                                         multi_line=True, missing=())


SHEET_ROWS = 1000  # data rows per sheet: a sheet is one file


def _sheets(spark, d, base):
    """Customers as sheets (blocks of customer keys) of plain lines: a title
    of one cell, a quoted one, a blank line, a header row with the CODGEO
    marker, then the data. Odd sheets have their columns in another order,
    names hold the separator, quotes and a line break, as a title does."""
    name = F.concat(F.lit('"'), F.col("c_name"), F.lit(',\n""'), F.col("c_mktsegment"), F.lit('"""'))
    code, seg = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    c = T(spark, d, "customer").select(F.floor(F.col("c_custkey") / SHEET_ROWS).alias("sheet"), (F.col("c_custkey") + 10).alias("ord"),
                                       F.when(F.floor(F.col("c_custkey") / SHEET_ROWS) % 2 == 0, F.concat_ws(",", code, name, seg, F.lit("x")))
                                       .otherwise(F.concat_ws(",", seg, code, name)).alias("line"))
    sheets = c.select("sheet").distinct()
    header = F.when(F.col("sheet") % 2 == 0, "CODGEO,NOM,SEG,SOLDE").otherwise("SEG,CODGEO,NOM")
    for i, line in enumerate([F.lit("Title"), F.lit('"Source,\n""register"""'), F.lit("# notes"), header]):
        c = c.unionByName(sheets.select("sheet", F.lit(i).cast("long").alias("ord"), line.alias("line")))
    # rows of a sheet stay together and in order; each sheet is one file
    c.repartition("sheet").sortWithinPartitions("sheet", "ord").drop("ord").write.partitionBy("sheet").text(base)
    return S.read_cells(spark, base)


SHEET_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS CODGEO, c_name || ',' || chr(10) || '"' || c_mktsegment || '"' AS NOM, c_mktsegment AS SEG FROM customer"""


@register("s4_promote_header", SHEET_SQL)
def s4_promote_header(spark, d):
    cells = _sheets(spark, d, scratch_dir(spark, "s4"))
    return S.promote_header(cells, "CODGEO", 20).select("CODGEO", "NOM", "SEG")


@register("s5_skip_and_name", """
SELECT CASE WHEN c_custkey // 1000 % 2 = 0 THEN CAST(c_custkey AS VARCHAR) ELSE c_mktsegment END AS a,
       CASE WHEN c_custkey // 1000 % 2 = 0 THEN c_name || ',' || chr(10) || '"' || c_mktsegment || '"' ELSE CAST(c_custkey AS VARCHAR) END AS b,
       CASE WHEN c_custkey // 1000 % 2 = 0 THEN 'x' END AS d
FROM customer""")
def s5_skip_and_name(spark, d):
    cells = _sheets(spark, d, scratch_dir(spark, "s5"))
    return S.skip_and_name(cells, 4, ["a", "b", "c", "d"]).select("a", "b", "d")


FIXED_LAYOUT = [("COM", 1, 8), ("NCC", 9, 25), ("DEP", 34, 4)]


@register("s6_read_fixed_width", """
SELECT CAST(s_suppkey AS VARCHAR) AS COM, s_name AS NCC, CAST(s_nationkey AS VARCHAR) AS DEP FROM supplier""")
def s6_read_fixed_width(spark, d):
    path = scratch_dir(spark, "s6")
    s = T(spark, d, "supplier")
    line = F.concat(F.rpad(F.col("s_suppkey").cast("string"), 8, " "), F.rpad("s_name", 25, " "),
                    F.lpad(F.col("s_nationkey").cast("string"), 4, " "))
    s.select(line.alias("line")).write.option("sep", "\u0001").option("quote", "\u0000") \
        .option("encoding", "ISO-8859-1").csv(path)
    return S.read_fixed_width(spark, path, FIXED_LAYOUT)


@register("s7_write_delimited", """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, ' "' || text || '"; ' AS cell FROM documents""")
def s7_write_delimited(spark, d):
    """Whole texts with quotes, separators, line breaks and outer blanks."""
    path = scratch_dir(spark, "s7")
    W.write_delimited(T(spark, d, "documents").select("doc_id", F.concat(F.lit(' "'), "text", F.lit('"; ')).alias("cell")), path, ";")
    return S.read_text_table(spark, path, sep=";", multi_line=True, missing=())


@register("s8_write_plain_csv", """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation""")
def s8_write_plain_csv(spark, d):
    path = scratch_dir(spark, "s8")
    W.write_plain_csv(T(spark, d, "nation").select("n_nationkey", "n_name"), path)
    return S.read_text_table(spark, path, sep=",")


SUMMARY_SCHEMA = StructType([
    StructField("model", StringType()), StructField("accuracy", DoubleType()),
    StructField("report", MapType(StringType(), DoubleType())),
    StructField("confusion", ArrayType(ArrayType(LongType())))])


@register("s9_s10_json_summary", """
WITH p AS (SELECT quality AS y, 1 - toxic AS p FROM labels)
SELECT 'labels_rule' AS model, avg(CAST(y = p AS DOUBLE)) AS accuracy, avg(CAST(y = p AS DOUBLE)) AS report_accuracy,
       count(*) FILTER (WHERE y = 0 AND p = 0) AS c00, count(*) FILTER (WHERE y = 0 AND p = 1) AS c01,
       count(*) FILTER (WHERE y = 1 AND p = 0) AS c10, count(*) FILTER (WHERE y = 1 AND p = 1) AS c11
FROM p""")
def s9_s10_json_summary(spark, d):
    """Best-row summary with a nested report written as JSON and read back
    (built from the labels predictions fixture)."""
    lab = T(spark, d, "labels").select(F.col("quality").alias("y"), (1 - F.col("toxic")).alias("p"))
    acc = lab.agg(F.avg((F.col("y") == F.col("p")).cast("double")).alias("accuracy"),
                  F.count_if((F.col("y") == 0) & (F.col("p") == 0)).alias("c00"),
                  F.count_if((F.col("y") == 0) & (F.col("p") == 1)).alias("c01"),
                  F.count_if((F.col("y") == 1) & (F.col("p") == 0)).alias("c10"),
                  F.count_if((F.col("y") == 1) & (F.col("p") == 1)).alias("c11"))
    row = acc.select(F.lit("labels_rule").alias("model"), "accuracy",
                     F.create_map(F.lit("accuracy"), F.col("accuracy")).alias("report"),
                     F.array(F.array("c00", "c01"), F.array("c10", "c11")).alias("confusion"))
    path = scratch_dir(spark, "s9")
    W.write_json_summary(row, path)
    back = S.read_json_summary(spark, path, SUMMARY_SCHEMA)
    cell = {f"c{i}{j}": F.col("confusion")[i][j] for i in (0, 1) for j in (0, 1)}
    return back.select("model", "accuracy", F.col("report")["accuracy"].alias("report_accuracy"),
                       *[c.alias(n) for n, c in cell.items()])


@register("s11_read_optional", """
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation""")
def s11_read_optional(spark, d):
    path = scratch_dir(spark, "s11")
    W.write_plain_csv(T(spark, d, "nation").select("n_nationkey", "n_name"), path)
    schema = S.all_string_schema(["n_nationkey", "n_name"])
    present = S.read_optional(spark, path, schema, header=True)
    absent = S.read_optional(spark, path + "-missing", schema, header=True)
    return present.unionByName(absent)


@register("s12_export_filtered", """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'""")
def s12_export_filtered(spark, d):
    path = scratch_dir(spark, "s12")
    c = T(spark, d, "customer").select("c_custkey", "c_mktsegment")
    W.export_filtered(c, F.col("c_mktsegment") == "BUILDING", path)
    return S.read_text_table(spark, path, sep=";")


@register("s13_cached_scan", f"SELECT * FROM {DL_SQL}")
def s13_cached_scan(spark, d):
    """What a kept table's rows were, written from memory; then released."""
    kept = S.cached_scan(documents_labels(spark, d))
    try:
        return written(kept, "kept")
    finally:
        S.release(kept)
