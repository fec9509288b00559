"""Incremental (availableNow) processing of new raw files: each file once."""

from pyspark.sql import functions as F

from civitas.functions.scalars import parse_number, zfill
from civitas.operators import joins as J
from civitas.sources.readers import all_string_schema
from civitas.streaming.incremental import incremental_indicator


def test_incremental_indicator(spark, tmp_path):
    inbox, out, ck = tmp_path / "in", tmp_path / "out", tmp_path / "ck"
    inbox.mkdir()
    register = spark.createDataFrame([("01001", "A"), ("01002", "B")], "code_insee string, nom_commune string")

    def transform(df):
        parsed = df.select(zfill("CODGEO", 5).alias("code_insee"), parse_number("Q221").alias("revenu_median"))
        return J.enrich(parsed, register, "code_insee") \
            .withColumn("annee", F.lit(2021))

    schema = all_string_schema(["CODGEO", "Q221"])
    (inbox / "a.csv").write_text("CODGEO;Q221\n1001;1 000,5\n1002;s\n")
    incremental_indicator(spark, str(inbox), schema, transform, str(out), "t", checkpoint=str(ck))
    (inbox / "b.csv").write_text("CODGEO;Q221\n1002;20\n")
    incremental_indicator(spark, str(inbox), schema, transform, str(out), "t", checkpoint=str(ck))
    rows = sorted(((r["code_insee"], r["revenu_median"]) for r in spark.read.parquet(str(out)).collect()),
                  key=lambda t: (t[0], t[1] is None, t[1] or 0))
    assert rows == [("01001", 1000.5), ("01002", 20.0), ("01002", None)]
