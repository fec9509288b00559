"""Property tests (hypothesis) on the scalar functions, run as one Spark
job per property over a generated batch."""

from hypothesis import given, settings
from hypothesis import strategies as st

from civitas.functions import scalars as X

texts = st.lists(st.one_of(st.none(), st.text(max_size=12)), min_size=1, max_size=40)


@settings(max_examples=15, deadline=None)
@given(texts)
def test_parse_number_never_throws(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    df.select(X.parse_number("v")).collect()


@settings(max_examples=15, deadline=None)
@given(texts)
def test_zfill_length(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    for v, r in df.select("v", X.zfill("v", 5).alias("r")).collect():
        if v is None:
            assert r is None
        else:
            assert len(r) >= 5 and r.endswith(v)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 10**6)), min_size=1, max_size=40))
def test_share_in_range(spark, pairs):
    rows = [(float(min(a, b)), float(max(a, b))) for a, b in pairs]
    df = spark.createDataFrame(rows, "part double, total double")
    for (s,) in df.select(X.share("part", "total")).collect():
        assert s is None or 0.0 <= s <= 100.0


# --- invariants on the fixture queries (sf0.001) ---------------------------------

import __spark_entry__ as E  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402


def test_banded_median_is_a_midpoint(spark, sf_dir):
    from civitas.plans.bind_aggregates import QTY_BANDS, qty_midpoint
    mids = {qty_midpoint(b) for b in QTY_BANDS}
    vals = {r[0] for r in E.queries()["g25_banded_median"](spark, sf_dir).select("median_qty").collect()}
    assert vals <= mids | {None}


def test_crosstab_total_is_row_count(spark, sf_dir):
    ct = E.queries()["g14_crosstab"](spark, sf_dir)
    total = ct.select(sum(F.col(c) for c in ct.columns if c != "label").alias("t")).agg(F.sum("t")).first()[0]
    assert total == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()


def test_added_removed_halves_disjoint(spark, sf_dir):
    d = E.queries()["j6_added_removed"](spark, sf_dir)
    removed = {r[0] for r in d.filter("change = 'removed'").select("doc_id").collect()}
    added = {r[0] for r in d.filter("change = 'added'").select("doc_id").collect()}
    assert not (removed & added)


def test_social_shares_sum_to_100(spark, sf_dir):
    s = E.queries()["job03_social"](spark, sf_dir)
    cols = [c for c in s.columns if c.startswith("pourcentage_")]
    for r in s.select(sum(F.coalesce(F.col(c), F.lit(0.0)) for c in cols).alias("t")).collect():
        assert abs(r["t"] - 100) <= 0.5 + 1e-9
