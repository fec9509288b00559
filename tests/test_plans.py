"""Plan checks: pushdown, pruning, top-k, no Python UDF in the jobs."""

import __spark_entry__ as E


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_indicator_jobs(spark, sf_dir):
    for key in [k for k in E.queries() if k.startswith("job0") or k.startswith("job1")]:
        if key in ("job18_compare_classifiers", "job19_compare_regressors"):
            continue
        p = plan(E.queries()[key](spark, sf_dir))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, key


def test_top_k_is_take_ordered(spark, sf_dir):
    p = plan(E.queries()["k4_head"](spark, sf_dir))
    assert "TakeOrderedAndProject" in p


def test_filter_pushed_and_columns_pruned(spark, sf_dir):
    p = plan(E.queries()["f7_filter_threshold"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,45.0)]" in p
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in p


def test_equality_on_a_number_is_pushed(spark, sf_dir):
    from civitas.operators.filters import filter_equals
    df = filter_equals(spark.read.parquet(f"{sf_dir}/customer.parquet"), "c_nationkey", "5")
    assert "EqualTo(c_nationkey,5)" in plan(df)
    assert filter_equals(df, "c_nationkey", "five").count() == 0


def test_repeated_feature_key_stops(spark):
    import pytest
    from civitas.operators.joins import assemble_features
    left = spark.createDataFrame([(1, 2)], "k int, a int")
    right = spark.createDataFrame([(1, 3), (1, 4)], "k int, b int")
    with pytest.raises(Exception, match="repeated key"):
        assemble_features([left, right], "k").collect()
    assert assemble_features([right, left], "k").count() == 2


def test_first_per_key_uses_aggregate_not_window(spark, sf_dir):
    p = plan(E.queries()["g18_first_per_key"](spark, sf_dir))
    assert "Window" not in p and "Aggregate" in p


def test_unemployment_job_has_one_shuffle(spark):
    """J-02 on a raw sheet: parse, rate, broadcast register join, mean per
    commune — a single shuffle exchange (the final aggregation)."""
    from civitas.plans import jobs
    cols = ["CODGEO", *jobs.EMPLOYED, *jobs.UNEMPLOYED]
    sheet = spark.createDataFrame([("1001", *["1"] * 8)], ",".join(f"`{c}` string" for c in cols))
    reg = spark.createDataFrame([("01001", "A")], "code_insee string, nom_commune string")
    p = plan(jobs.unemployment_rate(sheet, reg, 2022))
    assert p.count("Exchange hashpartitioning") <= 2  # the mean, and the register's group if it is not broadcast
