"""Hot keys, observed audits, bucketed chains, selection, published runs."""

import pytest
from pyspark.sql import functions as F

from civitas.ml import compare as C
from civitas.ml import prep
from civitas.operators import joins as J
from civitas.operators import profile as Pr
from civitas.operators.ranking import exact_rank, hash_key
from civitas.plans import jobs


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_name_is_dealt_out(spark):
    """Three in ten rows share one name without a department."""
    rows = [(k, "hot" if k % 10 < 3 else f"n{k}", None if k % 10 < 3 else str(k % 7)) for k in range(2000)]
    left = spark.createDataFrame(rows, "a long, name string, dep string")
    right = spark.createDataFrame([(k + 10_000, n, d) for k, n, d in rows[:700]], "b long, name string, dep string")
    want = sorted((a, b, n) for a, n, d in rows for b, n2, d2 in [(k + 10_000, n2, d2) for k, n2, d2 in rows[:700] if n2 == "hot" or k == a] if (n, d) == (n2, d2))
    for how in ("inner", "left"):
        found = J.null_safe_join(left, right, ["name", "dep"], how=how, most_pairs=400)
        assert found.columns == ["name", "dep", "a", "b"]
        assert sorted((r.a, r.b, r.name) for r in found.where("b is not null").collect()) == want
    assert J.null_safe_join(left, right, ["name", "dep"], how="left", most_pairs=400).where("b is null").count() == sum(1 for a, n, _ in rows if n != "hot" and a >= 700)
    report = J.fan_out(left, right, ["name", "dep"]).orderBy(F.desc("n_pairs")).first()
    assert (report["name"], report["dep"], report.n_left, report.n_right, report.n_pairs) == ("hot", None, 600, 210, 126_000)
    dealt, _, blocks = J._dealt(left, right, ["name", "dep"], 400)
    sizes = [r["count"] for r in dealt.where("name = 'hot'").groupBy(*blocks).count().collect()]
    assert len(sizes) == 30 * 11 and max(sizes) <= 3 * 20  # no block holds much more than the side of a square


def test_audit_costs_no_scan(spark, tmp_path):
    raw = spark.createDataFrame([(k, f"{k:05d}", str(k * 10)) for k in range(50)], "o long, CODGEO string, Q221 string")
    raw.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    register = spark.createDataFrame([(f"{k:05d}", f"Commune {k}") for k in range(30)] + [("00003", "again")], "code_insee string, nom_commune string")
    audit = J.ObservedJoin()
    table = jobs.median_income(raw, register, 2021, order_col="o", audit=audit)
    plain = jobs.median_income(raw, register, 2021, order_col="o")
    assert plan(table).count("FileScan") == plan(plain).count("FileScan") == 1
    table.write.parquet(str(tmp_path / "out"))
    codes = raw.select(F.col("CODGEO").alias("code_insee"))
    metrics = dict(J.join_audit(codes, register.withColumnRenamed("nom_commune", "m"), "code_insee", "m").collect())
    assert audit.counts() == {k: metrics[k] for k in ("rows_before", "rows_after", "unmatched")} == {"rows_before": 50, "rows_after": 51, "unmatched": 20}
    assert metrics["ref_duplicates"] == 1
    one_name = F.col("code_insee") != "00003"
    written = spark.read.parquet(str(tmp_path / "out"))
    assert written.count() == 30 and sorted(map(tuple, written.where(one_name).collect())) == sorted(map(tuple, plain.where(one_name).collect()))


def test_audit_of_missing_keys(spark):
    left = spark.createDataFrame([(1,), (None,), (2,)], "k long")
    right = spark.createDataFrame([(1, None), (None, "x"), (None, "y"), (1, "z")], "k long, m string")
    joined = left.join(right, "k", "left")
    assert dict(J.join_audit(left, right, "k", "m").collect()) == {
        "rows_before": 3, "rows_after": joined.count(), "unmatched": joined.where("m is null").count(), "ref_duplicates": 2}


def test_bucketed_chain_moves_nothing(spark):
    tables = [spark.range(100).select((F.col("id") % 50 + k).alias("code"), F.lit(2020).alias("annee"), F.lit(k).alias(f"v{k}")).distinct() for k in range(3)]
    keys = ["annee", "code"]
    names = [J.write_bucketed(t, "t", keys, 4) for t in tables]
    chain = J.assemble_bucketed(spark, names, keys)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(chain) and plan(chain).count("SortMergeJoin") == 2
        assert sorted(map(str, chain.collect())) == sorted(map(str, J.assemble_features(tables, keys).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("n", [0, 1, 7, 1000])
def test_selection_equals_ranking(spark, n):
    df = spark.range(n).withColumn("c", F.when(F.col("id") % 10 < 7, "a").when(F.col("id") % 10 < 9, "b"))
    ranked = exact_rank(df.withColumn("h", hash_key(42, "id")), [], "h", "id")
    want = {r.id for r in ranked.where(F.col("rank") <= F.ceil(F.lit(0.2 * n))).collect()}
    split = prep.random_split(df, 0.2, 42, "id")
    assert {r.id for r in split.where("is_test").collect()} == want and split.count() == n
    ranked = exact_rank(df.withColumn("h", hash_key(42, "id")), ["c"], "h", "id")
    sizes = {r["c"]: round(0.2 * r["count"]) for r in df.groupBy("c").count().collect()}
    want = {r.id for r in ranked.collect() if r["rank"] <= sizes[r.c]}
    both = prep.split_and_folds(df, lambda k: F.rint(k * F.lit(0.2)), 5, 42, "id", "c")
    assert {r.id for r in prep.stratified_split(df, "c", 0.2, 42, "id").where("is_test").collect()} == want
    assert {r.id for r in both.where("is_test").collect()} == want
    assert dict(both.select("id", "fold").collect()) == dict(prep.folds(df, 5, 42, "id", "c").select("id", "fold").collect())


def test_selection_ranks_the_border_bucket_only(spark):
    df = spark.range(5000).withColumn("h", hash_key(1, "id"))
    last = prep.first_rows(df, "h", "id", lambda n: F.ceil(n * F.lit(0.2)))
    assert "RowNumber" in plan(last) or "row_number" in plan(last)
    split = prep.random_split(spark.range(5000), 0.2, 1, "id")
    assert "Window" not in plan(split).split("Subquery")[0]


class Stops(Exception):
    pass


def test_published_runs(spark, sf_dir, tmp_path, monkeypatch):
    e = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    df = e.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"e{i}") for i in range(4)], (F.col("label") % 2).cast("string").alias("target"))
    cfg = C.Config(target="target", id_col="vec_id", k_folds=2, n_trees=3, parallelism=2, models=("random_forest", "extra_trees"))
    result, folder = C.compare_classifiers(df, cfg), str(tmp_path / "runs")
    assert C.published_run(spark, folder) is None
    first = C.publish_run(result, "f1_weighted_test", folder)

    def stops(*_):
        raise Stops
    monkeypatch.setattr(C, "save_model", stops)
    with pytest.raises(Stops):
        C.publish_run(result, "f1_weighted_test", folder)
    run = C.published_run(spark, folder)
    board = run["leaderboard"].orderBy(F.desc("f1_weighted_test"), "model").first()
    assert run["run"] == first and run["winner"] == board["model"] == run["summary"].first()["model"]
    assert run["predictions"].count() == result["predictions"].count() and run["report"].count() > 0
    assert run["load_model"]().transform(df.withColumn("__target", F.col("target"))).count() == df.count()


def test_histograms_leave_infinities_out(spark):
    df = spark.createDataFrame([(float(k), None) for k in range(11)] + [(float("inf"), None), (float("nan"), None)], "x double, y double")
    bins = Pr.histograms(df, ["x", "y"], 5).collect()
    x = sorted((r.bin, r.lo, r.hi, r["count"]) for r in bins if r["column"] == "x")
    assert x == [(1, 0.0, 2.0, 2), (2, 2.0, 4.0, 2), (3, 4.0, 6.0, 2), (4, 6.0, 8.0, 2), (5, 8.0, 10.0, 3)]
    assert [(r.lo, r["count"]) for r in bins if r["column"] == "y"] == [(None, 0)] * 5
    boxes = {r["column"]: r for r in Pr.box_table(df, ["x", "y"]).collect()}
    assert set(boxes) == {"x"} and boxes["x"].n_outliers == 1
