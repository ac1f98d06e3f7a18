"""Equal answers on both sides of every size switch; gaps, infinities, constant groups."""

import math

import pytest
from pyspark.sql import functions as F

from sparktab import session
from sparktab.operators import attribution, charts, clean, evaluate, models, prepare, quantile, relate, support, tuning, validate
from sparktab.sources import artifacts
from sparktab.streaming import flows

NAN, INF = float("nan"), float("inf")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def groups(spark):
    rows = [("a", float(i % 7)) for i in range(40)] + [(None, float(i)) for i in range(25)] + [("c", 5.0)] * 6
    rows += [("a", NAN), ("a", None), (None, INF), ("a", -INF), ("d", None), ("e", 2.0), ("a", -0.0), ("a", 0.0)]
    return spark.createDataFrame(rows, "g string, x double")


@pytest.mark.parametrize("by", [[], ["g"]])
def test_both_quantile_paths_agree(groups, by):
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    one = quantile.quantiles(groups, ["x"], probs, by)
    two = quantile.quantiles(groups, ["x"], probs, by, small_bytes=0)
    assert rows_of(one) == rows_of(two)
    if by:
        assert {r["g"] for r in one.collect()} == {"a", "c", "e", None}


def test_charts_keep_all_groups(groups):
    for small in (0, 1 << 24):
        boxes = charts.box_stats(groups, ["x"], ["g"], small_bytes=small)
        assert {r["g"] for r in boxes.collect()} == {"a", "c", "e", None}
        assert {r["g"] for r in clean.fence_report(groups, ["x"], ["g"], small_bytes=small).collect()} == {"a", "c", "e", None}
        shape = charts.violin(groups, ["x"], ["g"], points=5, small_bytes=small).collect()
        assert {r["g"] for r in shape} == {"a", "c", "e", None}
        assert [(r["point"], r["median"]) for r in shape if r["g"] == "c"] == [(None, 5.0)]
    both = charts.compare_boxes(boxes, boxes, ["g"])
    assert both.count() == 4


def test_histogram_without_a_limit(spark):
    rows = spark.range(3000).select((F.col("id") % 10).cast("double").alias("x")).union(spark.sql("SELECT CAST(1e7 AS DOUBLE)")).union(spark.sql("SELECT double('infinity')"))
    bins = charts.histogram(rows, ["x"]).collect()
    assert sum(r["n"] for r in bins) == 3001 and max(r["bin"] for r in bins) > 10_000 and all(r["n"] for r in bins)
    listed = charts.histogram(rows.where("x < 10"), ["x"], bins=30).collect()
    assert len(listed) == 30 and sum(r["n"] == 0 for r in listed) == 20


def test_measures_leave_out_what_is_not_finite(groups):
    moments = clean.fit_moments(groups, ["x"])["x"]
    assert moments.n == 74 and math.isfinite(moments.mean) and moments.n_missing == 5


def test_joins_match_null_with_null(spark):
    left = spark.createDataFrame([(None, i) for i in range(3000)] + [("a", 1), ("b", 2)], "k string, v int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, w int")
    want = [r for r in rows_of(support.null_safe_join(left, right, ["k"], "left"))]
    assert rows_of(support.spread_join(left, right, ["k"], "left")) == want
    assert rows_of(support.lookup(left, right, ["k"], True, "left")) == want
    assert sum(r[2] == 10 for r in want) == 3000


def test_codes_by_expression_and_by_join_agree(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "c string")
    few = prepare.ordinal(df, "c", "code")
    many = prepare.encode_joined(df, "c", "code")
    assert rows_of(few.select("c", "code")) == rows_of(many.select("c", "code"))
    wide = spark.range(20_000).withColumn("s", F.col("id").cast("string"))
    codes = [r["code"] for r in prepare.code_table(wide, "s").orderBy("s").collect()]
    assert codes == list(range(20_000))
    hot = prepare.one_hot_sparse(wide, "s")
    assert hot.agg(F.min("s_width"), F.max("s_index")).first() == (20_000, 19_999)


def test_crosstab_of_many_levels(spark):
    df = spark.range(3000).selectExpr("id % 2 AS a", "id AS b")
    assert relate.crosstab(df, "a", "b").count() == 3000
    assert relate.crosstab(df.where("id < 40"), "a", "b").count() == 80


def test_distinct_rows_carry_one_row_per_digest(spark):
    df = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, "y", 1.0), (4, "y", 1.0), (5, "y", None)], "id int, t string, v double")
    assert clean.distinct_rows(df, ["id"]).count() == 3
    assert sorted(r["id"] for r in clean.keep_first(df, ["id"]).collect()) == [1, 3, 5]
    plan = clean.distinct_rows(df, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Exchange") < plan.rindex("partial_") and "_row" in plan


def test_rules_without_a_column(spark):
    out = validate.rule_counts(spark.range(3), [validate.InRange("nowhere", 0, 1)])
    assert out.count() == 0 and out.columns == ["rule", "n_rows", "n_violations"]


MODEL = attribution.LinearModel(("x", "y"), ("a", "b"), ((1.0, 0.5), (-1.0, 0.2)), (0.1, -0.1), (0.5, 0.5))


def gapped(spark):
    return spark.createDataFrame([(1, 1.0, 2.0), (2, None, 2.0), (3, NAN, 1.0), (4, 0.0, INF)], "id int, x double, y double")


def test_scores_of_rows_with_gaps(spark):
    rows = {r["id"]: r["result"] for r in attribution.score(gapped(spark), MODEL, ["id"]).collect()}
    assert rows[1]["prediction"] == "a" and len(rows[1]["top_factors"]) == 2
    assert all(rows[i]["prediction"] is None and rows[i]["top_factors"] == [] for i in (2, 3, 4))
    steps = attribution.waterfall(attribution.with_scores(gapped(spark), MODEL), MODEL, ["id"], shown=1).collect()
    assert sorted(r["id"] for r in steps) == [1, 1, 2, 3, 4] and all(r["feature"] is None for r in steps if r["id"] > 1)


def test_missing_as_mean(spark):
    import dataclasses

    filled = dataclasses.replace(MODEL, missing="mean", centre=(0.0, 0.0), spread=(1.0, 1.0))
    rows = {r["id"]: r["result"]["prediction"] for r in attribution.score(gapped(spark), filled, ["id"]).collect()}
    assert None not in rows.values()


def test_stream_survives_a_record_with_gaps(spark, tmp_path):
    gapped(spark).write.parquet(str(tmp_path / "in"))
    stream = flows.read_stream(spark, str(tmp_path / "in"), gapped(spark).schema)
    flows.write_tables(flows.score_stream(stream, MODEL, ["id"]), str(tmp_path / "out"), str(tmp_path / "at")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_late_records_are_dropped(spark, tmp_path):
    """Two files, one batch each: what comes after its window closed is not counted."""
    kinds = "ts timestamp, k int"
    for i, rows in enumerate(([("2024-01-01 00:10:00", 1), ("2024-01-01 12:00:00", 2)], [("2024-01-01 00:20:00", 1), ("2024-01-01 11:30:00", 3)])):
        spark.createDataFrame(rows, "t string, k int").selectExpr("CAST(t AS timestamp) AS ts", "k").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = flows.read_stream(spark, str(tmp_path / "in"), spark.createDataFrame([], kinds).schema)
        once = flows.dedup_stream(stream.withColumn("hour", F.date_trunc("hour", "ts")), ["k", "hour"], "ts", "6 hours")
        flows.write_tables(once, str(tmp_path / "out"), str(tmp_path / "at")).awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2, 3]


@pytest.fixture(scope="module")
def rare(spark):
    """A level that all folds but one lack."""
    rows = [(i, float(i % 9), "rare" if i == 7 else ["p", "q"][i % 2], str(int(i % 9 > 4)), i % 3) for i in range(60)]
    return spark.createDataFrame(rows, "id int, x double, c string, y string, fold int").withColumn("label", F.col("y").cast("double")).persist()


@pytest.mark.parametrize("name,params", [("perceptron", {"hidden": (3,), "max_iter": 5}), ("kernel_svm", {"components": 5, "max_iter": 3})])
def test_folds_that_lack_a_level(rare, name, params):
    found = tuning.search(name, [params], rare, ("0", "1"), ["x"], ["c"], folds=3)
    assert 0 <= found.means[0] <= 1 and found.model.predict(rare).count() == 60


def test_linear_form_with_categories(spark, rare, tmp_path):
    fitted = models.train("logistic", rare, ("0", "1"), ["x"], ["c"], {"C": 10.0})
    saved = artifacts.load_linear(spark, artifacts.save_linear(spark, fitted.linear(rare), str(tmp_path / "m")))
    assert saved == fitted.linear(rare) and saved.features == ("x", "c_p", "c_q", "c_rare")
    test = rare.withColumn("x", F.when(F.col("id") % 10 != 0, F.col("x")))  # with gaps, and an unseen level
    test = test.withColumn("c", F.when(F.col("id") == 3, "new").otherwise(F.col("c")))
    one = {r["id"]: r["probability"] for r in attribution.with_scores(test, saved).collect()}
    two = {r["id"]: r["probability"] for r in fitted.predict(test).collect()}
    assert all(abs(a - b) < 1e-9 for i in one for a, b in zip(one[i], two[i]))


def test_confusion_pairs_are_made_on_the_cluster(spark):
    df = spark.createDataFrame([("1", "2"), ("1", "1")], "label string, prediction string")
    assert evaluate.confusion(df, [str(i) for i in range(300)]).count() == 90_000


def test_written_tables_are_released(spark):
    import os

    session.release(spark)
    kept = session.settled(spark.range(3), "probe")
    path = kept.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and session.release(spark) == 1 and not os.path.exists(path)
