import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.operators import charts, quantile, relate, support

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def _values(kind, n, seed):
    rng = random.Random(seed)
    if kind == "ties":
        return [float(rng.randrange(5)) for _ in range(n)]
    if kind == "hot":
        return [42.0 if rng.random() < 0.4 else rng.gauss(40, 5) for _ in range(n)]
    if kind == "heavy":
        return [rng.paretovariate(0.3) for _ in range(n)]
    return [rng.uniform(-1, 1) for _ in range(n)]


@pytest.mark.parametrize(
    "kind,n,limit", [("ties", 500, 1 << 20), ("hot", 3000, 3), ("heavy", 3000, 3), ("even", 2, 1 << 20), ("even", 1, 3)]
)
def test_selection_is_exact(spark, monkeypatch, kind, n, limit):
    monkeypatch.setattr(quantile, "VALUES_PER_TASK", limit)  # 3: several levels
    if limit == 3:
        monkeypatch.setattr(quantile, "MARGINS", (-0.2, 0.2))
    values = _values(kind, n, n)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = quantile.quantiles(df, ["x"], PROBS, small_bytes=0).first()
    assert got["n"] == n
    np.testing.assert_allclose(got["q"], np.percentile(values, [p * 100 for p in PROBS]), rtol=1e-12)


def test_selection_by_group_and_column(spark):
    rng = random.Random(9)
    data = [("big" if i % 3 else f"g{i % 7}", rng.gauss(0, 1), float(i % 11)) for i in range(2000)]
    df = spark.createDataFrame(data, "g string, x double, y double")
    big = quantile.quantiles(df, ["x", "y"], [0.25, 0.5, 0.75], ["g"], small_bytes=0)
    small = quantile.quantiles(df, ["x", "y"], [0.25, 0.5, 0.75], ["g"], small_bytes=1 << 62)
    a = {(r["g"], r["column"]): (r["n"], r["q"]) for r in big.collect()}
    b = {(r["g"], r["column"]): (r["n"], r["q"]) for r in small.collect()}
    assert a.keys() == b.keys()
    for key in a:
        assert a[key][0] == b[key][0]
        np.testing.assert_allclose(a[key][1], b[key][1], rtol=1e-12)


def test_approximate_quantiles_are_close(spark):
    df = spark.range(10_000).select(F.col("id").cast("double").alias("x"))
    got = quantile.quantiles(df, ["x"], [0.5], exact=False).first()
    assert abs(got["q"][0] - 5000) <= 5


def test_statistics_too_many_to_broadcast_are_joined(spark):
    df = spark.range(300).select((F.col("id") % 30).alias("g"), F.col("id").alias("v"))
    stats = df.groupBy("g").agg(F.max("v").alias("top"))
    df = df.withColumn("g", F.when(F.col("v") % 3 == 0, 0).otherwise(F.col("g")))  # one hot group
    stats = df.groupBy("g").agg(F.max("v").alias("top"))
    joined = support.attach(df, stats, ["g"], limit=5)
    assert joined.exceptAll(df.join(stats, "g")).count() == 0
    assert joined.count() == 300
    assert set(joined.columns) == {"g", "v", "top"}


def test_plan_size_is_checked(spark):
    assert support.measured_bytes(spark.range(10), ["id"]) == 80
    assert support.bounded_rows(spark.range(10), 5) is None
    assert len(support.bounded_rows(spark.range(5), 5)) == 5


def test_histogram_matches_numpy(spark):
    values = _values("heavy", 400, 3)
    values = [min(v, 50.0) for v in values]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = charts.histogram(df, ["x"], bins=30).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=30)
    assert [r["n"] for r in got] == counts.tolist()
    np.testing.assert_allclose([r["left"] for r in got], edges[:-1])


def test_automatic_bins_match_numpy(spark):
    values = _values("even", 500, 4)
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = charts.histogram(df, ["x"]).collect()
    assert len(got) == len(np.histogram_bin_edges(values, bins="auto")) - 1
    assert sum(r["n"] for r in got) == 500


def test_constant_column_has_one_bin(gaps):
    got = charts.histogram(gaps, ["same", "x"], bins=4)
    assert got.where("column = 'same'").count() == 1
    assert got.where("column = 'x'").agg(F.sum("n")).first()[0] == 3


def test_density_integrates_to_one(spark):
    values = _values("even", 800, 6)
    df = spark.createDataFrame([(v, "a" if v > 0 else "b") for v in values], "x double, g string")
    for method in ("exact", "binned"):
        got = charts.density(df, ["x"], points=100, by=["g"], cut=4.0, method=method).collect()
        for g in "ab":
            curve = sorted((r["x"], r["density"]) for r in got if r["g"] == g)
            x, y = np.array(curve).T
            assert abs(np.trapezoid(y, x) - 1) < 0.01
    with pytest.raises(ValueError):
        charts.density(df, ["x"], method="other")


def test_box_and_comparison(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6, 7, 8, 100]], "x double")
    box = charts.box_stats(df, ["x"])
    got = box.first()
    assert (got["whisker_low"], got["whisker_high"], got["n_fliers"]) == (1.0, 8.0, 1)
    after = charts.box_stats(df.where("x < 50"), ["x"])
    change = charts.compare_boxes(box, after).first()
    assert change["rows_removed"] == 1 and change["fliers_change"] == -1


def test_violin_has_quartiles_and_density(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(9)] + [("b", 1.0)], "g string, x double")
    got = charts.violin(df, ["x"], ["g"], points=10).collect()
    assert {r["g"] for r in got} == {"a", "b"}
    assert [(r["point"], r["density"], r["median"]) for r in got if r["g"] == "b"] == [(None, None, 1.0)]  # no curve
    assert len(got) == 11 and {r["median"] for r in got if r["g"] == "a"} == {4.0}


def test_correlation_is_pairwise_complete_and_symmetric(spark):
    data = [(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.0, 0.0), (4.0, 8.5, 5.0), (None, 1.0, 2.0)]
    df = spark.createDataFrame(data, "a double, b double, c double")
    matrix = {(r["a"], r["b"]): r["r"] for r in relate.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert matrix[("a", "b")] == matrix[("b", "a")] and matrix[("a", "a")] == 1.0
    expected = np.corrcoef([2.0, 3.0, 4.0], [1.0, 0.0, 5.0])[0, 1]
    assert abs(matrix[("a", "c")] - expected) < 1e-12
    assert all(-1 <= r <= 1 for r in matrix.values())


def test_score_correlations_are_sorted_by_strength(spark):
    df = spark.createDataFrame([(float(i), -float(i), float(i % 2)) for i in range(10)], "s double, a double, b double")
    got = relate.score_correlations(df, ["s", "a", "b"], "s").collect()
    assert [r["feature"] for r in got] == ["a", "b"] and got[0]["sign"] == "negative"


def test_crosstab_lists_absent_pairs(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1), (None, 2)], "g string, v int")
    got = {(r["g"], r["v"]): (r["n"], r["pct"]) for r in relate.crosstab(df, "g", "v").collect()}
    assert got[("b", 2)] == (0, 0.0)
    assert abs(got[("a", 1)][1] - 200 / 3) < 1e-9


def test_scaled_group_means(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 2.0)], "g string, v double")
    got = {r["g"]: r["scaled"] for r in relate.scaled_group_means(df, ["v"], "g").collect()}
    assert got["a"] == 0.0 and abs(got["b"] - 1) < 1e-8 and abs(got["c"] - 0.5) < 1e-8
