import math

import pytest
from pyspark.sql import functions as F

from sparktab import infer_spec
from sparktab.operators import clean, profile, validate
from sparktab.spec import present


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_roles_come_from_the_schema(gaps):
    spec = infer_spec(gaps, keys=["key"], score="same", exclude=["x"])
    assert spec.numeric == ("x", "same") and spec.target == "c"
    assert spec.outlier_columns == ["x"]
    assert spec.feature_columns == []
    assert present(gaps, ["x", "absent"]) == ["x"]


def test_null_counts_and_info(gaps):
    got = {r["column"]: r["n_null"] for r in profile.null_counts(gaps).collect()}
    assert got == {"key": 0, "x": 1, "same": 0, "c": 1}
    info = {r["column"]: (r["position"], r["type"], r["n_present"]) for r in profile.table_info(gaps).collect()}
    assert info["c"] == (3, "string", 4)


def test_summary_ignores_nan(gaps):
    got = {r["column"]: r for r in profile.summary(gaps, ["x", "same"]).collect()}
    assert got["x"]["n"] == 3 and got["x"]["mean"] == 4.0
    assert (got["x"]["q25"], got["x"]["q50"], got["x"]["q75"]) == (2.0, 3.0, 5.5)
    assert got["same"]["std"] == 0.0


def test_summary_of_an_empty_table(gaps):
    got = profile.summary(gaps.where("key > 99"), ["x"]).collect()
    assert got[0]["n"] == 0 and got[0]["mean"] is None and got[0]["q50"] is None


def test_summary_is_the_same_by_selection(gaps):
    small = profile.summary(gaps, ["x", "same"], small_bytes=1 << 62).collect()
    large = profile.summary(gaps, ["x", "same"], small_bytes=0).collect()
    assert sorted(small) == sorted(large)


def test_frequencies_skip_nulls_and_break_ties_by_value(gaps):
    got = [tuple(r) for r in profile.by_frequency(profile.category_counts(gaps)).collect()]
    assert got == [("c", "a", 2), ("c", "b", 2)]
    assert {r["pct"] for r in profile.category_shares(gaps).collect()} == {50.0}


def test_duplicates(spark):
    data = [(1, "a", None), (2, "a", None), (3, "b", 1.0), (4, None, 1.0), (5, "a", None)]
    df = spark.createDataFrame(data, "key bigint, t string, v double")
    assert clean.duplicate_count(df, ["key"]).first().asDict() == {"n_rows": 5, "n_distinct": 3, "n_duplicates": 2}
    assert clean.distinct_rows(df, ["key"]).count() == 3
    assert clean.distinct_rows(df, ["key"], keep=["t"]).count() == 3
    assert rows(clean.keep_first(df, ["key"]), "key") == [(1,), (3,), (4,)]
    again = clean.distinct_rows(clean.distinct_rows(df, ["key"]))
    assert again.count() == 3


def test_digest_tells_neighbouring_values_apart(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, "abc"), ("abc", None)], "a string, b string")
    assert clean.duplicate_count(df).first()["n_duplicates"] == 0
    zero = spark.createDataFrame([(0.0,), (-0.0,)], "x double")
    assert clean.duplicate_count(zero).first()["n_duplicates"] == 1


def test_zscore_limit_is_strict(spark):
    # ten zeros' worth of spread: mean 0, population deviation 1, one value at exactly 3
    data = [(3.0,), (-3.0,)] + [(0.0,)] * 16
    df = spark.createDataFrame(data, "x double")
    fitted = clean.fit_moments(df, ["x"])
    assert fitted["x"].deviation == 1.0
    assert df.where(clean.within_deviations(fitted)).count() == 16
    assert df.where(clean.within_deviations(fitted, limit=3.0001)).count() == 18


def test_undefined_zscores(gaps):
    assert clean.zscore_filter(gaps, ["x", "same"]).count() == 5
    assert clean.zscore_filter(gaps, ["x"], on_undefined="strict").count() == 0
    assert clean.zscore_filter(gaps, ["same"], on_undefined="strict").count() == 0
    with pytest.raises(ValueError):
        clean.zscore_filter(gaps, ["x"], on_undefined="other")


def test_zscores_fitted_on_other_rows(spark):
    train = spark.createDataFrame([(0.0,), (2.0,)], "x double")
    df = spark.createDataFrame([(1.0,), (50.0,)], "x double")
    assert rows(clean.zscore_filter(df, ["x"], fit_on=train), "x") == [(1.0,)]


def test_values_on_a_fence_are_inside(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 9.0]  # quartiles 3 and 7, fences -3 and 13
    df = spark.createDataFrame([(v,) for v in values] , "x double")
    assert clean.fit_fences(df, ["x"]) == {"x": (-3.0, 13.0)}
    probe = spark.createDataFrame([(-3.0,), (13.0,), (13.1,), (-3.1,), (None,), (float("nan"),)], "x double")
    flag = clean.beyond_fences({"x": (-3.0, 13.0)})["x"]
    assert rows(probe.where(flag), "x") == [(-3.1,), (13.1,)]
    report = clean.fence_report(df, ["x"]).first()
    assert (report["q1"], report["q3"], report["n_outside"]) == (3.0, 7.0, 0)


def test_step_audit(spark):
    df = spark.range(10)
    got = clean.step_audit(df, F.col("id") < 7, "cut").first()
    assert (got["rows_before"], got["rows_after"], got["rows_removed"], got["pct_removed"]) == (10, 7, 3, 30.0)
    empty = clean.step_audit(df.where("id > 99"), F.lit(True), "cut").first()
    assert empty["rows_before"] == 0 and empty["pct_removed"] is None


def test_validation(gaps):
    rules = [validate.InRange("x", 1, 3), validate.OneOf("c", ("a",)), validate.InRange("absent", 0, 1)]
    checked = validate.with_violations(gaps, rules)
    got = {r["key"]: r["violations"] for r in checked.collect()}
    assert got[1] == [] and got[4] == []
    assert got[2] == ["x:range", "c:allowed"] and got[3] == ["x:range", "c:allowed"]
    assert validate.accepted(checked).count() + validate.rejected(checked).count() == 5
    counts = {r["rule"]: r["n_violations"] for r in validate.rule_counts(gaps, rules).collect()}
    assert counts == {"x:range": 3, "c:allowed": 3}


def test_one_row(spark):
    df = spark.createDataFrame([(1.0,)], "x double")
    got = profile.summary(df, ["x"]).first()
    assert got["std"] is None and got["q25"] == got["max"] == 1.0
    assert clean.zscore_filter(df, ["x"]).count() == 1
    assert math.isclose(clean.fit_moments(df, ["x"])["x"].mean, 1.0)
