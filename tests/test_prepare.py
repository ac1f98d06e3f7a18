import math
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparktab.functions.hashing import key_digest
from sparktab.operators import neighbours, prepare


@settings(deadline=None)
@given(st.dictionaries(st.text("abc", min_size=1), st.integers(1, 500), min_size=1, max_size=6), st.floats(0.01, 0.99))
def test_quotas_add_up_and_are_proportional(counts, share):
    got = prepare.quotas(counts, share)
    total = sum(counts.values())
    assert sum(got.values()) == math.ceil(share * total)
    for c, n in counts.items():
        exact = n * math.ceil(share * total) / total
        assert math.floor(exact) <= got[c] <= min(n, math.floor(exact) + 1)


def _labelled(spark, n=600):
    rare = F.when(F.col("id") % 50 == 0, "rare").when(F.col("id") % 3 == 0, "some").otherwise("most")
    return spark.range(n).select(F.col("id").alias("key"), rare.alias("label"))


def _ranked(df):
    w = Window.partitionBy("label").orderBy(key_digest(["key"], 54))
    return df.withColumn("rank", F.row_number().over(w))


def test_split_takes_each_quota_in_digest_order(spark, monkeypatch):
    df = _labelled(spark)
    counts = prepare.class_counts(df, "label")
    quota = prepare.quotas(counts, 0.3)
    expected = {r["key"] for r in _ranked(df).collect() if r["rank"] <= quota[r["label"]]}
    marked = prepare.fit_split(df, ["key"], "label").mark(df)
    assert {r["key"] for r in marked.where("is_test").collect()} == expected
    assert marked.count() == 600
    # the same through digest prefixes, as for classes too large to order
    monkeypatch.setattr(prepare, "ROWS_PER_BUCKET", 1)
    split = prepare.fit_split(df, ["key"], "label")
    assert {r["key"] for r in split.mark(df).where("is_test").collect()} == expected


def test_split_of_everything_or_of_a_tiny_class(spark):
    df = _labelled(spark, 60)
    assert prepare.fit_split(df, ["key"], "label", 1.0).mark(df).where("NOT is_test").count() == 0
    one = prepare.fit_split(df, ["key"], "label", 0.01).mark(df)
    assert one.where("is_test").count() == 1


def test_folds_are_even_within_classes(spark):
    df = _labelled(spark)
    expected = {r["key"]: (r["rank"] - 1) % 5 for r in _ranked(df).collect()}
    folds = prepare.stratified_folds(df, ["key"], "label", 5, rows_per_bucket=3)
    assert {r["key"]: r["fold"] for r in folds.collect()} == expected


def test_codes_and_indicators(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c")], "key bigint, c string")
    levels = prepare.fit_levels(df.where("key < 4"), "c")
    coded = df.select("key", levels.encode().alias("code"), levels.decode(levels.encode()).alias("back"))
    assert {r["key"]: (r["code"], r["back"]) for r in coded.collect()} == {
        1: (1, "b"), 2: (0, "a"), 3: (None, None), 4: (None, None)
    }
    hot = prepare.one_hot(df, "c", levels)
    assert hot.columns == ["key", "c_a", "c_b"]
    assert {r["key"]: r["c_a"] + r["c_b"] for r in hot.collect()} == {1: 1, 2: 1, 3: 0, 4: 0}


def test_codes_by_join_equal_codes_by_expression(spark):
    df = spark.range(500).select("id", F.concat(F.lit("v"), F.col("id") % 90).alias("c"))
    joined = {r["id"]: r["code"] for r in prepare.ordinal(df, "c", "code").collect()}
    names = sorted({f"v{i % 90}" for i in range(500)})
    assert joined == {i: names.index(f"v{i % 90}") for i in range(500)}


def test_standardiser_uses_train_rows_and_population_deviation(spark):
    train = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, same double")
    scaler = prepare.fit_standardiser(train, ["x", "same"])
    got = scaler.apply(train).collect()
    assert sorted(r["x"] for r in got) == [-1.0, 1.0]
    assert {r["same"] for r in got} == {0.0}


def _brute(train, test, k):
    out = {}
    for key, x, _ in test:
        d = sorted((sum((a - b) ** 2 for a, b in zip(x, y)), other, vote) for other, y, vote in train)[:k]
        votes = {}
        for _, _, vote in d:
            votes[vote] = votes.get(vote, 0) + 1
        out[key] = ([o for _, o, _ in d], min(votes, key=lambda v: (-votes[v], v)))
    return out


def test_neighbours_equal_brute_force(spark):
    rng = random.Random(1)
    points = []
    for i in range(400):
        centre = 0.0 if i % 3 else 8.0
        x = [round(rng.gauss(centre, 1) * 4) / 4 for _ in range(3)]  # sums of squares are exact
        points.append((i, [1.0, 1.0, 1.0] if i % 4 == 0 else x, i % 5))  # a quarter shares one point
    train, test = points[:320], points[320:]
    schema = "key bigint, v array<double>, label int"
    a, b = spark.createDataFrame(train, schema), spark.createDataFrame(test, schema)
    expected = _brute(train, test, 5)
    found = neighbours.nearest(a, b, "key", "v", "label", k=5, block=16).collect()
    for key, (others, _) in expected.items():
        assert [r["neighbour"] for r in sorted((r for r in found if r["asked"] == key), key=lambda r: r["place"])] == others
    votes = neighbours.predict_nearest(a, b, "key", "v", "label", k=5, block=1 << 20).collect()
    assert {r["key"]: r["prediction"] for r in votes} == {k: v for k, (_, v) in expected.items()}


def test_far_cells_are_not_visited(spark):
    rng = np.random.default_rng(2)
    schema = "key bigint, v array<double>, label int"
    rows = [(i, (rng.normal(size=2) + (0 if i % 2 else 100)).tolist(), i % 2) for i in range(200)]
    train = spark.createDataFrame(rows, schema)
    test = spark.createDataFrame([(1000, [0.0, 0.0], 1)], schema)
    pivots = neighbours._pivots(train, "key", "v", 200)
    table = neighbours._cell_table(neighbours._cells(train, "key", "v", "label", pivots), 5)
    visited = neighbours._visits(test, "key", "v", pivots, table, 5).count()
    assert 0 < visited < len(table)
