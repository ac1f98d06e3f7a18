import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.operators import attribution, evaluate, models, prepare, stages, tuning
from sparktab.operators.attribution import LinearModel
from sparktab.session import fresh_path
from sparktab.sources import artifacts, reports, tables

MODEL = LinearModel(
    features=("x", "y", "z"),
    classes=("low", "high"),
    weights=((1.0, -2.0, 0.5), (-1.0, 2.0, -0.5)),
    intercepts=(0.1, -0.1),
    means=(1.0, 1.0, 0.0),
)


@pytest.fixture(scope="module")
def points(spark):
    data = [(1, 1.0, 1.0, 0.0), (2, 3.0, 0.0, 4.0), (3, 0.0, 5.0, -1.0), (4, 2.0, 1.5, 0.0)]
    return spark.createDataFrame(data, "key bigint, x double, y double, z double")


def test_attributions_add_up_to_the_margin(points):
    long = attribution.attributions(points, MODEL, ["key"]).collect()
    for row in points.collect():
        for c, name in enumerate(MODEL.classes):
            x = (row["x"], row["y"], row["z"])
            margin = MODEL.intercepts[c] + sum(w * v for w, v in zip(MODEL.weights[c], x))
            total = MODEL.base(c) + sum(r["phi"] for r in long if r["key"] == row["key"] and r["class"] == name)
            assert math.isclose(total, margin, abs_tol=1e-12)


def test_score_record(points):
    got = {r["key"]: r["result"] for r in attribution.score(points, MODEL, ["key"], k=2).collect()}
    for r in got.values():
        assert math.isclose(sum(r["probabilities"].values()), 1.0)
        assert math.isclose(max(r["probabilities"].values()) * 100, r["confidence"])
    first = got[1]["top_factors"]  # all attributions are zero: by name, and zero is away
    assert [(t["feature"], t["direction"]) for t in first] == [("x", "away"), ("y", "away")]
    assert got[2]["prediction"] == "low"
    # x, y and z all contribute 2: the first two names win
    assert [t["feature"] for t in got[2]["top_factors"]] == ["x", "y"]
    assert {t["direction"] for t in got[2]["top_factors"]} == {"toward"}


def test_waterfall_folds_the_rest_and_ends_at_the_margin(points):
    scored = attribution.with_scores(points, MODEL)
    steps = attribution.waterfall(scored, MODEL, ["key"], shown=1).orderBy("key", "step").collect()
    third = [r for r in steps if r["key"] == 3]
    assert [r["feature"] for r in third] == ["y", "other"]
    margin = MODEL.intercepts[1] + (-1.0 * 0 + 2.0 * 5 + 0.5)
    assert math.isclose(third[-1]["running"], margin)


def test_importance_is_the_mean_absolute_attribution(points):
    few = {(r["class"], r["feature"]): r["importance"] for r in attribution.importance(points, MODEL).collect()}
    long = attribution.attributions(points, MODEL, ["key"])
    mean = long.groupBy("class", "feature").agg(F.avg(F.abs("phi")).alias("importance"))
    many = {(r["class"], r["feature"]): r["importance"] for r in mean.collect()}
    assert few.keys() == many.keys() and all(math.isclose(few[k], many[k]) for k in few)
    assert few[("low", "y")] == 2.0 * (0 + 1 + 4 + 0.5) / 4


def test_report_with_a_class_never_predicted(spark):
    pairs = [("a", "a"), ("a", "a"), ("b", "a"), ("c", "c"), ("a", "c")]
    df = spark.createDataFrame(pairs, "label string, prediction string")
    matrix = evaluate.confusion(df, evaluate.classes_of(df))
    assert matrix.count() == 9 and matrix.agg(F.sum("n")).first()[0] == 5
    report = {r["class"]: r for r in evaluate.class_report(matrix).collect()}
    assert report["b"]["precision"] == 0.0 and report["b"]["f1"] == 0.0 and report["b"]["support"] == 1
    assert report["accuracy"]["f1"] == 0.6
    assert math.isclose(report["macro avg"]["recall"], (2 / 3 + 0 + 1) / 3)
    assert math.isclose(report["weighted avg"]["recall"], 0.6)


def test_ranking_and_gain(spark):
    before = spark.createDataFrame([("m", 0.5), ("n", 0.7)], "model string, accuracy double")
    after = spark.createDataFrame([("m", 0.8), ("n", 0.8)], "model string, accuracy double")
    got = evaluate.before_after(before, after).collect()
    assert [r["model"] for r in got] == ["m", "n"]
    assert got[0]["best_before"] == 0.7 and math.isclose(got[0]["gain"], 0.3)
    assert evaluate.best_model(after).first()["model"] == "m"


def test_confidence_thresholds(spark):
    df = spark.createDataFrame([(1, "a", 70.0), (2, "a", 69.9), (3, "b", 90.0)], "key int, prediction string, confidence double")
    assert {r["key"]: r["borderline"] for r in evaluate.with_borderline(df).collect()} == {1: False, 2: True, 3: False}
    assert evaluate.confidence_summary(df).first()["share_high"] == 1 / 3


@pytest.fixture(scope="module")
def trained(spark, blobs):
    rows, classes = models.training_frame(blobs, ["key"], "class")
    fitted = models.train("logistic", rows, classes, ["x", "y"], params={"C": 100.0})
    return rows, classes, fitted


def test_logistic_separates_blobs_and_survives_saving(spark, blobs, trained):
    rows, classes, fitted = trained
    out = fitted.predict(rows)
    judged = models.with_label_name(out, classes)
    assert evaluate.accuracy(judged).first()["accuracy"] > 0.95
    loaded = artifacts.load_model(spark, artifacts.save_model(spark, fitted, fresh_path(spark, "model")))
    before = {r["key"]: (r["prediction"], r["confidence"]) for r in out.collect()}
    after = {r["key"]: (r["prediction"], r["confidence"]) for r in loaded.predict(blobs).collect()}
    assert before == after


def test_linear_form_of_a_trained_model_gives_its_probabilities(trained):
    rows, _, fitted = trained
    own = {r["key"]: r["probability"] for r in fitted.predict(rows).collect()}
    linear = {r["key"]: r["probability"] for r in attribution.with_scores(rows, fitted.linear()).collect()}
    for key, expected in own.items():
        np.testing.assert_allclose(linear[key], expected, atol=1e-9)
    weights = np.array(fitted.linear().weights)
    np.testing.assert_allclose(weights.sum(0), 0, atol=1e-6)


@pytest.mark.parametrize(
    "name,params",
    [
        ("kernel_svm", {"components": 30, "max_iter": 10}),
        ("boosted_leaf", {"rounds": 3, "max_depth": 3, "min_leaf": 3}),
        ("bayes", {}),
    ],
)
def test_other_models_beat_the_majority(trained, name, params):
    rows, classes, _ = trained
    fitted = models.train(name, rows, classes, ["x", "y"], ["kind"], params)
    out = fitted.predict(rows)
    assert evaluate.accuracy(models.with_label_name(out, classes)).first()["accuracy"] > 0.8
    sums = out.select(F.aggregate("probability", F.lit(0.0), lambda a, p: a + p).alias("s")).collect()
    assert all(math.isclose(r["s"], 1.0) for r in sums)


def test_fourier_features_approximate_the_kernel(spark):
    from pyspark.ml.linalg import Vectors

    data = [(Vectors.dense([0.0, 0.0]),), (Vectors.dense([1.0, 0.5]),)]
    df = spark.createDataFrame(data, ["features"])
    stage = stages.FourierFeatures(width=2, components=400, gamma=0.5)
    a, b = (np.array(r["projected"].toArray()) for r in stage.transform(df).collect())
    assert abs(a @ b - math.exp(-0.5 * 1.25)) < 0.12


def test_search_tables(spark, trained):
    rows, classes, _ = trained
    folded = prepare.stratified_folds(rows, ["key"], "label", 2)
    grid = tuning.grid_of({"max_depth": [1, 4]})
    found = tuning.search("tree", grid, folded, classes, ["x", "y"], folds=2)
    table = found.table(spark).orderBy("candidate").collect()
    assert len(table) == 2 and sum(r["is_best"] for r in table) == 1
    assert [tuple(r) for r in found.best_params(spark).collect()] == [("tree", "max_depth", "4")]


def test_sampled_candidates_differ_and_repeat():
    options = {"a": range(10), "b": range(10)}
    one, two = tuning.sample_of(options, 20, seed=3), tuning.sample_of(options, 20, seed=3)
    assert one == two and len({tuple(c.items()) for c in one}) == 20
    assert len(tuning.sample_of({"a": [1, 2]}, 50)) == 2


def test_sources(spark, gaps):
    with pytest.raises(ValueError):
        tables.rename_all(gaps, ["a", "b"])
    with pytest.raises(ValueError):
        tables.rename_some(gaps, {"absent": "x"})
    assert tables.rename_some(gaps, {"x": "y"}).columns == ["key", "y", "same", "c"]
    assert tables.without_nan(gaps).where("x IS NULL").count() == 2
    made = tables.from_records(spark, [{"b": 1, "a": 2}], "a int, b int", ["b", "a"])
    assert made.columns == ["b", "a"] and tuple(made.first()) == (1, 2)


def test_delimited_header_is_checked(spark, gaps):
    path = fresh_path(spark, "csv")
    gaps.select("key", "c").write.option("header", True).csv(path)
    assert tables.read_delimited(spark, path, "key bigint, c string").count() == 5
    with pytest.raises(Exception):
        tables.read_delimited(spark, path, "c string, key bigint").collect()


def test_report_store(spark, gaps):
    store = reports.ReportStore(spark, fresh_path(spark, "reports"))
    saved = [store.save("a", "one", gaps), store.save("a", "two", gaps.limit(2)), store.save("a", "one", gaps)]
    assert [tuple(r) for r in store.manifest(saved).collect()] == [("a", 2, 7)]
    assert store.manifest([]).count() == 0


def test_every_registered_model_is_compared():
    from sparktab.plans import catalogue, training

    parts = {"train_many": training.MANY, "train_many_boosted": training.MANY_BOOSTED, "train_many_by_gradient": training.MANY_BY_GRADIENT}
    assert {m for of in parts.values() for m in of} == set(models.BUILDERS) | {"neighbours"}
    for name, of in parts.items():
        assert all(f"'{m}'" in catalogue.ORACLES[name] for m in of)


def test_searches_share_their_passes(spark, trained):
    """Ensembles, machines and networks cross-validated together, as they are alone."""
    rows, classes, _ = trained
    folded = prepare.stratified_folds(rows, ["key"], "label", 3)
    wanted = {
        "boosted_level": [{"rounds": 2, "max_depth": 2}, {"rounds": 3, "max_depth": 3, "subsample": 0.8}],
        "boosted_symmetric": [{"rounds": 2, "rate": 0.3}],
        "kernel_svm": [{"C": 1.0, "kernel": "linear"}, {"C": 10.0, "gamma": "scale", "components": 30}],
        "perceptron": [{"hidden": (8,), "solver": "lbfgs", "max_iter": 20}],
    }
    found = tuning.searched_together(wanted, folded, classes, ["x", "y"], ["kind"], folds=3)
    for name, cs in wanted.items():
        result = found[name]
        assert result.candidates == cs and len(result.means) == len(cs) and all(0.6 < m <= 1 for m in result.means), name
        alone = tuning.search(name, cs[:1], folded, classes, ["x", "y"], ["kind"], folds=3)
        assert math.isclose(alone.means[0], result.means[0]) and math.isclose(alone.deviations[0], result.deviations[0])
        judged = evaluate.accuracy(models.with_label_name(result.model.predict(rows), classes)).first()
        assert judged["accuracy"] > 0.85
        loaded = artifacts.load_model(spark, artifacts.save_model(spark, result.model, fresh_path(spark, "model")))
        assert sorted(loaded.predict(rows).select("key", "confidence").collect()) == sorted(result.model.predict(rows).select("key", "confidence").collect())


def test_neighbours_are_judged_in_one_pass(spark, trained):
    """Fold by fold, with the other folds as the rows that vote."""
    from sparktab.operators.neighbours import predict_nearest

    rows, classes, _ = trained
    folded = prepare.stratified_folds(rows, ["key"], "label", 4).persist()
    found = tuning.train_many({"neighbours": {"k": 3}}, folded, classes, ["x", "y"], folds=4)["neighbours"]
    ready = found.model.features(folded).select("key", "_x", "label", "fold").persist()
    rates = []
    for f in range(4):
        asked = ready.where(F.col("fold") == f)
        said = predict_nearest(ready.where(F.col("fold") != f), asked, "key", "_x", "label", 3).join(asked, "key")
        rates.append(said.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0])
    assert math.isclose(found.means[0], np.mean(rates)) and math.isclose(found.deviations[0], np.std(rates))
    out = found.model.predict(rows)
    assert out.count() == rows.count() and out.where("confidence > 60 AND prediction IS NOT NULL").count() > 50


@pytest.mark.parametrize("n,k", [(400, 5), (3, 5)])
def test_neighbours_by_planes(spark, n, k):
    """Most true neighbours are found, distances are exact, every row has k, a hot bucket is cut."""
    from sparktab.operators import neighbours

    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(size=(n, 6)) + 4 * rng.integers(0, 3, size=(n, 1)), np.ones((n // 2, 6))])
    df = spark.createDataFrame([(i, p.tolist(), i % 3) for i, p in enumerate(points)], "key long, x array<double>, label int")
    train, test = df.where("key % 4 > 0"), df.where("key % 4 = 0")
    exact = {(r["asked"], r["neighbour"]): r["distance2"] for r in neighbours.nearest(train, test, "key", "x", "label", k).collect()}
    rows = neighbours.nearest_by_planes(train, test, "key", "x", "label", k, neighbours.fit_planes(train, "x", rows_per_bucket=16), block=32).collect()
    for r in rows:
        d = ((points[r["asked"]] - points[r["neighbour"]]) ** 2).sum()
        assert math.isclose(d, r["distance2"], abs_tol=1e-12)
    want = min(k, train.count())
    counts = {}
    for r in rows:
        counts[r["asked"]] = counts.get(r["asked"], 0) + 1
    assert set(counts.values()) == {want} and len(counts) == test.count()
    assert sum((r["asked"], r["neighbour"]) in exact for r in rows) >= 0.9 * len(exact)


def test_folded_rows_lie_as_the_cached_ones(spark, tmp_path):
    """Numbering the folds shuffles; passes then run over as few partitions as the rows need."""
    from sparktab.plans import training

    rows = spark.range(900).selectExpr("id AS doc_id", "'en' AS lang", "concat(repeat('a b. ', cast(id % 7 + 1 AS int)), id) AS text")
    rows.withColumn("n_chars", F.length("text").cast("bigint")).write.parquet(str(tmp_path / "documents.parquet"))
    rows.selectExpr("doc_id", "cast(doc_id % 3 = 0 AS int) AS quality").write.parquet(str(tmp_path / "labels.parquet"))
    spark.conf.set("spark.sql.shuffle.partitions", 37)
    seen, plain = [], models.ROWS_PER_PARTITION
    models.ROWS_PER_PARTITION = 300

    def run(folded, classes, test):
        keys = [[r["doc_id"] for r in p] for p in folded.select("doc_id").rdd.glom().collect()]
        seen.append(keys)
        return folded.groupBy("fold").count()

    try:
        counts = [r["count"] for r in training._searched(spark, str(tmp_path), run).collect()]
    finally:
        models.ROWS_PER_PARTITION = plain
        spark.conf.set("spark.sql.shuffle.partitions", 2)
    assert len(seen[0]) == 3 and all(k == sorted(k) for k in seen[0]) and sum(map(len, seen[0])) == 630
    assert len(counts) == 5 and max(counts) - min(counts) <= 2


def test_forest_rows_are_dealt_by_their_trees(spark, trained, monkeypatch):
    """As many tasks as rows times trees are worth, all rows kept, no more tasks than the bound."""
    rows, classes, _ = trained
    n = rows.count()
    assert models.for_trees("forest", rows, n) is rows and models.for_trees("tree", rows, 10**9) is rows
    monkeypatch.setattr(models, "FOREST_PAIRS", n * 10)
    single = rows.coalesce(1)
    for trees, parts in ((30, 3), (1000, models.FOREST_TASKS)):
        dealt = models.for_trees("forest", single, n, {"trees": trees})
        assert dealt.rdd.getNumPartitions() == parts and sorted(dealt.collect()) == sorted(rows.collect())
    assert all(b(models.Shape(n, 2, 2), {})[0].getCacheNodeIds() for b in (models.BUILDERS["forest"], models.BUILDERS["tree"]))
    fitted = models.train("forest", single, classes, ["x", "y"], params={"trees": 30})
    assert evaluate.accuracy(models.with_label_name(fitted.predict(rows), classes)).first()["accuracy"] > 0.85
