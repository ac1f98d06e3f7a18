import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.operators import calibrate, gram, models, prepare
from sparktab.session import fresh_path
from sparktab.streaming import history


def plain_isotonic(scores, hits):
    """The closest rising values, by max over starts of min over ends of the means."""
    order = np.argsort(scores, kind="stable")
    s, h = np.array(scores)[order], np.array(hits, dtype=float)[order]
    levels = np.unique(s)
    n, y = np.array([(s == v).sum() for v in levels]), np.array([h[s == v].sum() for v in levels])
    mean = lambda a, b: y[a : b + 1].sum() / n[a : b + 1].sum()
    return dict(zip(levels.tolist(), [max(min(mean(a, b) for b in range(i, len(levels))) for a in range(i + 1)) for i in range(len(levels))]))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_isotonic_fit(spark, seed):
    rng = np.random.default_rng(seed)
    scores = rng.integers(0, 41, 300) / 40
    hits = rng.random(300) < (scores**2 if seed < 3 else 0.5)
    df = spark.createDataFrame([(float(s), bool(h)) for s, h in zip(scores, hits)] + [(None, True), (0.5, None)], "s double, h boolean")
    fitted = calibrate.fit_isotonic(df, F.col("s"), F.col("h"), 40)
    want = plain_isotonic(scores, hits)
    for r in df.where("s IS NOT NULL AND h IS NOT NULL").withColumn("p", fitted.apply(F.col("s"))).collect():
        assert math.isclose(r["p"], want[r["s"]], abs_tol=1e-12)
    assert df.where("s IS NULL").select(fitted.apply(F.col("s"))).first()[0] is None


def test_pools_add_up_in_any_cut():
    rng = np.random.default_rng(4)
    levels = [(i, float(rng.integers(1, 9)), 0.0) for i in range(60)]
    levels = [(i, n, float(rng.integers(0, int(n) + 1))) for i, n, _ in levels]
    pool = lambda part: calibrate.Pool() + calibrate.Pool(tuple(part))
    whole = pool(levels)
    means = [h / n for _, n, h in whole.blocks]
    assert means == sorted(means) and len(set(means)) == len(means)
    for a, b in ((1, 2), (10, 40), (30, 31)):
        parts = [pool(levels[:a]), pool(levels[a:b]), pool(levels[b:])]
        assert (parts[0] + parts[1]) + parts[2] == whole == parts[0] + (parts[1] + parts[2])


def test_no_rows_to_calibrate(spark):
    df = spark.createDataFrame([], "s double, h boolean")
    assert calibrate.fit_isotonic(df, F.col("s"), F.col("h")).values == (0.5,)
    assert calibrate.reliability(df, F.col("s"), F.col("h")).count() == 0


def test_calibrated_model(spark):
    """Rows say less than a deep ensemble claims; calibrated, claims and shares meet."""
    rng = np.random.default_rng(5)
    rows = [(i, float(rng.normal()), float(rng.normal())) for i in range(600)]
    df = spark.createDataFrame([(i, x, y, "b" if rng.random() < 1 / (1 + math.exp(-2 * x)) else "a") for i, x, y in rows], "key long, x double, y double, class string")
    framed, classes = models.training_frame(df, ["key"], "class")
    folded = prepare.stratified_folds(framed, ["key"], "label", 3).persist()
    params = {"rounds": 8, "max_depth": 5, "rate": 0.5, "l2": 0.1, "min_hessian": 0.0}
    judged = calibrate.out_of_fold("boosted_level", params, folded, classes, ["x", "y"], folds=3)
    assert judged.count() == 600
    made = calibrate.calibrated("boosted_level", params, folded, classes, ["x", "y"], folds=3)
    fresh = spark.createDataFrame([(i, float(rng.normal()), float(rng.normal())) for i in range(600)], "key long, x double, y double")
    truth = 1 / (1 + F.exp(-2 * F.col("x")))
    miss = lambda m: m.predict(fresh).agg(F.avg((F.get("probability", F.lit(1)) - truth) ** 2)).first()[0]
    assert miss(made) < miss(made.model)
    for r in made.predict(fresh).collect():
        assert math.isclose(sum(r["probability"]), 1.0) and r["confidence"] == max(r["probability"]) * 100


@pytest.mark.parametrize("width", [1, 2, 7, 200, 300])
def test_wide_correlations(spark, width):
    """Tiles, pairwise gaps, large means, constant columns."""
    rng = np.random.default_rng(width)
    x = rng.normal(size=(60, width)) + 1e4 * rng.integers(0, 3, size=width)
    x[rng.random(size=x.shape) < 0.1] = np.nan
    if width > 5:
        x[:, 3], x[:, 4] = 7.25, np.nan
    df = spark.createDataFrame([[None if math.isnan(v) and i % 2 else float(v) for i, v in enumerate(r)] for r in x], ", ".join(f"c{i} double" for i in range(width))).repartition(3)
    got = {(r["position_a"], r["position_b"]): r for r in gram.wide_correlations(df, df.columns).collect()}
    assert got.keys() == {(a, b) for a in range(width) for b in range(a + 1, width)}
    for (a, b), r in got.items():
        both = ~np.isnan(x[:, a]) & ~np.isnan(x[:, b])
        assert r["n"] == both.sum() and (r["a"], r["b"]) == (f"c{a}", f"c{b}")
        if width > 5 and {a, b} & {3, 4}:
            assert r["r"] is None
        else:
            assert math.isclose(r["r"], np.corrcoef(x[both, a], x[both, b])[0, 1], abs_tol=1e-7)


def test_one_scan_for_all_pairs(spark):
    df = spark.range(50).select(*[(F.col("id") * i % 7).cast("double").alias(f"c{i}") for i in range(40)])
    path = fresh_path(spark, "wide")
    df.write.parquet(path)
    plan = gram.wide_correlations(spark.read.parquet(path), df.columns)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_history_of_a_stream(spark):
    """Late repeats are found; a batch that runs again changes nothing; snapshots replace batches."""
    rows = [(i, i % 37 if i % 5 else None, "x" * (i % 3)) for i in range(400)]
    source, out, state = (fresh_path(spark, k) for k in ("source", "first", "seen"))
    df = spark.createDataFrame(rows, "id long, a long, b string")
    for k in range(7):
        df.where(F.col("id") % 7 == k).coalesce(1).write.mode("append").parquet(source)
    stream = lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(source)
    run = lambda: history.first_seen(stream(), ["a", "b"], out, state, fresh_path(spark, "progress"), 8, 2).awaitTermination()
    run()
    once = sorted(map(tuple, spark.read.parquet(out).collect()), key=str)
    assert len(once) == len({r[1:] for r in rows}) == len({r[1:3] for r in once})
    past = history.History(spark, state, 8, 2)
    assert past.before(7).count() == len(once) and past.before(0).count() == 0
    assert past.before(7, [3]).where("prefix <> 3").count() == 0
    assert not history._exists(spark, past._folder("new", 0)) and history._exists(spark, past._folder("all", 5))
    last = spark.read.parquet(f"{out}/batch=6")
    again = last.select("digest", "prefix").join(past.before(6), ["prefix", "digest"], "left_semi")
    assert again.count() == 0  # what batch 6 finds when it runs again is what it found
    past.keep(last, 6)
    assert past.before(7).count() == len(once)
    df.limit(50).coalesce(1).write.mode("append").parquet(source)


def test_landmarks(spark):
    """Products of the features are the kernel, better with more landmarks, exact with all rows."""
    from sparktab.operators import gradient, landmarks

    rng = np.random.default_rng(6)
    x = rng.normal(size=(120, 3))
    exact = landmarks.gaussian(x, x, 0.4)
    assert math.isclose(exact[2, 5], math.exp(-0.4 * ((x[2] - x[5]) ** 2).sum()))
    errors = []
    for count in (10, 40, 120):
        z = landmarks.chosen(x, count, 0.4).features(x)
        errors.append(np.abs(z @ z.T - exact).max())
    assert errors[0] > errors[1] > errors[2] and errors[2] < 1e-4
    df = spark.createDataFrame([(i, r.tolist(), int((r**2).sum() > 2.4)) for i, r in enumerate(x)], "key long, x array<double>, y int")
    found = landmarks.fit_landmarks(df, F.col("x"), ["key"], 40, 0.4)
    told = landmarks.kernel_errors(df.coalesce(1), F.col("x"), found.features, 0.4).collect()
    assert sum(r["pairs"] for r in told) == 120**2 and max(r["mean_error"] for r in told) < 0.02
    from sparktab.operators.blocks import blocks_of

    machine = gradient.LandmarkMachine(3, 2, 10.0, components=40).with_landmarks(found)
    one = gradient.fit(blocks_of(df, F.col("x"), F.col("y"), ["key"]), [gradient.Model(machine)])[0][0]
    assert (one.probabilities(x).argmax(axis=1) == [int((r**2).sum() > 2.4) for r in x]).mean() > 0.95
    again = gradient.Fitted.from_json(one.to_json())
    np.testing.assert_allclose(again.probabilities(x), one.probabilities(x))
    with pytest.raises(ValueError):
        landmarks.fit_landmarks(df.limit(0), F.col("x"), ["key"])
