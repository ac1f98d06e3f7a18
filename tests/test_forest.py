import math

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
from pyspark.sql import functions as F

from sparktab.operators import forest as f
from sparktab.operators import learners, models, prepare, tuning
from sparktab.operators.blocks import blocks_of
from sparktab.operators.boosting import binned
from sparktab.session import fresh_path
from sparktab.sources import artifacts


def data(n=300, classes=3, seed=4):
    rng = np.random.default_rng(seed)
    y = np.arange(n) % classes
    x = rng.normal(size=(n, 3)) + 2.0 * np.stack([np.cos(y * 2.1), np.sin(y * 2.1), 0 * y], axis=1)
    cuts = [np.quantile(c, np.arange(1, 8) / 8) for c in x.T]
    return x, y, cuts


def plain(x, y, weight, rows, depth, least):
    """Class shares of each row by a tree that tries all columns, node by node."""
    counts = np.bincount(y[rows], weight[rows], 3)
    out = {int(r): counts / counts.sum() for r in rows}
    best, n = (1e-12, None), counts.sum()
    for j in range(len(x)):
        for b in range(7):
            low = rows[x[j, rows] <= b]
            below = np.bincount(y[low], weight[low], 3)
            above = counts - below
            if depth and min(below.sum(), above.sum()) >= least:
                gain = ((below**2).sum() / below.sum() + (above**2).sum() / above.sum() - (counts**2).sum() / n) / n
                best = max(best, (gain, (j, b)), key=lambda t: t[0])
    if best[1]:
        j, b = best[1]
        for part in (rows[x[j, rows] <= b], rows[x[j, rows] > b]):
            out.update(plain(x, y, weight, part, depth - 1, least))
    return out


@pytest.mark.parametrize("depth,least", [(30, 1), (3, 1), (30, 9)])
def test_a_tree_splits_as_a_plain_one(depth, least, monkeypatch):
    x, y, cuts = data()
    bins, weight = np.ascontiguousarray(binned(x, cuts).T), np.random.default_rng(1).integers(0, 3, 300)
    s = f.Settings(depth=depth, min_leaf=least, columns="all")
    tree = f.grown(bins, y, weight, 3, 8, s, 0)
    seen = np.flatnonzero(weight)
    want = plain(bins, y, weight.astype(float), seen, depth, least)
    np.testing.assert_allclose(tree.votes(bins)[seen], [want[int(r)] for r in seen], atol=1e-6)
    again = f.Tree.unpacked(3, *map(bytes, tree.packed()))
    assert (again.votes(bins) == tree.votes(bins)).all()
    some = f.grown(bins, y, weight, 3, 8, f.Settings(min_leaf=least), 7)
    monkeypatch.setattr(f, "JUDGED", 30)
    assert some.packed() == f.grown(bins, y, weight, 3, 8, f.Settings(min_leaf=least), 7).packed()
    assert len(f.grown(bins, y, 0 * weight, 3, 8, s, 0).feature) == 1
    assert [f.Settings(columns=c).tried(10) for c in ("sqrt", "all", "log2", "onethird", "3", "0.25", "auto")] == [4, 10, 4, 4, 3, 3, 4]


@pytest.fixture(scope="module")
def rows(spark):
    x, y, _ = data()
    listed = [(i, *r.tolist(), f"c{c}", float(c)) for i, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(listed * 2, "key long, a double, b double, c double, class string, label double").repartition(3, "key").persist()
    return df, ("c0", "c1", "c2")


def test_folds_and_forests_in_tasks(spark, rows):
    """Folds are judged by the trees that did not see them; the driver gets neither votes nor trees. Repeated rows are drawn apart."""
    df, _ = rows
    x, _, cuts = data()
    blocks = blocks_of(df, F.array("a", "b", "c"), F.col("label"), ["key"], (F.col("key") % 4).cast("int"))
    asked = [f.Model(f.Settings(trees=12, seed=s), fold) for s in (1, 2) for fold in (0, 3, -1)]
    made, hits = f.fit(blocks, asked, 3, cuts, 4)
    assert [m is not None for m in made] == [False, False, True] * 2
    held = blocks.collect()
    whole, y, fold = np.concatenate([b.x for b in held]), np.concatenate([b.y for b in held]), np.concatenate([b.fold for b in held])
    bins, places = np.ascontiguousarray(binned(whole, cuts).T), np.arange(600, dtype=np.uint64)
    for model, one, (n, good) in zip(asked, made, hits):
        votes, kept = 0.0, fold != model.left_out
        for t in range(12):
            weight = np.searchsorted(f.DRAWN, f.shares(places, model.settings.seed, t), side="right") * kept
            assert 0.8 < weight[kept].mean() < 1.2
            votes = votes + f.grown(bins, y, weight, 3, 8, model.settings, t).votes(bins).astype(float)
        if model.left_out >= 0:
            assert n == 150 and good == (votes[~kept].argmax(axis=1) == y[~kept]).sum() > 110
        else:
            assert spark.read.parquet(one.trees).count() == 12
            ready = df.select("key", F.array("a", "b", "c").alias("x"))
            got = learners.fitted_stage(one, "v").transform(ready.withColumn("v", learners.array_to_vector("x"))).collect()
            want = {tuple(r): v / v.sum() for r, v in zip(whole.tolist(), votes)}
            assert len(got) == 600 and all(np.allclose(r["probability"].toArray(), want[tuple(r["x"])], atol=1e-12) for r in got)


def test_forests_are_searched_without_a_cross_validator(spark, rows, monkeypatch):
    df, classes = rows
    folded = prepare.stratified_folds(df.dropDuplicates(["key"]), ["key"], "label", 3).persist()
    monkeypatch.setattr(tuning, "CrossValidator", None)
    monkeypatch.setattr(learners, "ASKED", 40)
    found = tuning.search("forest", [{"trees": 3, "max_depth": 1}, {"trees": 20}], folded, classes, ["a", "b", "c"], folds=3)
    assert len(found.means) == 2 and found.best == 1 and 0.75 < found.means[1] <= 1
    many = tuning.train_many({"forest": {"trees": 20}}, folded, classes, ["a", "b", "c"], folds=3)["forest"]
    assert math.isclose(many.means[0], found.means[1])
    trees = tuning.train_many({"forest": {"trees": 20}, "tree": {}}, folded, classes, ["a", "b", "c"], folds=3)
    assert math.isclose(trees["forest"].means[0], found.means[1]) and 0.6 < trees["tree"].means[0] < found.means[1] + 0.1
    own = trees["tree"].model.predict(folded).collect()  # every row once, all columns: distinct rows go to leaves of their own
    assert sum(r["prediction"] == f"c{r['key'] % 3}" for r in own) > 290
    path = artifacts.save_model(spark, many.model, fresh_path(spark, "model"))
    loaded = artifacts.load_model(spark, path)
    trees = loaded.pipeline.stages[-2].getOrDefault("trees")
    assert trees.startswith(path) and spark.read.parquet(trees).count() == 20
    one, two = (m.predict(folded).orderBy("key").select("key", "prediction", "probability").collect() for m in (many.model, loaded))
    assert one == two and sum(r["prediction"] == f"c{r['key'] % 3}" for r in one) > 270 and all(abs(sum(r["probability"]) - 1) < 1e-12 for r in one)


def test_more_rows_than_a_task_has_room_for(rows, monkeypatch):
    """Go to Spark's forest or tree, in searches too."""
    df, classes = rows
    monkeypatch.setattr(f, "TASK_BYTES", 600 * 115 - 1)
    fitted = models.train("forest", df, classes, ["a", "b", "c"], params={"trees": 3})
    assert isinstance(fitted.pipeline.stages[-2], RandomForestClassificationModel) and fitted.predict(df).count() == 600
    assert isinstance(models.train("tree", df, classes, ["a", "b", "c"]).pipeline.stages[-2], DecisionTreeClassificationModel)
    assert not tuning._shared("tree", models.Shape(600, 3, 3)) and not tuning._shared("forest", models.Shape(600, 3, 3)) and tuning._shared("forest", models.Shape(599, 3, 3))
