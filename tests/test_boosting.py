import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.operators import boosting as b
from sparktab.operators.blocks import blocks_of, shares


def data(n=160, classes=2, seed=1):
    rng = np.random.default_rng(seed)
    x = np.round(rng.normal(size=(n, 3)), 1)
    y = (np.digitize(x[:, 0] + 0.5 * x[:, 1] ** 2 + 0.2 * rng.normal(size=n), np.linspace(-1, 1.5, classes - 1)) if classes > 2 else (x[:, 0] * x[:, 1] > 0)).astype(int)
    x[rng.random(size=x.shape) < 0.05] = np.nan
    return x, y, np.arange(n) % 3


def frame(spark, x, y, fold, parts=3):
    rows = [(i, [None if math.isnan(v) else float(v) for v in r], int(c), int(f)) for i, (r, c, f) in enumerate(zip(x, y, fold))]
    return spark.createDataFrame(rows, "key long, x array<double>, y int, fold int").repartition(parts)


def blocks(spark, x, y, fold, parts=3):
    return blocks_of(frame(spark, x, y, fold, parts), F.col("x"), F.col("y"), ["key"], F.col("fold"))


def cuts_of(x, bins=16):
    return [np.unique(np.sort(c[~np.isnan(c)])[[max(0, math.ceil(i / bins * (~np.isnan(c)).sum()) - 1) for i in range(1, bins)]]) for c in x.T]


def plain_split(x, g, h, cuts, s):
    """The best cut of one leaf, by trying all."""
    best = (-math.inf, None, None)
    score = lambda m: g[m].sum() ** 2 / (h[m].sum() + s.l2) if h[m].sum() + s.l2 > 0 else 0.0
    for f, cs in enumerate(cuts):
        for c in cs:
            low = x[:, f] <= c
            ok = s.growth == "symmetric" or (min(low.sum(), (~low).sum()) >= s.min_leaf and min(h[low].sum(), h[~low].sum()) >= s.min_hessian)
            gain = 0.5 * (score(low) + score(~low) - score(np.ones(len(x), bool)))
            if ok and gain > best[0] * (1 + 1e-9) + 1e-12:
                best = (gain, f, c)
    return best


def plain_tree(x, g, h, cuts, s):
    """Leaves as (rows, depth), grown one after the other."""
    leaves = [(np.arange(len(x)), 0)]
    if s.growth == "symmetric":
        for d in range(s.depth):
            gains = {}
            for f, cs in enumerate(cuts):
                for c in cs:
                    gains[f, c] = 0.0
                    for at, _ in leaves:
                        low = x[at, f] <= c
                        score = lambda m, at=at: g[at[m]].sum() ** 2 / (h[at[m]].sum() + s.l2) if h[at[m]].sum() + s.l2 > 0 else 0.0
                        gains[f, c] += 0.5 * (score(low) + score(~low) - score(np.ones(len(at), bool)))
            top = max(gains.values())
            if top <= 0:
                break
            f, c = next(k for k, v in gains.items() if v >= top * (1 - 1e-9))
            leaves = [(at[m], d + 1) for at, _ in leaves for m in (x[at, f] <= c, ~(x[at, f] <= c))]
        return leaves
    closed = []
    while leaves and (s.growth == "level" or len(leaves) + len(closed) < s.leaves):
        found = [plain_split(x[at], g[at], h[at], cuts, s) if not s.depth or d < s.depth else (-math.inf, None, None) for at, d in leaves]
        i = max(range(len(leaves)), key=lambda j: found[j][0])
        gain, f, c = found[i]
        if gain <= max(s.min_gain, 0):
            break
        at, d = leaves.pop(i)
        leaves += [(at[x[at, f] <= c], d + 1), (at[~(x[at, f] <= c)], d + 1)]
    return leaves + closed


def plain_fit(x, y, classes, cuts, s):
    """Margins after all rounds, without Spark, bins or histograms."""
    outputs = 1 if classes == 2 else classes
    share = np.log(np.bincount(y, minlength=classes) / len(y))
    margins = np.tile([share[1] - share[0]] if outputs == 1 else share, (len(x), 1))
    for _ in range(s.rounds):
        p = 1 / (1 + np.exp(-margins)) if outputs == 1 else np.exp(margins) / np.exp(margins).sum(1, keepdims=True)
        hit = (y == 1)[:, None] if outputs == 1 else y[:, None] == np.arange(classes)
        for k in range(outputs):
            g, h = (p - hit)[:, k], (p * (1 - p))[:, k]
            for at, _ in plain_tree(x, g, h, cuts, s):
                if len(at):
                    margins[at, k] += s.rate * -g[at].sum() / (h[at].sum() + s.l2)
    return margins


SETTINGS = {
    "level": b.Settings(rounds=3, depth=3),
    "leaf": b.Settings(growth="leaf", rounds=3, depth=0, leaves=7, rate=0.2, l2=0.5, min_leaf=4, min_hessian=0.001),
    "leaf_deep": b.Settings(growth="leaf", rounds=2, depth=4, leaves=12, min_leaf=1, min_gain=0.05),
    "symmetric": b.Settings(growth="symmetric", rounds=3, depth=3, l2=3.0),
}


@pytest.mark.parametrize("classes", [2, 4])
def test_all_growths_equal_plain_boosting(spark, classes):
    """Fitted together, each as it would be alone."""
    x, y, fold = data(classes=classes)
    cuts = cuts_of(x)
    made, hits = b.fit(blocks(spark, x, y, fold), [b.Model(s) for s in SETTINGS.values()], classes, cuts, 3)
    for (name, s), ensemble in zip(SETTINGS.items(), made):
        np.testing.assert_allclose(ensemble.margins(x), plain_fit(x, y, classes, cuts, s), atol=1e-9, err_msg=name)
        assert all(len(t.feature) <= 2 * s.most_leaves() + 20 for r in ensemble.rounds for t in r)
        again = b.Ensemble.from_json(ensemble.to_json())
        assert (again.margins(x) == ensemble.margins(x)).all()
        np.testing.assert_allclose(ensemble.probabilities(x).sum(1), 1.0, atol=1e-12)
    assert (hits == 0).all()


def test_folds_share_passes(spark):
    """A model that leaves a fold out is the one fitted to the other rows; its hits are of that fold."""
    x, y, fold = data()
    cuts, s = cuts_of(x), SETTINGS["leaf"]
    made, hits = b.fit(blocks(spark, x, y, fold), [b.Model(s, f) for f in range(3)], 2, cuts, 3)
    for f in range(3):
        want = plain_fit(x[fold != f], y[fold != f], 2, cuts, s)
        np.testing.assert_allclose(made[f].margins(x[fold != f]), want, atol=1e-9)
        held = fold == f
        assert hits[f].tolist() == [held.sum(), ((made[f].margins(x[held])[:, 0] > 0) == (y[held] == 1)).sum()]


def test_parts_and_runs_change_nothing(spark, monkeypatch):
    x, y, fold = data(classes=4)
    cuts, wanted = cuts_of(x), [b.Model(s) for s in SETTINGS.values()]
    one, _ = b.fit(blocks(spark, x, y, fold), wanted, 4, cuts, 3)
    monkeypatch.setattr(b, "PASS_BYTES", 5000)
    monkeypatch.setattr(b, "OPEN_BYTES", 100_000)
    monkeypatch.setattr(b, "CUT_EVERY", 2)
    many, _ = b.fit(blocks(spark, x, y, fold, 1), wanted, 4, cuts, 3)
    for a, c in zip(one, many):
        np.testing.assert_allclose(a.margins(x), c.margins(x), atol=1e-9)


def test_row_and_column_shares(spark):
    x, y, fold = data()
    s = b.Settings(rounds=2, depth=2, row_share=0.5, column_share=0.4)
    made, _ = b.fit(blocks(spark, x, y, fold), [b.Model(s)], 2, cuts_of(x), 3)
    for tree, in made[0].rounds:
        assert len({f for f in tree.feature if f >= 0}) <= 1 and 50 < tree.rows[0] < 110
    u = shares(np.arange(100_000, dtype=np.uint64), 3, 4)
    assert abs(u.mean() - 0.5) < 0.01 and abs((u < 0.1).mean() - 0.1) < 0.01 and (shares(np.arange(9, dtype=np.uint64), 3, 5) != u[:9]).all()


def test_cuts_and_odd_columns(spark):
    df = spark.createDataFrame([(1.0, None, 5.0), (2.0, None, 5.0), (float("nan"), None, 5.0), (9.0, None, 5.0)], "a double, b double, c double")
    cuts = b.fit_cuts(df, ["a", "b", "c"], 4)
    assert [c.tolist() for c in cuts] == [[1.0, 2.0, 9.0], [], [5.0]]
    x = np.array([[1.0, 7.0, 5.0], [1.5, np.nan, 5.1], [np.nan, 0.0, np.nan]])
    assert b.binned(x, cuts).tolist() == [[0, 0, 0], [1, 0, 1], [3, 0, 1]]
    with pytest.raises(ValueError):
        b.fit(blocks_of(df.limit(0), F.array("a"), F.lit(0), ["a"]), [b.Model(b.Settings())], 2, cuts[:1])


def test_one_class_and_constant_features(spark):
    x, y, fold = np.ones((20, 3)), np.zeros(20, dtype=int), np.zeros(20, dtype=int)
    made, _ = b.fit(blocks(spark, x, y, fold), [b.Model(s) for s in SETTINGS.values()], 2, cuts_of(x))
    for ensemble in made:
        assert (ensemble.probabilities(x)[:, 0] > 0.99).all()


def test_ensembles_are_fitted_in_tasks(spark):
    """A job for the class counts and one for all rounds of all models, not one per level of a tree."""
    x, y, fold = data()
    rows, wanted = blocks(spark, x, y, fold), [b.Model(s, f) for s in SETTINGS.values() for f in (-1, 0, 1)]
    spark.sparkContext.setJobGroup("boosted in tasks", "")
    try:
        made, hits = b.fit(rows, wanted, 2, cuts_of(x), 3)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("boosted in tasks")) <= 4
    assert [len(e.rounds) for e in made] == [m.settings.rounds for m in wanted]
    assert [n for n, _ in hits] == [0 if m.left_out < 0 else (fold == m.left_out).sum() for m in wanted]


@pytest.mark.parametrize("classes", [2, 4])
def test_passes_and_tasks_fit_the_same(spark, monkeypatch, classes):
    """Rows that are too many for a task give the same trees and hits in passes, from which the
    driver gets a cut and six sums per leaf."""
    x, y, fold = data(classes=classes)
    cuts, shared = cuts_of(x), b.Settings(rounds=2, depth=3, row_share=0.6, column_share=0.7)
    wanted = [b.Model(replace(s, min_gain=s.min_gain or 1e-9), f) for s in (*SETTINGS.values(), shared) for f in (-1, 1)]  # no cut by rounding alone
    whole, hits = b.fit(blocks(spark, x, y, fold), wanted, classes, cuts, 3)
    sent, pass_of = [], b._cuts_of_pass

    def spied(rows, asked, *rest):
        found = pass_of(rows, asked, *rest)
        leaves = sum(len(a[3]) for a in asked)
        sent.append(sum(v.nbytes for o in found.values() for v in vars(o).values()) <= leaves * 9 * 8)
        return found

    monkeypatch.setattr(b, "_cuts_of_pass", spied)
    monkeypatch.setattr(b, "TASK_BYTES", 0)
    monkeypatch.setattr(b, "PASS_BYTES", 5000)
    monkeypatch.setattr(b, "OPEN_BYTES", 100_000)
    monkeypatch.setattr(b, "CUT_EVERY", 2)
    passed, again = b.fit(blocks(spark, x, y, fold), wanted, classes, cuts, 3)
    assert sent and all(sent) and (hits == again).all()
    for one, other in zip(whole, passed):
        for trees, others in zip(one.rounds, other.rounds, strict=True):
            for t, o in zip(trees, others, strict=True):
                assert (t.feature == o.feature).all() and (t.cut == o.cut).all() and (t.rows == o.rows).all()
                np.testing.assert_allclose(t.value, o.value, atol=1e-9)
