import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparktab.operators import gradient as g
from sparktab.operators import target_stats
from sparktab.operators.blocks import Block, blocks_of


def data(n=150, classes=3, seed=2):
    rng = np.random.default_rng(seed)
    y = np.arange(n) % classes
    x = rng.normal(size=(n, 2)) + 2.0 * np.stack([np.cos(y * 2.1), np.sin(y * 2.1)], axis=1)
    return x, y, (np.arange(n) // classes) % 5


@pytest.fixture(scope="module")
def blocks(spark):
    rows = [(i, r.tolist(), int(c), int(f)) for i, (r, c, f) in enumerate(zip(*data()))]
    df = spark.createDataFrame(rows, "key long, x array<double>, y int, fold int").repartition(3)
    return blocks_of(df, F.col("x"), F.col("y"), ["key"], F.col("fold"))


LEARNERS = [
    g.Logistic(2, 3, C=2.0),
    g.PairMachine(2, 3, C=0.5),
    g.PairMachine(2, 3, components=20, gamma=0.3),
    g.Network(2, 3, (7, 5), "relu", 0.01),
    g.Network(2, 3, (6,), "tanh", 0.1),
    g.Network(2, 3, (4,), "logistic", 1.0),
]


@pytest.mark.parametrize("learner", LEARNERS)
def test_gradients_are_differences_of_the_loss(learner):
    x, y, _ = data()
    w = np.random.default_rng(0).normal(size=learner.size)
    value, grad = learner.loss(w, x, y)
    for i in range(learner.size):
        e = np.zeros(learner.size)
        e[i] = 1e-5
        slope = (learner.loss(w + e, x, y)[0] - learner.loss(w - e, x, y)[0]) / 2e-5
        assert math.isclose(grad[i], slope, rel_tol=1e-4, abs_tol=1e-3), i
    np.testing.assert_allclose(learner.scores(w, x).sum(axis=1), 1.0)
    assert learner.weighed(w).sum() < learner.size == len(learner.start(1)) and value > 0


@pytest.mark.parametrize("learner", LEARNERS)
def test_like_models_have_their_losses_in_one_go(learner, monkeypatch):
    """Each over its own rows, in blocks and in runs of a few rows; what machines see is worked out once a run."""
    x, y, fold = data()
    models = [g.Model(replace(learner, **{n: v} if hasattr(learner, n) else {}), f) for n, v in (("C", 0.1), ("C", 7.0), ("max_iter", 3)) for f in (-1, 0, 4)]
    trials = {m: np.random.default_rng(m).normal(size=learner.size) for m in range(len(models))}
    block, calls, plain = Block(x, y, fold, np.arange(len(y), dtype=np.uint64)), [], type(learner).__dict__.get("seen")
    if plain:
        monkeypatch.setattr(type(learner), "seen", lambda self, x: calls.append(len(x)) or plain(self, x))
    for numbers in (1 << 19, 200):
        monkeypatch.setattr(g, "SCORE_NUMBERS", numbers)
        calls.clear()
        found = g._losses(models, trials, {})(block)
        assert sum(calls) == (len(y) if plain else 0)
        for m, model in enumerate(models):
            seen = fold != model.left_out
            value, grad = model.learner.loss(trials[m], x[seen], y[seen])
            np.testing.assert_allclose(found[m], [value, seen.sum(), *grad], rtol=1e-9, atol=1e-9)


def test_equal_models_are_fitted_once(blocks, monkeypatch):
    models = [g.Model(g.PairMachine(2, 3, c, max_iter=5), f) for _ in range(2) for c in (0.1, 1) for f in (0, 1, -1)]
    most, plain = [], g._pass
    monkeypatch.setattr(g, "_pass", lambda rows, ms, trials, *a: most.append(len(trials)) or plain(rows, ms, trials, *a))
    fitted, hits = g.fit(blocks, models, 5)
    assert max(most) == 6 and len(fitted) == len(hits) == 12
    for k in range(6):
        assert fitted[k].learner == models[k].learner and (fitted[k].weights == fitted[k + 6].weights).all() and (hits[k] == hits[k + 6]).all()
    most.clear()
    asked, plain_losses = [], g._losses
    monkeypatch.setattr(g, "_losses", lambda ms, trials, batch: asked.append(len(trials)) or plain_losses(ms, trials, batch))
    far, near = g.fit(blocks, [g.Model(g.Logistic(2, 3, 10.0, n)) for n in (500, 6)], 5)[0]
    assert asked[:6] == [1] * 6 and near.passes < far.passes == len(asked)  # at equal weights they share a loss
    assert (hits[[2, 5], 0] == 0).all() and (hits[[0, 1, 3, 4], 0] == 30).all()


def objective(learner, w, x, y):
    n = len(y)
    return learner.loss(w, x, y)[0] / n + 0.5 * learner.penalty(n) * (learner.weighed(w) * w**2).sum()


def test_descent_ends_where_the_gradient_does(blocks):
    """Candidates and folds together, each at its own optimum."""
    x, y, fold = data()
    learners = [g.Logistic(2, 3, C=c) for c in (0.01, 1.0, 100.0)] + [g.PairMachine(2, 3, C=c) for c in (0.1, 10.0)]
    models = [g.Model(one, f) for one in learners for f in (-1, 0, 3)]
    fitted, hits = g.fit(blocks, models, 5)
    for model, one, (n, good) in zip(models, fitted, hits):
        seen = fold != model.left_out
        grad = model.learner.loss(one.weights, x[seen], y[seen])[1] / seen.sum() + model.learner.penalty(seen.sum()) * model.learner.weighed(one.weights) * one.weights
        assert np.abs(grad).max() < 1e-3
        rng = np.random.default_rng(1)
        least = objective(model.learner, one.weights, x[seen], y[seen])
        assert all(objective(model.learner, one.weights + 0.05 * rng.normal(size=one.learner.size), x[seen], y[seen]) > least - 1e-9 for _ in range(20))
        assert n == (~seen).sum() and good == (one.probabilities(x[~seen]).argmax(axis=1) == y[~seen]).sum()


def test_many_models_take_the_passes_of_the_slowest(blocks, monkeypatch):
    calls, plain = [], g.total
    monkeypatch.setattr(g, "total", lambda *a: calls.append(1) or plain(*a))
    models = [g.Model(g.Logistic(2, 3, C=c), f) for c in (0.1, 1.0, 10.0) for f in range(5)]
    fitted, _ = g.fit(blocks, models, 5)
    assert len(calls) == max(f.passes for f in fitted) + 2
    together = [f.weights for f in fitted]
    monkeypatch.setattr(g, "PASS_NUMBERS", 20)
    for one, w in zip(g.fit(blocks, models, 5)[0], together):
        np.testing.assert_allclose(one.weights, w, atol=1e-9)


def test_networks_learn(blocks):
    x, y, _ = data()
    models = [g.Model(g.Network(2, 3, (16,), a, 0.001, s, batch=40, rate=0.01, max_iter=60)) for a, s in (("relu", "adam"), ("tanh", "adam"), ("relu", "lbfgs"))]
    for one in g.fit(blocks, models, 5)[0]:
        assert (one.probabilities(x).argmax(axis=1) == y).mean() > 0.85
        again = g.Fitted.from_json(one.to_json())
        assert again.learner == one.learner and (again.weights == one.weights).all()
    strong, weak = g.fit(blocks, [g.Model(g.Network(2, 3, (16,), "tanh", a, "lbfgs", max_iter=50)) for a in (100.0, 0.0)], 5)[0]
    assert np.abs(strong.weights * strong.learner.weighed(strong.weights)).max() < 0.5 < np.abs(weak.weights).max()


def test_batches_cover_every_row_once(blocks):
    model = g.Model(g.Network(2, 3, batch=30))
    found = [g._pass(blocks, [model], {0: model.learner.start(1)}, {0: (7, k, 5)})[0] for k in range(5)]
    whole = g._pass(blocks, [model], {0: model.learner.start(1)})[0]
    assert sum(f[1] for f in found) == whole[1] == 150 and min(f[1] for f in found) > 10
    np.testing.assert_allclose(sum(f[2] for f in found), whole[2], atol=1e-9)


def test_kernel_machine_bends(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 2))
    y = ((x**2).sum(axis=1) > 1.4).astype(int)
    df = spark.createDataFrame([(i, r.tolist(), int(c)) for i, (r, c) in enumerate(zip(x, y))], "key long, x array<double>, y int")
    rows = blocks_of(df, F.col("x"), F.col("y"), ["key"])
    round_one, flat = g.fit(rows, [g.Model(g.PairMachine(2, 2, 10.0, 60, 0.5)), g.Model(g.PairMachine(2, 2, 10.0))])[0]
    assert (round_one.probabilities(x).argmax(axis=1) == y).mean() > 0.93 > 0.75 > (flat.probabilities(x).argmax(axis=1) == y).mean()


def test_ordered_target_stats(spark):
    """Against a plain walk over the rows in md5 order, with a hot category, NULLs and small buckets."""
    import hashlib

    rows = [(i, None if i % 11 == 0 else "hot" if i % 3 else f"c{i % 7}", None if i % 13 == 0 else float(i % 5 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "key long, kind string, t double")
    given = [t for _, _, t in rows if t is not None]
    prior, sums, want = sum(given) / len(given), {}, {}
    for key, kind, t in sorted(rows, key=lambda r: hashlib.md5(f"54|{r[0]}".encode()).hexdigest()):
        s, n = sums.get(kind, (0.0, 0))
        want[key] = (s + 2.0 * prior) / (n + 2.0)
        sums[kind] = (s, n) if t is None else (s + t, n + 1)
    for size in (10, 1 << 16):
        got = {r["key"]: r["mean"] for r in target_stats.ordered(df, "kind", {"mean": F.col("t")}, ["key"], 2.0, rows_per_bucket=size).collect()}
        assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], abs_tol=1e-12) for k in want)
    later = spark.createDataFrame([(1, "hot", 9), (2, None, 9), (3, "new", 9)], "key long, kind string, mean int")
    found = {r["key"]: r["mean"] for r in target_stats.fit(df, "kind", {"mean": F.col("t")}, 2.0).apply(later).collect()}
    for key, kind in ((1, "hot"), (2, None)):
        assert math.isclose(found[key], (sums[kind][0] + 2.0 * prior) / (sums[kind][1] + 2.0))
    assert math.isclose(found[3], prior)


def test_epochs_of_mini_batches_take_few_jobs(blocks, monkeypatch):
    """One job for a single group of rows; with more groups one an epoch, and weights that still learn."""
    x, y, _ = data()
    calls, plain = [], g.total_by_key
    monkeypatch.setattr(g, "total_by_key", lambda *a: calls.append(1) or plain(*a))
    model = g.Model(g.Network(2, 3, (16,), "tanh", 0.001, batch=10, rate=0.01, max_iter=40))
    one, others = g.fit(blocks, [model, g.Model(model.learner, 2)], 5)[0]
    assert len(calls) == 1 and one.passes == 40 * 15 and others.passes == 40 * 12
    at, first, second, n = model.learner.start(54), 0.0, 0.0, 0
    row = np.concatenate([b.row for b in blocks.collect()])
    xs, ys = (np.concatenate([getattr(b, c) for b in blocks.collect()]) for c in ("x", "y"))
    for epoch in range(40):  # a plain walk over the mini-batches
        which = (g.shares(row, 54, epoch) * 15).astype(int)
        for k in range(15):
            i, n = np.flatnonzero(which == k), n + 1
            if len(i):
                grad = model.learner.loss(at, xs[i], ys[i])[1] / len(i) + 0.001 / len(i) * model.learner.weighed(at) * at
                first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad**2
                at = at - 0.01 * math.sqrt(1 - 0.999**n) / (1 - 0.9**n) * first / (np.sqrt(second) + 1e-8)
    np.testing.assert_allclose(one.weights, at, atol=1e-6)
    monkeypatch.setattr(g, "GROUP_ROWS", 50)
    calls.clear()
    apart = g.fit(blocks, [model], 5)[0][0]
    assert len(calls) == 40 and (apart.probabilities(x).argmax(axis=1) == y).mean() > 0.85


@pytest.mark.parametrize("hidden,activation,classes", [((7,), "relu", 2), ((5, 4), "tanh", 3), ((6,), "logistic", 11)])
def test_steps_in_place_are_the_loss(hidden, activation, classes):
    """Mini-batches of different sizes in the same arrays; single precision goes the same way."""
    x, y, _ = data(classes=classes)
    learner = g.Network(2, classes, hidden, activation)
    w = learner.start(3)
    steps = g._Steps(learner, w, 90)
    for some in (slice(0, 90), slice(90, 150), slice(0, 1)):
        value, grad = learner.loss(w, x[some], y[some])
        assert math.isclose(steps.loss(np.column_stack([x[some], np.ones(len(x[some]))]), y[some]), value, rel_tol=1e-9)
        np.testing.assert_allclose(steps.grad, grad, atol=1e-9)
    row, ways = np.arange(150, dtype=np.uint64), []
    for kind in ("float64", "float32"):
        ways.append(g._Batches(g.Model(g.Network(2, classes, hidden, activation, 0.01, batch=20)), 150))
        for epoch in range(20):
            loss, n = ways[-1].over(x.astype(kind), y, row, epoch)
    assert n == 150 and ways[1].at.dtype == "float32" and ways[0].passes == ways[1].passes == 20 * 8
    np.testing.assert_allclose(ways[1].at, ways[0].at, atol=1e-3)


def test_many_rows_are_one_group(blocks, monkeypatch):
    """Networks on more than 100,000 rows go through whole epochs in one job, in single precision."""
    calls, plain = [], g.total_by_key
    monkeypatch.setattr(g, "total_by_key", lambda *a: calls.append(1) or plain(*a))
    big = blocks.map(lambda b: replace(b, x=np.tile(b.x, (700, 1)), y=np.tile(b.y, 700), fold=np.tile(b.fold, 700), row=np.arange(700 * len(b.y), dtype=np.uint64) + b.row[0]))
    one = g.fit(big, [g.Model(g.Network(2, 3, (4,), batch=1000, rate=0.01, max_iter=3))], 5)[0][0]
    x, y, _ = data()
    assert len(calls) == 1 and one.passes == 3 * 105 and (one.probabilities(x).argmax(axis=1) == y).mean() > 0.8
    assert (one.weights == one.weights.astype("float32")).all()
