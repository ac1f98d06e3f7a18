import numpy as np
from llm_fixtures import prose

from sparktab.llm import pu_quality as q


def mixture(n, prior, seed):
    rng = np.random.default_rng(seed)
    good = rng.normal(0, 1, (n, 4))
    unlabelled = np.where(rng.random((n, 1)) < prior, rng.normal(0, 1, (n, 4)), rng.normal(3, 1, (n, 4)))
    return good, unlabelled


def test_prior_and_risk_separate_unlabelled_text():
    good, mixed = mixture(4000, 0.7, 1)
    first = q.fitted(good, mixed, None, rounds=15)
    cells = lambda x: np.bincount(np.minimum((q.logistic(first.margins(x)) * q.CELLS).astype(int), q.CELLS - 1), minlength=q.CELLS)
    prior = q.class_prior(cells(good), cells(mixed))
    assert abs(prior - 0.7) < 0.1
    model = q.fitted(good, mixed, prior, rounds=25)
    rng = np.random.default_rng(9)
    assert (model.margins(rng.normal(0, 1, (500, 4))) > 0).mean() > 0.9 > 0.1 > (model.margins(rng.normal(3, 1, (500, 4))) > 0).mean()
    assert q.class_prior(np.zeros(0), np.zeros(0)) == 0.5 == q.class_prior(np.zeros(9), np.ones(9))


def test_step_descends_the_risk():
    """The step's gradient is that of the loss, by differences."""
    good, mixed = mixture(40, 0.5, 3)
    model = q.Scorer(4)
    x = np.concatenate([good, mixed])
    loss = lambda: np.logaddexp(0, -model.margins(x)).sum()
    state, before = [0, [0.0] * 4, [0.0] * 4], [p.copy() for p in model.parts]
    model.step(x, -q.logistic(-model.margins(x)), state, 0.0, 0.0)
    gradient = state[1][0] / 0.1
    for i, j in ((0, 0), (1, 5), (3, 23)):
        model.parts = [p.copy() for p in before]
        model.parts[0][i, j] += 1e-5
        up = loss()
        model.parts[0][i, j] -= 2e-5
        assert abs((up - loss()) / 2e-5 - gradient[i, j]) < 1e-3


def test_features_of_odd_texts():
    assert q.features("")[-1] == 1 == q.features(" \n\t")[-1]
    for text in ("x", "x" * 50_000, "a " * 20_000, "É 日本 😀", "\n\n|"):
        assert np.isfinite(q.features(text)).all() and len(q.features(text)) == q.WIDTH


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = q.quality_table(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.93
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_bad_labels_are_not_read(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    once = {r["doc_id"]: r["score"] for r in q.quality_table(docs, labels).collect()}
    more = labels.selectExpr("doc_id", "quality", "1 - toxic AS toxic")
    assert {r["doc_id"]: r["score"] for r in q.quality_table(docs, more).collect()} == once


def test_odd_tables(spark, odd, nothing, clashing, odd_rows):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(31, None, 0), (None, 1, 1), (5, 0, 0)], "doc_id long, quality int, toxic int")
    for docs in (odd, clashing):
        rows = q.quality_table(docs, labels).collect()
        assert len(rows) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in rows)
        assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    assert q.quality_table(nothing, labels).count() == 0
    assert {r["score"] for r in q.quality_table(odd, labels.limit(0)).collect()} == {0.5}
    assert prose(1, 30) == prose(1, 30)


def test_negative_part_is_walked_back(monkeypatch):
    """Every step's slope against differences of the risk: the whole of it while its negative part is
    not below zero, else that part's opposite alone. Both cases occur."""
    good, mixed = mixture(300, 0.8, 5)
    seen, plain = [], q.Scorer.step

    def step(model, x, slope, *rest):
        margin, n = model.margins(x).astype("float64"), 300
        soft = lambda v: np.logaddexp(0, v).mean()
        part = lambda m: soft(m[n:]) - 0.9 * soft(m[:n])
        risk = (lambda m: 0.9 * soft(-m[:n]) + part(m)) if part(margin) >= 0 else (lambda m: -part(m))
        for i in (0, 7, n, n + 40):
            e = np.zeros(len(margin))
            e[i] = 1e-4
            assert abs((risk(margin + e) - risk(margin - e)) / 2e-4 - slope[i]) < 1e-5
        seen.append(part(margin) >= 0)
        plain(model, x, slope, *rest)

    monkeypatch.setattr(q.Scorer, "step", step)
    model = q.fitted(good, mixed, 0.9, rounds=60, batch=300)
    assert set(seen) == {True, False}
    assert np.isfinite(model.margins(mixed)).all()
