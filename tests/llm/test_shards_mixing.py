import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparktab.llm import mixing, shards


@given(st.lists(st.integers(0, 400), max_size=12), st.integers(1, 9), st.integers(0, 99))
@settings(max_examples=60, deadline=None)
def test_matrix_has_exact_margins(sizes, k, seed):
    matrix = np.array(shards.communication_matrix(sizes, k, seed)).reshape(-1, k)
    assert matrix.sum(axis=1).tolist() == sizes and (matrix >= 0).all()
    totals = matrix.sum(axis=0)
    assert totals.sum() == sum(sizes) and totals.max() - totals.min() <= 1


def test_draws_beyond_numpy_follow_the_same_law(monkeypatch):
    rng = np.random.default_rng(1)
    want = rng.hypergeometric(700, 1300, 90, size=4000)
    monkeypatch.setattr(shards, "NUMPY_ROWS", 10)
    got = np.array([shards.draw(rng, 700, 1300, 90) for _ in range(4000)])
    assert abs(got.mean() - want.mean()) < 0.4 and abs(got.std() - want.std()) < 0.3
    assert all(shards.draw(rng, 5, 30, 33) >= 3 for _ in range(50)) and shards.draw(rng, 20, 20, 0) == 0


def placed(df):
    by = {}
    for r in df.collect():
        by.setdefault(r["shard"], []).append(r["slot"])
    return by


def test_every_row_has_a_slot_of_its_own(odd, odd_rows):
    out = shards.shuffled(odd, 4, block_rows=16, cell_rows=5)
    assert out.columns == [*odd.columns, "shard", "slot"]
    by = placed(out)
    assert sorted(map(len, by.values())) in ([18, 18, 19, 19], [18, 18, 18, 19]) or max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values()) and sum(map(len, by.values())) == len(odd_rows)
    key = lambda rows: sorted(map(repr, (tuple(r)[:5] for r in rows)))
    assert key(out.collect()) == key(odd_rows)


def test_shards_of_little_or_nothing(odd, nothing, clashing):
    assert shards.shuffled(nothing, 4).count() == 0
    assert sorted(map(len, placed(shards.shuffled(odd.limit(3), 8)).values())) == [1, 1, 1]
    out = shards.shuffled(clashing, 4)
    assert out.columns.count("shard") == 1 and {len(v) for v in placed(out).values()} <= {18, 19}


def test_shuffle_is_uniform(spark):
    out = shards.shuffled(spark.range(4000).withColumnRenamed("id", "doc_id"), 4, block_rows=500).collect()
    first = [r["shard"] for r in out if r["doc_id"] < 1000]
    counts = np.bincount(first, minlength=4)
    assert (abs(counts - 250) < 60).all()
    early = np.mean([r["doc_id"] for r in out if r["slot"] < 300])
    assert abs(early - 2000) < 150


def test_shard_table_columns(tables, spark):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    import zlib

    texts = {r["doc_id"]: (r["text"] or "").encode() for r in docs.collect()}
    rows = shards.shard_table(docs, scan=True).collect()
    assert len(rows) == len(texts) and {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}
    assert all((r["size"], r["text_crc32"]) == (len(texts[r["doc_id"]]) + 1, zlib.crc32(texts[r["doc_id"]])) for r in rows)


@given(st.lists(st.floats(0.01, 50), min_size=1, max_size=9), st.integers(0, 40))
@settings(max_examples=60, deadline=None)
def test_segments_deviate_by_less_than_a_block(targets, more):
    weights = mixing.exact_weights(targets)
    period = sum(weights)
    size = -(-period // min(weights)) + more
    had, t = [0] * len(weights), 0
    for k in range(4):
        for i, j, slot in mixing.segment(weights, k, size):
            assert (j, slot) == (had[i], t)  # no block or slot is left out at a border
            had[i], t = had[i] + 1, t + 1
            if len(weights) > 1 and (t % size < 4 or t % 7 == 0):
                assert all(abs(h * period - w * t) < period for h, w in zip(had, weights))
        assert t == (k + 1) * size and had == mixing.at_border(weights, t, size)


def test_close_weights_at_small_segments():
    """Borders meet for every proportion of few sources, wherever they lie."""
    import itertools as it

    for weights in it.product(range(1, 8), repeat=3):
        size = -(-sum(weights) // min(weights))
        had = [0, 0, 0]
        for k in range(5):
            for i, j, t in mixing.segment(list(weights), k, size):
                had[i] += 1
                assert j + 1 == had[i] and all(abs(h * sum(weights) - w * (t + 1)) < sum(weights) for h, w in zip(had, weights))


def test_mix_places_every_row_and_keeps_weights(odd, odd_rows):
    out = mixing.mixed(odd, block_rows=4)
    assert out.columns == [*odd.columns, "block", "epoch", "block_slot", "place"]
    rows = out.collect()
    first = [r for r in rows if r["epoch"] == 0]
    key = lambda rows: sorted(repr(tuple(r)[:5]) for r in rows)
    assert key(first) == key(odd_rows)
    assert len({(r["block_slot"], r["place"]) for r in rows}) == len(rows)
    owners = {}
    for r in rows:
        assert owners.setdefault(r["block_slot"], r["source"]) == r["source"]
    sources = sorted({r[3] for r in odd_rows}, key=lambda s: (s is not None, s))
    weights = mixing.exact_weights([sum(x[3] == s for x in odd_rows) ** 0.7 for s in sources])
    had = dict.fromkeys(sources, 0)
    assert sorted(owners) == list(range(len(owners)))
    for t in range(len(owners)):
        had[owners[t]] += 1
        assert all(abs(had[s] - w * (t + 1) / sum(weights)) < 1 for s, w in zip(sources, weights))


def test_mix_of_nothing_targets_and_names(nothing, odd, clashing):
    assert mixing.mixed(nothing).count() == 0
    with pytest.raises(ValueError):
        mixing.mixed(odd, targets={"s0": 1.0})
    out = mixing.mixed(odd, targets={"s0": 2, "s1": 1, "s2": 1, None: 1}, block_rows=1)
    assert {r["source"] for r in out.select("source").collect()} == {"s0", "s1", "s2", None}
    assert mixing.mixed(clashing).columns.count("epoch") == 1


def test_small_sources_have_their_share_of_rows(spark):
    sizes = {"hot": 3000, "one": 1, "three": 3, "odd": 17, "fifty": 50}
    targets = {"hot": 4, "one": 1, "three": 1, "odd": 1, "fifty": 1}
    docs = spark.createDataFrame([(i, s) for s, n in sizes.items() for i in range(n)], "doc_id long, source string")
    rows = mixing.mixed(docs, targets=targets).collect()
    for s, n in sizes.items():
        mine = sorted((r["block"], r["place"], r["epoch"], r["doc_id"]) for r in rows if r["source"] == s)
        assert abs(len(mine) - len(rows) * targets[s] / 8) < 16
        assert [m[:3] for m in mine] == [(k // 16, k % 16, k // n) for k in range(len(mine))]
        assert [m[3] for m in mine] == [mine[k % n][3] for k in range(len(mine))] and {m[3] for m in mine} == set(range(n))
    assert sum(r["source"] == "hot" for r in rows) == 3000


def test_mix_deviates_from_the_targets_by_less_than_a_block(spark, monkeypatch):
    from fractions import Fraction

    targets = {"hot": 1.0} | {f"tiny{k}": 0.001 for k in range(30)} | {"some": 0.0015}
    docs = spark.createDataFrame([(i, "hot") for i in range(2000)] + [(-k, s) for k, s in enumerate(targets) if s != "hot"], "doc_id long, source string")
    rows = mixing.mixed(docs, targets=targets, block_rows=1).collect()
    scale = sum(map(Fraction, targets.values()))
    assert sorted(r["block_slot"] for r in rows) == list(range(len(rows)))
    for r in rows:  # before its slot the source has had `block` blocks, after it one more
        share, t = Fraction(targets[r["source"]]) / scale, r["block_slot"]
        assert abs(r["block"] - share * t) < 1 and abs(r["block"] + 1 - share * (t + 1)) < 1
    monkeypatch.setattr(mixing, "BROADCAST_SLOTS", 0)
    where = lambda rs: sorted((r["source"], r["block"], r["block_slot"], r["place"]) for r in rs)
    assert where(mixing.mixed(docs, targets=targets, block_rows=1).collect()) == where(rows)
    monkeypatch.setattr(mixing, "SEGMENT_SLOTS", 1)  # several segments, each made in a task
    cut = mixing.mixed(docs, targets=targets, block_rows=1).collect()
    assert sorted(r["block_slot"] for r in cut) == list(range(len(cut))) and {r["doc_id"] for r in cut} == {r["doc_id"] for r in rows}
    for r in cut:
        share, t = Fraction(targets[r["source"]]) / scale, r["block_slot"]
        assert abs(r["block"] - share * t) < 1 and abs(r["block"] + 1 - share * (t + 1)) < 1


def test_many_tiny_sources_beside_a_hot_one(spark):
    sizes = [1_000_000] + [1] * 1000
    weights = mixing.exact_weights([n**0.7 for n in sizes])
    end, ender = mixing.last_slot(spark, weights, [-(-n // 16) for n in sizes])
    size = mixing.segment_size(weights)
    had = [0] * len(sizes)
    for k in range(end // size + 1):
        for i, _, t in mixing.segment(weights, k, size):
            had[i] += t <= end
    assert had[0] == 62_500 and ender == 0 and all(abs(h * sum(weights) - w * (end + 1)) < sum(weights) for h, w in zip(had, weights))
