import math
import random

from sparktab.operators import exact_tree


def plain(rows, features, min_split, min_leaf, depth=None, path=""):
    """The same tree, one cut at a time: {path: (n, feature, cut)}."""
    n = len(rows)
    classes = sorted({y for _, y in rows})
    if n < min_split or len(classes) < 2 or depth == len(path):
        return {path: (n, None, None)}

    def purity(part):
        return sum(sum(y == c for _, y in part) ** 2 for c in classes) / len(part)

    best = None
    for f in range(features):
        values = sorted({x[f] for x, _ in rows})
        for a, b in zip(values, values[1:]):
            cut = (a + b) / 2
            left, right = [r for r in rows if r[0][f] <= cut], [r for r in rows if r[0][f] > cut]
            if min(len(left), len(right)) >= min_leaf:
                key = (-round((purity(left) + purity(right) - purity(rows)) / n, 12), f, cut)
                best = min(best or key, key)
    if best is None:
        return {path: (n, None, None)}
    _, f, cut = best
    found = {path: (n, f, cut)}
    for side, keep in (("L", lambda x: x[f] <= cut), ("R", lambda x: x[f] > cut)):
        found |= plain([r for r in rows if keep(r[0])], features, min_split, min_leaf, depth, path + side)
    return found


def data(n, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        x = (round(rng.gauss(0, 1), 1), round(rng.gauss(0, 1), 1), float(rng.randint(0, 3)))
        rows.append((x, "abc"[(x[0] * x[1] > 0) + (x[2] == 2 and rng.random() < 0.7)]))
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*x, y) for x, y in rows], "a double, b double, c double, y string").repartition(4)


def test_whole_tree_equals_the_plain_one(spark):
    rows = data(90, 3)
    tree = exact_tree.grow(table(spark, rows), ["a", "b", "c"], "y", min_samples_split=20, min_samples_leaf=2)
    got = {r["node"]: (r["n"], r["f"], r["cut"]) for r in tree.nodes.collect()}
    want = plain(rows, 3, 20, 2)
    assert got.keys() == want.keys() and max(map(len, got)) > 2
    for path, (n, f, cut) in want.items():
        assert got[path][:2] == (n, f) and (cut is None or math.isclose(got[path][2], cut))


def test_unlimited_tree_learns_every_row_and_limits_hold(spark):
    rows = list({x: (x, y) for x, y in data(24, 4)}.values())
    frame = table(spark, rows)
    tree = exact_tree.grow(frame, ["a", "b", "c"], "y")
    assert all(r["p"] == r["y"] for r in tree.predict(frame, "p").collect())
    short = exact_tree.grow(frame, ["a", "b", "c"], "y", max_depth=1)
    assert sorted(r["node"] for r in short.nodes.collect()) == ["", "L", "R"] and short.predict(frame).count() == len(rows)


def test_gaps_constants_one_class_and_nothing(spark):
    rows = [(1.0, 5.0, "x"), (None, 5.0, "x"), (float("nan"), 5.0, "y"), (3.0, 5.0, "y"), (9.0, 5.0, None)]
    frame = spark.createDataFrame(rows, "a double, b double, y string")
    tree = exact_tree.grow(frame, ["a", "b"], "y")
    nodes = {r["node"]: r for r in tree.described().collect()}
    assert tree.means == (2.0, 5.0) and nodes[""]["n_rows"] == 4  # missing is the mean of 1 and 3
    assert {r["feature"] for r in nodes.values()} <= {"a", None} and tree.predict(frame).count() == 5
    alike = exact_tree.grow(frame.where("y = 'x'"), ["a", "b"], "y")
    assert alike.nodes.count() == 1 and alike.described().first()["prediction"] == "x"
    none = exact_tree.grow(frame.limit(0), ["a", "b"], "y")
    assert none.nodes.count() == 0 and {r["p"] for r in none.predict(frame, "p").collect()} == {None}
