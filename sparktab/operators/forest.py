"""Random forests and single trees: whole trees grown in tasks, on rows that each task has.

Features are put into bins once. A task takes its share of the trees of all forests, candidates and
folds, and grows each by levels: of every open node it adds up classes by bin, for the columns
drawn for that node. What folds vote is added up in tasks, and trees are written to the
shared folder by the tasks that grew them, so the driver gets neither.

Rows are drawn with replacement (Poisson counts), a split is the one that lowers Gini's
impurity most, and a tree votes by the shares of classes in a leaf.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark import RDD
from pyspark.sql import SparkSession

from sparktab.operators.blocks import Block, for_models, shares
from sparktab.operators.boosting import binned
from sparktab.session import fresh_path

BINS = 32
#: Memory of the rows in a task that grows trees; what a row takes there besides its bins.
TASK_BYTES, ROW_BYTES = 256 << 20, 112
#: Class counts of the nodes that are judged at once; more nodes make more runs.
JUDGED = 1 << 18
#: Gains up to this are none.
LEAST_GAIN = 1e-12
#: Shares are multiples of this, so that sums of votes are exact and don't depend on their order.
GRAIN = 2.0**-30
#: How often a row is drawn: the chances of at most 0, 1, 2 ... times.
DRAWN = np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(16)])
TREES = "tree int, feature binary, cut binary, left binary, shares binary"


@dataclass(frozen=True)
class Settings:
    """``columns``: how many are tried per node, as Spark names it (``sqrt``, ``all``, a number, a share).
    Without ``drawn`` a tree has every row once."""

    trees: int = 100
    depth: int = 30
    min_leaf: int = 1
    columns: str = "sqrt"
    seed: int = 54
    drawn: bool = True

    def tried(self, width: int) -> int:
        named = {"all": width, "sqrt": math.sqrt(width), "log2": math.log2(width), "onethird": width / 3}
        named["auto"] = named["all" if self.trees == 1 else "sqrt"]
        wanted = named.get(self.columns.lower())
        if wanted is None:
            wanted = int(self.columns) if self.columns.isdigit() else float(self.columns) * width
        return min(width, max(1, math.ceil(wanted)))


@dataclass(frozen=True)
class Model:
    """A forest to grow and the fold that it does not see (-1: sees all)."""

    settings: Settings
    left_out: int = -1


@dataclass(frozen=True)
class Forest:
    """A grown forest: the folder of its trees and the cuts that bins stand for."""

    trees: str
    cuts: tuple
    classes: int


def in_tasks(rows: int, width: int) -> bool:
    """Whether a task can have all rows."""
    return rows * (width + ROW_BYTES) <= TASK_BYTES


@dataclass
class Tree:
    """Nodes as arrays, node 0 the root. ``feature`` is -1 in leaves, whose ``left`` is their row of
    ``shares``. A bin up to ``cut`` goes to ``left``, one above it to the node after that."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    shares: np.ndarray

    def votes(self, x: np.ndarray) -> np.ndarray:
        """Shares of the classes in each row's leaf. ``x``: (feature, row) of bins."""
        at = np.zeros(x.shape[1], dtype=np.int64)
        todo = np.arange(len(at)) if self.feature[0] >= 0 else np.empty(0, dtype=np.int64)
        while len(todo):
            here = at[todo]
            at[todo] = self.left[here] + (x[self.feature[here], todo] > self.cut[here])
            todo = todo[self.feature[at[todo]] >= 0]
        return self.shares[self.left[at]]

    def packed(self) -> tuple[bytearray, ...]:
        return tuple(bytearray(v.tobytes()) for v in (self.feature, self.cut, self.left, self.shares))

    @staticmethod
    def unpacked(classes: int, feature: bytes, cut: bytes, left: bytes, shares: bytes) -> Tree:
        read = lambda data, kind: np.frombuffer(data, dtype=kind)
        return Tree(read(feature, "int16"), read(cut, "uint16"), read(left, "int32"), read(shares, "float32").reshape(-1, classes))


def _best(x: np.ndarray, rows: np.ndarray, node: np.ndarray, y: np.ndarray, weight: np.ndarray, whole: np.ndarray, columns: np.ndarray, bins: int, least: int) -> tuple[np.ndarray, ...]:
    """Of each node the gain, feature, bin and class counts below the best cut. ``columns``: (node, tried)."""
    count, classes = whole.shape
    n, own = whole.sum(axis=1), (whole**2).sum(axis=1)
    top, feature, cut, below, nodes = np.full(count, -np.inf), np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros((count, classes)), np.arange(count)
    first = (y * count + node) * bins
    for tried in columns.T:
        hist = np.bincount(first + x[tried[node], rows], weight, classes * count * bins).reshape(classes, count, bins)
        low = hist.cumsum(axis=2)
        lower, square_low, square_high = low.sum(axis=0), 0.0, 0.0
        for c in range(classes):
            square_low, square_high = square_low + low[c] ** 2, square_high + (whole[:, c, None] - low[c]) ** 2
        upper = n[:, None] - lower
        score = square_low / np.maximum(lower, 1.0) + square_high / np.maximum(upper, 1.0)
        score[(lower < least) | (upper < least)] = -np.inf
        at = score.argmax(axis=1)
        found = score[nodes, at]
        better = np.flatnonzero(found > top)
        top[better], feature[better], cut[better], below[better] = found[better], tried[better], at[better], low[:, better, at[better]].T
    return (top - own / n) / n, feature, cut, below


def grown(x: np.ndarray, y: np.ndarray, weight: np.ndarray, classes: int, bins: int, s: Settings, number: int) -> Tree:
    """The tree of a number, on rows that count ``weight`` times. ``x``: (feature, row) of bins."""
    rng, width, tried = np.random.default_rng([s.seed, number]), len(x), s.tried(len(x))
    rows = np.flatnonzero(weight)
    y, weight = y[rows].astype(np.int64), weight[rows].astype(float)
    counts = [np.bincount(y, weight, classes)[None]]
    feature, cut, left = (np.full(1, v, np.int64) for v in (-1, 0, 0))
    ids, whole, node, made = np.zeros(1, np.int64), counts[0], np.zeros(len(rows), np.int64), 1
    most = max(1, JUDGED // (bins * classes))
    for _ in range(s.depth):
        if not len(rows):
            break
        ends, best = np.concatenate([[0], np.cumsum(np.bincount(node, minlength=len(ids)))]), []
        for a in range(0, len(ids), most):  # rows lie by node
            some, kept = slice(ends[a], ends[min(a + most, len(ids))]), whole[a : a + most]
            columns = rng.random((len(kept), width)).argsort(axis=1)[:, :tried]
            best.append(_best(x, rows[some], node[some] - a, y[some], weight[some], kept, columns, bins, s.min_leaf))
        gain, f, b, below = (np.concatenate(v) for v in zip(*best))
        split = gain > LEAST_GAIN
        children = made + 2 * np.arange(split.sum())
        feature[ids[split]], cut[ids[split]], left[ids[split]] = f[split], b[split], children
        feature, cut, left = (np.append(column, np.full(2 * len(children), v)) for column, v in ((feature, -1), (cut, 0), (left, 0)))
        fresh = np.stack([below[split], whole[split] - below[split]], axis=1).reshape(-1, classes)
        counts.append(fresh)
        made += len(fresh)
        goes_on = ((fresh > 0).sum(axis=1) > 1) & (fresh.sum(axis=1) >= 2 * s.min_leaf)
        high = x[f[node], rows] > b[node]
        child = 2 * (np.cumsum(split) - 1)[node] + high
        keep = split[node] & np.append(goes_on, False)[np.where(split[node], child, -1)]
        rows, y, weight, high, node = rows[keep], y[keep], weight[keep], high[keep], (np.cumsum(goes_on) - 1)[child[keep]]
        # the lower rows of a parent go before its higher ones, which keeps rows by node
        place, size = np.empty(len(rows), np.int64), np.bincount(node, minlength=int(goes_on.sum()))
        start = np.concatenate([[0], np.cumsum(size)])
        for side in (np.flatnonzero(~high), np.flatnonzero(high)):
            here = node[side]
            place[side] = start[here] + np.arange(len(side)) - np.searchsorted(here, here)
        order = np.empty_like(place)
        order[place] = np.arange(len(place))
        rows, y, weight, node = rows[order], y[order], weight[order], node[order]
        ids, whole = (children[:, None] + np.arange(2)).ravel()[goes_on], fresh[goes_on]
    leaf, counts = np.flatnonzero(feature < 0), np.concatenate(counts)
    left[leaf] = np.arange(len(leaf))
    part = counts[leaf] / np.maximum(counts[leaf].sum(axis=1, keepdims=True), 1.0)
    return Tree(feature.astype("int16"), cut.astype("uint16"), left.astype("int32"), (np.round(part / GRAIN) * GRAIN).astype("float32"))


def _grown_in_tasks(rows: RDD, models: Sequence[Model], classes: int, bins: int, of) -> RDD:
    """``of`` gets a task's rows (bins, class, fold), and its trees as (model, tree number, tree) one after another."""
    units = [(m, t) for m, model in enumerate(models) for t in range(model.settings.trees)]

    def run(blocks: list[Block]) -> Iterator:
        x = np.ascontiguousarray(np.concatenate([b.x for b in blocks]).T)
        y, fold = (np.concatenate([getattr(b, c) for b in blocks]) for c in ("y", "fold"))
        places, mine = np.arange(len(y), dtype=np.uint64), [u for k, u in enumerate(units) if blocks[0].serves(k)]

        def trees() -> Iterator[tuple[int, int, Tree]]:
            for m, t in mine:
                s = models[m].settings
                weight = np.searchsorted(DRAWN, shares(places, s.seed, t), side="right") if s.drawn else np.ones(len(y), dtype=np.int64)
                weight[fold == models[m].left_out] = 0
                yield m, t, grown(x, y, weight, classes, bins, s, t)

        return of(x, y, fold, trees())

    return for_models(rows, len(units), run)


def fit(rows: RDD, models: Sequence[Model], classes: int, cuts: Sequence[np.ndarray], folds: int = 1) -> tuple[list[Forest | None], np.ndarray]:
    """The forests that see all rows, and per model the rows and hits (2 columns) of the fold it did not see.

    ``rows`` are blocks of raw features that ``in_tasks`` allows.
    """
    bins, hits, made = max(map(len, cuts), default=0) + 1, np.zeros((len(models), 2)), [None] * len(models)
    rows = rows.map(lambda b: replace(b, x=binned(np.nan_to_num(b.x), cuts)))
    judged = [m for m, model in enumerate(models) if model.left_out >= 0]
    if judged:

        def votes(x: np.ndarray, y: np.ndarray, fold: np.ndarray, trees: Iterator) -> Iterator[tuple]:
            last, held = -1, None
            for m, _, tree in trees:
                if m != last:
                    if held is not None:
                        yield last, (held, y[i])
                    i = np.flatnonzero(fold == models[judged[m]].left_out)
                    last, held, asked = m, 0.0, np.ascontiguousarray(x[:, i])
                held = held + tree.votes(asked).astype(float)
            if held is not None:
                yield last, (held, y[i])

        sums = _grown_in_tasks(rows, [models[m] for m in judged], classes, bins, votes).reduceByKey(lambda a, b: (a[0] + b[0], a[1]), min(len(judged), rows.context.defaultParallelism))
        for m, n, good in sums.map(lambda t: (t[0], len(t[1][1]), int((t[1][0].argmax(axis=1) == t[1][1]).sum()) if len(t[1][1]) else 0)).collect():
            hits[judged[m]] = n, good
    for m, model in enumerate(models):
        if model.left_out < 0:
            packed = _grown_in_tasks(rows, [model], classes, bins, lambda x, y, fold, trees: ((t, *tree.packed()) for _, t, tree in trees))
            spark, path = SparkSession.getActiveSession(), fresh_path(SparkSession.getActiveSession(), "forest")
            spark.createDataFrame(packed, TREES, verifySchema=False).write.parquet(path)
            made[m] = Forest(path, tuple(map(tuple, (c.tolist() for c in cuts))), classes)
    return made, hits
