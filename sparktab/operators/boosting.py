"""Gradient-boosted trees: many ensembles grown together in the same passes.

Features are put into bins once. Gradients, hessians and rows are added up per (tree, leaf,
feature, bin), and cuts are chosen where these sums lie, in tasks; the driver gets cuts.

* As long as the binned rows are worth no more than ``TASK_BYTES``, each task gets them with its share
  of the models and takes these through all rounds, so that a fit is one job. Of two siblings
  only the smaller one is added up, the other is its parent's histogram less that.
* More rows stay where they are. A pass adds up the open leaves of all models in tasks and
  chooses their cuts in others. All candidates, folds and classes share each pass, so the
  number of passes is that of the longest ensemble, whatever the number of models.

Trees grow in one of three ways:

* ``level``: every leaf that gains is split, down to ``depth``,
* ``leaf``: the leaf that gains most is split until there are ``leaves``. A step expands all
  leaves that may still be chosen, so a tree takes about as many steps as it is deep,
* ``symmetric``: all leaves of a level are split by the one cut that gains most in sum.

Gains are second-order with an L2 penalty. Two classes have one logistic margin; more have one
tree per class and round under shared softmax probabilities, which need no normalising.
"""

from __future__ import annotations

import json
import math
import operator
from collections.abc import Iterator, Sequence
from dataclasses import asdict, dataclass, field, fields, replace

import numpy as np
from pyspark import RDD
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.operators.blocks import Block, for_models, moved_on, shares, spread, total

BINS = 64
#: Memory of the rows in a task that takes ensembles through all rounds; more rows are gone over in passes.
TASK_BYTES = 128 << 20
#: Histogram bytes that one task chooses cuts from at once, and those of a pass; more models make more runs.
PASS_BYTES, OPEN_BYTES = 16 << 20, 256 << 20
#: Rounds between two cuts of the lineage.
CUT_EVERY = 16
#: Gains this close count as equal; the first feature and the lowest cut win.
TIE = 1e-9


@dataclass(frozen=True)
class Settings:
    """``depth`` 0 has no limit (with ``leaf`` growth only)."""

    growth: str = "level"
    rounds: int = 100
    rate: float = 0.3
    depth: int = 6
    leaves: int = 31
    l2: float = 1.0
    min_gain: float = 0.0
    min_leaf: int = 1
    min_hessian: float = 1.0
    row_share: float = 1.0
    column_share: float = 1.0
    seed: int = 54

    def most_leaves(self) -> int:
        return self.leaves if self.growth == "leaf" else 2**self.depth


@dataclass
class Tree:
    """Nodes as arrays; node 0 is the root, ``feature`` is -1 in leaves. Up to ``cut`` goes left."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        return leaf_of(x, self.feature, self.cut, self.left, self.right)


def leaf_of(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The leaf of each row. A missing value is on no cut's lower side: it goes right."""
    at = np.zeros(len(x), dtype=np.int64)
    todo = np.arange(len(x)) if feature[0] >= 0 else np.empty(0, dtype=np.int64)
    while len(todo):
        here = at[todo]
        at[todo] = np.where(x[todo, feature[here]] <= cut[here], left[here], right[here])
        todo = todo[feature[at[todo]] >= 0]
    return at


@dataclass
class Ensemble:
    """Start margins and, per round, one tree per output."""

    classes: int
    rate: float
    start: list[float]
    rounds: list[list[Tree]] = field(default_factory=list)

    def margins(self, x: np.ndarray) -> np.ndarray:
        out = np.tile(np.array(self.start), (len(x), 1))
        for trees in self.rounds:
            for k, tree in enumerate(trees):
                out[:, k] += self.rate * tree.value[tree.leaf_of(x)]
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return probabilities(self.margins(x).T).T

    def to_json(self) -> str:
        trees = [[{k: np.asarray(v).tolist() for k, v in asdict(t).items()} for t in r] for r in self.rounds]
        return json.dumps({"classes": self.classes, "rate": self.rate, "start": self.start, "rounds": trees})

    @staticmethod
    def from_json(text: str) -> Ensemble:
        found = json.loads(text)
        found["rounds"] = [[Tree(**{k: np.array(v) for k, v in t.items()}) for t in r] for r in found["rounds"]]
        return Ensemble(**found)


def probabilities(margins: np.ndarray) -> np.ndarray:
    """(outputs, rows) to (classes, rows): logistic for one output, softmax for more."""
    if len(margins) == 1:
        p = 1.0 / (1.0 + np.exp(-np.clip(margins[0], -500, 500)))
        return np.stack([1.0 - p, p])
    e = np.exp(margins - margins.max(axis=0))
    return e / e.sum(axis=0)


def slopes(margins: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and hessian of the log loss by each output's margin."""
    p = probabilities(margins)
    if len(margins) == 1:
        p = p[1:]
        hit = (y == 1)[None, :]
    else:
        hit = y[None, :] == np.arange(len(margins))[:, None]
    return p - hit, p * (1.0 - p)


def fit_cuts(df: DataFrame, features: Sequence[str | Column], bins: int = BINS) -> list[np.ndarray]:
    """At most ``bins - 1`` cuts per feature, at its quantiles; a value up to a cut is below it."""
    wanted = [i / bins for i in range(1, bins)]
    columns = [F.col(f"`{c}`") if isinstance(c, str) else c for c in features]
    row = df.agg(*[F.percentile_approx(F.nanvl(c.cast("double"), F.lit(None)), wanted, 10_000).alias(f"q{i}") for i, c in enumerate(columns)]).first()
    return [np.unique(np.array(row[f"q{i}"] or [], dtype="float64")) for i in range(len(features))]


def binned(x: np.ndarray, cuts: Sequence[np.ndarray]) -> np.ndarray:
    """Each value's number of cuts below it; a missing value is above all."""
    return np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1).astype(np.uint8 if max(map(len, cuts), default=0) < 256 else np.uint16)


# ------------------------------------------------------------------------ growing


def _score(sums: np.ndarray, l2: float) -> np.ndarray:
    """``sums``: (leaf, gradient and so on, ...)."""
    bottom = sums[:, 1] + l2
    return np.where(bottom > 0, sums[:, 0] ** 2 / np.where(bottom > 0, bottom, 1.0), 0.0)


@dataclass
class Offers:
    """The cuts that gain most: one for each leaf, or with ``symmetric`` growth one for all of them.
    ``low`` and ``whole`` are each leaf's gradient, hessian and rows below the cut and in all."""

    gain: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    low: np.ndarray
    whole: np.ndarray


def offers(hist: np.ndarray, s: Settings, columns: np.ndarray) -> Offers:
    """Tries every (feature, bin) cut of the leaves. ``hist``: (leaf, 3, feature, bin)."""
    low = hist.cumsum(axis=3)
    whole = low[:, :, :1, -1:]
    high = whole - low
    gain = 0.5 * (_score(low, s.l2) + _score(high, s.l2) - _score(whole, s.l2))
    gain[:, ~columns] = -np.inf
    if s.growth == "symmetric":
        gain = gain.sum(axis=0, keepdims=True)
    else:
        ok = (low[:, 2] >= s.min_leaf) & (high[:, 2] >= s.min_leaf) & (low[:, 1] >= s.min_hessian) & (high[:, 1] >= s.min_hessian)
        gain = np.where(ok, gain, -np.inf)
    flat = gain.reshape(len(gain), -1)
    top = flat.max(axis=1)
    feature, cut = np.divmod((flat >= (top - TIE * np.abs(top))[:, None]).argmax(axis=1), hist.shape[3])
    return Offers(top, feature, cut, low[np.arange(len(hist)), :, feature, cut], whole[:, :, 0, 0])


class Growing:
    """A tree while it grows: what is known of its leaves, and which of them it waits for."""

    def __init__(self, s: Settings, columns: np.ndarray) -> None:
        self.s, self.columns = s, columns
        self.feature, self.bin, self.left, self.right = [-1], [0], [-1], [-1]
        self.depth, self.sums, self.gain = [0], [np.zeros(3)], [0.0]
        self.parent = [-1]
        #: (gain, feature, bin, sums below) of leaves that may be split, and of those whose parent is not split for good.
        self.best: dict[int, tuple[float, int, int, np.ndarray]] = {}
        self.parked: dict[int, tuple[float, int, int, np.ndarray]] = {}
        self.kept: set[int] = set()
        self.waits: dict[int, tuple[int, int]] = {0: (-1, -1)}  # wanted leaf: (parent, its larger sibling, wanted too)

    def wanted(self) -> np.ndarray:
        """All leaves that it waits for."""
        return np.array(sorted({*self.waits, *(large for _, large in self.waits.values() if large >= 0)}), dtype=np.int64)

    def routes(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array(v, dtype=np.int64) for v in (self.feature, self.bin, self.left, self.right))

    def _split(self, node: int, f: int, b: int, low: np.ndarray) -> tuple[int, int]:
        a = len(self.feature)
        self.feature[node], self.bin[node], self.left[node], self.right[node] = f, b, a, a + 1
        for sums in (low, self.sums[node] - low):
            columns = (self.feature, self.bin, self.left, self.right, self.parent, self.depth, self.sums, self.gain)
            for column, value in zip(columns, (-1, 0, -1, -1, node, self.depth[node] + 1, sums, 0.0)):
                column.append(value)
        return a, a + 1

    def _ask(self, node: int) -> None:
        """Waits for the children."""
        a, b = self.left[node], self.right[node]
        small, large = (a, b) if self.sums[a][2] <= self.sums[b][2] else (b, a)
        self.waits[small] = (node, large)

    def take(self, found: Offers) -> None:
        """The offers for the leaves waited for; goes on as far as they allow."""
        level = self.wanted().tolist()
        if level == [0]:
            self.sums[0] = found.whole[0]
        self.waits.clear()
        if self.s.growth == "symmetric":
            self._level_by_one_cut(level, found)
            return
        for node, top, f, b, low in zip(level, found.gain.tolist(), found.feature.tolist(), found.bin.tolist(), found.low):
            if top > self.s.min_gain and top > 0:
                chosen = self.parent[node] < 0 or self.parent[node] in self.kept or self.s.growth == "level"
                (self.best if chosen else self.parked)[node] = (top, f, b, low)
        if self.s.growth == "level":
            self._level(level)
        else:
            self._best_first()

    def _open(self, node: int) -> bool:
        return not self.s.depth or self.depth[node] < self.s.depth

    def _level(self, fresh: list[int]) -> None:
        for node in sorted(n for n in fresh if n in self.best):
            gain, f, b, low = self.best.pop(node)
            self.gain[node] = gain
            self.kept.add(node)
            children = self._split(node, f, b, low)
            if self._open(children[0]):
                self._ask(node)

    def _level_by_one_cut(self, level: list[int], found: Offers) -> None:
        top, f, b = float(found.gain[0]), int(found.feature[0]), int(found.bin[0])
        if not top > max(self.s.min_gain, 0.0):
            return
        for node, low in zip(level, found.low):
            self.gain[node] = top
            self.kept.add(node)
            a, _ = self._split(node, f, b, low)
            if self._open(a):
                self._ask(node)

    def _expand(self, node: int) -> None:
        """Splits a leaf for the time being and waits for its children, if they may be split in turn."""
        _, f, b, low = self.best[node]
        if self._open(self._split(node, f, b, low)[0]):
            self._ask(node)

    def _best_first(self) -> None:
        """Splits the leaf that gains most for good as long as its children are known; then
        expands all leaves that may still be chosen."""
        order = lambda n: (-self.best[n][0], n)
        while self.best and len(self.kept) + 1 < self.s.leaves:
            node = min(self.best, key=order)
            if self.left[node] < 0:
                if len(self.kept) + 2 < self.s.leaves:
                    for other in sorted(self.best, key=order)[: self.s.leaves - 1 - len(self.kept)]:
                        if self.left[other] < 0:
                            self._expand(other)
                    if any(parent == node for parent, _ in self.waits.values()):
                        return
                else:
                    self._split(node, *self.best[node][1:])
            self.gain[node] = self.best.pop(node)[0]
            self.kept.add(node)
            for child in (self.left[node], self.right[node]):
                if child in self.parked:
                    self.best[child] = self.parked.pop(child)
        self.waits.clear()

    def leaves_for_good(self) -> np.ndarray:
        """Of each node itself, or the leaf above it if it was split for the time being only."""
        out = np.arange(len(self.feature))
        for node, parent in enumerate(self.parent):
            if parent >= 0 and parent not in self.kept:
                out[node] = out[parent]
        return out

    def finished(self, cuts: Sequence[np.ndarray]) -> tuple[Tree, Tree]:
        """The tree over bins and the one over values. Expanded leaves that were not chosen are leaves."""
        inner = np.array([n in self.kept for n in range(len(self.feature))])
        sums = np.array(self.sums)
        bottom = sums[:, 1] + self.s.l2
        value = np.where(inner | (bottom <= 0), 0.0, -sums[:, 0] / np.where(bottom > 0, bottom, 1.0))
        feature = np.where(inner, self.feature, -1)
        rest = (np.array(self.left), np.array(self.right), value, np.array(self.gain), sums[:, 2])
        edge = np.array([cuts[f][b] if f >= 0 and b < len(cuts[f]) else math.inf for f, b in zip(feature, self.bin)])
        return Tree(feature, np.array(self.bin), *rest), Tree(feature, edge, *rest)


@dataclass(frozen=True)
class Model:
    """One ensemble to fit: its settings and the fold that it does not see (-1: sees all)."""

    settings: Settings
    left_out: int = -1

    def sees(self, fold: np.ndarray, row: np.ndarray, number: int) -> np.ndarray:
        keep = fold != self.left_out
        if self.settings.row_share < 1.0:
            keep &= shares(row, self.settings.seed, number) < self.settings.row_share
        return keep

    def begin(self, number: int, output: int, width: int) -> Growing:
        """The tree of a round and an output before its first cut."""
        s, columns = self.settings, np.ones(width, dtype=bool)
        if s.column_share < 1.0:
            rng = np.random.default_rng([s.seed, number, output])
            columns = np.isin(np.arange(width), rng.choice(width, max(1, round(width * s.column_share)), replace=False))
        return Growing(s, columns)


def histograms(x: np.ndarray, slot: np.ndarray, leaves: int, bins: int, g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """(leaf, 3, feature, bin) of the rows that have a ``slot``. ``x``: (feature, row)."""
    rows = np.flatnonzero(slot >= 0)
    first, g, h, size = slot[rows] * bins, g[rows], h[rows], leaves * bins
    out = np.empty((leaves, 3, len(x), bins))
    for f, values in enumerate(x):
        flat = first + values[rows]
        for k, weights in enumerate((g, h, None)):
            out[:, k, f] = np.bincount(flat, weights, size).reshape(leaves, bins)
    return out


def _slots(nodes: Sequence[int], size: int) -> np.ndarray:
    """The place of each node of a tree among some, or -1."""
    slot = np.full(size, -1)
    slot[nodes] = np.arange(len(nodes))
    return slot


# -------------------------------------------------------------- ensembles in tasks


def _moved(at: np.ndarray, x: np.ndarray, routes: tuple[np.ndarray, ...]) -> None:
    """Takes rows from split nodes to the leaves below them."""
    feature, cut, left, right = routes
    todo = np.flatnonzero(left[at] >= 0)
    while len(todo):
        here = at[todo]
        at[todo] = np.where(x[feature[here], todo] <= cut[here], left[here], right[here])
        todo = todo[left[at[todo]] >= 0]


def _tree(growing: Growing, x: np.ndarray, keep: np.ndarray, g: np.ndarray, h: np.ndarray, bins: int) -> np.ndarray:
    """Grows a tree to its end; the leaf of each row, seen or not."""
    at, held = np.zeros(x.shape[1], dtype=np.int64), {}
    while growing.waits:
        small = sorted(growing.waits)
        slot = np.where(keep, _slots(small, len(growing.feature))[at], -1)
        held.update(zip(small, histograms(x, slot, len(small), bins, g, h)))
        for node, (parent, large) in growing.waits.items():
            if large >= 0:
                held[large] = held.pop(parent) - held[node]
        growing.take(offers(np.stack([held[n] for n in growing.wanted()]), growing.s, growing.columns))
        _moved(at, x, growing.routes())
    return growing.leaves_for_good()[at]


def _ensemble(model: Model, found: Ensemble, x: np.ndarray, y: np.ndarray, fold: np.ndarray, row: np.ndarray, cuts: Sequence[np.ndarray], bins: int) -> np.ndarray:
    """Takes an ensemble through all its rounds; rows and hits of the fold that it does not see."""
    margins = np.repeat(np.array(found.start)[:, None], len(y), axis=1)
    for number in range(model.settings.rounds):
        keep, (g, h) = model.sees(fold, row, number), slopes(margins, y)
        found.rounds.append([])
        for k in range(len(margins)):
            growing = model.begin(number, k, len(cuts))
            leaf = _tree(growing, x, keep, g[k], h[k], bins)
            by_bin, by_value = growing.finished(cuts)
            margins[k] += found.rate * by_bin.value[leaf]
            found.rounds[-1].append(by_value)
    i = np.flatnonzero(fold == model.left_out)
    return np.array([len(i), (probabilities(margins[:, i]).argmax(axis=0) == y[i]).sum()], dtype=float)


def _fit_in_tasks(rows: RDD, models: Sequence[Model], begun: Sequence[Ensemble], cuts: Sequence[np.ndarray], bins: int) -> tuple[list[Ensemble], np.ndarray]:
    """All rows with a share of the models in each task."""

    def fitted(blocks: list[Block]) -> Iterator[tuple[int, Ensemble, np.ndarray]]:
        x = np.concatenate([b.x.T for b in blocks], axis=1)
        y, fold, row = (np.concatenate([getattr(b, c) for b in blocks]) for c in ("y", "fold", "row"))
        for m, model in enumerate(models):
            if blocks[0].serves(m):
                found = replace(begun[m], rounds=[])
                yield m, found, _ensemble(model, found, x, y, fold, row, cuts, bins)

    made = sorted(for_models(rows.map(lambda b: replace(b, x=binned(b.x, cuts))), len(models), fitted).collect(), key=lambda t: t[0])
    return [found for _, found, _ in made], np.stack([hits for _, _, hits in made])


# ------------------------------------------------------------------------- passes


def _cuts_of_pass(rows: RDD, asked: list[tuple], models: Sequence[Model], bins: int, number: int) -> dict[tuple[int, int], Offers]:
    """``asked``: (model, output, routes, leaves wanted, columns). Sums are added up by model and
    output, and the cuts chosen from them, in tasks; per (model, output) the offers come back."""

    def part(blocks: Iterator[Block]) -> Iterator[tuple[int, np.ndarray]]:
        held = [replace(b, x=np.ascontiguousarray(b.x.T)) for b in blocks]
        wanted = [(i, a) for i, a in enumerate(asked) if held and held[0].serves(a[0])]
        for m in sorted({a[0] for _, a in wanted}):
            keeps = [models[m].sees(b.fold, b.row, number) for b in held]
            steep = [slopes(b.state[m], b.y) for b in held]
            for i, (_, k, routes, leaves, _) in (w for w in wanted if w[1][0] == m):
                slots, found = _slots(leaves, len(routes[0])), 0.0
                for b, keep, (g, h) in zip(held, keeps, steep):
                    slot = np.where(keep, slots[leaf_of(b.x.T, *routes)], -1)
                    found = found + histograms(b.x, slot, len(leaves), bins, g[k], h[k])
                yield i, found

    def chosen(i: int, hist: np.ndarray) -> tuple[int, Offers]:
        return i, offers(hist, models[asked[i][0]].settings, asked[i][4])

    tasks = min(len(asked), rows.context.defaultParallelism)
    sums = rows.mapPartitions(part).reduceByKey(operator.add, tasks, lambda i: i)
    found: dict[tuple[int, int], list[Offers]] = {}
    for i, one in sorted(sums.map(lambda kv: chosen(*kv)).collect(), key=lambda t: t[0]):
        found.setdefault(asked[i][:2], []).append(one)
    joined = lambda some: Offers(*[np.concatenate([getattr(o, f.name) for o in some]) for f in fields(Offers)])
    return {key: joined(some) for key, some in found.items()}


def _in_parts(m: int, k: int, growing: Growing, leaf_bytes: int) -> list[tuple]:
    """A tree's wanted leaves, in parts of up to ``PASS_BYTES`` if they can be judged apart."""
    leaves = growing.wanted()
    size = len(leaves) if growing.s.growth == "symmetric" else max(1, PASS_BYTES // leaf_bytes)
    return [(m, k, growing.routes(), leaves[at : at + size], growing.columns) for at in range(0, len(leaves), size)]


def _added(done: list[tuple]):
    """``done``: (model, output, tree over bins, rate)."""

    def step(block: Block) -> Block:
        state = block.state.copy()
        for m, k, tree, rate in done:
            if block.serves(m):
                state[m, k] += rate * tree.value[tree.leaf_of(block.x)]
        return replace(block, state=state)

    return step


def _fit_in_passes(rows: RDD, models: Sequence[Model], ensembles: Sequence[Ensemble], cuts: Sequence[np.ndarray], bins: int) -> np.ndarray:
    """Rows stay where they are. Takes the ensembles to their end; rows and hits."""
    width, starts = len(cuts), np.array([e.start for e in ensembles])
    per_leaf, outputs = width * bins * 24, starts.shape[1]

    def begin(block: Block) -> Block:
        return replace(block, x=binned(block.x, cuts), state=np.repeat(starts[:, :, None], len(block.y), axis=2))

    dealt = spread(rows, len(models))
    last, state = None, moved_on(dealt, begin, False)
    for number in range(max(m.settings.rounds for m in models)):
        growing = {(m, k): model.begin(number, k, width) for m, model in enumerate(models) if number < model.settings.rounds for k in range(outputs)}
        while asked := [part for (m, k), g in growing.items() if g.waits for part in _in_parts(m, k, g, per_leaf)]:
            for key, found in _cuts_of_pass(state, asked, models, bins, number).items():
                growing[key].take(found)
            if last is not None:  # the new state is there now
                last, _ = None, last.unpersist()
        done = []
        for (m, k), g in growing.items():
            by_bin, by_value = g.finished(cuts)
            if k == 0:
                ensembles[m].rounds.append([])
            ensembles[m].rounds[-1].append(by_value)
            done.append((m, k, by_bin, models[m].settings.rate))
        last, state = state, moved_on(state, _added(done), number % CUT_EVERY == CUT_EVERY - 1)

    def judged(block: Block) -> np.ndarray:
        out = np.zeros((len(models), 2))
        for m, model in enumerate(models):
            i = np.flatnonzero((block.fold == model.left_out) & block.serves(m))
            out[m] = len(i), (probabilities(block.state[m][:, i]).argmax(axis=0) == block.y[i]).sum()
        return out

    hits = total(state, judged)
    state.unpersist()
    if last is not None:
        last.unpersist()
    if dealt is not rows:
        dealt.unpersist()
    return hits


def class_counts(rows: RDD, classes: int, folds: int) -> np.ndarray:
    """Rows per (fold, class)."""
    return total(rows, lambda b: np.bincount(b.fold * classes + b.y, minlength=folds * classes).reshape(folds, classes))


def _begun(model: Model, counts: np.ndarray, classes: int) -> Ensemble:
    """An ensemble of no rounds, with the margins of the classes' shares among the rows that it sees."""
    n = counts.sum(axis=0) - (counts[model.left_out] if model.left_out >= 0 else 0)
    log_share = np.log(np.maximum(n, 1e-9) / max(n.sum(), 1e-9))
    start = [float(log_share[1] - log_share[0])] if classes == 2 else [float(v) for v in log_share]
    return Ensemble(classes, model.settings.rate, start)


def fit(rows: RDD, models: Sequence[Model], classes: int, cuts: Sequence[np.ndarray], folds: int = 1) -> tuple[list[Ensemble], np.ndarray]:
    """All models' ensembles, and per model the rows and hits (2 columns) of the fold it did not see.

    ``rows`` are blocks of raw features. Models are fitted together: whole in tasks if the rows are
    worth no more than ``TASK_BYTES``, else in shared passes as far as ``OPEN_BYTES`` allows.
    """
    width, bins, outputs = len(cuts), max(map(len, cuts), default=0) + 1, 1 if classes == 2 else classes
    counts = class_counts(rows, classes, folds)
    ensembles = [_begun(m, counts, classes) for m in models]
    if counts.sum() * (width + 32 * outputs + 96) <= TASK_BYTES:
        return _fit_in_tasks(rows, models, ensembles, cuts, bins)
    hits, runs, held = [], [[]], 0
    for m, model in enumerate(models):
        size = outputs * model.settings.most_leaves() * width * bins * 24
        if runs[-1] and held + size > OPEN_BYTES:
            runs.append([])
            held = 0
        runs[-1].append(m)
        held += size
    for run in runs:
        hits.append(_fit_in_passes(rows, [models[m] for m in run], [ensembles[m] for m in run], cuts, bins))
    return ensembles, np.concatenate(hits)
