"""Models fitted by gradients: many candidates and folds in the same passes.

A pass evaluates every model at its own trial weights and adds up losses and gradients over
all rows, in each task first and then in a tree. What kernel machines see of a row is worked out
once for all that see it alike, and their products are one. The driver holds one vector of weights per
model and moves each by L-BFGS with its own line search. The number of passes is that of the
slowest model, whatever the number of models. Networks move by Adam on mini-batches: groups of
rows go through whole epochs in their tasks, and the groups' weights are averaged in between.

Learners are small values: logistic regression, a squared-hinge machine with one plane
per pair of classes, on the inputs or on random Fourier features of an RBF kernel, and a
network of any layers with relu, tanh or logistic units and an L2 penalty. The kernel may
also be given by landmark rows.
"""

from __future__ import annotations

import copy
import functools
import json
import math
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, replace

import numpy as np
from pyspark import RDD

from sparktab.operators.blocks import Block, Sums, shares, spread, total, total_by_key
from sparktab.operators.landmarks import Landmarks

#: Pairs of differences that L-BFGS remembers.
MEMORY = 10
#: Numbers of one pass over all models; more models make more passes.
PASS_NUMBERS = 1 << 22
#: Numbers of the scores that models which see rows alike have at once; more go over fewer rows at a time.
SCORE_NUMBERS = 1 << 17
#: Rows that one task takes through an epoch of mini-batches.
GROUP_ROWS = 1 << 20
#: Rows from which a group's steps are taken in single precision, in half the time.
SINGLE_ROWS = 1 << 13
#: Bytes of networks' weights and moments that come to the driver in a whole fit; more make fewer averages.
STATE_BYTES = 400 << 20


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class Logistic:
    """``C`` weighs the summed loss against half the squared weights."""

    inputs: int
    classes: int
    C: float = 1.0
    max_iter: int = 1000

    @property
    def size(self) -> int:
        return self.classes * (self.inputs + 1)

    def start(self, seed: int) -> np.ndarray:
        return np.zeros(self.size)

    def penalty(self, n: float) -> float:
        return 1.0 / (self.C * max(n, 1.0))

    def _parts(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        w = w.reshape(self.classes, self.inputs + 1)
        return w[:, :-1], w[:, -1]

    def scores(self, w: np.ndarray, x: np.ndarray) -> np.ndarray:
        weights, shift = self._parts(w)
        return softmax(x @ weights.T + shift)

    def loss(self, w: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        p = self.scores(w, x)
        at = np.arange(len(y))
        value = -np.log(np.maximum(p[at, y], 1e-300)).sum()
        p[at, y] -= 1.0
        return value, np.concatenate([p.T @ x, p.sum(axis=0)[:, None]], axis=1).ravel()

    def alike(self) -> tuple:
        """Models for which this is equal have their losses in one go."""
        return "logistic", self.inputs, self.classes

    def losses(self, ws: np.ndarray, x: np.ndarray, y: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``loss`` for each row of ``ws`` over the rows in its column of ``keep``."""
        w = ws.reshape(len(ws), self.classes, self.inputs + 1)
        scores, hits = [x @ w[:, c, :-1].T + w[:, c, -1] for c in range(self.classes)], [(y == c)[:, None] for c in range(self.classes)]
        top = functools.reduce(np.maximum, scores)  # class by class, as a reduction along few classes is slow
        own = functools.reduce(np.add, (z * hit for z, hit in zip(scores, hits)))
        scores = [np.exp(z - top) for z in scores]
        whole = functools.reduce(np.add, scores)
        values = (np.minimum(top + np.log(whole) - own, -math.log(1e-300)) * keep).sum(axis=0)
        grads = np.empty_like(w)
        for c, hit in enumerate(hits):
            slope = (scores[c] / whole - hit) * keep
            grads[:, c, :-1], grads[:, c, -1] = slope.T @ x, slope.sum(axis=0)
        return values, grads.reshape(len(ws), -1)

    def weighed(self, w: np.ndarray) -> np.ndarray:
        """Which weights the penalty takes: all but the shifts."""
        m = np.ones((self.classes, self.inputs + 1))
        m[:, -1] = 0.0
        return m.ravel()


@dataclass(frozen=True)
class PairMachine:
    """Squared hinge, one plane per pair of classes; the class with most votes wins.

    ``components`` random Fourier features stand for the kernel exp(-gamma * squared
    distance); 0 takes the inputs as they are. ``gamma`` 0 is 1 / inputs.
    """

    inputs: int
    classes: int
    C: float = 1.0
    components: int = 0
    gamma: float = 0.0
    seed: int = 54
    max_iter: int = 200

    @property
    def pairs(self) -> list[tuple[int, int]]:
        return [(a, b) for a in range(self.classes) for b in range(a + 1, self.classes)]

    @property
    def width(self) -> int:
        return self.components or self.inputs

    @property
    def size(self) -> int:
        return len(self.pairs) * (self.width + 1)

    def start(self, seed: int) -> np.ndarray:
        return np.zeros(self.size)

    def penalty(self, n: float) -> float:
        return 1.0 / (self.C * max(n, 1.0))

    def seen(self, x: np.ndarray) -> np.ndarray:
        if not self.components:
            return x
        rng = np.random.default_rng(self.seed)
        gamma = self.gamma or 1.0 / self.inputs
        directions = rng.normal(scale=math.sqrt(2 * gamma), size=(self.inputs, self.components))
        return math.sqrt(2.0 / self.components) * np.cos(x @ directions + rng.uniform(0, 2 * math.pi, self.components))

    def planes(self, w: np.ndarray, x: np.ndarray) -> np.ndarray:
        w = w.reshape(len(self.pairs), self.width + 1)
        return self.seen(x) @ w[:, :-1].T + w[:, -1]

    def scores(self, w: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Votes, and under one vote the margins, as shares of the classes."""
        margins = self.planes(w, x)
        out = np.zeros((len(x), self.classes))
        for k, (a, b) in enumerate(self.pairs):
            for c, m in ((a, -margins[:, k]), (b, margins[:, k])):
                out[:, c] += (m > 0) + (0.5 + 0.5 * np.tanh(m)) / (3.0 * self.classes)
        return softmax(2.0 * out) if self.classes > 2 else _two(margins[:, 0])

    def loss(self, w: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        z, weights = self.seen(x), w.reshape(len(self.pairs), self.width + 1)
        value, grad = 0.0, np.zeros_like(weights)
        for k, (a, b) in enumerate(self.pairs):
            at = np.flatnonzero((y == a) | (y == b))
            side = np.where(y[at] == b, 1.0, -1.0)
            short = np.maximum(0.0, 1.0 - side * (z[at] @ weights[k, :-1] + weights[k, -1]))
            value += (short**2).sum()
            slope = -2.0 * short * side
            grad[k, :-1], grad[k, -1] = slope @ z[at], slope.sum()
        return value, grad.ravel()

    def alike(self) -> tuple:
        return replace(self, C=1.0, max_iter=0), len(self.pairs)

    def losses(self, ws: np.ndarray, x: np.ndarray, y: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``loss`` for each row of ``ws`` over the rows in its column of ``keep``; what machines see is worked out once."""
        seen, weights = self.seen(x), ws.reshape(len(ws), len(self.pairs), self.width + 1)
        values, grads = np.zeros(len(ws)), np.zeros_like(weights)
        for k, (a, b) in enumerate(self.pairs):
            at = slice(None) if self.classes == 2 else np.flatnonzero((y == a) | (y == b))
            z, side = seen[at], np.where(y[at] == b, 1.0, -1.0)[:, None]
            short = np.maximum(0.0, 1.0 - side * (z @ weights[:, k, :-1].T + weights[:, k, -1])) * keep[at]
            values += (short**2).sum(axis=0)
            short *= -2.0 * side
            grads[:, k, :-1], grads[:, k, -1] = short.T @ z, short.sum(axis=0)
        return values, grads.reshape(len(ws), -1)

    def weighed(self, w: np.ndarray) -> np.ndarray:
        m = np.ones((len(self.pairs), self.width + 1))
        m[:, -1] = 0.0
        return m.ravel()


@dataclass(frozen=True)
class LandmarkMachine(PairMachine):
    """A ``PairMachine`` on whitened kernel values to landmark rows (``components`` of them), which
    ``with_landmarks`` sets from the data."""

    components: int = 100
    points: tuple = ()
    whiten: tuple = ()

    @property
    def width(self) -> int:
        return len(self.whiten[0]) if self.whiten else self.components

    def with_landmarks(self, found: Landmarks) -> LandmarkMachine:
        return replace(self, points=tuple(map(tuple, found.points.tolist())), whiten=tuple(map(tuple, found.whiten.tolist())), gamma=found.gamma)

    def seen(self, x: np.ndarray) -> np.ndarray:
        return Landmarks(np.array(self.points), np.array(self.whiten), self.gamma).features(x)


def _two(margin: np.ndarray) -> np.ndarray:
    p = 1.0 / (1.0 + np.exp(-np.clip(2.0 * margin, -500, 500)))
    return np.stack([1.0 - p, p], axis=1)


UNITS: dict[str, tuple[Callable, Callable]] = {
    "relu": (lambda z: np.maximum(z, 0.0), lambda a: (a > 0).astype(float)),
    "tanh": (np.tanh, lambda a: 1.0 - a * a),
    "logistic": (lambda z: 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))), lambda a: a * (1.0 - a)),
}


@dataclass(frozen=True)
class Network:
    """Layers of units and a softmax; ``alpha`` halves the squared weights, shared by the rows.

    ``solver`` ``adam`` takes mini-batches of about ``batch`` rows and stops when ten epochs gain less
    than 0.0001 (over ``GROUP_ROWS`` rows, each group takes its own and weights are averaged); ``lbfgs`` takes all rows, in as many passes as steps.
    """

    inputs: int
    classes: int
    hidden: tuple[int, ...] = (100,)
    activation: str = "relu"
    alpha: float = 0.0001
    solver: str = "adam"
    batch: int = 200
    rate: float = 0.001
    max_iter: int = 500

    @property
    def layers(self) -> list[tuple[int, int]]:
        sizes = [self.inputs, *self.hidden, self.classes]
        return list(zip(sizes[:-1], sizes[1:]))

    @property
    def size(self) -> int:
        return sum((a + 1) * b for a, b in self.layers)

    def start(self, seed: int) -> np.ndarray:
        rng, out = np.random.default_rng(seed), []
        for a, b in self.layers:
            bound = math.sqrt((2.0 if self.activation == "logistic" else 6.0) / (a + b))
            out.append(rng.uniform(-bound, bound, (a + 1) * b))
        return np.concatenate(out)

    def penalty(self, n: float) -> float:
        return self.alpha / max(n, 1.0)

    def _parts(self, w: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        out, at = [], 0
        for a, b in self.layers:
            part = w[at : at + (a + 1) * b].reshape(a + 1, b)
            out.append((part[:-1], part[-1]))
            at += (a + 1) * b
        return out

    def _forward(self, w: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
        unit, parts, seen = UNITS[self.activation][0], self._parts(w), [x]
        for weights, shift in parts[:-1]:
            seen.append(unit(seen[-1] @ weights + shift))
        weights, shift = parts[-1]
        return [*seen, softmax(seen[-1] @ weights + shift)]

    def scores(self, w: np.ndarray, x: np.ndarray) -> np.ndarray:
        return self._forward(w, x)[-1]

    def loss(self, w: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
        *seen, p = self._forward(w, x)
        slope, at, grads = UNITS[self.activation][1], np.arange(len(y)), []
        value = -np.log(np.maximum(p[at, y], 1e-300)).sum()
        back = p.copy()
        back[at, y] -= 1.0
        for k, (weights, _) in reversed(list(enumerate(self._parts(w)))):
            grads.append(np.concatenate([seen[k].T @ back, back.sum(axis=0)[None, :]]).ravel())
            if k:
                back = (back @ weights.T) * slope(seen[k])
        return value, np.concatenate(grads[::-1])

    def alike(self) -> tuple:
        return self, sum(b for _, b in self.layers)

    def losses(self, ws: np.ndarray, x: np.ndarray, y: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found = [self.loss(w, x[seen], y[seen]) for w, seen in zip(ws, keep.T)]
        return np.array([value for value, _ in found]), np.stack([grad for _, grad in found])

    def weighed(self, w: np.ndarray) -> np.ndarray:
        out = []
        for a, b in self.layers:
            m = np.ones((a + 1, b))
            m[-1] = 0.0
            out.append(m.ravel())
        return np.concatenate(out)


#: As ``UNITS``, in place and given zeros of that shape: the unit, and a gradient times the slope at what the unit gave.
IN_PLACE: dict[str, tuple[Callable, Callable]] = {
    "relu": (lambda z, zero: np.maximum(z, zero, out=z), lambda g, a: np.multiply(g, a > 0, out=g)),
    "tanh": (lambda z, zero: np.tanh(z, out=z), lambda g, a: np.multiply(g, np.subtract(1.0, np.multiply(a, a, out=a), out=a), out=g)),
    "logistic": (lambda z, zero: np.divide(1.0, 1.0 + np.exp(-np.clip(z, -80, 80)), out=z), lambda g, a: np.multiply(g, a * (1.0 - a), out=g)),
}
#: Up to so many classes are gone through one by one, which is faster than along rows.
FEW_CLASSES = 8


class _Steps:
    """What ``Network.loss`` gives, mini-batch by mini-batch, in arrays that are made once. Rows have
    a further feature, 1, whose weights are the first layer's shifts."""

    def __init__(self, learner: Network, weights: np.ndarray, most: int) -> None:
        kind, sizes = weights.dtype, [b for _, b in learner.layers]
        self.unit, self.slope = IN_PLACE[learner.activation]
        self.parts, self.grad = learner._parts(weights), np.empty_like(weights)
        self.grads, (a, b) = learner._parts(self.grad), learner.layers[0]
        self.first, self.first_grad = (w[: (a + 1) * b].reshape(a + 1, b) for w in (weights, self.grad))
        self.seen, self.back = ([np.empty((most, b), kind) for b in sizes] for _ in range(2))
        self.zero = [np.zeros((most, b), kind) for b in sizes]
        self.ones, self.at, self.least = np.ones(most, kind), np.arange(most), max(1e-300, float(np.finfo(kind).tiny))
        self.along = (lambda f, z: functools.reduce(f, z.T)) if learner.classes <= FEW_CLASSES else (lambda f, z: f.reduce(z, axis=1))

    def loss(self, x: np.ndarray, y: np.ndarray) -> float:
        """The summed loss; the summed gradient goes to ``grad``."""
        n, seen, last = len(y), [x], len(self.parts) - 1
        for k, (weights, shift) in enumerate(self.parts):
            z = np.matmul(seen[-1], weights if k else self.first, out=self.seen[k][:n])
            if k:
                z += shift
            seen.append(self.unit(z, self.zero[k][:n]) if k < last else z)
        back, at = seen.pop(), self.at[:n]
        back -= self.along(np.maximum, back)[:, None]
        np.exp(back, out=back)
        back /= self.along(np.add, back)[:, None]
        hit = back[at, y]
        back[at, y] = hit - self.ones[:n]
        for k in range(last, 0, -1):
            weights, shift = self.grads[k]
            np.matmul(seen[k].T, back, out=weights)
            np.matmul(self.ones[:n], back, out=shift)
            back = self.slope(np.matmul(back, self.parts[k][0].T, out=self.back[k - 1][:n]), seen[k])
        np.matmul(x.T, back, out=self.first_grad)
        return -float(np.log(np.maximum(hit, self.least)).sum())


LEARNERS = {c.__name__: c for c in (Logistic, PairMachine, LandmarkMachine, Network)}
Learner = Logistic | PairMachine | Network


@dataclass(frozen=True)
class Model:
    """What to fit and the fold that it does not see (-1: sees all)."""

    learner: Learner
    left_out: int = -1
    seed: int = 54


@dataclass(frozen=True)
class Fitted:
    learner: Learner
    weights: np.ndarray
    passes: int = 0

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self.learner.scores(self.weights, np.nan_to_num(x))

    def to_json(self) -> str:
        return json.dumps({"kind": type(self.learner).__name__, "learner": asdict(self.learner), "weights": self.weights.tolist()})

    @staticmethod
    def from_json(text: str) -> Fitted:
        found = json.loads(text)
        given = {k: tuple(v) if isinstance(v, list) else v for k, v in found["learner"].items()}
        return Fitted(LEARNERS[found["kind"]](**given), np.array(found["weights"]))


def _losses(models: Sequence[Model], trials: dict[int, np.ndarray], batch: dict[int, tuple[int, int, int]]):
    """Of each model at its trial weights: loss, rows and gradient in one array. ``batch``: per
    model (epoch, which, of how many), if it takes a part of the rows."""

    groups: dict[tuple, list[int]] = {}
    for m in trials:
        groups.setdefault(models[m].learner.alike(), []).append(m)

    def kept(block: Block, m: int) -> np.ndarray:
        keep = block.fold != models[m].left_out
        if m in batch:
            epoch, which, parts = batch[m]
            if parts > 1:
                keep &= (shares(block.row, models[m].seed, epoch) * parts).astype(int) == which
        return keep

    def of(block: Block) -> Sums:
        out, whole = Sums(), np.nan_to_num(block.x)
        for alike, group in groups.items():
            ms = [m for m in group if block.serves(m)]
            if not ms:
                continue
            ws, keep = np.stack([trials[m] for m in ms]), np.stack([kept(block, m) for m in ms], axis=1)
            values, grads, step = 0.0, 0.0, max(1, SCORE_NUMBERS // (len(ms) * alike[-1]))
            for start in range(0, len(whole), step):
                some = slice(start, start + step)
                found = models[ms[0]].learner.losses(ws, whole[some], block.y[some], keep[some])
                values, grads = values + found[0], grads + found[1]
            for k, m in enumerate(ms):
                out[m] = np.concatenate([[values[k], keep[:, k].sum()], grads[k]])
        return out

    return of


def _pass(rows: RDD, models: Sequence[Model], trials: dict[int, np.ndarray], batch: dict[int, tuple[int, int, int]] | None = None) -> dict[int, tuple[float, float, np.ndarray]]:
    """Loss, rows and gradient (sums) per model; in parts if all models' weights are too many. Models
    that differ in how far they go or in their penalty alone share what they have at equal weights."""
    found, part, held, batch = Sums(), {}, 0, batch or {}
    twins: dict[tuple, list[int]] = {}
    for m, w in trials.items():
        twins.setdefault((models[m].learner.alike(), models[m].left_out, w.tobytes(), (batch[m], models[m].seed) if m in batch else None), []).append(m)
    for m in (ms[0] for ms in twins.values()):
        w = trials[m]
        if part and held + len(w) > PASS_NUMBERS:
            found += total(rows, _losses(models, part, batch))
            part, held = {}, 0
        part[m] = w
        held += len(w)
    if part:
        found += total(rows, _losses(models, part, batch))
    return {m: (v[0], v[1], v[2:]) for ms in twins.values() for v in [found[ms[0]]] for m in ms}


def _dot(a: np.ndarray, b: np.ndarray) -> float:
    """Without a linear algebra library, whose threads may not outlive the start of the JVM."""
    return float((a * b).sum())


class _Descent:
    """One model's way by L-BFGS: a trial at a time."""

    def __init__(self, model: Model) -> None:
        self.learner = model.learner
        self.at = self.trial = model.learner.start(model.seed)
        self.mask = self.learner.weighed(self.at)
        self.value, self.grad, self.direction, self.step = math.inf, None, None, 1.0
        self.changes: list[tuple[np.ndarray, np.ndarray]] = []
        self.steps = self.halved = self.passes = 0
        self.done = False

    def take(self, loss: float, n: float, grad: np.ndarray) -> None:
        """The mean loss with its penalty at the trial, and what to try next."""
        self.passes += 1
        n, l2 = max(n, 1.0), self.learner.penalty(n)
        value = loss / n + 0.5 * l2 * (self.mask * self.trial**2).sum()
        grad = grad / n + l2 * self.mask * self.trial
        if self.grad is not None:
            slope = _dot(self.grad, self.direction)
            if not value <= self.value + 1e-4 * self.step * slope:
                self.halved += 1
                self.step *= 0.5
                self.done = self.halved > 30
                self.trial = self.at + self.step * self.direction
                return
            ds, dg = self.trial - self.at, grad - self.grad
            if _dot(ds, dg) > 1e-12 * _dot(dg, dg):
                self.changes = [*self.changes[1 - MEMORY :], (ds, dg)]
            self.steps += 1
            self.done = self.value - value <= 1e-9 * max(abs(self.value), abs(value), 1e-6) or self.steps >= self.learner.max_iter
        self.at, self.value, self.grad = self.trial, value, grad
        self.done = self.done or np.abs(grad).max() < 1e-6
        self.direction = self._towards(-grad)
        self.step = 1.0 if self.changes else min(1.0, 1.0 / max(np.abs(grad).sum(), 1e-12))
        self.halved = 0
        self.trial = self.at + self.step * self.direction

    def _towards(self, q: np.ndarray) -> np.ndarray:
        alphas = []
        for ds, dg in reversed(self.changes):
            alphas.append(_dot(ds, q) / _dot(ds, dg))
            q = q - alphas[-1] * dg
        if self.changes:
            ds, dg = self.changes[-1]
            q = q * _dot(ds, dg) / _dot(dg, dg)
        for (ds, dg), a in zip(self.changes, reversed(alphas)):
            q = q + (a - _dot(dg, q) / _dot(ds, dg)) * ds
        return q


class _Batches:
    """One network's way by Adam: an epoch of mini-batches at a time."""

    def __init__(self, model: Model, n: float) -> None:
        self.model, self.learner, self.at, self.n = model, model.learner, model.learner.start(model.seed), n
        self.first, self.second = np.zeros_like(self.at), np.zeros_like(self.at)
        self.passes = self.epoch = self.idle = 0
        self.best, self.done = math.inf, self.learner.max_iter < 1

    def over(self, x: np.ndarray, y: np.ndarray, row: np.ndarray, epoch: int) -> tuple[float, int]:
        """A step per mini-batch of these rows, in their precision; the summed loss with its penalties, and the rows."""
        parts, loss, one = max(1, round(len(y) / self.learner.batch)), 0.0, x.dtype.type
        self.at, self.first, self.second = (np.array(v, dtype=x.dtype) for v in (self.at, self.first, self.second))
        decay = (self.learner.alpha * self.learner.weighed(self.at)).astype(x.dtype)
        which = (shares(row, self.model.seed, epoch) * parts).astype(np.uint16 if parts <= 1 << 16 else np.int64)
        order, sizes = np.argsort(which, kind="stable"), np.bincount(which, minlength=parts)
        x, y, steps, stop = np.column_stack([x[order], np.ones(len(y), x.dtype)]), y[order], _Steps(self.learner, self.at, int(sizes.max())), 0
        grad, held = steps.grad, np.empty_like(self.at)
        for size in sizes.tolist():
            self.passes += 1
            if size:
                start, stop = stop, stop + size
                loss += steps.loss(x[start:stop], y[start:stop])
                np.multiply(decay, self.at, out=held)
                loss += 0.5 * _dot(held, self.at)
                grad += held
                grad /= one(size)
                self.first *= one(0.9)
                self.first += np.multiply(grad, one(0.1), out=held)
                self.second *= one(0.999)
                self.second += np.multiply(np.multiply(grad, grad, out=held), one(0.001), out=held)
                rate = self.learner.rate * math.sqrt(1.0 - 0.999**self.passes) / (1.0 - 0.9**self.passes)
                np.sqrt(self.second, out=held)
                held += one(1e-8)
                np.divide(self.first, held, out=held)
                self.at -= np.multiply(held, one(rate), out=held)
        return loss, len(y)

    def judge(self, loss: float, n: float) -> None:
        """After an epoch: whether to go on."""
        mean = loss / max(n, 1.0)
        self.idle = self.idle + 1 if mean > self.best - 1e-4 else 0
        self.best = min(self.best, mean)
        self.epoch += 1
        self.done = self.idle >= 10 or self.epoch >= self.learner.max_iter

    def state(self) -> np.ndarray:
        return np.concatenate([[self.passes], self.at, self.first, self.second])

    def take(self, state: np.ndarray, told: np.ndarray) -> None:
        """The groups' mean state, and each epoch's loss and rows."""
        self.passes = round(state[0])
        self.at, self.first, self.second = np.split(state[1:], 3)
        for loss, n in told:
            if not self.done:
                self.judge(loss, n)


def _epochs(ways: dict[int, _Batches], epochs: int, alone: bool):
    """Of each network that a group of rows serves: its state after some epochs over the group,
    weighed by the group's share of the rows, then each epoch's loss and rows. A group that is
    ``alone`` has all rows, so it also knows when to stop."""

    def of(blocks: list[Block]) -> Sums:
        out, x = Sums(), np.nan_to_num(np.concatenate([b.x for b in blocks]))
        x = x.astype(np.float32) if len(x) >= SINGLE_ROWS else x
        y, fold, row = (np.concatenate([getattr(b, c) for b in blocks]) for c in ("y", "fold", "row"))
        for m, way in ways.items():
            i = np.flatnonzero(fold != way.model.left_out)
            if not blocks[0].serves(m) or not len(i):
                continue
            way, told, seen = copy.copy(way), np.zeros((epochs, 2)), (x[i], y[i], row[i])
            for e in range(min(epochs, way.learner.max_iter - way.epoch)):
                told[e] = way.over(*seen, way.epoch if alone else way.epoch + e)
                if alone:
                    way.judge(*told[e])
                    if way.done:
                        told = told[: e + 1]
                        break
            out[m] = np.concatenate([len(i) / way.n * way.state(), told.ravel()])
        return out

    return of


def _by_batches(rows: RDD, ways: dict[int, _Batches]) -> None:
    """Takes all networks to their end. Rows lie in groups of up to ``GROUP_ROWS`` (a few hundred bytes each in a task). In a job each
    group goes through epochs of its own mini-batches, then the groups' weights are averaged.
    So jobs are as many as epochs at most, whatever the number of rows, and a single group needs one."""
    groups = max(1, min(rows.getNumPartitions(), math.ceil(max(w.n for w in ways.values()) / GROUP_ROWS)))
    gathered = rows.coalesce(groups)
    dealt = spread(gathered, len(ways))
    longest, held = max(w.learner.max_iter for w in ways.values()), sum(24 * w.learner.size for w in ways.values())
    epochs = longest if groups == 1 else math.ceil(longest * held / STATE_BYTES)
    alike = sorted(ways, key=lambda m: (ways[m].learner.activation, -ways[m].learner.size, m))
    numbers = {m: k for k, m in enumerate(alike)}  # so that a group's copies share the networks evenly
    while open_ones := {numbers[m]: way for m, way in ways.items() if not way.done}:
        found = total_by_key(dealt, _epochs(open_ones, epochs, groups == 1))
        for k, way in open_ones.items():
            if k not in found:  # no rows to learn from
                way.done = True
                continue
            size = 1 + 3 * way.learner.size
            way.take(found[k][:size], found[k][size:].reshape(-1, 2))
    if dealt is not gathered:
        dealt.unpersist()


def fit(rows: RDD, models: Sequence[Model], folds: int = 1) -> tuple[list[Fitted], np.ndarray]:
    """All models, and per model the rows and hits (2 columns) of the fold it did not see. Equal models are fitted once."""
    if len(distinct := list(dict.fromkeys(models))) < len(models):
        found, hits = fit(rows, distinct, folds)
        places = {model: at for at, model in enumerate(distinct)}
        return [found[places[m]] for m in models], hits[[places[m] for m in models]]
    counts = total(rows, lambda b: np.bincount(b.fold, minlength=folds)).astype(float)
    rows, given = spread(rows, len(models)), rows
    ways: list[_Descent | _Batches] = []
    for model in models:
        n = counts.sum() - (counts[model.left_out] if model.left_out >= 0 else 0)
        adam = isinstance(model.learner, Network) and model.learner.solver == "adam"
        ways.append(_Batches(model, n) if adam else _Descent(model))
    batched = {m: way for m, way in enumerate(ways) if isinstance(way, _Batches)}
    if batched:
        _by_batches(given, batched)
    while open_ones := [m for m, way in enumerate(ways) if not way.done]:
        found = _pass(rows, models, {m: ways[m].trial for m in open_ones})
        for m in open_ones:
            ways[m].take(*found[m])
    fitted = [Fitted(model.learner, way.at, way.passes) for model, way in zip(models, ways)]

    def judged(block: Block) -> np.ndarray:
        out = np.zeros((len(models), 2))
        for m, (model, one) in enumerate(zip(models, fitted)):
            i = np.flatnonzero(block.fold == model.left_out)
            if block.serves(m) and len(i):
                out[m] = len(i), (one.probabilities(block.x[i]).argmax(axis=1) == block.y[i]).sum()
        return out

    hits = total(rows, judged)
    if rows is not given:
        rows.unpersist()
    return fitted, hits
