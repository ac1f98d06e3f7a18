"""Quality scores by positive-unlabelled learning.

Trusted positives are documents labelled good; documents without a label are the
unlabelled web text, good and bad mixed. Labels that say bad are never read. First a
classifier tells positives from unlabelled text; where positives are densest against all
unlabelled documents, their ratio bounds the class prior. Then the non-negative unbiased
risk is minimised: the positives' loss times the prior, plus the unlabelled loss as
negatives less the positives' share in it, which is not allowed to fall below zero.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import crc_mod, logistic
from sparktab.session import settled

#: Cells of the class prior's histogram.
CELLS = 1_000
UPPER = np.arange(256) // 32 == 2
MARKS = [np.isin(np.arange(256), list(m.encode())) for m in ("#", "*", "$", "%", "&", "|<>", "!", "\"'()[]{}", ".?", ",;:", "=_/\\~^`+-@", "0123456789")]
OTHER = np.arange(256) >= 128
MARKS = np.stack([UPPER, OTHER, *MARKS]).astype(np.float64)
WIDTH = len(MARKS) + 8


def features(text: str) -> np.ndarray:
    """Shares and logarithms that describe a whole text; an empty one has its own mark."""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    words = text.split()
    out = np.zeros(WIDTH, dtype=np.float32)
    if not words:
        out[-1] = 1.0
        return out
    n = len(words)
    found = np.bincount(data, minlength=256)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    ends = found[ord(".")] + found[ord("!")] + found[ord("?")]
    out[: len(MARKS)] = np.sqrt(np.minimum(MARKS @ found / n, 4.0))
    out[len(MARKS) : -1] = (
        np.log1p(n) / 8,
        min(len(data) / n, 30) / 10,
        len(set(words)) / n ** 0.9,
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(lines)) / len(lines),
        np.log1p(n / (1 + ends)) / 4,
        len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2),
    )
    return out


class Scorer:
    """A small network: one hidden layer of rectified units, one margin."""

    def __init__(self, width: int, hidden: int = 24, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(width), np.ones(width)
        self.parts = [rng.normal(0, np.sqrt(2 / width), (width, hidden)), np.zeros(hidden), rng.normal(0, np.sqrt(1 / hidden), hidden), np.zeros(1)]

    def margins(self, x: np.ndarray) -> np.ndarray:
        w, b, v, c = self.parts
        return np.maximum(self.standard(x) @ w + b, 0) @ v + c[0]

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def step(self, x: np.ndarray, slope: np.ndarray, state: list, rate: float, decay: float) -> None:
        """One Adam step against the gradient of the margins."""
        w, b, v, c = self.parts
        z = self.standard(x)
        hidden = np.maximum(z @ w + b, 0)
        back = (hidden > 0) * slope[:, None] * v
        grads = [z.T @ back + decay * w, back.sum(axis=0), hidden.T @ slope + decay * v, np.array([slope.sum()])]
        state[0] += 1
        for k, g in enumerate(grads):
            state[1][k] = 0.9 * state[1][k] + 0.1 * g
            state[2][k] = 0.999 * state[2][k] + 0.001 * g**2
            first, second = state[1][k] / (1 - 0.9 ** state[0]), state[2][k] / (1 - 0.999 ** state[0])
            self.parts[k] = self.parts[k] - rate * first / (np.sqrt(second) + 1e-8)


def fitted(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None, rounds: int = 60, batch: int = 512) -> Scorer:
    """A scorer with the logistic loss; ``prior`` None: positives against unlabelled, else the non-negative risk."""
    both = np.concatenate([positive, unlabelled])
    model, state = Scorer(both.shape[1]), [0, [0.0] * 4, [0.0] * 4]
    model.mean, model.scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    rng = np.random.default_rng(3)
    steps = max(1, len(unlabelled) // batch)
    for round_ in range(rounds):
        order = rng.permutation(len(unlabelled))
        rate = 0.005 * (1 - round_ / rounds) + 1e-4
        for k in range(steps):
            u = unlabelled[order[k * batch : (k + 1) * batch]]
            p = positive[rng.integers(len(positive), size=min(batch, max(64, len(positive))))]
            x = np.concatenate([p, u])
            margin = model.margins(x)
            up, uu = margin[: len(p)], margin[len(p) :]
            as_good, as_bad = -logistic(-up) / len(p), logistic(up) / len(p)
            if prior is None:
                slope = np.concatenate([as_good, logistic(uu) / len(u)])
            else:
                negative = np.logaddexp(0, uu).mean() - prior * np.logaddexp(0, up).mean()
                part = np.concatenate([-prior * as_bad, logistic(uu) / len(u)])
                # below zero the negative part is overfitted: walk it back
                slope = np.concatenate([prior * as_good, np.zeros(len(u))]) + part if negative >= 0 else -part
            model.step(x, slope, state, rate, 1e-4)
    return model


def class_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of good documents among the unlabelled, from counts by score cell.

    Where the score is high enough, unlabelled text is all good, so the ratio of both
    tails is the share; the least ratio of a tail with a tenth of the positives at
    least is taken, each with one standard error on top.
    """
    p, u = positive[::-1].cumsum(), unlabelled[::-1].cumsum()
    if not len(p) or not p[-1] or not u[-1]:
        return 0.5
    at = np.flatnonzero(p >= max(20, 0.1 * p[-1]))
    if not len(at):
        return 0.5
    share = (u[at] + np.sqrt(u[at]) + 1) / u[-1] / (p[at] / p[-1])
    return float(np.clip(share.min(), 0.02, 0.98))


def _scores(df: DataFrame, model: Scorer):
    held = df.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    @F.pandas_udf("double")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series(logistic(held.value.margins(np.stack(part.to_list()).astype(float))) if len(part) else np.empty(0))

    return run


def text_features(text: str) -> Column:
    """The features of a text column."""

    @F.pandas_udf("array<float>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([features(t) for t in part.fillna("").tolist()], dtype=object)

    return run(F.col(text))


def quality_table(docs: DataFrame, labels: DataFrame, positives: int = 10_000, unlabelled: int = 20_000, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Features are made of every whole text once and written. The network is fitted on at
    most ``positives`` good-labelled and ``unlabelled`` documents by hash of doc_id and
    text features; the class prior counts all documents outside the held-out part
    (crc32 of doc_id mod 5 is 0). NULL and empty texts are scored as texts without words.
    A NULL doc_id is not held out and unlabelled. Without positives or unlabelled text every score is 0.5.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(False)).alias("held_out"), text_features("text").alias("x"))
    rows = settled(slim, "features")
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("quality").alias("quality"))
    training = settled(rows.where("NOT held_out").join(known.withColumn("known", F.lit(True)), "doc_id", "left").select("doc_id", "x", F.coalesce(F.col("quality") == 1, F.lit(False)).alias("good"), F.col("known").isNull().alias("unlabelled")).where("good OR unlabelled"), "training")
    sizes = training.agg(F.count_if("good"), F.count_if("unlabelled")).first()

    def sample(which: str, size: int, most: int) -> np.ndarray:
        even = F.pmod(F.xxhash64("doc_id", "x"), F.lit(1 << 30))
        chosen = training.where(F.col(which) & (even < int((1 << 30) * min(1.0, 1.2 * most / max(1, size)))))
        found = chosen.orderBy(even, "doc_id").limit(most).select("x").collect()
        return np.array([r["x"] for r in found], dtype=float).reshape(-1, WIDTH)

    good, mixed = sample("good", sizes[0], positives), sample("unlabelled", sizes[1], unlabelled)
    if not len(good) or not len(mixed):
        score = F.lit(0.5)
    else:
        first = fitted(good, mixed, None)
        cell = F.least((_scores(rows, first)(F.col("x")) * CELLS).cast("int"), F.lit(CELLS - 1))
        tally = training.withColumn("cell", cell).groupBy("cell").agg(F.count_if("good").alias("p"), F.count_if("unlabelled").alias("u")).collect()
        p, u = np.zeros(CELLS), np.zeros(CELLS)
        for r in tally:
            p[r["cell"]], u[r["cell"]] = r["p"], r["u"]
        score = _scores(rows, fitted(good, mixed, class_prior(p, u)))(F.col("x"))
    found = rows.select("doc_id", "held_out", score.alias("score"))
    return found.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
