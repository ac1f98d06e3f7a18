"""Scores turned into probabilities one can trust.

Scores of kernel machines and boosted trees rank rows but are not shares. An isotonic fit,
the closest non-decreasing function from score to outcome, makes them so. It is found by
pooling: neighbouring blocks whose means fall are put together. Pooled blocks of two score
ranges put together and pooled again are the pooled blocks of both, so the fit needs one
aggregation per score level and any order of merging. Scores are told apart to
``LEVELS`` steps, which bounds the levels whatever the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.functions.vectors import doubles
from sparktab.operators import models
from sparktab.operators.models import TrainedModel

LEVELS = 10_000


@dataclass(frozen=True)
class Pool:
    """Blocks (first level, rows, outcomes) with rising means; they add up in the order of levels."""

    blocks: tuple[tuple[int, float, float], ...] = ()

    def __add__(self, other: Pool) -> Pool:
        out: list[tuple[int, float, float]] = list(self.blocks)
        for level, n, hits in other.blocks:
            while out and out[-1][2] * n >= hits * out[-1][1]:  # the mean before is no lower
                level, n, hits = out[-1][0], out[-1][1] + n, out[-1][2] + hits
                out.pop()
            out.append((level, n, hits))
        return Pool(tuple(out))


def level(score: Column, levels: int = LEVELS) -> Column:
    return F.floor(score * levels + 0.5).cast("int")


@dataclass(frozen=True)
class Isotonic:
    """A step function over score levels."""

    starts: tuple[int, ...]
    values: tuple[float, ...]
    levels: int = LEVELS

    def apply(self, score: Column) -> Column:
        """The probability of a score; those under all fitted ones get the first step's."""
        at = F.size(F.filter(F.array(*[F.lit(s) for s in self.starts[1:]]), lambda s: s <= level(score, self.levels))) if len(self.starts) > 1 else F.lit(0)
        return F.when(score.isNotNull(), F.get(doubles(self.values), at))


def fit_isotonic(df: DataFrame, score: Column, outcome: Column, levels: int = LEVELS) -> Isotonic:
    """The isotonic fit of a boolean outcome on a score of 0 to 1. NULLs of either are left out.

    At most ``levels`` + 1 rows reach the driver. Without rows every score is its own middle: 0.5.
    """
    rows = df.select(level(score, levels).alias("level"), outcome.cast("int").alias("hit")).where("level IS NOT NULL AND hit IS NOT NULL")
    found = rows.groupBy("level").agg(F.count("*").alias("n"), F.sum("hit").alias("hits")).orderBy("level").collect()
    pool = Pool() + Pool(tuple((r["level"], float(r["n"]), float(r["hits"])) for r in found))
    if not pool.blocks:
        return Isotonic((0,), (0.5,), levels)
    return Isotonic(tuple(b[0] for b in pool.blocks), tuple(b[2] / b[1] for b in pool.blocks), levels)


def reliability(df: DataFrame, score: Column, outcome: Column, bins: int = 10) -> DataFrame:
    """bin, n, mean_score, share: per bin of equal width what was said and what came true."""
    of = F.least(F.floor(score * bins), F.lit(bins - 1)).cast("int").alias("bin")
    rows = df.select(of, score.alias("score"), outcome.cast("int").alias("hit")).where("score IS NOT NULL AND hit IS NOT NULL")
    return rows.groupBy("bin").agg(F.count("*").alias("n"), F.avg("score").alias("mean_score"), F.avg("hit").alias("share"))


def out_of_fold(name: str, params: Mapping, rows: DataFrame, classes: Sequence[str], numeric: Sequence[str], categories: Sequence[str] = (), fold: str = "fold", folds: int = 5) -> DataFrame:
    """``rows`` with the probabilities that a model fitted to the other folds gives them."""
    out = None
    for k in range(folds):
        model = models.train(name, rows.where(F.col(fold) != k), classes, numeric, categories, params)
        part = model.predict(rows.where(F.col(fold) == k))
        out = part if out is None else out.unionByName(part)
    return out


@dataclass(frozen=True)
class CalibratedModel:
    """A trained model whose probabilities went through one isotonic fit per class."""

    model: TrainedModel
    fits: tuple[Isotonic, ...]

    def predict(self, df: DataFrame) -> DataFrame:
        """As the model's own; probabilities are normalised, and those that are all zero stay its own."""
        out = self.model.predict(df)
        made = F.array(*[f.apply(F.get("probability", F.lit(i))) for i, f in enumerate(self.fits)])
        total = F.aggregate("_made", F.lit(0.0), lambda a, v: a + v)
        scored = out.withColumn("_made", made).withColumn("probability", F.when(total > 0, F.transform("_made", lambda v: v / total)).otherwise(F.col("probability")))
        top = F.array_position("probability", F.array_max("probability")).cast("int")
        named = F.element_at(F.array(*[F.lit(c) for c in self.model.classes]), top)
        return scored.withColumns({"prediction": named, "confidence": F.array_max("probability") * 100.0}).drop("_made")


def calibrated(name: str, params: Mapping, rows: DataFrame, classes: Sequence[str], numeric: Sequence[str], categories: Sequence[str] = (), fold: str = "fold", folds: int = 5) -> CalibratedModel:
    """The model of all rows, calibrated on scores that rows got from models that didn't see them."""
    judged = out_of_fold(name, params, rows, classes, numeric, categories, fold, folds).persist()
    fits = tuple(fit_isotonic(judged, F.get("probability", F.lit(i)), F.col("label") == float(i)) for i in range(len(classes)))
    judged.unpersist()
    return CalibratedModel(models.train(name, rows, classes, numeric, categories, params), fits)
