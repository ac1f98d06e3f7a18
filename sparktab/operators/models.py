"""The classifier family: one registry of builders, training of many, prediction."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.functions.vectors import name_at
from sparktab.operators import boosting, forest, gradient, learners
from sparktab.operators.attribution import LinearModel
from sparktab.operators.prepare import Levels, class_counts, fit_levels
from sparktab.operators.stages import CategoryColumns, ClassScores, GatherFeatures, ScaleColumns

SEED = 54
ROWS_PER_PARTITION = 100_000
#: Rows times trees that are worth a task of a forest, and the most tasks.
FOREST_PAIRS, FOREST_TASKS = 200_000, 12


@dataclass(frozen=True)
class Shape:
    """What builders need to know of the training data."""

    rows: int
    inputs: int
    classes: int
    levels: Mapping[str, tuple] = field(default_factory=dict)


def _logistic(shape: Shape, p: Mapping) -> list:
    """``C`` weighs the summed loss against half the squared weights; Spark averages the loss."""
    return [
        LogisticRegression(
            family="multinomial",
            elasticNetParam=0.0,
            regParam=1.0 / (p.get("C", 1.0) * max(shape.rows, 1)),
            standardization=False,
            maxIter=p.get("max_iter", 1000),
        )
    ]


def forest_form(shape: Shape, p: Mapping) -> forest.Settings:
    return forest.Settings(p.get("trees", 100), p.get("max_depth") or 30, p.get("min_leaf", 1), str(p.get("max_features", "sqrt")), p.get("seed", SEED))


def tree_form(shape: Shape, p: Mapping) -> forest.Settings:
    return forest.Settings(1, p.get("max_depth") or 30, p.get("min_leaf", 1), "all", p.get("seed", SEED), drawn=False)


#: Learners whose trees are grown in tasks, all candidates and folds together.
IN_TASKS: dict[str, Callable[[Shape, Mapping], forest.Settings]] = {"forest": forest_form, "tree": tree_form}


def _in_tasks(name: str) -> Callable[[Shape, Mapping], list]:
    return lambda shape, p: [learners.forest_stage(IN_TASKS[name](shape, p), shape.classes, shape.inputs)]


def kernel_machine(shape: Shape, p: Mapping) -> gradient.PairMachine:
    """Planes between pairs of classes, on random Fourier features unless ``kernel`` is linear.

    ``gamma`` is a number, ``auto`` (1 / inputs) or ``scale`` (1 / (inputs * variance), which is the
    same on standardised inputs). ``map`` ``landmarks`` takes kernel values to landmark rows instead.
    """
    width = p.get("gamma", 0.0)
    kind = gradient.LandmarkMachine if p.get("map") == "landmarks" else gradient.PairMachine
    return kind(
        inputs=shape.inputs,
        classes=shape.classes,
        C=p.get("C", 1.0),
        components=p.get("components", 100) if p.get("kernel", "rbf") == "rbf" else 0,
        gamma=0.0 if isinstance(width, str) else width,
        seed=p.get("seed", SEED),
        max_iter=p.get("max_iter", 100),
    )


def network(shape: Shape, p: Mapping) -> gradient.Network:
    """Layers of units; the settings of ``gradient.Network`` by their names."""
    given = {k: v for k, v in p.items() if k in ("activation", "alpha", "solver", "batch", "rate", "max_iter")}
    return gradient.Network(inputs=shape.inputs, classes=shape.classes, hidden=tuple(p.get("hidden", (100,))), **given)


def logistic_form(shape: Shape, p: Mapping) -> gradient.Logistic:
    return gradient.Logistic(shape.inputs, shape.classes, p.get("C", 1.0), p.get("max_iter", 1000))


def _bayes(shape: Shape, p: Mapping) -> list:
    return [NaiveBayes(modelType="gaussian")]


def boosted(defaults: Mapping, p: Mapping) -> boosting.Settings:
    """A preset's settings with those given in their place."""
    names = {"max_depth": "depth", "subsample": "row_share"}
    return boosting.Settings(**{names.get(k, k): v for k, v in {**defaults, **p}.items()})


#: How each family's trees grow, with settings as their kinds usually have.
BOOSTED = {
    "boosted_level": {"growth": "level", "rounds": 100, "depth": 6, "rate": 0.3},
    "boosted_leaf": {"growth": "leaf", "rounds": 100, "depth": 0, "leaves": 31, "rate": 0.1, "l2": 0.0, "min_leaf": 20, "min_hessian": 0.001},
    "boosted_symmetric": {"growth": "symmetric", "rounds": 1000, "depth": 6, "rate": 0.03, "l2": 3.0},
}
#: Learners whose candidates and folds can be fitted in the same passes.
BY_GRADIENT: dict[str, Callable[[Shape, Mapping], gradient.Learner]] = {"logistic": logistic_form, "kernel_svm": kernel_machine, "perceptron": network}


def _boosted(name: str) -> Callable[[Shape, Mapping], list]:
    return lambda shape, p: [learners.boosted_stage(boosted(BOOSTED[name], p), shape.classes, shape.inputs)]


def _by_gradient(name: str) -> Callable[[Shape, Mapping], list]:
    return lambda shape, p: [learners.gradient_stage(BY_GRADIENT[name](shape, p))]


BUILDERS: dict[str, Callable[[Shape, Mapping], list]] = {
    "logistic": _logistic,
    "forest": _in_tasks("forest"),
    "kernel_svm": _by_gradient("kernel_svm"),
    "bayes": _bayes,
    "tree": _in_tasks("tree"),
    "boosted_level": _boosted("boosted_level"),
    "boosted_leaf": _boosted("boosted_leaf"),
    "boosted_symmetric": _boosted("boosted_symmetric"),
    "perceptron": _by_gradient("perceptron"),
}


def preparation(shape: Shape, numeric: Sequence[str], categories: Sequence[str] = ()) -> list:
    """The stages before a classifier: scaled numbers and encoded categories in one vector."""
    head: list = [ScaleColumns(inputCols=list(numeric))]
    if categories:
        levels = json.dumps({c: list(v) for c, v in shape.levels.items()})
        head.append(CategoryColumns(inputCols=list(categories), levels=levels))
    return [*head, GatherFeatures(numeric=list(numeric), categories=list(categories))]


def stages_for(
    name: str, shape: Shape, numeric: Sequence[str], categories: Sequence[str] = (), params: Mapping | None = None
) -> list:
    """Preparation, classifier and a common output, as one list of pipeline stages."""
    return [*preparation(shape, numeric, categories), *BUILDERS[name](shape, params or {}), ClassScores()]


@dataclass(frozen=True)
class TrainedModel:
    """A fitted pipeline with the class names its codes stand for."""

    name: str
    pipeline: PipelineModel
    classes: tuple[str, ...]
    numeric: tuple[str, ...]
    categories: tuple[str, ...] = ()

    def predict(self, df: DataFrame) -> DataFrame:
        """The input columns with prediction (class name), probability and confidence."""
        kept = df.columns
        out = self.pipeline.transform(df.withColumns({f"_in_{c}": F.col(c) for c in kept}))
        return out.select(
            *[F.col(f"_in_{c}").alias(c) for c in kept],
            name_at(self.classes, F.col("prediction").cast("int")).alias("prediction"),
            F.col("scores").alias("probability"),
            (F.array_max("scores") * 100.0).alias("confidence"),
        )

    def linear(self, train_rows: DataFrame | None = None) -> LinearModel:
        """The logistic model as weights over raw columns, for attribution and scoring.

        Encoded categories become formulas over their columns; ``train_rows`` gives their
        means, which attributions are measured from. A missing feature counts as its
        mean, as in the pipeline.
        """
        if self.name != "logistic":
            raise ValueError("needs a logistic model")
        if self.categories and train_rows is None:
            raise ValueError("needs the training rows for the means of encoded categories")
        scaler = self.pipeline.stages[0].standardiser()
        fitted = self.pipeline.stages[-2]
        matrix = fitted.coefficientMatrix.toArray()
        formulas = self._formulas()
        means = [0.0] * len(self.numeric)
        if formulas:
            row = train_rows.agg(*[F.avg(F.expr(f)).alias(f"m{i}") for i, (_, f) in enumerate(formulas)]).first()
            means += [float(row[f"m{i}"] or 0.0) for i in range(len(formulas))]
        plain = len(formulas)
        return LinearModel(
            features=(*self.numeric, *(n for n, _ in formulas)),
            classes=self.classes,
            weights=tuple(tuple(float(v) for v in row) for row in matrix),
            intercepts=tuple(float(v) for v in fitted.interceptVector),
            means=tuple(means),
            centre=(*(scaler.fitted[c].mean for c in self.numeric), *[0.0] * plain),
            spread=(*(scaler.fitted[c].deviation or 0.0 for c in self.numeric), *[0.0] * plain),
            formulas=formulas,
            missing="mean",
        )

    def _formulas(self) -> tuple[tuple[str, str], ...]:
        """The encoded category columns in the order of the feature vector, as SQL text."""
        if not self.categories:
            return ()
        levels = self.pipeline.stages[1].value()
        text = lambda v: "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
        out = []
        for c in self.categories:
            if len(levels[c]) <= 2:
                out.append((f"{c}_code", f"CASE WHEN `{c}` = {text(levels[c][-1])} THEN {float(len(levels[c]) - 1)}D ELSE 0.0D END"))
            else:
                out += [(f"{c}_{v}", f"CASE WHEN `{c}` = {text(v)} THEN 1.0D ELSE 0.0D END") for v in sorted(levels[c], key=lambda v: f"_cat:{c}:{v}")]
        return tuple(out)


def training_frame(df: DataFrame, keys: Sequence[str], target: str, partitions: int | None = None) -> tuple[DataFrame, tuple]:
    """Rows with a numeric ``label`` in a repeatable layout, cached for iterative fits.

    Seeded learners sample per partition, so rows are placed and ordered by key, in
    partitions of a size that grows neither with the cluster nor with the table. Call
    ``unpersist`` on the frame when the fits are done.
    """
    counts = class_counts(df, target)
    levels = Levels(target, tuple(counts))
    pieces = partitions or max(1, math.ceil(sum(counts.values()) / ROWS_PER_PARTITION))
    ready = df.where(F.col(target).isNotNull()).withColumn("label", levels.encode(F.col(target)).cast("double"))
    return laid_out(ready, keys, pieces).persist(StorageLevel.MEMORY_AND_DISK), tuple(str(v) for v in levels.values)


def laid_out(df: DataFrame, keys: Sequence[str], pieces: int) -> DataFrame:
    return df.repartition(pieces, *keys).sortWithinPartitions(*keys)


def for_trees(name: str, df: DataFrame, rows: int, params: Mapping | None = None) -> DataFrame:
    """The rows in as many partitions as a forest's trees are worth; other learners take them as they lie.

    Each task sends counts for every open node, so there are ``FOREST_TASKS`` at most: more would
    make what is sent grow with rows times tasks.
    """
    wanted = min(FOREST_TASKS, math.ceil(rows * (params or {}).get("trees", 100) / FOREST_PAIRS)) if name == "forest" else 1
    if wanted <= 1 or df.rdd.getNumPartitions() >= wanted:
        return df
    return df.withColumn("_lot", F.xxhash64(*df.columns)).repartition(wanted, "_lot").sortWithinPartitions("_lot").drop("_lot")


def shape_of(train: DataFrame, numeric: Sequence[str], categories: Sequence[str], classes: Sequence) -> Shape:
    levels = {c: fit_levels(train, c).values for c in categories}
    wide = sum(1 if len(v) <= 2 else len(v) for v in levels.values())
    return Shape(sum(class_counts(train, "label").values()), len(numeric) + wide, len(classes), levels)


def train(
    name: str,
    rows: DataFrame,
    classes: Sequence[str],
    numeric: Sequence[str],
    categories: Sequence[str] = (),
    params: Mapping | None = None,
    shape: Shape | None = None,
) -> TrainedModel:
    shape = shape or shape_of(rows, numeric, categories, classes)
    fitted = Pipeline(stages=stages_for(name, shape, numeric, categories, params)).fit(for_trees(name, rows, shape.rows, params))
    return TrainedModel(name, fitted, tuple(classes), tuple(numeric), tuple(categories))


def accuracy_evaluator() -> MulticlassClassificationEvaluator:
    return MulticlassClassificationEvaluator(metricName="accuracy")


def with_label_name(df: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Replaces the numeric label by its class name, to compare with predictions."""
    return df.withColumn("label", name_at(classes, F.col("label").cast("int")))


def predict_bayes(train_rows: DataFrame, test_rows: DataFrame, key: str, features: str, label: str) -> DataFrame:
    """key, prediction by Gaussian naive Bayes over an array of features."""
    levels = fit_levels(train_rows, label)

    def packed(df: DataFrame) -> DataFrame:
        return df.select(
            key,
            levels.encode(F.col(label)).cast("double").alias("label"),
            array_to_vector(F.col(features).cast("array<double>")).alias("features"),
        )

    fitted = NaiveBayes(modelType="gaussian").fit(packed(train_rows))
    scored = fitted.transform(packed(test_rows).drop("label"))
    return scored.select(key, levels.decode(F.col("prediction").cast("int")).alias("prediction"))
