"""Pipeline stages around the trainers of many models: one fitted model, saved as JSON text."""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator
from dataclasses import asdict

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
from pyspark import SparkFiles, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.operators import boosting, forest, gradient
from sparktab.operators.blocks import blocks_of
from sparktab.operators.landmarks import fit_landmarks
from sparktab.session import ship_package

#: Rows that go through a forest's trees at once.
ASKED = 1 << 16
KINDS = {"boosted": boosting.Ensemble.from_json, "gradient": gradient.Fitted.from_json}


@functools.lru_cache(maxsize=4)
def _scorer(kind: str, text: str):
    return KINDS[kind](text)


class FittedLearner(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` and ``prediction``; rows are scored in Arrow batches."""

    kind = Param(Params._dummy(), "kind", "how the text is read", TypeConverters.toString)
    fitted = Param(Params._dummy(), "fitted", "the model as JSON text", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, kind="gradient", fitted="{}", featuresCol="features"):
        super().__init__()
        self._setDefault(featuresCol="features")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        kind, text = self.getOrDefault(self.kind), self.getOrDefault(self.fitted)

        @F.pandas_udf("array<double>")
        def scores(x: pd.Series) -> pd.Series:
            rows = np.stack(x.to_numpy()) if len(x) else np.zeros((0, 1))
            return pd.Series(list(_scorer(kind, text).probabilities(rows))) if len(x) else pd.Series([], dtype=object)

        return _with_scores(dataset, scores(vector_to_array(F.col(self.getFeaturesCol()))))


def _with_scores(dataset: DataFrame, scores: Column) -> DataFrame:
    found = dataset.withColumn("_scores", scores)
    top = (F.array_position("_scores", F.array_max("_scores")) - 1).cast("double")
    return found.withColumns({"probability": array_to_vector(F.col("_scores")), "prediction": top}).drop("_scores")


class _ForestWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        SparkSession.getActiveSession().read.parquet(self.instance.getOrDefault("trees")).write.parquet(f"{path}/trees")


class _ForestReader(DefaultParamsReader):
    def load(self, path: str) -> FittedForest:
        return super().load(path)._set(trees=f"{path}/trees")


class FittedForest(Model, HasFeaturesCol, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` and ``prediction`` by the trees of a folder. Spark brings its files to the
    executors; a task takes some rows through one tree after another, so it holds a few trees of any forest."""

    trees = Param(Params._dummy(), "trees", "folder of the trees", TypeConverters.toString)
    fitted = Param(Params._dummy(), "fitted", "cuts and number of classes as JSON text", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, trees="", fitted="{}", featuresCol="features"):
        super().__init__()
        self._setDefault(featuresCol="features")
        self._set(**self._input_kwargs)

    def write(self) -> _ForestWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> _ForestReader:
        return _ForestReader(cls)

    def _files(self, spark: SparkSession) -> list[str]:
        """Has Spark bring the folder's files to its tasks; their names there."""
        context, place = spark.sparkContext, spark._jvm.org.apache.hadoop.fs.Path(self.getOrDefault("trees"))
        brought, names = getattr(context, "_sparktab_files", set()), []
        for found in place.getFileSystem(context._jsc.hadoopConfiguration()).listStatus(place):
            if found.getPath().getName().startswith("part-"):
                names.append(found.getPath().getName())
                if names[-1] not in brought:
                    context.addFile(found.getPath().toString())
                    brought.add(names[-1])
        context._sparktab_files = brought
        return sorted(names)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        names, given = self._files(dataset.sparkSession), json.loads(self.getOrDefault("fitted"))
        cuts, classes = [np.array(c) for c in given["cuts"]], given["classes"]

        def voted(x: np.ndarray) -> np.ndarray:
            bins, votes = np.ascontiguousarray(boosting.binned(np.nan_to_num(x), cuts).T), np.zeros((len(x), classes))
            for name in names:
                for batch in pq.ParquetFile(SparkFiles.get(name)).iter_batches(1, columns=["feature", "cut", "left", "shares"]):
                    for tree in zip(*(c.to_pylist() for c in batch.columns)):
                        votes += forest.Tree.unpacked(classes, *tree).votes(bins)
            return votes / np.maximum(votes.sum(axis=1, keepdims=True), forest.GRAIN)

        @F.pandas_udf("array<double>")
        def scores(some: Iterator[pd.Series]) -> Iterator[pd.Series]:
            held, size = [], 0
            for x in some:
                held.append(x)
                size += len(x)
                if size >= ASKED:
                    yield pd.Series(list(voted(np.stack(pd.concat(held).to_numpy()))))
                    held, size = [], 0
            if held:
                yield pd.Series(list(voted(np.stack(pd.concat(held).to_numpy()))) if size else [], dtype=object)

        return _with_scores(dataset, scores(vector_to_array(F.col(self.getFeaturesCol()))))


class _Learner(Estimator, HasFeaturesCol, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    settings = Param(Params._dummy(), "settings", "the learner's settings as JSON text", TypeConverters.toString)
    classes = Param(Params._dummy(), "classes", "number of classes", TypeConverters.toInt)

    def _blocks(self, dataset: DataFrame):
        x = vector_to_array(F.col(self.getFeaturesCol()))
        return blocks_of(dataset, x, F.col(self.getLabelCol()), [x, F.col(self.getLabelCol())])


class BoostedTrees(_Learner):
    """Boosted trees by the settings of ``boosting.Settings``; ``width`` is the number of features."""

    width = Param(Params._dummy(), "width", "number of features", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, settings="{}", classes=2, width=1, featuresCol="features", labelCol="label"):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FittedLearner:
        x = vector_to_array(F.col(self.getFeaturesCol()))
        cuts = boosting.fit_cuts(dataset, inputs_of(x, self.getOrDefault(self.width)))
        model = boosting.Model(boosting.Settings(**json.loads(self.getOrDefault(self.settings))))
        rows = self._blocks(dataset)
        made, _ = boosting.fit(rows, [model], self.getOrDefault(self.classes), cuts)
        rows.unpersist()
        return fitted_stage(made[0], self.getFeaturesCol())


class ForestTrees(_Learner):
    """A forest or a tree by the settings of ``forest.Settings``, grown in tasks; more rows than those can have go to Spark's."""

    width = Param(Params._dummy(), "width", "number of features", TypeConverters.toInt)
    cacheNodeIds = Param(Params._dummy(), "cacheNodeIds", "Spark's forest keeps each row's nodes between levels", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, settings="{}", classes=2, width=1, cacheNodeIds=True, featuresCol="features", labelCol="label"):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", cacheNodeIds=True)
        self._set(**self._input_kwargs)

    def getCacheNodeIds(self) -> bool:
        return self.getOrDefault(self.cacheNodeIds)

    def _fit(self, dataset: DataFrame) -> Model:
        s, width, classes = forest.Settings(**json.loads(self.getOrDefault(self.settings))), self.getOrDefault(self.width), self.getOrDefault(self.classes)
        if not forest.in_tasks(dataset.count(), width):
            given = {"maxDepth": min(s.depth, 30), "minInstancesPerNode": s.min_leaf, "seed": s.seed, "cacheNodeIds": self.getCacheNodeIds()}
            one = RandomForestClassifier(numTrees=s.trees, featureSubsetStrategy=s.columns, **given) if s.drawn else DecisionTreeClassifier(**given)
            return one.fit(dataset)
        x = vector_to_array(F.col(self.getFeaturesCol()))
        rows, cuts = self._blocks(dataset), boosting.fit_cuts(dataset, inputs_of(x, width), forest.BINS)
        made, _ = forest.fit(rows, [forest.Model(s)], classes, cuts)
        rows.unpersist()
        return fitted_stage(made[0], self.getFeaturesCol())


class GradientLearner(_Learner):
    """A learner of ``gradient`` by its name and settings."""

    learner = Param(Params._dummy(), "learner", "name of the learner", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, learner="Network", settings="{}", classes=2, featuresCol="features", labelCol="label"):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> FittedLearner:
        given = {k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(self.getOrDefault(self.settings)).items()}
        x = vector_to_array(F.col(self.getFeaturesCol()))
        learner = with_landmarks(gradient.LEARNERS[self.getOrDefault(self.learner)](**given), dataset, x, [x])
        rows = self._blocks(dataset)
        made, _ = gradient.fit(rows, [gradient.Model(learner)])
        rows.unpersist()
        return fitted_stage(made[0], self.getFeaturesCol())


def with_landmarks(learner: gradient.Learner, df: DataFrame, x: Column, keys: list) -> gradient.Learner:
    """The learner with landmarks drawn from the rows, if it wants any."""
    if not isinstance(learner, gradient.LandmarkMachine) or learner.points:
        return learner
    return learner.with_landmarks(fit_landmarks(df, x, keys, learner.components, learner.gamma, learner.seed))


def inputs_of(x: Column, width: int) -> list[Column]:
    return [F.get(x, F.lit(i)) for i in range(width)]


def fitted_stage(model: boosting.Ensemble | gradient.Fitted | forest.Forest, features: str = "features") -> FittedLearner | FittedForest:
    if isinstance(model, forest.Forest):
        return FittedForest(trees=model.trees, fitted=json.dumps({"cuts": model.cuts, "classes": model.classes}), featuresCol=features)
    kind = "boosted" if isinstance(model, boosting.Ensemble) else "gradient"
    return FittedLearner(kind=kind, fitted=model.to_json(), featuresCol=features)


def boosted_stage(settings: boosting.Settings, classes: int, width: int) -> BoostedTrees:
    return BoostedTrees(settings=json.dumps(asdict(settings)), classes=classes, width=width)


def forest_stage(settings: forest.Settings, classes: int, width: int) -> ForestTrees:
    return ForestTrees(settings=json.dumps(asdict(settings)), classes=classes, width=width)


def gradient_stage(learner: gradient.Learner) -> GradientLearner:
    return GradientLearner(learner=type(learner).__name__, settings=json.dumps(asdict(learner)), classes=learner.classes)
