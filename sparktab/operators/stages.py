"""Spark ML stages over the package's expressions, so that all preparation is fitted
inside the pipeline, on the training rows of each fold, and saved with the model."""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasInputCols, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.functions.vectors import doubles
from sparktab.operators.clean import Moments
from sparktab.operators.prepare import Levels, Standardiser, fit_levels, fit_standardiser


class _HasFitted(Params):
    fitted = Param(Params._dummy(), "fitted", "fitted values as JSON text", TypeConverters.toString)

    def value(self):
        return json.loads(self.getOrDefault(self.fitted))


class ScaleColumns(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Standardises columns in place by the population statistics of the fitted rows."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> ScaleColumnsModel:
        fitted = fit_standardiser(dataset, self.getInputCols()).fitted
        text = json.dumps({c: [m.n, m.n_missing, m.mean, m.deviation] for c, m in fitted.items()})
        return ScaleColumnsModel()._set(inputCols=self.getInputCols(), fitted=text)


class ScaleColumnsModel(Model, HasInputCols, _HasFitted, DefaultParamsReadable, DefaultParamsWritable):
    def standardiser(self) -> Standardiser:
        return Standardiser({c: Moments(*v) for c, v in self.value().items()})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.standardiser().apply(dataset)


class CategoryColumns(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Turns categories into numbers: two levels into a code, more into indicators.

    ``levels`` (JSON text) names the levels of all training rows, so that every fold has the
    same columns even if it lacks a level; without it they are those of the fitted rows.
    """

    levels = Param(Params._dummy(), "levels", "levels per column as JSON text", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, levels="{}"):
        super().__init__()
        self._setDefault(levels="{}")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> CategoryColumnsModel:
        known = json.loads(self.getOrDefault(self.levels))
        levels = {c: known.get(c) or list(fit_levels(dataset, c).values) for c in self.getInputCols()}
        return CategoryColumnsModel()._set(inputCols=self.getInputCols(), fitted=json.dumps(levels))


class CategoryColumnsModel(Model, HasInputCols, _HasFitted, DefaultParamsReadable, DefaultParamsWritable):
    def columns(self) -> dict:
        out = {}
        for name, values in self.value().items():
            levels = Levels(name, tuple(values))
            if len(values) <= 2:
                out[f"_cat:{name}:code"] = F.coalesce(levels.encode().cast("double"), F.lit(0.0))
            else:
                marks = levels.indicators().values()
                out.update({f"_cat:{name}:{v}": c.cast("double") for v, c in zip(values, marks)})
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns(self.columns())


class GatherFeatures(Transformer, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Packs numeric columns and all fitted category columns into one vector.

    Category columns are only known after fitting, so they are found by their prefix and
    taken in name order.
    """

    numeric = Param(Params._dummy(), "numeric", "numeric columns", TypeConverters.toListString)
    categories = Param(Params._dummy(), "categories", "category columns", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, numeric=None, categories=None, outputCol="features"):
        super().__init__()
        self._setDefault(numeric=[], categories=[], outputCol="features")
        self._set(**self._input_kwargs)

    def names(self, columns: list[str]) -> list[str]:
        out = list(self.getOrDefault(self.numeric))
        for c in self.getOrDefault(self.categories):
            out += sorted(x for x in columns if x.startswith(f"_cat:{c}:"))
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values = [F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in self.names(dataset.columns)]
        return dataset.withColumn(self.getOutputCol(), array_to_vector(F.array(*values)))


class FourierFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Random Fourier features (Rahimi and Recht, 2007): a linear model on them
    approximates one with the kernel exp(-gamma * squared distance)."""

    components = Param(Params._dummy(), "components", "number of features", TypeConverters.toInt)
    gamma = Param(Params._dummy(), "gamma", "kernel width; 0 means 1 / inputs", TypeConverters.toFloat)
    width = Param(Params._dummy(), "width", "number of inputs", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="projected", components=100, gamma=0.0, width=1, seed=54):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="projected", components=100, gamma=0.0, width=1, seed=54)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        p, d = self.getOrDefault(self.width), self.getOrDefault(self.components)
        gamma = self.getOrDefault(self.gamma) or 1.0 / p
        rng = np.random.default_rng(self.getSeed())
        directions = rng.normal(scale=math.sqrt(2 * gamma), size=(d, p))
        shifts = rng.uniform(0, 2 * math.pi, size=d)
        table = F.array(*[F.struct(doubles(w).alias("w"), F.lit(float(b)).alias("b")) for w, b in zip(directions, shifts)])
        x = vector_to_array(F.col(self.getInputCol()))

        def one(t):
            products = F.zip_with(t.w, x, lambda a, b: a * b)
            return math.sqrt(2.0 / d) * F.cos(F.aggregate(products, t.b, lambda acc, v: acc + v))

        return dataset.withColumn(self.getOutputCol(), array_to_vector(F.transform(table, one)))


class ClassScores(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Gives every classifier the same output: ``probability`` as an array.

    Models without probabilities of their own get their raw scores through a logistic
    function, normalised over the classes. These rank classes; they are not calibrated.
    """

    source = Param(Params._dummy(), "source", "probability or raw score column", TypeConverters.toString)
    calibrated = Param(Params._dummy(), "calibrated", "the source holds probabilities", TypeConverters.toBoolean)
    steepness = Param(Params._dummy(), "steepness", "factor on raw scores", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, source="probability", calibrated=True, steepness=1.0):
        super().__init__()
        self._setDefault(source="probability", calibrated=True, steepness=1.0)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values = vector_to_array(F.col(self.getOrDefault(self.source)))
        if not self.getOrDefault(self.calibrated):
            k = self.getOrDefault(self.steepness)
            values = F.transform(values, lambda v: 1.0 / (1.0 + F.exp(-k * v)))
            total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
            values = F.transform(values, lambda v: v / total)
        return dataset.withColumn("scores", values)
