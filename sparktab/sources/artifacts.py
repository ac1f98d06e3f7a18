"""Trained models on disk: one new directory per saved version, never overwritten."""

from __future__ import annotations

import dataclasses
import json

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from sparktab.operators.attribution import LinearModel
from sparktab.operators.models import TrainedModel


def save_model(spark: SparkSession, model: TrainedModel, directory: str) -> str:
    """Writes the pipeline and a one-row table with what scoring needs besides it."""
    model.pipeline.write().save(f"{directory}/pipeline")
    row = (model.name, list(model.classes), list(model.numeric), list(model.categories))
    kinds = "name string, classes array<string>, numeric array<string>, categories array<string>"
    spark.createDataFrame([row], kinds).coalesce(1).write.parquet(f"{directory}/roles")
    return directory


def load_model(spark: SparkSession, directory: str) -> TrainedModel:
    row = spark.read.parquet(f"{directory}/roles").first()
    return TrainedModel(
        name=row["name"],
        pipeline=PipelineModel.load(f"{directory}/pipeline"),
        classes=tuple(row["classes"]),
        numeric=tuple(row["numeric"]),
        categories=tuple(row["categories"]),
    )


def save_linear(spark: SparkSession, model: LinearModel, directory: str) -> str:
    """Writes a linear model as one row of JSON text, for scoring without its pipeline."""
    spark.createDataFrame([(json.dumps(dataclasses.asdict(model)),)], "model string").coalesce(1).write.parquet(directory)
    return directory


def load_linear(spark: SparkSession, directory: str) -> LinearModel:
    deep = lambda v: tuple(deep(x) for x in v) if isinstance(v, list) else v
    found = json.loads(spark.read.parquet(directory).first()["model"])
    return LinearModel(**{k: deep(v) for k, v in found.items()})
