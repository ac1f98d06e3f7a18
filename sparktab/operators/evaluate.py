"""Evaluation of predictions, confidence reports and model ranking."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.functions.scalar import share_where
from sparktab.functions.vectors import confidence
from sparktab.operators.support import bounded_rows

# ----------------------------------------------------------------- predicted classes


def classes_of(df: DataFrame, label: str = "label", prediction: str = "prediction") -> list:
    """Every class that occurs as a label or as a prediction, sorted."""
    pair = df.select(F.explode(F.array(F.col(label), F.col(prediction))).alias("class"))
    rows = bounded_rows(pair.where("class IS NOT NULL").distinct())
    if rows is None:
        raise ValueError("too many classes")
    return sorted(r[0] for r in rows)


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """by..., n, accuracy."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n"), share_where(F.col(label) == F.col(prediction)).alias("accuracy")
    )


def fold_summary(df: DataFrame, fold: str, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Mean and population deviation of the accuracy over folds."""
    return (
        accuracy(df, label, prediction, [*by, fold])
        .groupBy(*by)
        .agg(F.avg("accuracy").alias("cv_mean"), F.stddev_pop("accuracy").alias("cv_std"))
    )


def confusion(df: DataFrame, classes: Sequence, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """label, prediction, n for every pair of classes; pairs that never occur have 0.

    The driver holds the classes; their pairs are made on the cluster.
    """
    counted = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count("*").alias("n")
    )
    kinds = dict(counted.dtypes)
    rows = df.sparkSession.createDataFrame([(c,) for c in classes], f"label {kinds['label']}")
    listed = F.array(*[F.lit(c) for c in classes]).cast(f"array<{kinds['prediction']}>")
    every = rows.withColumn("prediction", F.explode(listed))
    return every.join(counted, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def class_report(matrix: DataFrame) -> DataFrame:
    """precision, recall, f1 and support per class, then accuracy and both averages.

    Works on the confusion matrix, which is as small as the number of classes squared. A
    ratio with nothing to divide by is 0.
    """
    sides = F.array(
        F.struct(F.col("label").alias("class"), F.lit(1).alias("actual"), F.lit(0).alias("said")),
        F.struct(F.col("prediction").alias("class"), F.lit(0).alias("actual"), F.lit(1).alias("said")),
    )
    hits = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    per_class = (
        matrix.withColumn("hit", hits)
        .select("n", "hit", F.inline(sides))
        .groupBy("class")
        .agg(
            F.sum(F.col("n") * F.col("actual")).alias("support"),
            F.sum(F.col("n") * F.col("said")).alias("predicted"),
            F.sum(F.col("hit") * F.col("actual")).alias("hit"),
        )
        .withColumn("precision", _ratio(F.col("hit"), F.col("predicted")))
        .withColumn("recall", _ratio(F.col("hit"), F.col("support")))
        .withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    )
    shown = ["precision", "recall", "f1"]
    total = F.sum("support")
    whole = per_class.agg(
        total.alias("support"),
        _ratio(F.sum("hit"), total).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in shown],
        *[_ratio(F.sum(F.col(c) * F.col("support")), total).alias(f"weighted_{c}") for c in shown],
    )
    lines = [
        F.struct(
            F.lit(name).alias("class"),
            *[
                (F.col("accuracy") if name == "accuracy" else F.col(f"{prefix}_{c}")).alias(c)
                for c in shown
            ],
            F.col("support"),
        )
        for name, prefix in (("accuracy", ""), ("macro avg", "macro"), ("weighted avg", "weighted"))
    ]
    single = per_class.select(F.col("class").cast("string").alias("class"), *shown, "support")
    return single.unionByName(whole.select(F.inline(F.array(*lines))))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


# ---------------------------------------------------------------------- model tables


def rank_models(results: DataFrame, score: str = "accuracy") -> DataFrame:
    """Best first; equal scores by name."""
    return results.orderBy(F.col(score).desc(), "model")


def best_model(results: DataFrame, score: str = "accuracy") -> DataFrame:
    return rank_models(results, score).limit(1)


def before_after(before: DataFrame, after: DataFrame, score: str = "accuracy") -> DataFrame:
    """model, before, after, gain, with the best of each side as reference lines."""
    both = before.select("model", F.col(score).alias("before")).join(
        after.select("model", F.col(score).alias("after")), "model", "inner"
    )
    tops = both.agg(F.max("before").alias("best_before"), F.max("after").alias("best_after"))
    top = F.broadcast(tops.withColumn("_one", F.lit(1)))
    return (
        both.withColumn("_one", F.lit(1))
        .join(top, "_one")
        .drop("_one")
        .withColumn("gain", F.col("after") - F.col("before"))
        .orderBy(F.col("after").desc(), "model")
    )


# ------------------------------------------------------------------------ confidence


def with_confidence(df: DataFrame, probability: str = "probability", out: str = "confidence") -> DataFrame:
    return df.withColumn(out, confidence(F.col(probability)))


def confidence_summary(df: DataFrame, by: Sequence[str] = (), high: float = 90.0) -> DataFrame:
    """by..., n, mean confidence and the share of rows at or above ``high``."""
    return df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg("confidence").alias("mean_confidence"),
        share_where(F.col("confidence") >= high).alias("share_high"),
    )


def with_borderline(df: DataFrame, threshold: float = 70.0) -> DataFrame:
    """Strictly below the threshold."""
    return df.withColumn("borderline", F.coalesce(F.col("confidence") < threshold, F.lit(False)))


def triage(df: DataFrame, threshold: float = 70.0, by: Sequence[str | Column] = ()) -> DataFrame:
    """Rows per predicted class and borderline flag."""
    return with_borderline(df, threshold).groupBy(*by, "prediction", "borderline").agg(F.count("*").alias("n"))


def surest_correct(df: DataFrame, keys: Sequence[str], probability: str = "probability") -> DataFrame:
    """Per class, the correct row with the highest probability, the lowest key on ties.

    One pass with a partial aggregate, so each task sends one row per class. Correctness
    is part of the value, not a filter: a filter would be pushed below the scoring, which
    would then be computed twice per row. Classes without a correct row do not appear.
    """
    worth = F.when(F.col("label") == F.col("prediction"), -F.array_max(probability))
    best = F.min(F.when(worth.isNotNull(), F.struct(worth.alias("p"), F.struct(*keys).alias("k")))).alias("best")
    found = df.groupBy("label").agg(best).where("best IS NOT NULL")
    return found.select("label", "best.k.*", (-F.col("best.p")).alias("top_probability"))
