"""Exact additive attribution of a linear classifier, and set-based scoring.

For a linear margin the contribution of a feature against the training mean is
``weight * (value - mean)``; with the base value ``intercept + weights . means`` the
contributions add up to the margin. Model values are literals, so everything here is a
projection: no join, no shuffle, and the same code runs on streams.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.functions.scalar import direction, measure, presented
from sparktab.functions.vectors import doubles, named_map


@dataclass(frozen=True)
class LinearModel:
    """Weights per class over features. ``centre`` and ``spread`` are what the features
    were standardised with before the weights apply; ``means`` are the training means of
    the features as the weights see them. ``missing`` says what a missing feature does:
    ``null`` leaves the row without a prediction, ``mean`` counts it as 0 after scaling,
    which is the training mean, as trained pipelines do. ``formulas`` are features that are
    computed, such as the indicators of a category.
    """

    features: tuple[str, ...]
    classes: tuple[str, ...]
    weights: tuple[tuple[float, ...], ...]
    intercepts: tuple[float, ...]
    means: tuple[float, ...]
    centre: tuple[float, ...] | None = None
    spread: tuple[float, ...] | None = None
    formulas: tuple[tuple[str, str], ...] = ()
    missing: str = "null"

    def raw(self, j: int) -> Column:
        """A feature's own value: a column, or what its formula (SQL text) makes of columns."""
        name = self.features[j]
        formula = dict(self.formulas).get(name)
        return measure(name if formula is None else F.expr(formula))

    def inputs(self) -> list[Column]:
        """The features as the weights see them."""
        out = []
        for j in range(len(self.features)):
            value = self.raw(j)
            if self.centre is not None:
                value = value - F.lit(self.centre[j])
            if self.spread is not None and self.spread[j]:
                value = value / F.lit(self.spread[j])
            out.append(F.coalesce(value, F.lit(0.0)) if self.missing == "mean" else value)
        return out

    def base(self, c: int) -> float:
        return self.intercepts[c] + sum(w * m for w, m in zip(self.weights[c], self.means))

    def phi(self, c: int, j: int) -> Column:
        """Attribution of feature ``j`` to class ``c``, given the inputs as ``_x0``..."""
        return F.lit(float(self.weights[c][j])) * (F.col(f"_x{j}") - F.lit(float(self.means[j])))


def with_inputs(df: DataFrame, model: LinearModel) -> DataFrame:
    """Adds each input once, as ``_x0``...; expressions on top refer to them instead of
    repeating how a feature is computed."""
    return df.withColumns({f"_x{j}": x for j, x in enumerate(model.inputs())})


def with_scores(df: DataFrame, model: LinearModel) -> DataFrame:
    """Adds probability (array), prediction (class name) and confidence (percent).

    A softmax shifted by the largest margin, step by step in plain columns: all of it is
    arithmetic in generated code. The first class wins ties.
    """
    classes = range(len(model.classes))
    margins = {
        f"_m{c}": sum((F.col(f"_x{j}") * F.lit(float(w)) for j, w in enumerate(model.weights[c])), F.lit(0.0))
        + F.lit(float(model.intercepts[c]))
        for c in classes
    }
    prediction = F.when(F.lit(False), F.lit(model.classes[0]))
    for c in classes:
        prediction = prediction.when(F.col(f"_m{c}") == F.col("_top"), F.lit(model.classes[c]))
    total = sum((F.col(f"_e{c}") for c in classes), F.lit(0.0))
    scored = (
        with_inputs(df, model)
        .withColumns(margins)
        .withColumn("_top", F.greatest(*margins))
        .withColumns({"prediction": prediction, **{f"_e{c}": F.exp(F.col(f"_m{c}") - F.col("_top")) for c in classes}})
        .withColumn("_total", total)
        .withColumns(
            {
                "probability": F.array(*[F.col(f"_e{c}") / F.col("_total") for c in classes]),
                "confidence": F.lit(1.0) / F.col("_total") * 100.0,
            }
        )
    )
    return scored.drop("_top", "_total", *[f"_x{j}" for j in range(len(model.features))], *margins, *[f"_e{c}" for c in classes])


# ---------------------------------------------------------------------- attributions


def attributions(df: DataFrame, model: LinearModel, keys: Sequence[str]) -> DataFrame:
    """keys..., class, feature, value, phi: every class and feature of every row."""
    items = [
        F.struct(
            F.lit(c).alias("class"),
            F.lit(f).alias("feature"),
            F.col("_raw")[j].alias("value"),
            model.phi(i, j).alias("phi"),
        )
        for i, c in enumerate(model.classes)
        for j, f in enumerate(model.features)
    ]
    raw = F.array(*[model.raw(j) for j in range(len(model.features))])
    return with_inputs(df, model).withColumn("_raw", raw).select(*keys, F.inline(F.array(*items)))


def _per_class(model: LinearModel) -> Column:
    """Every class with its weight on the row's feature, as an array to unfold."""
    weights = F.create_map(*[x for c, w in zip(model.classes, model.weights) for x in (F.lit(c), doubles(w))])
    return F.transform(
        F.map_entries(weights), lambda e: F.struct(e.key.alias("class"), F.get(e.value, F.col("j")).alias("w"))
    )


def importance(df: DataFrame, model: LinearModel) -> DataFrame:
    """class, feature, importance: the mean absolute attribution.

    The attribution is linear, so the mean is ``|weight| * mean |value - mean|``: one
    aggregate per feature whatever the number of classes, and no row is multiplied.
    """
    away = [F.avg(F.abs(F.col(f"_x{j}") - F.lit(float(m)))).alias(f"away__{j}") for j, m in enumerate(model.means)]
    items = [
        F.struct(F.lit(j).alias("j"), F.lit(f).alias("feature"), F.col(f"away__{j}").alias("away"))
        for j, f in enumerate(model.features)
    ]
    per_feature = with_inputs(df, model).agg(*away).select(F.inline(F.array(*items)))
    return per_feature.select("feature", "away", F.inline(_per_class(model))).select(
        "class", "feature", (F.abs("w") * F.col("away")).alias("importance")
    )


def names_array(names: Sequence[str]) -> Column:
    """A literal array of names."""
    return F.array(*[F.lit(n) for n in names])


def ranked_importance(df: DataFrame, model: LinearModel) -> DataFrame:
    return importance(df, model).orderBy("class", F.col("importance").desc(), "feature")


def attribution_summary(df: DataFrame, model: LinearModel, bins: int = 20) -> DataFrame:
    """What a summary plot shows, as counts: per class, feature and value bin the rows and
    the mean, lowest and highest attribution. Bins split each feature's range evenly.

    Rows are binned per feature; the classes' attributions follow from each bin's lowest,
    mean and highest input, so classes multiply the bins and not the rows.
    """
    span = df.agg(*[f(model.raw(j)).alias(f"{n}__{j}") for j in range(len(model.features)) for n, f in (("lo", F.min), ("hi", F.max))])
    edges = span.first()
    items = [
        F.struct(
            F.lit(j).alias("j"),
            F.lit(f).alias("feature"),
            _even_bin(model.raw(j), edges[f"lo__{j}"], edges[f"hi__{j}"], bins).alias("bin"),
            (F.col(f"_x{j}") - F.lit(float(model.means[j]))).alias("away"),
        )
        for j, f in enumerate(model.features)
    ]
    binned = (
        with_inputs(df, model)
        .select(F.inline(F.array(*items)))
        .where("away IS NOT NULL")
        .groupBy("j", "feature", "bin")
        .agg(F.count("*").alias("n"), F.avg("away").alias("mean"), F.min("away").alias("low"), F.max("away").alias("high"))
    )
    ends = [F.col("w") * F.col("low"), F.col("w") * F.col("high")]
    return binned.select("feature", "bin", "n", "mean", "low", "high", F.inline(_per_class(model))).select(
        "class",
        "feature",
        "bin",
        "n",
        (F.col("w") * F.col("mean")).alias("mean_phi"),
        F.least(*ends).alias("low_phi"),
        F.greatest(*ends).alias("high_phi"),
    )


def _even_bin(value: Column, low: float | None, high: float | None, bins: int) -> Column:
    if low is None or high <= low:
        return F.lit(0)
    return F.least(F.floor((value - F.lit(low)) / F.lit((high - low) / bins)), F.lit(bins - 1)).cast("int")


# ------------------------------------------------------------- per-row explanations


def _with_ordered(df: DataFrame, model: LinearModel) -> DataFrame:
    """Adds ``_code`` of the predicted class and ``_ordered``, its attributions: largest
    magnitude first, ties by feature. Both are NULL and empty where a missing feature
    leaves a row without a prediction."""
    weights = F.element_at(F.array(*[doubles(w) for w in model.weights]), F.col("_code") + 1)
    names, means = names_array(model.features), doubles(model.means)
    parts = F.transform(
        F.zip_with(F.zip_with("_inputs", means, lambda x, m: x - m), F.col("_weights"), lambda d, w: d * w),
        lambda phi, j: F.struct((-F.abs(phi)).alias("rank"), F.get(names, j).alias("feature"), phi.alias("phi")),
    )
    code = (F.array_position(names_array(model.classes), F.col("prediction")) - 1).cast("int")
    nothing = F.array().cast("array<struct<rank:double,feature:string,phi:double>>")
    return (
        df.withColumns({"_code": code, "_inputs": F.array(*model.inputs())})
        .withColumn("_weights", weights)
        .withColumn("_ordered", F.when(F.col("_code").isNotNull(), F.array_sort(parts)).otherwise(nothing))
        .drop("_inputs", "_weights")
    )


def with_top_factors(df: DataFrame, model: LinearModel, k: int = 3) -> DataFrame:
    """Adds the k features that moved the predicted class most: feature, direction, impact.

    The direction is relative to the predicted class. Sorting happens inside the row.
    """
    top = F.slice("_ordered", 1, k)
    shaped = F.transform(
        top,
        lambda t: F.struct(
            t.feature.alias("feature"), direction(t.phi).alias("direction"), F.abs(t.phi).alias("impact")
        ),
    )
    return _with_ordered(df, model).withColumn("top_factors", shaped).drop("_ordered", "_code")


def waterfall(df: DataFrame, model: LinearModel, keys: Sequence[str], shown: int = 5) -> DataFrame:
    """keys..., step, feature, phi, running: the path from base value to margin.

    The ``shown`` largest contributions, then the rest folded into ``other``; ``running``
    starts at the base value of the predicted class and ends at its margin. The outer
    explode keeps Spark from inferring a filter on the whole expression, which it would
    push to the scan and evaluate twice. A row without a prediction has one row of NULLs.
    """
    base = F.element_at(doubles([model.base(c) for c in range(len(model.classes))]), F.col("_code") + 1)
    pairs = F.transform(F.slice("_ordered", 1, shown), lambda t: F.struct(t.feature.alias("feature"), t.phi.alias("phi")))
    if len(model.features) > shown:
        rest = F.aggregate(
            F.slice("_ordered", shown + 1, len(model.features)), F.lit(0.0), lambda acc, t: acc + t.phi
        )
        pairs = F.when(F.size("_ordered") == 0, pairs).otherwise(
            F.concat(pairs, F.array(F.struct(F.lit("other").alias("feature"), rest.alias("phi"))))
        )
    running = F.transform(
        "steps",
        lambda _, i: F.aggregate(F.slice("steps", F.lit(1), i + 1), F.col("base"), lambda acc, t: acc + t.phi),
    )
    return (
        _with_ordered(df, model)
        .select(*keys, base.alias("base"), pairs.alias("steps"))
        .withColumn("running", running)
        .select(*keys, F.posexplode_outer(F.arrays_zip("steps", "running")).alias("step", "part"))
        .select(
            *keys,
            (F.col("step") + 1).alias("step"),
            F.col("part.steps.feature").alias("feature"),
            F.col("part.steps.phi").alias("phi"),
            F.col("part.running").alias("running"),
        )
    )


def score(df: DataFrame, model: LinearModel, keys: Sequence[str], k: int = 3) -> DataFrame:
    """keys..., result: prediction, confidence, probabilities by class and top factors."""
    ready = with_top_factors(with_scores(df, model), model, k)
    return ready.select(
        *keys,
        F.struct(
            "prediction",
            "confidence",
            named_map(model.classes, F.col("probability")).alias("probabilities"),
            "top_factors",
        ).alias("result"),
    )


def presented_scores(scored: DataFrame, digits: int = 1) -> DataFrame:
    """Scores as people read them: rounded percentages and impacts."""
    r = F.col("result")
    return scored.withColumn(
        "result",
        F.struct(
            r.prediction.alias("prediction"),
            presented(r.confidence, digits).alias("confidence"),
            F.transform_values(r.probabilities, lambda _, p: presented(p * 100.0, digits)).alias("probabilities"),
            F.transform(
                r.top_factors,
                lambda t: F.struct(
                    F.initcap(F.translate(t.feature, "_", " ")).alias("feature"),
                    t.direction.alias("direction"),
                    presented(t.impact, 4).alias("impact"),
                ),
            ).alias("top_factors"),
        ),
    )
