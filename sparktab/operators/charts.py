"""The tables behind histograms, density curves, box and violin plots."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.functions.scalar import outside
from sparktab.operators.clean import fences
from sparktab.operators.quantile import quantiles
from sparktab.operators.support import SMALL_BYTES, attach, melt, null_safe_join

LISTED_BINS = 10_000
DENSITY_BINS = 4096

# ---------------------------------------------------------------------- histograms


def auto_bin_count(n: Column, low: Column, high: Column, iqr: Column) -> Column:
    """Bins of the narrower of Sturges' and Freedman and Diaconis' non-zero widths."""
    spread = high - low
    sturges = spread / (F.log2(n.cast("double")) + 1.0)
    freedman = 2.0 * iqr * F.pow(n.cast("double"), F.lit(-1.0 / 3.0))
    width = F.when(freedman > 0, F.least(sturges, freedman)).otherwise(sturges)
    wanted = F.ceil(F.try_divide(spread, width))
    return F.when(spread > 0, wanted).otherwise(F.lit(1)).cast("bigint")


def bin_edges(
    df: DataFrame,
    columns: Sequence[str],
    bins: int | str = "auto",
    by: Sequence[str] = (),
    small_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """by..., column, low, high, bins. Each group, NULL too, spans its own range."""
    if bins == "auto":
        q = quantiles(df, columns, [0.0, 0.25, 0.75, 1.0], by, small_bytes=small_bytes)
        low, q1, q3, high = (F.col("q")[i] for i in range(4))
        count = auto_bin_count(F.col("n"), low, high, q3 - q1)
        return q.select(*by, "column", low.alias("low"), high.alias("high"), count.alias("bins"))
    return (
        melt(df, columns, by)
        .groupBy(*by, "column")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
        .withColumn("bins", F.when(F.col("high") > F.col("low"), F.lit(int(bins))).otherwise(F.lit(1)).cast("bigint"))
    )


def bin_of(value: Column, low: Column, high: Column, bins: Column) -> Column:
    """Position of a value's bin; the last bin is closed on the right."""
    width = (high - low) / bins
    return F.least(F.coalesce(F.floor(F.try_divide(value - low, width)), F.lit(0)), bins - 1).cast("bigint")


def histogram(
    df: DataFrame,
    columns: Sequence[str],
    bins: int | str = "auto",
    by: Sequence[str] = (),
    small_bytes: int = SMALL_BYTES,
    listed_bins: int = LISTED_BINS,
) -> DataFrame:
    """by..., column, bin, left, right, n.

    There is no limit to the bins. Empty ones are listed with n = 0 where a group has at
    most ``listed_bins``; of longer tails only the bins with rows are given.
    """
    by = list(by)
    edges = bin_edges(df, columns, bins, by, small_bytes)
    shape = ["low", "high", "bins"]
    placed = attach(melt(df, columns, by), edges, [*by, "column"], spread=F.xxhash64("value"))
    counted = placed.groupBy(*by, "column", *shape, bin_of(F.col("value"), *map(F.col, shape)).alias("bin")).agg(
        F.count("*").alias("n")
    )
    some = counted.groupBy(*by, "column", *shape).agg(F.min("bin").alias("_any"))
    every = some.where(F.col("bins") <= listed_bins).withColumn("bin", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("bins") - 1)))
    listed = every.select(*by, "column", *shape, "bin", F.lit(0).cast("bigint").alias("n"))
    width = (F.col("high") - F.col("low")) / F.col("bins")
    return (
        counted.unionByName(listed)
        .groupBy(*by, "column", *shape, "bin")
        .agg(F.sum("n").alias("n"))
        .select(
            *by,
            "column",
            "bin",
            (F.col("low") + F.col("bin") * width).alias("left"),
            (F.col("low") + (F.col("bin") + 1) * width).alias("right"),
            "n",
        )
    )


# -------------------------------------------------------------------------- density


def density(
    df: DataFrame,
    columns: Sequence[str],
    points: int = 200,
    by: Sequence[str] = (),
    cut: float = 0.0,
    method: str = "exact",
    density_bins: int = DENSITY_BINS,
) -> DataFrame:
    """Gaussian kernel density on an even grid: by..., column, point, x, density.

    Scott's bandwidth; the grid runs from minimum to maximum, extended by ``cut``
    bandwidths. ``exact`` sums one kernel per row and grid point within each Arrow batch,
    so rows are never multiplied and only sums are shuffled. ``binned`` first reduces each
    group to ``density_bins`` counted means, so the cost per row no longer depends on the
    grid. A group of equal values or one row has no curve.
    """
    by = list(by)
    keys = [*by, "column"]
    rows = melt(df, columns, by)
    scale = (
        rows.groupBy(*keys)
        .agg(
            F.count("*").alias("total"),
            F.stddev_samp("value").alias("s"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
        )
        .where("s > 0")
        .withColumn("h", F.col("s") * F.pow(F.col("total").cast("double"), F.lit(-0.2)))
        .withColumn("first", F.col("low") - cut * F.col("h"))
        .withColumn("step", (F.col("high") - F.col("low") + 2 * cut * F.col("h")) / (points - 1))
    )
    fitted = attach(rows, scale, keys, spread=F.xxhash64("value"))
    shape = ["total", "h", "first", "step"]
    if method == "binned":
        bin_id = bin_of(F.col("value"), F.col("low"), F.col("high"), F.lit(density_bins))
        weighed = fitted.groupBy(*keys, *shape, bin_id.alias("bin")).agg(
            F.avg("value").alias("value"), F.count("*").cast("double").alias("weight")
        )
    elif method == "exact":
        weighed = fitted.withColumn("weight", F.lit(1.0))
    else:
        raise ValueError(method)

    needed = weighed.select(*keys, *shape, "value", "weight")
    kept = [f for f in needed.schema.fields if f.name not in ("value", "weight")]
    out = T.StructType([*kept, T.StructField("point", T.IntegerType()), T.StructField("mass", T.DoubleType())])
    norm = F.col("total") * F.col("h") * math.sqrt(2 * math.pi)
    return (
        needed.mapInPandas(_kernel_sums([f.name for f in kept], points), out)
        .groupBy(*keys, *shape, "point")
        .agg(F.sum("mass").alias("mass"))
        .select(
            *keys,
            "point",
            (F.col("first") + F.col("point") * F.col("step")).alias("x"),
            (F.col("mass") / norm).alias("density"),
        )
    )


def _kernel_sums(group: list[str], points: int):
    """Kernel sums of each batch on its group's grid: one row per group and grid point."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        steps = np.arange(points, dtype="int32")
        for batch in batches:
            for labels, rows in batch.groupby(group, dropna=False, sort=False):
                named = {k: None if pd.isna(v) else v for k, v in zip(group, labels)}
                grid = named["first"] + steps * named["step"]
                u = (grid[:, None] - rows["value"].to_numpy()[None, :]) / named["h"]
                mass = np.exp(-0.5 * u * u) @ rows["weight"].to_numpy()
                constant = {k: pd.Series([v] * points, dtype=object if v is None or isinstance(v, str) else None) for k, v in named.items()}
                yield pd.DataFrame({**constant, "point": steps, "mass": mass})

    return sums


# -------------------------------------------------------------------- boxes, violins


def box_stats(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: float = 1.5, small_bytes: int = SMALL_BYTES
) -> DataFrame:
    """Quartiles, whiskers (outermost values inside the fences) and the count beyond."""
    by = list(by)
    limits = fences(df, columns, by, k, small_bytes)
    stats = ["n", "q1", "median", "q3"]
    rows = attach(melt(df, columns, by), limits, [*by, "column"], spread=F.xxhash64("value"))
    return rows.groupBy(*by, "column", *stats).agg(
        F.min(F.when(F.col("value") >= F.col("low"), F.col("value"))).alias("whisker_low"),
        F.max(F.when(F.col("value") <= F.col("high"), F.col("value"))).alias("whisker_high"),
        F.count_if(outside(F.col("value"), F.col("low"), F.col("high"))).alias("n_fliers"),
    )


def compare_boxes(before: DataFrame, after: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Box statistics before and after a step, with the change of spread and fliers."""
    keys = [*by, "column"]
    stats = ["n", "q1", "median", "q3", "whisker_low", "whisker_high", "n_fliers"]

    def tagged(df: DataFrame, tag: str) -> DataFrame:
        return df.select(*keys, *[F.col(c).alias(f"{c}_{tag}") for c in stats])

    return (
        null_safe_join(tagged(before, "before"), tagged(after, "after"), keys)
        .withColumn("rows_removed", F.col("n_before") - F.col("n_after"))
        .withColumn(
            "iqr_change",
            (F.col("q3_after") - F.col("q1_after")) - (F.col("q3_before") - F.col("q1_before")),
        )
        .withColumn("fliers_change", F.col("n_fliers_after") - F.col("n_fliers_before"))
    )


def violin(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str],
    points: int = 100,
    method: str = "exact",
    small_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """Density per category, two bandwidths beyond the data, with the three quartiles.

    A category without a curve keeps its quartiles in one row with a NULL point.
    """
    curve = density(df, columns, points, by, cut=2.0, method=method)
    inner = quantiles(df, columns, [0.25, 0.5, 0.75], by, small_bytes=small_bytes).select(
        *by, "column", *[F.col("q")[i].alias(n) for i, n in enumerate(("q1", "median", "q3"))]
    )
    keys = [*by, "column"]
    return null_safe_join(inner, curve, keys, "left").select(*keys, "point", "x", "density", "q1", "median", "q3")
