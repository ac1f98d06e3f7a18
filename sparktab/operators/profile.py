"""Quality profile: gaps, types, summaries and category frequencies.

Each report reads the table once: all columns are aggregated into a single row, which
is then turned into one row per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.functions.scalar import measure
from sparktab.functions.vectors import doubles
from sparktab.operators.quantile import quantiles
from sparktab.operators.support import SMALL_BYTES, cells, measured_bytes, turn
from sparktab.spec import numeric_columns, text_columns

QUARTILES = (0.25, 0.5, 0.75)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column, n_null, n_rows."""
    columns = list(columns or df.columns)
    make = {"n_null": lambda c: F.count_if(F.col(c).isNull()), "n_rows": lambda c: F.count("*")}
    return turn(df.agg(*cells(columns, make)), columns, {"n_null": "bigint", "n_rows": "bigint"})


def table_info(df: DataFrame) -> DataFrame:
    """position, column, type, n_present."""
    types = {name: (i, kind) for i, (name, kind) in enumerate(df.dtypes)}
    make = {
        "position": lambda c: F.lit(types[c][0]),
        "type": lambda c: F.lit(types[c][1]),
        "n_present": lambda c: F.count(F.col(c)),
    }
    return turn(
        df.agg(*cells(df.columns, make)),
        df.columns,
        {"position": "int", "type": "string", "n_present": "bigint"},
    )


def summary(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True, small_bytes: int = SMALL_BYTES
) -> DataFrame:
    """column, n, mean, std (sample), min, q25, q50, q75, max."""
    columns = list(columns or numeric_columns(df))
    make = {
        "n": lambda c: F.count(measure(c)),
        "mean": lambda c: F.avg(measure(c)),
        "std": lambda c: F.stddev_samp(measure(c)),
        "min": lambda c: F.min(measure(c)),
        "max": lambda c: F.max(measure(c)),
    }
    kinds = {"n": "bigint", "mean": "double", "std": "double", "min": "double", "max": "double"}
    order = ["column", "n", "mean", "std", "min", "q25", "q50", "q75", "max"]
    split = [F.col("q")[i].alias(name) for i, name in enumerate(("q25", "q50", "q75"))]

    if exact and measured_bytes(df, columns) > small_bytes:
        moments = turn(df.agg(*cells(columns, make)), columns, kinds)
        cuts = quantiles(df, columns, QUARTILES, small_bytes=small_bytes).select("column", *split)
        return moments.join(F.broadcast(cuts), "column", "left").select(*order)

    quartile = (
        (lambda c: F.percentile(measure(c), doubles(QUARTILES)))
        if exact
        else (lambda c: F.percentile_approx(measure(c), list(QUARTILES), 10_000))
    )
    wide = df.agg(*cells(columns, {**make, "q": quartile}))
    return turn(wide, columns, {**kinds, "q": "array<double>"}).select(
        *[c for c in order[:5]], *split, "max"
    )


def category_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """column, value, n for every present value of the text columns."""
    columns = list(columns or text_columns(df))
    wide = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    return (
        wide.unpivot([], columns, "column", "value")
        .where("value IS NOT NULL")
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )


def by_frequency(counts: DataFrame) -> DataFrame:
    """Presentation order: per column, most frequent first, ties by value."""
    return counts.orderBy("column", F.col("n").desc(), "value")


def category_shares(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Adds each value's percentage of its column's present values.

    The totals are one row per column, which bounds the broadcast.
    """
    counts = category_counts(df, columns)
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", "n", (F.col("n") * 100.0 / F.col("total")).alias("pct")
    )
