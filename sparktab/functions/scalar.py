"""Scalar building blocks. All are Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def measure(name: str | Column) -> Column:
    """A numeric column as double with NaN and infinities turned into NULL.

    Spark orders NaN above every number, so it would otherwise pass ``x > high``; one
    infinite value would make means, deviations and bin widths useless.
    """
    col = (F.col(name) if isinstance(name, str) else name).cast("double")
    return F.when(F.abs(col) < F.lit(float("inf")), col)


def title_label(col: Column) -> Column:
    """``total_price`` -> ``Total Price``."""
    return F.initcap(F.translate(col, "_", " "))


def file_label(col: Column) -> Column:
    """A display name made safe for a path."""
    return F.lower(F.regexp_replace(col, "[^A-Za-z0-9]+", "_"))


def share_percent(part: Column, whole: Column) -> Column:
    """``part`` in percent of ``whole``; NULL when there is no whole."""
    return F.try_divide(part.cast("double") * 100.0, whole.cast("double"))


def direction(col: Column, up: str = "toward", down: str = "away") -> Column:
    """Word for the sign of a contribution. Zero counts as ``down``."""
    return F.when(col > 0, F.lit(up)).otherwise(F.lit(down))


def indicator(condition: Column) -> Column:
    """1 when the condition holds, else 0 (also for NULL)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def outside(col: Column, low, high) -> Column:
    """Strictly beyond a fence on either side; NULL is never outside."""
    return F.coalesce((col < low) | (col > high), F.lit(False))


def share_where(condition: Column) -> Column:
    """Aggregate: share of rows that meet the condition."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))


def any_of(conditions: Sequence[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out


def all_of(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def presented(col: Column, digits: int) -> Column:
    """Half-even rounding, for columns people read; never for values compared later."""
    return F.bround(col, digits)
