"""Expressions over probability vectors and feature arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(values: Sequence[float]) -> Column:
    """A literal ``array<double>``."""
    return F.array(*[F.lit(float(v)) for v in values])


def confidence(probabilities: Column) -> Column:
    """The highest probability in percent."""
    return F.array_max(probabilities) * 100.0


def named_map(names: Sequence[str], values: Column) -> Column:
    return F.map_from_arrays(F.array(*[F.lit(n) for n in names]), values)


def name_at(names: Sequence[str], position: Column) -> Column:
    """Decode a 0-based code with a literal list of names."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), position + 1)
