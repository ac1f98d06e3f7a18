"""Row validation against closed ranges and lists of allowed values."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.functions.scalar import measure


@dataclass(frozen=True)
class InRange:
    """``low <= value <= high``."""

    column: str
    low: float
    high: float

    @property
    def name(self) -> str:
        return f"{self.column}:range"

    def holds(self) -> Column:
        return measure(self.column).between(self.low, self.high)


@dataclass(frozen=True)
class OneOf:
    """The value is in a list."""

    column: str
    allowed: tuple

    @property
    def name(self) -> str:
        return f"{self.column}:allowed"

    def holds(self) -> Column:
        return F.col(self.column).isin(list(self.allowed))


Rule = InRange | OneOf


def applicable(df: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """Rules whose column the frame has."""
    have = set(df.columns)
    return [r for r in rules if r.column in have]


def _broken(rule: Rule) -> Column:
    """A missing value breaks its rule."""
    return ~F.coalesce(rule.holds(), F.lit(False))


def with_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Adds ``violations``: the names of the broken rules, in rule order."""
    marks = [F.when(_broken(r), F.lit(r.name)) for r in applicable(df, rules)]
    empty = F.array().cast("array<string>")
    return df.withColumn("violations", F.array_compact(F.array(*marks)) if marks else empty)


def rule_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule, n_rows, n_violations; one pass for all rules. No rows without an applicable rule."""
    usable = applicable(df, rules)
    if not usable:
        return df.sparkSession.createDataFrame([], "rule string, n_rows bigint, n_violations bigint")
    row = df.agg(F.count("*").alias("n"), *[F.count_if(_broken(r)).alias(f"r{i}") for i, r in enumerate(usable)])
    items = [
        F.struct(F.lit(r.name).alias("rule"), F.col("n").alias("n_rows"), F.col(f"r{i}").alias("n_violations"))
        for i, r in enumerate(usable)
    ]
    return row.select(F.inline(F.array(*items)))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("violations") == 0).drop("violations")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.where(F.size("violations") > 0)
