"""Column roles: which columns identify, measure, categorise or label a row."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def columns_of_type(df: DataFrame, *types: type) -> list[str]:
    """Names of the columns whose type is an instance of one of ``types``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types)]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, T.NumericType)


def text_columns(df: DataFrame) -> list[str]:
    return columns_of_type(df, T.StringType)


def without(names: Iterable[str], excluded: Iterable[str]) -> list[str]:
    """``names`` in order, less those in ``excluded``."""
    skip = set(excluded)
    return [n for n in names if n not in skip]


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The requested names the frame has; reports skip the others."""
    have = set(df.columns)
    return [n for n in names if n in have]


@dataclass(frozen=True)
class TableSpec:
    """Roles of a table's columns. ``exclude`` is left out of modelling only."""

    keys: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    target: str | None = None
    score: str | None = None
    exclude: tuple[str, ...] = field(default=())

    @property
    def outlier_columns(self) -> list[str]:
        """Every measured column but the score, also those not modelled."""
        return without(self.numeric, [self.score] if self.score else [])

    @property
    def feature_columns(self) -> list[str]:
        drop = set(self.exclude) | {self.score, self.target}
        return [c for c in (*self.numeric, *self.categorical) if c not in drop]

    def features_and_label(self, df: DataFrame, label: str = "label") -> DataFrame:
        """Keys, features and the target on one row, so nothing is joined back later."""
        if self.target is None:
            raise ValueError("the spec names no target")
        return df.select(*self.keys, *self.feature_columns, df[self.target].alias(label))


def infer_spec(
    df: DataFrame,
    keys: Iterable[str] = (),
    target: str | None = None,
    score: str | None = None,
    exclude: Iterable[str] = (),
) -> TableSpec:
    """Derive roles from the schema; the target defaults to the last text column."""
    keys = tuple(keys)
    numeric = without(numeric_columns(df), [*keys, target])
    categorical = without(text_columns(df), keys)
    if target is None and categorical:
        target = categorical[-1]
    return TableSpec(
        keys=keys,
        numeric=tuple(numeric),
        categorical=tuple(without(categorical, [target])),
        target=target,
        score=score,
        exclude=tuple(exclude),
    )
