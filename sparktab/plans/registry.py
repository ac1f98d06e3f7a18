"""The catalogue: named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with its SQL counterpart if there is one."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fixed(col: Column | str, digits: int = 6) -> Column:
    """A double cut to fixed digits, so that two engines' sums compare equal."""
    col = F.col(col) if isinstance(col, str) else col
    scale = float(10**digits)
    return F.floor(col * scale + 0.5).cast("double") / scale


def fx(expr: str, digits: int = 6) -> str:
    """The same rounding in the SQL counterpart."""
    scale = f"{float(10**digits):.1f}"
    return f"(floor(({expr}) * CAST({scale} AS DOUBLE) + 0.5) / CAST({scale} AS DOUBLE))"
