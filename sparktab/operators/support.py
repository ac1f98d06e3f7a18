"""Shared plumbing: size checks, small-side joins and the one-row-to-many turn."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparktab.functions.scalar import measure
from sparktab.session import settled, shared_dir

SMALL_ROWS = 10_000
SMALL_BYTES = 16 << 20
SALTS = 32
HOT_PARTS = 1000


def measured_bytes(df: DataFrame, columns: Sequence[str]) -> int:
    """What the given columns take as numbers: rows, which are counted, times eight bytes."""
    return df.count() * len(columns) * 8


def bounded_rows(df: DataFrame, limit: int = SMALL_ROWS) -> list[Row] | None:
    """All rows if there are at most ``limit`` of them, else None."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def pinned(stats: DataFrame, limit: int = SMALL_ROWS) -> tuple[DataFrame, bool]:
    """Statistics computed once, so that all later passes see the same values, and
    whether they are few: few are held as local rows, others are checkpointed."""
    rows = bounded_rows(stats, limit)
    if rows is not None:
        return stats.sparkSession.createDataFrame(rows, stats.schema), True
    shared_dir(stats.sparkSession)
    return stats.checkpoint(), False


def lookup(df: DataFrame, table: DataFrame, on: Sequence[str], small: bool, how: str = "inner", spread: Column | None = None) -> DataFrame:
    """Join rows with a table of one row per key: broadcast if small, else spread. NULL keys match each other."""
    on = list(on)
    if small:
        return null_safe_join(df, F.broadcast(table), on, how)
    return spread_join(df, table, on, how, spread)


def null_safe_join(df: DataFrame, table: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL equals NULL; the columns of ``df``, then the others of ``table``."""
    renamed = table.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = F.lit(True)
    for c in on:
        same = same & F.col(f"`{c}`").eqNullSafe(F.col(f"`_on_{c}`"))
    return df.join(renamed, same, how).drop(*[f"_on_{c}" for c in on])


def attach(
    df: DataFrame, stats: DataFrame, on: Sequence[str], limit: int = SMALL_ROWS, spread: Column | None = None
) -> DataFrame:
    """Join rows with per-group statistics, one statistics row per group."""
    table, small = pinned(stats, limit)
    return lookup(df, table, on, small, "inner", spread)


def spread_join(
    df: DataFrame, table: DataFrame, on: Sequence[str], how: str = "inner", spread: Column | None = None, counts: DataFrame | None = None
) -> DataFrame:
    """Equi-join in which keys holding much of ``df`` are spread over ``SALTS`` tasks.

    At most ``HOT_PARTS`` keys can hold more than that part of the rows; only their rows
    are salted and only their rows of ``table`` are copied. NULL is a key like any other:
    it may be hot, and it matches NULL. The keys are counted once; the total is their sum.
    ``counts`` (on..., n), if it is known already, has the keys that may meet.
    """
    on = list(on)
    if counts is None:
        counts = settled(df.groupBy(*on).agg(F.count("*").alias("n")), "key-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") > max(total // HOT_PARTS, 1)).select(*on).collect()
    if not hot:
        return null_safe_join(df, table, on, how)
    kinds = df.select(*on).schema
    marks = F.broadcast(df.sparkSession.createDataFrame(hot, T.StructType([T.StructField(f.name, f.dataType) for f in kinds])).withColumn("_hot", F.lit(True)))
    if spread is None:
        spread = F.xxhash64(*[F.col(c) for c in df.columns])
    salt = F.when(F.col("_hot"), F.pmod(spread, F.lit(SALTS)).cast("int")).otherwise(F.lit(0))
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = null_safe_join(df, marks, on, "left").withColumn("_salt", salt).drop("_hot")
    right = null_safe_join(table, marks, on, "left").withColumn("_salt", F.explode(salts)).drop("_hot")
    return null_safe_join(left, right, [*on, "_salt"], how).drop("_salt")


def melt(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., column, value), NULL and NaN measurements left out."""
    wide = df.select(*by, *[measure(c).alias(c) for c in columns])
    return wide.unpivot(list(by), list(columns), "column", "value").where("value IS NOT NULL")


def turn(row: DataFrame, columns: Sequence[str], fields: dict[str, str], by: Sequence[str] = ()) -> DataFrame:
    """One row holding ``<field>__<column>`` cells -> one row per column.

    ``fields`` maps the field to the SQL type of its cells. This lets a report read
    the table once for all columns.
    """
    items = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{f}__{c}`").cast(t).alias(f) for f, t in fields.items()])
        for c in columns
    ]
    return row.select(*by, F.inline(F.array(*items)))


def cells(columns: Sequence[str], makers: dict) -> list[Column]:
    """Aggregates named for ``turn``: ``makers`` maps field -> function of the column name."""
    return [make(c).alias(f"{f}__{c}") for c in columns for f, make in makers.items()]
