"""Duplicates, z-score and quartile-fence outliers, and the audit of each step.

Statistics are fitted in one aggregation and come back as a bounded value; applying
them is a projection with literals. Nothing is joined, and a fitted value works on
streams as well as on tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.functions.hashing import row_digest
from sparktab.functions.scalar import all_of, measure, outside
from sparktab.operators.quantile import quantiles
from sparktab.operators.support import SMALL_BYTES, attach, cells, melt
from sparktab.spec import without

# --------------------------------------------------------------------- duplicates


def distinct_rows(df: DataFrame, ignore: Sequence[str] = (), keep: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows once the identifying columns are gone; NULLs equal each other.

    Rows are told apart by a digest. Copies are combined before the shuffle, which then
    carries one row per digest and task. With ``keep`` only those columns come out: wide
    columns that nobody reads later are hashed where they lie and never shuffled.
    """
    body = df.drop(*ignore)
    if not body.columns:
        return body.limit(1)
    kept = body.columns if keep is None else list(keep)
    marked = body.select(row_digest(body, body.columns).alias("_digest"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row"))
    return marked.groupBy("_digest").agg(F.any_value("_row").alias("_row")).select("_row.*")


def keep_first(df: DataFrame, keys: Sequence[str], content: Sequence[str] | None = None) -> DataFrame:
    """One row per distinct content: the one with the lowest key.

    Rows are grouped by a digest of their content. Copies are combined before the shuffle,
    which carries one row per digest and task; there is no join. Rows of one content
    and key come out once.
    """
    content = list(content) if content is not None else without(df.columns, keys)
    key = F.struct(*[F.col(f"`{k}`") for k in keys])
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    marked = df.select(row_digest(df, content).alias("_digest"), key.alias("_key"), whole.alias("_row"))
    return marked.groupBy("_digest").agg(F.min_by("_row", "_key").alias("_row")).select("_row.*")


def duplicate_count(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """Rows, distinct rows and rows beyond the first of each group of equals."""
    body = df.drop(*ignore)
    groups = body.groupBy(row_digest(body, body.columns).alias("_digest")).agg(F.count("*").alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count("*").alias("n_distinct"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count("*")).cast("bigint").alias("n_duplicates"),
    )


# ------------------------------------------------------------------------ z-scores


@dataclass(frozen=True)
class Moments:
    """Count, gaps, mean and population deviation of one column."""

    n: int
    n_missing: int
    mean: float | None
    deviation: float | None

    @property
    def usable(self) -> bool:
        return self.n > 0 and bool(self.deviation)


def fit_moments(df: DataFrame, columns: Sequence[str]) -> dict[str, Moments]:
    """One aggregation for all columns; the result is four numbers per column."""
    make = {
        "n": lambda c: F.count(measure(c)),
        "gaps": lambda c: F.count_if(measure(c).isNull()),
        "mean": lambda c: F.avg(measure(c)),
        "deviation": lambda c: F.stddev_pop(measure(c)),
    }
    row = df.agg(*cells(columns, make)).first()
    return {
        c: Moments(row[f"n__{c}"], row[f"gaps__{c}"], row[f"mean__{c}"], row[f"deviation__{c}"])
        for c in columns
    }


def zscore(column: str, moments: Moments) -> Column:
    """Deviations from the mean; NULL for a gap or a constant column."""
    if not moments.usable:
        return F.lit(None).cast("double")
    return (measure(column) - F.lit(moments.mean)) / F.lit(moments.deviation)


def within_deviations(fitted: dict[str, Moments], limit: float = 3.0, on_undefined: str = "keep") -> Column:
    """True when every column's ``|z|`` is strictly below ``limit``.

    ``keep``: an undefined z never removes a row. ``strict``: one gap in a column, or a
    constant column, makes that column undefined for the whole table and removes every row.
    """
    if on_undefined not in ("keep", "strict"):
        raise ValueError(on_undefined)
    if on_undefined == "strict" and any(m.n_missing or not m.usable for m in fitted.values()):
        return F.lit(False)
    return all_of([F.coalesce(F.abs(zscore(c, m)) < limit, F.lit(True)) for c, m in fitted.items()])


def zscore_filter(
    df: DataFrame,
    columns: Sequence[str],
    limit: float = 3.0,
    on_undefined: str = "keep",
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Keep rows inside ``limit`` deviations on all columns; ``fit_on`` may be the train rows."""
    fitted = fit_moments(df if fit_on is None else fit_on, columns)
    return df.where(within_deviations(fitted, limit, on_undefined))


# ------------------------------------------------------------------ quartile fences


def fences(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: float = 1.5, small_bytes: int = SMALL_BYTES
) -> DataFrame:
    """Quartiles and fences: by..., column, n, q1, median, q3, iqr, low, high."""
    q = quantiles(df, columns, [0.25, 0.5, 0.75], by, small_bytes=small_bytes)
    iqr = F.col("q")[2] - F.col("q")[0]
    return q.select(
        *by,
        "column",
        "n",
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("median"),
        F.col("q")[2].alias("q3"),
        iqr.alias("iqr"),
        (F.col("q")[0] - k * iqr).alias("low"),
        (F.col("q")[2] + k * iqr).alias("high"),
    )


def fence_report(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), k: float = 1.5, small_bytes: int = SMALL_BYTES
) -> DataFrame:
    """Fences plus the number of values strictly outside them."""
    limits = fences(df, columns, by, k, small_bytes)
    stat = ["n", "q1", "q3", "iqr", "low", "high"]
    rows = attach(melt(df, columns, by), limits, [*by, "column"])
    return rows.groupBy(*by, "column", *stat).agg(
        F.count_if(outside(F.col("value"), F.col("low"), F.col("high"))).alias("n_outside")
    )


def fit_fences(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> dict[str, tuple[float, float]]:
    """Fences of the whole table, one pair per column."""
    return {r["column"]: (r["low"], r["high"]) for r in fences(df, columns, k=k).collect()}


def beyond_fences(limits: dict[str, tuple[float, float]]) -> dict[str, Column]:
    """Per column: is the value strictly outside its fences?"""
    return {c: outside(measure(c), low, high) for c, (low, high) in limits.items()}


# --------------------------------------------------------------------------- audit


def step_audit(df: DataFrame, keep: Column, step: str) -> DataFrame:
    """Rows before and after a filter, counted in one pass over the unfiltered rows."""
    before, after = F.count("*"), F.count_if(keep)
    return df.agg(
        F.lit(step).alias("step"),
        before.alias("rows_before"),
        after.alias("rows_after"),
        (before - after).alias("rows_removed"),
        F.try_divide((before - after) * 100.0, before.cast("double")).alias("pct_removed"),
    )


def table_shape(df: DataFrame, step: str) -> DataFrame:
    return df.agg(
        F.lit(step).alias("step"),
        F.count("*").alias("n_rows"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
    )


__all__ = [
    "Moments",
    "beyond_fences",
    "distinct_rows",
    "duplicate_count",
    "fence_report",
    "fences",
    "fit_fences",
    "fit_moments",
    "keep_first",
    "step_audit",
    "table_shape",
    "within_deviations",
    "zscore",
    "zscore_filter",
]
