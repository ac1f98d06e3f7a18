"""Relations between columns: correlation, category means, cross tabulation."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.functions.scalar import measure
from sparktab.operators.support import bounded_rows, cells, turn

PAIRS_PER_PASS = 400


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strict lower triangle of the Pearson matrix: position_a, a, position_b, b, r.

    Pairwise complete. All pairs of a pass share one aggregation; very wide tables take
    several passes, so that the generated code stays within the JVM's method size.
    """
    pairs = [(j, columns[j], i, columns[i]) for i, j in combinations(range(len(columns)), 2)]
    out = None
    for start in range(0, len(pairs), PAIRS_PER_PASS):
        part = pairs[start : start + PAIRS_PER_PASS]
        row = df.agg(*[F.corr(measure(a), measure(b)).alias(f"r{n}") for n, (_, a, _, b) in enumerate(part)])
        items = [
            F.struct(
                F.lit(pa).alias("position_a"),
                F.lit(a).alias("a"),
                F.lit(pb).alias("position_b"),
                F.lit(b).alias("b"),
                F.col(f"r{n}").alias("r"),
            )
            for n, (pa, a, pb, b) in enumerate(part)
        ]
        long = row.select(F.inline(F.array(*items)))
        out = long if out is None else out.unionByName(long)
    return out


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The full matrix as (a, b, r): the triangle, its mirror and the diagonal."""
    lower = correlations(df, columns)
    both = F.array(F.struct(F.col("a"), F.col("b"), F.col("r")), F.struct(F.col("b").alias("a"), F.col("a").alias("b"), F.col("r")))
    make = {"r": lambda c: F.when(F.stddev_pop(measure(c)) > 0, F.lit(1.0))}
    diagonal = turn(df.agg(*cells(columns, make)), columns, {"r": "double"})
    return lower.select(F.inline(both)).unionByName(
        diagonal.select(F.col("column").alias("a"), F.col("column").alias("b"), "r")
    )


def score_correlations(df: DataFrame, columns: Sequence[str], score: str) -> DataFrame:
    """Each column's correlation with the score: feature, r, strength, sign. Zero is negative."""
    others = [c for c in columns if c != score]
    make = {"r": lambda c: F.corr(measure(c), measure(score))}
    long = turn(df.agg(*cells(others, make)), others, {"r": "double"})
    return long.select(
        F.col("column").alias("feature"),
        "r",
        F.abs("r").alias("strength"),
        F.when(F.col("r") > 0, F.lit("positive")).otherwise(F.lit("negative")).alias("sign"),
    ).orderBy(F.col("strength").desc(), "feature")


def group_means(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Mean of every column per category: by, column, mean."""
    make = {"mean": lambda c: F.avg(measure(c))}
    wide = df.where(F.col(by).isNotNull()).groupBy(by).agg(*cells(columns, make))
    return turn(wide, columns, {"mean": "double"}, [by])


def scaled_group_means(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Adds each column's means scaled to 0..1 across the categories.

    The range per column is one row per column, which bounds the broadcast.
    """
    means = group_means(df, columns, by)
    span = means.groupBy("column").agg(F.min("mean").alias("lo"), F.max("mean").alias("hi"))
    return means.join(F.broadcast(span), "column").select(
        by,
        "column",
        "mean",
        ((F.col("mean") - F.col("lo")) / (F.col("hi") - F.col("lo") + 1e-9)).alias("scaled"),
    )


def crosstab(df: DataFrame, a: str, b: str, listed_levels: int = 1_000) -> DataFrame:
    """a, b, n, pct of the row of ``a``.

    Pairs that never occur are listed with 0 as long as ``b`` has at most ``listed_levels``
    levels; a larger table is long and sparse, with the pairs that occur. Only the counts
    per pair are shuffled.
    """
    pairs = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count("*").alias("n"))
    levels = bounded_rows(pairs.select(b).distinct(), listed_levels)
    if levels is None:
        totals = pairs.groupBy(a).agg(F.sum("n").alias("total"))
        return pairs.join(totals, a).select(a, b, F.col("n").cast("bigint").alias("n"), (F.col("n") * 100.0 / F.col("total")).alias("pct"))
    kind = dict(df.dtypes)[b]
    listed = F.array(*[F.lit(r[0]) for r in sorted(levels)]).cast(f"array<{kind}>")
    lines = pairs.groupBy(a).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(b), F.col("n")))).alias("counts"),
        F.sum("n").alias("total"),
    )
    n = F.coalesce(F.try_element_at("counts", F.col(b)), F.lit(0)).cast("bigint")
    return lines.withColumn(b, F.explode(listed)).select(
        a, b, n.alias("n"), (n * 100.0 / F.col("total")).alias("pct")
    )
