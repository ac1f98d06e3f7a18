"""Categories as numbers: the mean of a target over rows of the same category.

On rows a model is fitted to, a row's own target must not be in its number. Rows stand
in the order of a digest of their key, and each takes the statistics of the rows before it.
Digest prefixes cut that order into even buckets: sums of whole buckets are prefix sums over
few rows per category, and only the rows of one category and bucket are ordered in one task,
so a category that holds most of the table is many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktab.functions.hashing import key_digest
from sparktab.operators.support import lookup, null_safe_join, pinned
from sparktab.session import settled

ROWS_PER_BUCKET = 1 << 16


def _priors(df: DataFrame, targets: Mapping[str, Column]) -> dict[str, float]:
    row = df.agg(*[F.avg(t.cast("double")).alias(name) for name, t in targets.items()]).first()
    return {name: row[name] or 0.0 for name in targets}


def ordered(
    df: DataFrame,
    category: str,
    targets: Mapping[str, Column],
    keys: Sequence[str],
    weight: float = 1.0,
    seed: int = 54,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``df`` with a column per target (names of ``targets``, whose values are numbers): the mean
    of ``weight`` times the table's mean and the targets of the category's earlier rows.

    NULL is a category; a NULL target counts as no row. Keys must be unique.
    """
    n = df.count()
    digits = max(1, math.ceil(math.log(max(n / rows_per_bucket, 1), 16)))
    rows = df.withColumn("_digest", key_digest(keys, seed)).withColumn("_bucket", F.substring("_digest", 1, digits))
    rows = rows.withColumns({f"_t_{k}": t.cast("double") for k, t in targets.items()})
    sums = [f(F.col(f"_t_{k}")).alias(f"_{f.__name__}_{k}") for k in targets for f in (F.sum, F.count)]
    buckets = settled(rows.groupBy(category, "_bucket").agg(*sums), "bucket-sums")
    before = Window.partitionBy(category).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    earlier = buckets.select(category, "_bucket", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_0") for c in buckets.columns if c not in (category, "_bucket")])
    inside = Window.partitionBy(category, "_bucket").orderBy("_digest", *keys).rowsBetween(Window.unboundedPreceding, -1)
    joined = null_safe_join(rows, earlier, [category, "_bucket"])
    priors = _priors(df, targets)

    def mean(k: str) -> Column:
        total = F.col(f"_sum_{k}_0") + F.coalesce(F.sum(f"_t_{k}").over(inside), F.lit(0.0))
        count = F.col(f"_count_{k}_0") + F.count(f"_t_{k}").over(inside)
        return (total + F.lit(weight * priors[k])) / (count + F.lit(weight))

    kept = [F.col(f"`{c}`") for c in df.columns if c not in targets]
    return joined.select(*kept, *[mean(k).alias(k) for k in targets])


@dataclass(frozen=True)
class TargetStats:
    """The statistics of all fitted rows, for rows that come later."""

    category: str
    table: DataFrame
    priors: dict[str, float]

    def apply(self, df: DataFrame) -> DataFrame:
        """``df`` with the columns of ``ordered``; a category never met has the table's mean."""
        table, small = pinned(self.table)
        joined = lookup(df.drop(*self.priors), table, [self.category], small, "left")
        return joined.withColumns({k: F.coalesce(F.col(f"`{k}`"), F.lit(v)) for k, v in self.priors.items()})


def fit(df: DataFrame, category: str, targets: Mapping[str, Column], weight: float = 1.0) -> TargetStats:
    priors = _priors(df, targets)
    means = [((F.coalesce(F.sum(t.cast("double")), F.lit(0.0)) + F.lit(weight * priors[k])) / (F.count(t) + F.lit(weight))).alias(k) for k, t in targets.items()]
    return TargetStats(category, settled(df.groupBy(category).agg(*means), "target-stats"), priors)
