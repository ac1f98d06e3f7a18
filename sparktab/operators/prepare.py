"""Category codes, indicators, stratified splits and folds, standardisation."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktab.functions.hashing import digest_prefix, key_digest
from sparktab.functions.scalar import indicator, measure
from sparktab.operators.clean import Moments, fit_moments
from sparktab.operators.support import bounded_rows, spread_join
from sparktab.session import settled

INLINE_LEVELS = 64
#: A split keeps one digest per class on the driver and compares it in an expression.
CLASSES = 10_000
ROWS_PER_BUCKET = 1 << 16

# ------------------------------------------------------------------ category codes


@dataclass(frozen=True)
class Levels:
    """The sorted levels of a category; a level's code is its position."""

    column: str
    values: tuple

    def encode(self, col: Column | None = None) -> Column:
        """Code of a value; NULL for a gap or an unseen level. Needs no join."""
        col = F.col(self.column) if col is None else col
        position = F.array_position(F.array(*[F.lit(v) for v in self.values]), col)
        return F.when(position > 0, (position - 1).cast("int"))

    def decode(self, code: Column) -> Column:
        return F.try_element_at(F.array(*[F.lit(v) for v in self.values]), (code + 1).cast("int"))

    def indicators(self, col: Column | None = None) -> dict[str, Column]:
        """One 0/1 column per level, none left out; a gap or unseen level is all zero."""
        col = F.col(self.column) if col is None else col
        return {f"{self.column}_{v}": indicator(col == F.lit(v)) for v in self.values}


def fit_levels(df: DataFrame, column: str) -> Levels:
    """Sorted distinct present values, for categories that fit in an expression."""
    rows = bounded_rows(df.select(column).where(F.col(column).isNotNull()).distinct())
    if rows is None:
        raise ValueError(f"{column} has too many levels for an expression; use encode_joined")
    return Levels(column, tuple(sorted(r[0] for r in rows)))


def code_table(df: DataFrame, column: str) -> DataFrame:
    """value, code for any number of levels: a distributed sort, numbered on the JVM.

    Each range's levels are numbered in order where they lie and written; a range's first
    code is the number of levels in the ranges before, of which there is one row each.
    """
    levels = df.select(column).where(F.col(column).isNotNull()).distinct()
    ordered = levels.repartitionByRange(column).sortWithinPartitions(column)
    marked = settled(ordered.select(column, F.monotonically_increasing_id().alias("_id")), "codes")
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = marked.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    starts = starts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    numbered = marked.withColumn("_part", part).join(F.broadcast(starts), "_part")
    return numbered.select(column, (F.col("_start") + place).alias("code"))


def encode_joined(df: DataFrame, column: str, out: str) -> DataFrame:
    """Adds the sorted-order code by a join, for categories of unbounded size; levels
    holding much of the table are spread."""
    codes = code_table(df, column).withColumnRenamed("code", out)
    return spread_join(df, codes, [column], "left")


def ordinal(df: DataFrame, column: str, out: str) -> DataFrame:
    """Adds the sorted-order code, by expression for few levels and by join for many."""
    rows = bounded_rows(df.select(column).where(F.col(column).isNotNull()).distinct(), INLINE_LEVELS)
    if rows is None:
        return encode_joined(df, column, out)
    levels = Levels(column, tuple(sorted(r[0] for r in rows)))
    return df.withColumn(out, levels.encode().cast("bigint"))


def one_hot(df: DataFrame, column: str, levels: Levels | None = None) -> DataFrame:
    """Replaces a category by its indicators, appended at the end. For many levels see ``one_hot_sparse``."""
    levels = levels or fit_levels(df, column)
    kept = [c for c in df.columns if c != column]
    return df.select(*kept, *[c.alias(n) for n, c in levels.indicators().items()])


def one_hot_sparse(df: DataFrame, column: str) -> DataFrame:
    """Replaces a category of any number of levels by ``<column>_index`` and ``<column>_width``.

    They are the sparse form of its indicators: where the only 1 is (NULL for a gap: all
    zero) and how many indicators there are.
    """
    coded = encode_joined(df, column, f"{column}_index")
    width = df.agg(F.count_distinct(column).alias("n")).first()["n"]
    kept = [c for c in df.columns if c != column]
    return coded.select(*kept, f"{column}_index", F.lit(width).cast("bigint").alias(f"{column}_width"))


# ------------------------------------------------------------------ splits and folds


def class_counts(df: DataFrame, label: str) -> dict:
    rows = bounded_rows(df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n")), CLASSES)
    if rows is None:
        raise ValueError(f"{label} is not a class label: over {CLASSES} values")
    return {r[0]: r["n"] for r in sorted(rows, key=lambda r: r[0])}


def quotas(counts: dict, share: float) -> dict:
    """Test rows per class: proportional, the rest to the largest fractions, ties by label."""
    total = sum(counts.values())
    wanted = math.ceil(share * total)
    out = {c: n * wanted // total for c, n in counts.items()}
    order = sorted(counts, key=lambda c: (-(counts[c] * wanted % total), c))
    for c in order[: wanted - sum(out.values())]:
        out[c] += 1
    return out


@dataclass(frozen=True)
class StratifiedSplit:
    """Rows are ordered within their class by a digest of their key; a class's first
    ``quota`` rows are test rows. Fitting finds the last digest of each quota, so that
    applying it is one comparison per row: no shuffle, no sort of a class.

    The key must be unique.
    """

    label: str
    keys: tuple[str, ...]
    seed: int
    last_digest: dict

    def is_test(self) -> Column:
        digest = key_digest(self.keys, self.seed)
        flag = F.lit(False)
        for value, last in self.last_digest.items():
            flag = F.when(F.col(self.label) == F.lit(value), digest <= F.lit(last)).otherwise(flag)
        return flag

    def mark(self, df: DataFrame, out: str = "is_test") -> DataFrame:
        return df.where(F.col(self.label).isNotNull()).withColumn(out, self.is_test())


def fit_split(df: DataFrame, keys: Sequence[str], label: str, share: float = 0.3, seed: int = 54) -> StratifiedSplit:
    """Find each class's last test digest by counting digest prefixes.

    Prefixes are as long as it takes for the one in which a quota ends to hold few rows,
    at most four hex digits at a time; only there are rows ordered.
    """
    keys = tuple(keys)
    body = df.where(F.col(label).isNotNull()).select(label, key_digest(keys, seed).alias("digest"))
    counts = class_counts(df, label)
    last = {c: "" for c in counts}
    state = {c: ("", q) for c, q in quotas(counts, share).items() if q > 0}
    last.update({c: "g" for c, (_, q) in state.items() if q == counts[c]})  # sorts after any digest
    state = {c: s for c, s in state.items() if last[c] != "g"}
    width, size = 0, max(counts.values(), default=0)
    while state and size > ROWS_PER_BUCKET and width < 28:
        width += min(4, max(1, math.ceil(math.log(size / ROWS_PER_BUCKET, 16))))
        state, size = _narrow(body, label, state, width)
    if state:
        last.update(_nth_digest(body, label, state, width))
    return StratifiedSplit(label, keys, seed, last)


def _inside(label: str, state: dict, width: int) -> Column:
    """Rows whose digest starts with the prefix their class's quota ends in."""
    hit = F.lit(False)
    for value, (prefix, _) in state.items():
        hit = hit | ((F.col(label) == F.lit(value)) & F.col("digest").startswith(F.lit(prefix)))
    return hit


def _wanted(label: str, state: dict) -> Column:
    rank = F.lit(None).cast("bigint")
    for value, (_, r) in state.items():
        rank = F.when(F.col(label) == F.lit(value), F.lit(r)).otherwise(rank)
    return rank


def _narrow(body: DataFrame, label: str, state: dict, width: int) -> tuple[dict, int]:
    upto = Window.partitionBy(label).orderBy("prefix").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (
        body.where(_inside(label, state, width))
        .groupBy(label, F.substring("digest", 1, width).alias("prefix"))
        .agg(F.count("*").alias("n"))
        .withColumn("stop", F.sum("n").over(upto))
        .where((F.col("stop") >= _wanted(label, state)) & (F.col("stop") - F.col("n") < _wanted(label, state)))
        .collect()
    )
    found = {r[label]: (r["prefix"], state[r[label]][1] - (r["stop"] - r["n"])) for r in rows}
    return found, max(r["n"] for r in rows)


def _nth_digest(body: DataFrame, label: str, state: dict, width: int) -> dict:
    ordered = Window.partitionBy(label).orderBy("digest")
    rows = (
        body.where(_inside(label, state, width))
        .withColumn("rank", F.row_number().over(ordered))
        .where(F.col("rank") == _wanted(label, state))
        .collect()
    )
    return {r[label]: r["digest"] for r in rows}


def hash_split(df: DataFrame, keys: Sequence[str], share: float = 0.3, seed: int = 54, out: str = "is_test") -> DataFrame:
    """Splits by a digest threshold: nothing to fit, class shares hold approximately."""
    return df.withColumn(out, digest_prefix(key_digest(keys, seed), 8) < F.lit(share * 2**32))


def stratified_folds(
    df: DataFrame,
    keys: Sequence[str],
    label: str,
    folds: int,
    seed: int = 54,
    out: str = "fold",
    rows_per_bucket: int = 1 << 20,
) -> DataFrame:
    """Adds a fold id: the row's rank by key digest within its class, modulo ``folds``.

    Ranks are counted in digest-prefix buckets, which are even whatever the class sizes:
    rank = rows in earlier buckets + position in the own bucket.
    """
    counts = class_counts(df, label)
    digits = 2
    while max(counts.values(), default=0) >> (4 * digits) > rows_per_bucket and digits < 7:
        digits += 1
    rows = df.where(F.col(label).isNotNull()).withColumn("_digest", key_digest(keys, seed))
    rows = rows.withColumn("_bucket", F.substring("_digest", 1, digits))
    earlier = Window.partitionBy(label).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        rows.groupBy(label, "_bucket")
        .agg(F.count("*").alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .drop("_n")
    )
    inside = Window.partitionBy(label, "_bucket").orderBy("_digest", *keys)
    position = F.row_number().over(inside) - 1
    return (
        rows.withColumn("_position", position)
        .join(starts, [label, "_bucket"])
        .withColumn(out, F.pmod(F.col("_start") + F.col("_position"), F.lit(folds)).cast("int"))
        .drop("_digest", "_bucket", "_position", "_start")
    )


# ------------------------------------------------------------------- standardisation


@dataclass(frozen=True)
class Standardiser:
    """Centres and scales by the statistics of the rows it was fitted on."""

    fitted: dict[str, Moments]

    def scaled(self, column: str) -> Column:
        """Population deviations from the mean; a constant column becomes 0."""
        m = self.fitted[column]
        centred = measure(column) - F.lit(m.mean)
        return centred / F.lit(m.deviation) if m.usable else centred

    def apply(self, df: DataFrame, prefix: str = "") -> DataFrame:
        return df.withColumns({f"{prefix}{c}": self.scaled(c) for c in self.fitted})


def fit_standardiser(train: DataFrame, columns: Sequence[str]) -> Standardiser:
    return Standardiser(fit_moments(train, columns))
