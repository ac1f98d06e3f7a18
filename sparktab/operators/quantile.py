"""Exact interpolated quantiles, also for groups too large for one task.

Small inputs use Spark's ``percentile``. That aggregate keeps every distinct value
of a group in one map, so larger inputs go through selection instead:

1. sketch cut points close to the wanted ranks (tiny map-side sketches),
2. count the rows between neighbouring cut points (one aggregation),
3. repeat within the few intervals that hold a wanted rank while one of them still has
   more distinct values than a task should order, then count those values.

The counts in 2 are exact whatever the sketch says, hence so is the result; the
sketch only decides how many rows step 3 has to look at. Repeated values are
counted before they are shuffled, so a hot value costs nothing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktab.functions.scalar import measure
from sparktab.functions.vectors import doubles
from sparktab.operators.support import SMALL_BYTES, cells, lookup, melt, pinned, measured_bytes, turn

ACCURACY = 10_000
MARGINS = (-4e-4, -1e-4, 1e-4, 4e-4)
EVEN_GRID = tuple(i / 64 for i in range(1, 64))
VALUES_PER_TASK = 1 << 20
MAX_LEVELS = 8


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    exact: bool = True,
    small_bytes: int = SMALL_BYTES,
) -> DataFrame:
    """One row per group and column: by..., column, n, q (array aligned with ``probs``).

    NULL is a group of its own; a group without a finite value has no row. Both ways give
    the same rows: ``small_bytes`` (0: always select) only chooses how they are found.
    """
    by, columns, probs = list(by), list(columns), [float(p) for p in probs]
    if exact and measured_bytes(df, [*by, *columns]) > small_bytes:
        return _selected(melt(df, columns, by), probs, by)
    make = {
        "n": lambda c: F.count(measure(c)),
        "q": (lambda c: F.percentile(measure(c), doubles(probs)))
        if exact
        else (lambda c: F.percentile_approx(measure(c), probs, ACCURACY)),
    }
    wide = df.groupBy(*by).agg(*cells(columns, make))
    return turn(wide, columns, {"n": "bigint", "q": "array<double>"}, by).where("n > 0")


def _asked(probs: list[float]) -> Column:
    """The two ranks next to each wanted position, given the group size ``n``."""
    items = []
    for i, p in enumerate(probs):
        position = F.lit(p) * (F.col("n") - 1)
        for rank in (F.floor(position), F.ceil(position)):
            items.append(F.struct(F.lit(i).alias("i"), "n", position.alias("position"), rank.alias("rank")))
    return F.array_distinct(F.array(*items))


def _interval(value: Column, cuts: Column, count: int) -> Column:
    """Number of the open interval between cut points, or of the cut point itself: a value
    that fills many cut points is alone in its interval, and its neighbours are apart."""
    below = [F.when(cuts[i] < value, 1).otherwise(0) + F.when(cuts[i] <= value, 1).otherwise(0) for i in range(count)]
    return sum(below, F.lit(0))


def _selected(rows: DataFrame, probs: list[float], by: list[str]) -> DataFrame:
    keys = [*by, "column", "path"]
    spread = F.xxhash64("value")
    rows = rows.withColumn("path", F.lit(""))
    grid = sorted({min(max(p + m, 0.0), 1.0) for p in probs for m in MARGINS})
    asks, few = None, True
    for level in range(MAX_LEVELS + 1):
        if level == MAX_LEVELS:
            raise RuntimeError(f"an interval still has over {VALUES_PER_TASK} values after {MAX_LEVELS} cuts")
        found = rows.groupBy(*keys).agg(
            F.count("*").alias("n"), F.percentile_approx("value", list(grid), ACCURACY).alias("cuts")
        )
        found = found.withColumn("asks", _asked(probs)) if asks is None else lookup(found, asks, keys, few)
        groups, few = pinned(found)

        cell = _interval(F.col("value"), F.col("cuts"), len(grid))
        tagged = lookup(rows, groups.select(*keys, "cuts"), keys, few, spread=spread).select(
            *keys, cell.alias("cell"), "value"
        )
        before = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        counted = (
            tagged.groupBy(*keys, "cell")
            .agg(F.count("*").alias("size"), F.approx_count_distinct("value").alias("kinds"))
            .withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
        )
        inside = F.filter("asks", lambda a: (a.rank >= F.col("start")) & (a.rank < F.col("start") + F.col("size")))
        shifted = F.transform(inside, lambda a: a.withField("rank", a.rank - F.col("start")))
        wanted, few = pinned(
            lookup(counted, groups.select(*keys, "asks"), keys, few)
            .withColumn("asks", shifted)
            .where(F.size("asks") > 0)
            .select(*keys, "cell", "kinds", "asks")
        )
        held = lookup(tagged, wanted.select(*keys, "cell"), [*keys, "cell"], few, spread=spread)
        path = F.concat_ws("/", "path", F.col("cell").cast("string"))
        rows = held.select(*by, "column", path.alias("path"), "value")
        asks = wanted.select(*by, "column", path.alias("path"), "asks")
        if (wanted.agg(F.max("kinds")).first()[0] or 0) <= VALUES_PER_TASK:
            break
        grid = EVEN_GRID
    return _counted_out(rows, asks, few, keys, by)


def _counted_out(rows: DataFrame, asks: DataFrame, few: bool, keys: list[str], by: list[str]) -> DataFrame:
    """The values at the asked ranks of each interval, put together per group."""
    upto = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.groupBy(*keys, "value").agg(F.count("*").alias("copies")).withColumn("stop", F.sum("copies").over(upto))
    hit = F.filter("asks", lambda a: (a.rank < F.col("stop")) & (a.rank >= F.col("stop") - F.col("copies")))
    ends = (
        lookup(placed, asks, keys, few)
        .withColumn("hit", hit)
        .where(F.size("hit") > 0)
        .select(*by, "column", "value", F.inline("hit"))
        .groupBy(*by, "column", "n", "i", "position")
        .agg(F.min("value").alias("low"), F.max("value").alias("high"))
    )
    part = F.col("position") - F.floor("position")
    point = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(
        (F.lit(1.0) - part) * F.col("low") + part * F.col("high")
    )
    return (
        ends.withColumn("point", point)
        .groupBy(*by, "column", "n")
        .agg(F.array_sort(F.collect_list(F.struct("i", "point"))).alias("points"))
        .select(*by, "column", "n", F.col("points.point").alias("q"))
    )
