"""Correlations of wide tables: one scan, whatever the number of columns.

Each task adds up, over its rows, the five sums that a pair of columns needs (rows where both
are present, and over these the sums of either, of either's square and of the product) as
matrix products of Arrow batches. The matrices leave a task in square tiles and the tiles
are added up by key, so no task or driver holds more than its own. A task's memory is
columns x columns x 32 bytes: 2,000 columns take 128 MB.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.functions.scalar import measure

TILE = 128
#: Rows whose means the sums are taken from; this affects rounding alone.
SHIFT_ROWS = 1_000
SUMS = ("n", "sa", "sb", "saa", "sbb", "sab")


def _tiles(columns: Sequence[str], shift: np.ndarray):
    width = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s, q, p = (np.zeros((width, width)) for _ in range(4))
        for batch in batches:
            x = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype("float64") for i in range(width)], axis=1) - shift
            there = ~np.isnan(x)
            x[~there] = 0.0
            there = there.astype("float64")
            n += there.T @ there
            s += x.T @ there
            q += (x * x).T @ there
            p += x.T @ x
        for a in range(0, width, TILE):
            for b in range(a, width, TILE):
                rows, cols = slice(a, a + TILE), slice(b, b + TILE)
                parts = (n[rows, cols], s[rows, cols], s.T[rows, cols], q[rows, cols], q.T[rows, cols], p[rows, cols])
                cells = [np.stack(parts).ravel()]
                yield pa.RecordBatch.from_arrays([pa.array([a], pa.int32()), pa.array([b], pa.int32()), pa.array(cells, pa.list_(pa.float64()))], names=["a", "b", "sums"])

    return run


def wide_correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strict lower triangle as position_a, a, position_b, b, n, r, pairwise complete; r is NULL where
    a column does not vary over the pair's rows. NaN and infinities count as missing."""
    values = df.select(*[measure(c).alias(f"v{i}") for i, c in enumerate(columns)])
    first = values.limit(SHIFT_ROWS).agg(*[F.avg(f"v{i}") for i in range(len(columns))]).first()
    shift = np.array([v or 0.0 for v in first])
    width, names = len(columns), F.array(*[F.lit(c) for c in columns])
    tiles = values.mapInArrow(_tiles(columns, shift), "a int, b int, sums array<double>")
    cells = tiles.select("a", "b", F.posexplode("sums").alias("at", "v")).groupBy("a", "b", "at").agg(F.sum("v").alias("v"))
    tile_cells = F.least(F.lit(TILE), F.lit(width) - F.col("a")) * F.least(F.lit(TILE), F.lit(width) - F.col("b"))
    at_cell, cols = F.col("at") % tile_cells, F.least(F.lit(TILE), F.lit(width) - F.col("b"))
    placed = cells.select(
        (F.col("a") + F.floor(at_cell / cols)).cast("int").alias("j"),
        (F.col("b") + at_cell % cols).cast("int").alias("i"),
        F.floor(F.col("at") / tile_cells).cast("int").alias("what"),
        "v",
    ).where("j < i")
    pairs = placed.groupBy("i", "j").agg(*[F.max(F.when(F.col("what") == k, F.col("v"))).alias(c) for k, c in enumerate(SUMS)])
    n = F.col("n")
    share = lambda a, b: F.try_divide(F.col(a) * F.col(b), n)
    spread = lambda square, one: F.col(square) - share(one, one)
    # what is left of a constant column is rounding
    varies = lambda square, one: spread(square, one) > F.lit(1e-12) * (F.col(square) + share(one, one))
    r = F.try_divide(F.col("sab") - share("sa", "sb"), F.sqrt(F.greatest(spread("saa", "sa") * spread("sbb", "sb"), F.lit(0.0))))
    shown = F.when((n > 1) & varies("saa", "sa") & varies("sbb", "sb"), r)
    return pairs.select(
        F.col("j").alias("position_a"), F.element_at(names, F.col("j") + 1).alias("a"), F.col("i").alias("position_b"), F.element_at(names, F.col("i") + 1).alias("b"), n.cast("bigint").alias("n"), shown.alias("r")
    )
