"""Kernel features from landmark rows.

A Gaussian kernel between any two rows is approximated through a few landmarks: the kernel to
each of them, whitened so that products of these features are the kernel's projection on
the landmarks. Landmarks are drawn by leverage, how much a row adds that others don't
hold, from a sample of ``SAMPLE`` rows in the order of a digest of their key; the error on
all rows is measured block by block.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.operators.blocks import shares

#: Rows that landmarks are drawn from.
SAMPLE = 1_000
#: Rows of a block whose pairs are compared with the exact kernel.
PAIRS_OF = 256


def gaussian(a: np.ndarray, b: np.ndarray, gamma: float) -> np.ndarray:
    square = (a**2).sum(1)[:, None] - 2.0 * a @ b.T + (b**2).sum(1)[None, :]
    return np.exp(-gamma * np.maximum(square, 0.0))


@dataclass(frozen=True)
class Landmarks:
    points: np.ndarray
    whiten: np.ndarray
    gamma: float

    def features(self, x: np.ndarray) -> np.ndarray:
        return gaussian(x, self.points, self.gamma) @ self.whiten


def chosen(x: np.ndarray, count: int, gamma: float, seed: int = 54, ridge: float = 1e-3) -> Landmarks:
    """Landmarks among the rows of ``x``: drawn without replacement, likelier by leverage."""
    kernel = gaussian(x, x, gamma)
    leverage = np.einsum("ij,ji->i", kernel, np.linalg.inv(kernel + ridge * len(x) / max(count, 1) * np.eye(len(x))))
    drawn = np.log(np.maximum(shares(np.arange(len(x), dtype=np.uint64), seed), 1e-300)) / np.maximum(leverage, 1e-12)
    points = x[np.sort(np.argsort(-drawn, kind="stable")[:count])]
    values, vectors = np.linalg.eigh(gaussian(points, points, gamma))
    kept = values > 1e-9 * values[-1]
    return Landmarks(points, vectors[:, kept] / np.sqrt(values[kept]), gamma)


def fit_landmarks(df: DataFrame, x: Column, keys: Sequence[str | Column], count: int = 100, gamma: float = 0.0, seed: int = 54) -> Landmarks:
    """``gamma`` 0 is 1 / inputs. Missing values count as 0."""
    row = F.xxhash64(F.lit(seed), *keys)
    sample = df.select(F.transform(x, lambda v: F.coalesce(F.nanvl(v.cast("double"), F.lit(0.0)), F.lit(0.0))).alias("x"), row.alias("row"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.column("x").to_pylist()]
        if rows:
            points = np.array(rows, dtype="float64")
            found = chosen(points, min(count, len(points)), gamma or 1.0 / points.shape[1], seed)
            cells = [found.points.tolist(), found.whiten.tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.float64())) for c in cells], names=["point", "whiten"])

    # the linear algebra of the sample is one task's, not the driver's
    rows = sample.orderBy("row").limit(SAMPLE).coalesce(1).mapInArrow(choose, "point array<double>, whiten array<double>").collect()
    if not rows:
        raise ValueError("no rows to draw landmarks from")
    points, whiten = (np.array([r[c] for r in rows]) for c in ("point", "whiten"))
    return Landmarks(points, whiten, gamma or 1.0 / points.shape[1])


def kernel_errors(df: DataFrame, x: Column, features, gamma: float) -> DataFrame:
    """block, pairs, mean_error, max_error: products of ``features`` against the exact kernel, over all
    pairs of each block of ``PAIRS_OF`` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAIRS_OF):
                lists = batch.slice(at, PAIRS_OF).column("x")
                rows = np.nan_to_num(lists.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(lists), -1))
                z = features(rows)
                error = np.abs(z @ z.T - gaussian(rows, rows, gamma))
                cells = [[len(lists) ** 2], [float(error.mean())], [float(error.max())]]
                yield pa.RecordBatch.from_arrays([pa.array(cells[0], pa.int64()), pa.array(cells[1]), pa.array(cells[2])], names=["pairs", "mean_error", "max_error"])

    rows = df.select(F.transform(x, lambda v: F.coalesce(v.cast("double"), F.lit(0.0))).alias("x"))
    return rows.mapInArrow(run, "pairs long, mean_error double, max_error double")
