"""Training rows as blocks of numpy arrays, for trainers that pass over them many times.

Such a trainer needs one sum over all rows per step (gradients, histograms), for many models
at once. The blocks are kept as a cached RDD, the one place of the library that uses one:
a pass is then a single stage of numpy work and a tree of sums, without planning, and what a
model has reached so far travels with its block. Sums, unlike rows, come to the
driver; their size depends on models, features and bins alone.
"""

from __future__ import annotations

import math
import operator
import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparktab.session import shared_dir, ship_package

BLOCK_ROWS = 16_384
#: Partial sums that meet in one task or on the driver.
MEET = 8


@dataclass
class Block:
    """Some rows: features, class codes, folds and a hash of the key; ``state`` is the trainer's.

    A block serves the models whose number modulo ``parts`` is ``part`` (see ``spread``).
    """

    x: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    row: np.ndarray
    state: np.ndarray | None = None
    part: int = 0
    parts: int = 1

    def serves(self, model: int) -> bool:
        return model % self.parts == self.part


class Sums(dict):
    """Arrays by key that add up; a key that one side lacks counts as zero there."""

    def __add__(self, other: Sums) -> Sums:
        out = Sums(self)
        for k, v in other.items():
            out[k] = out[k] + v if k in out else v
        return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def block() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        lists = rows.column("x").combine_chunks()
        x = lists.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(rows.num_rows, -1)
        y, fold, row = (rows.column(c).to_numpy() for c in ("y", "fold", "row"))
        data = pickle.dumps(Block(x, y, fold, row.view("uint64")), protocol=5)
        return pa.RecordBatch.from_arrays([pa.array([data], type=pa.binary())], names=["block"])

    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            held.append(batch.slice(at, BLOCK_ROWS))
            if sum(b.num_rows for b in held) >= BLOCK_ROWS:
                yield block()
                held.clear()
    if held:
        yield block()


def blocks_of(df: DataFrame, features: Column, label: Column, keys: Sequence[str], fold: Column | None = None) -> RDD:
    """The rows with a label as cached ``Block``s. ``features`` is an array; its NULLs become NaN.

    ``label`` is a code from 0, ``fold`` a number from 0 (without it all rows are fold 0).
    """
    ship_package(df.sparkSession)
    x = F.transform(features, lambda v: F.coalesce(v.cast("double"), F.lit(float("nan"))))
    rows = df.where(label.isNotNull()).select(
        x.alias("x"), label.cast("int").alias("y"), (F.lit(0) if fold is None else fold).cast("int").alias("fold"), F.xxhash64(*keys).alias("row")
    )
    return rows.mapInArrow(_pack, "block binary").rdd.map(lambda r: pickle.loads(r[0])).persist(StorageLevel.MEMORY_AND_DISK)


def spread(rows: RDD, models: int) -> RDD:
    """The blocks once for each of several parts of the models, if the rows alone would leave
    cores idle: a small table with many models then keeps all of them busy."""
    n = rows.getNumPartitions()
    parts = min(models, rows.context.defaultParallelism // n)
    if parts <= 1:
        return rows

    def copies(index: int, blocks: Iterator[Block]) -> Iterator[tuple[int, Block]]:
        for block in blocks:
            for k in range(parts):
                yield index * parts + k, replace(block, part=k, parts=parts)

    return rows.mapPartitionsWithIndex(copies).partitionBy(n * parts, lambda k: k).values().persist(StorageLevel.MEMORY_AND_DISK)


def for_models(rows: RDD, models: int, of: Callable[[list[Block]], Iterator]) -> RDD:
    """``of`` over all blocks, in order, in each of as many tasks as cores and models allow. The
    caller sees to it that all blocks fit in a task."""
    parts = max(1, min(models, rows.context.defaultParallelism))

    def copies(index: int, blocks: Iterator[Block]) -> Iterator[tuple]:
        for at, block in enumerate(blocks):
            for k in range(parts):
                yield k, ((index, at), replace(block, part=k, parts=parts))

    def whole(found: Iterator[tuple]) -> Iterator:
        blocks = [block for _, block in sorted(found, key=lambda t: t[0])]
        return of(blocks) if blocks else iter(())

    return rows.mapPartitionsWithIndex(copies).partitionBy(parts, lambda k: k).values().mapPartitions(whole)


def total(rows: RDD, of: Callable[[Block], np.ndarray | Sums]) -> np.ndarray | Sums:
    """The sum of ``of`` over all blocks: in each task first, then in a tree of a few at a time."""

    def part(blocks: Iterator[Block]) -> Iterator[np.ndarray]:
        found = None
        for block in blocks:
            value = of(block)
            found = value if found is None else found + value
        if found is not None:
            yield found

    sums, n = rows.mapPartitions(part), rows.getNumPartitions()  # a partition without rows adds nothing
    try:
        return sums.reduce(operator.add) if n <= MEET else sums.treeReduce(operator.add, depth=math.ceil(math.log(n, MEET)))
    except ValueError as none:
        raise ValueError("no rows to train on") from none


def total_by_key(rows: RDD, of: Callable[[list[Block]], Sums]) -> Sums:
    """The sum of ``of`` over the blocks of each partition, added up key by key in tasks, so that
    the driver gets every key's array once."""

    def part(blocks: Iterator[Block]) -> Iterator[tuple]:
        held = list(blocks)
        if held:
            yield from of(held).items()

    n = rows.getNumPartitions()
    return Sums(rows.mapPartitions(part).reduceByKey(operator.add, min(n, rows.context.defaultParallelism)).collect())


def moved_on(rows: RDD, step: Callable[[Block], Block], cut: bool) -> RDD:
    """The blocks after a step, cached; ``cut`` also writes them to the shared folder, so that a
    lost executor's blocks are not computed from the beginning."""
    new = rows.map(step).persist(StorageLevel.MEMORY_AND_DISK)
    if cut:
        from pyspark.sql import SparkSession

        shared_dir(SparkSession.getActiveSession())
        new.checkpoint()
    return new


def shares(row: np.ndarray, *seeds: int) -> np.ndarray:
    """An even number in [0, 1) per row hash and seeds, the same wherever a row lies."""
    with np.errstate(over="ignore"):
        z = row.copy()
        for seed in seeds:
            z = (z ^ np.uint64(seed % 2**64)) + np.uint64(0x9E3779B97F4A7C15)
            z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            z ^= z >> np.uint64(31)
    return (z >> np.uint64(11)) / float(1 << 53)
