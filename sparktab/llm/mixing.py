"""Mixing sources to target weights by Pfair scheduling.

Each source's rows are numbered in a random order and read round and round: block ``j`` holds
the places ``block_rows * j`` and on of that endless list, so a block that reaches the last
row goes on with the first and every block but the mix's final one is full. Block ``j`` of a
source with weight ``w`` may not start before slot ``floor(j / w)`` and must be placed
before slot ``ceil((j + 1) / w)``; the block with the earliest deadline goes first. At any
slot ``t`` a source has then had ``w * t`` blocks, to less than one block.

Weights are the targets themselves, as exact fractions. The schedule is cut into segments of
slots, each made by a task of its own: what every source has had at a border can be worked
out from the segment before it alone (``at_border``), so tasks agree on their borders without
seeing each other, and the bound of one block holds across them. Slots meet the rows in a
join. The mix runs until each source has been read once; a source whose target exceeds its
share of the rows starts again (``epoch``), as its target asks for. No row is left out.

Why borders fit: blocks can be placed from one border to the next if no span of slots from the
first border on has more deadlines than slots, no span up to the second has more releases, and
no source has had less at the second. ``rounded`` meets the first, since of two blocks the
one with the earlier deadline can always go first; slots filled in order of deadlines from
there keep it, and meet the second as they were in fact filled. Segments in which the
smallest source has a whole block or more meet the third.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparktab.llm.common import driver_table, numbered, positions, row_hash
from sparktab.operators.support import spread_join

#: Schedules of up to so many slots (24 bytes each) are broadcast, longer ones are joined by shuffle.
BROADCAST_SLOTS = 200_000
#: Slots that a task schedules, or as many more as give each source a block.
SEGMENT_SLOTS = 1 << 16
#: Slots in an Arrow batch.
BATCH = 1 << 14


def exact_weights(targets: list) -> list[int]:
    """Whole numbers in exactly the proportions of the targets."""
    parts = [Fraction(t) for t in targets]
    scale = math.lcm(*(p.denominator for p in parts))
    whole = [int(p * scale) for p in parts]
    common = math.gcd(*whole) or 1
    return [w // common for w in whole]


def window(weight: int, period: int, block: int) -> tuple[int, int, int]:
    """The first slot of a block, the slot it must be placed before, and whether the next block's window is apart from it."""
    done = (block + 1) * period
    return block * period // weight, -(-done // weight), int(done % weight == 0)


def rounded(weights: list[int], slot: int) -> list[int]:
    """Blocks of each source before a slot: the whole part of its target, and one more for as many sources as slots
    are left over, those whose next block is due first."""
    period = sum(weights)
    had = [slot * w // period for w in weights]
    due = sorted((*window(w, period, j)[1:], i) for i, (w, j) in enumerate(zip(weights, had)) if slot * w % period)
    for *_, i in due[: slot - sum(had)]:
        had[i] += 1
    return had


def pfair(weights: list[int], slot: int, until: int, had: list[int], end: list[int] | None = None) -> Iterator[tuple[int, int]]:
    """The (source, block) that each slot up to ``until`` goes to, of sources that have ``had`` so many blocks, and have
    had ``end`` after it.

    Equal deadlines: the block whose window overlaps the next one's goes first, then the
    source of the smaller number.
    """
    period = sum(weights)
    waiting = [(*window(w, period, had[i]), i, had[i]) for i, w in enumerate(weights) if end is None or had[i] < end[i]]
    heapq.heapify(waiting)
    ready: list[tuple[int, int, int, int]] = []
    for t in range(slot, until):
        while waiting and waiting[0][0] <= t:
            _, due, apart, i, j = heapq.heappop(waiting)
            heapq.heappush(ready, (due if end is None else min(due, until), apart, i, j))
        _, _, i, j = heapq.heappop(ready)
        yield i, j
        if end is None or j + 1 < end[i]:
            heapq.heappush(waiting, (*window(weights[i], period, j + 1), i, j + 1))


def at_border(weights: list[int], slot: int, size: int) -> list[int]:
    """Blocks of each source before a border: those of the slots of the segment before it, by deadlines from ``rounded``."""
    start = max(0, slot - size)
    had = rounded(weights, start)
    for i, j in pfair(weights, start, slot, had[:]):
        had[i] = j + 1
    return had


def segment(weights: list[int], number: int, size: int) -> Iterator[tuple[int, int, int]]:
    """(source, block, slot) of a segment of ``size`` slots, each source having a target of one block in it or more."""
    slot = number * size
    turns = pfair(weights, slot, slot + size, at_border(weights, slot, size), at_border(weights, slot + size, size))
    return ((i, j, t) for t, (i, j) in enumerate(turns, slot))


def schedule(spark: SparkSession, weights: list[int], first: int, last: int, size: int, blocks: list[int] | None = None) -> DataFrame:
    """``__i2``, ``__j``, ``__slot`` of segments ``first`` to ``last`` - 1; with ``blocks`` only that block of each source.

    A task holds a few numbers per source.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                turns = (x for x in segment(weights, k, size) if blocks is None or x[1] == blocks[x[0]])
                while rows := list(itertools.islice(turns, BATCH)):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["__i2", "__j", "__slot"])

    parts = spark.range(first, last, 1, max(1, min(last - first, 10_000)))
    return parts.mapInArrow(run, "__i2 long, __j long, __slot long")


def segment_size(weights: list[int]) -> int:
    """Slots in a segment: ``SEGMENT_SLOTS``, or more if the smallest source has no block in them."""
    return max(SEGMENT_SLOTS, -(-sum(weights) // min(weights)))


def last_slot(spark: SparkSession, weights: list[int], blocks: list[int]) -> tuple[int, int]:
    """The slot by which every source has had its ``blocks``, and the source it goes to.

    Only the segments with the window of a source's last block that ends late are made.
    """
    period, size = sum(weights), segment_size(weights)
    ends = [window(w, period, n - 1) for w, n in zip(weights, blocks)]
    first, last = max(e[0] for e in ends) // size, -(-max(e[1] for e in ends) // size)
    found = schedule(spark, weights, first, last, size, [n - 1 for n in blocks])
    return tuple(found.agg(F.max(F.struct("__slot", "__i2")).alias("m")).first()["m"])


def mixed(docs: DataFrame, targets: dict | None = None, power: float = 0.7, block_rows: int = 16, seed: int = 29, scan: bool = False, cell_rows: int = 2_048) -> DataFrame:
    """All columns of ``docs`` plus ``block``, ``epoch``, ``block_slot`` and ``place``, all long.

    A row's place in the mix is (``block_slot``, ``place``); ``block`` counts its source's blocks and
    ``epoch`` how often the row came before. ``targets`` maps each source
    to its weight (None: the NULL source); a source it lacks is an error, as its rows would
    be lost. Without targets a source's weight is its row count to the ``power``. The driver
    holds one row per source, nothing per slot or row.
    An empty table gives no rows; repeated rows are placed one by one; columns that have
    the names of the new ones are replaced; texts aren't looked at.
    """
    spark = docs.sparkSession
    new = ["block", "epoch", "block_slot", "place"]
    rows = positions(docs.drop(*new), scan)
    sizes = [(r["source"], r["count"]) for r in rows.groupBy("source").count().collect()]
    sizes.sort(key=lambda x: (x[0] is not None, x[0]))
    if targets is not None and (lost := [s for s, _ in sizes if not targets.get(s, 0) > 0]):
        raise ValueError(f"no target weight for {lost[:5]}")
    weights = exact_weights([targets[s] if targets is not None else n**power for s, n in sizes])
    period, size = sum(weights), segment_size(weights) if weights else 1
    end, ender = last_slot(spark, weights, [-(-n // block_rows) for _, n in sizes]) if weights else (-1, -1)
    # no source has more blocks than this; the block that ends the mix has no row of its source a second time
    most = [n if i == ender else -(-(end + 1) * w // period) * block_rows for i, ((_, n), w) in enumerate(zip(sizes, weights))]
    kind = docs.schema["source"].dataType.simpleString()
    known = driver_table(spark, [(s, i, n, k) for i, ((s, n), k) in enumerate(zip(sizes, most))], f"source {kind}, __i long, __n long, __rows long")
    if len(sizes) <= BROADCAST_SLOTS:
        sized = rows.join(F.broadcast(known.withColumnRenamed("source", "__s")), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    else:
        sized = spread_join(rows, known, ["source"], spread=row_hash(seed), counts=known.select("source", F.col("__n").alias("n")))
    slots = schedule(spark, weights, 0, end // size + 1, size).where(F.col("__slot") <= end)
    slots = F.broadcast(slots) if end < BROADCAST_SLOTS else slots
    ranked = numbered(sized, ["source"], F.ceil(F.col("__n") / cell_rows), seed, "__index")
    again = F.explode(F.sequence(F.col("__index"), F.col("__rows") - 1, F.col("__n")))
    turns = ranked.withColumn("__at", again).withColumn("block", F.floor(F.col("__at") / block_rows)).withColumn("place", F.col("__at") % block_rows)
    placed = turns.join(slots, (F.col("__i") == F.col("__i2")) & (F.col("block") == F.col("__j")))  # one row per slot
    return (
        placed.withColumn("epoch", F.floor(F.col("__at") / F.col("__n")))
        .withColumn("block_slot", F.col("__slot"))
        .select(*[F.col(f"`{c}`") for c in docs.columns if c not in new], *new)
    )


def mix_table(docs: DataFrame, scan: bool = False) -> DataFrame:
    """doc_id, source, block, epoch, block_slot, place of every placement."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source")
    return mixed(narrow, scan=scan)
