"""Sharding by a hypergeometric communication matrix.

A uniform shuffle of all rows into shards whose sizes differ by one row at most. The
table's files are cut into blocks of consecutive rows, whose sizes are counted. How many
rows of each block go to each shard is drawn exactly: one block after the other takes a
multivariate hypergeometric sample of the places that the shards have left. Each block
then permutes its own row of the matrix over its rows, one exchange sends the rows, and
each shard permutes what it got, cell by cell, which gives the slots.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparktab.llm.common import FILE, ROW, driver_table, numbered, positions

#: numpy draws exactly up to this many rows.
NUMPY_ROWS = 1_000_000_000


def draw(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` rows, taken without replacement from ``good + bad``, are good."""
    if good < NUMPY_ROWS and bad < NUMPY_ROWS:
        return int(rng.hypergeometric(good, bad, n)) if n else 0
    low, high = max(0, n - bad), min(good, n)
    mode = min(max((n + 1) * (good + 1) // (good + bad + 2), low), high)
    choose = lambda a, b: math.lgamma(a + 1) - math.lgamma(b + 1) - math.lgamma(a - b + 1)
    here = math.exp(choose(good, mode) + choose(bad, n - mode) - choose(good + bad, n))
    u, down, up, p_down, p_up = rng.random() - here, mode, mode, here, here
    found = mode
    while u > 0 and (down > low or up < high):  # outwards from the likeliest count
        if up < high:
            p_up *= (good - up) * (n - up) / ((up + 1) * (bad - n + up + 1))
            up, found, u = up + 1, up + 1, u - p_up
        if u > 0 and down > low:
            p_down *= down * (bad - n + down) / ((good - down + 1) * (n - down + 1))
            down, found, u = down - 1, down - 1, u - p_down
    return found


def communication_matrix(sizes: list[int], shards: int, seed: int) -> list[list[int]]:
    """Rows of each block (row) that go to each shard (column), with exact margins."""
    total, rng = sum(sizes), np.random.default_rng(seed)
    left = [total // shards + (k < total % shards) for k in range(shards)]
    matrix = []
    for size in sizes:
        row, want, rest = [], size, sum(left)
        for k in range(shards):
            rest -= left[k]
            row.append(draw(rng, left[k], rest, want))
            want -= row[-1]
        left = [a - b for a, b in zip(left, row)]
        matrix.append(row)
    return matrix


def _local_permutation(seed: int):
    @F.pandas_udf("int")
    def shard_of(parts: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for file, block, rank, row in parts:
            out = np.zeros(len(file), dtype=np.int32)
            blocks = pd.DataFrame({"f": file, "b": block}).groupby(["f", "b"]).indices
            for key, at in blocks.items():
                if key not in held:
                    if len(held) >= 4:  # a scan visits a file's blocks one after the other
                        held.clear()
                    counts = np.asarray(row.iloc[at[0]])
                    labels = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
                    np.random.default_rng([seed, int(key[0]) % 2**64, int(key[1])]).shuffle(labels)
                    held[key] = labels
                out[at] = held[key][rank.to_numpy()[at]]
            yield pd.Series(out)

    return shard_of


def shuffled(
    df: DataFrame, shards: int, seed: int = 17, scan: bool = False, block_rows: int = 65_536, most_blocks: int = 16_384, cell_rows: int = 2_048
) -> DataFrame:
    """All columns of ``df`` plus ``shard`` (int) and ``slot`` (long, gapless from 0 in its shard).

    ``scan``: ``df`` is a whole Parquet table as read (see ``positions``). Blocks have
    ``block_rows`` rows, more if there would be over ``most_blocks`` besides one per file,
    so the matrix stays small. Every row, repeated ones too, gets a place of its own;
    NULLs don't matter, as no value is looked at. An empty table gives no rows; columns
    named shard or slot are replaced. Fewer rows than shards leave some shards empty.
    """
    spark = df.sparkSession
    rows = positions(df.drop("shard", "slot"), scan)
    per = max(block_rows, math.ceil(rows.count() / most_blocks))
    rows = rows.withColumn("__block", F.floor(F.col(ROW) / per)).withColumn("__at", F.col(ROW) % per)
    sizes = rows.groupBy(FILE, "__block").count().orderBy(FILE, "__block").collect()
    total = sum(r["count"] for r in sizes)
    matrix = communication_matrix([r["count"] for r in sizes], shards, seed)
    sent = driver_table(spark, [(r[FILE], r["__block"], m) for r, m in zip(sizes, matrix)], f"{FILE} long, __block long, __sent array<long>")
    shard = _local_permutation(seed)(F.col(FILE), F.col("__block"), F.col("__at"), F.col("__sent"))
    placed = rows.join(sent, [FILE, "__block"]).withColumn("shard", shard).drop("__block", "__at", "__sent")
    cells = F.lit(math.ceil(total / shards / cell_rows))
    return numbered(placed, ["shard"], cells, seed + 1, "slot").drop(FILE, ROW)


def shard_table(docs: DataFrame, shards: int = 8, scan: bool = False) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    ``size`` is the text's UTF-8 bytes plus 1; a NULL text has size 1 and the checksum of
    no bytes. The law is ``rows``: shard sizes differ by one row at most.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = shuffled(narrow, shards, scan=scan)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
