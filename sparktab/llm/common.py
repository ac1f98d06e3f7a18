"""What several operators of this subpackage share: row identity, numbering, hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparktab.session import settled, ship_package

FILE, ROW = "__file", "__row"
SPACE = " \t\n\x0b\x0c\r"
#: Texts that a Python task holds decoded at once.
SLICE = 256


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A whole table of the given folder.

    Python workers get this package first, and texts in batches of about 8 MB, unless the
    session has its own setting: long texts would make batches of any number of rows large.
    """
    ship_package(spark)
    if spark.conf.get(BATCH_BYTES) == "67108864b":  # the default
        spark.conf.set(BATCH_BYTES, "8m")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def positions(df: DataFrame, scan: bool = False) -> DataFrame:
    """Adds ``__file`` and ``__row``, which name one row for good, repeated rows included.

    They come from the files that are read, not from task numbers, so they don't change
    when a lost executor's tasks run again or when Spark splits the files another way.
    ``scan`` says that ``df`` is a whole Parquet table as read, perhaps with columns
    chosen or computed; anything else is written to the shared folder first.
    """
    if not scan:
        df = settled(df, "rows")
    meta = df.metadataColumn("_metadata")
    return df.select("*", F.xxhash64(meta["file_path"]).alias(FILE), meta["row_index"].alias(ROW))


def row_hash(seed: int) -> Column:
    """An even 64-bit number for each row of ``positions``."""
    return F.xxhash64(F.lit(seed), F.col(FILE), F.col(ROW))


def numbered(df: DataFrame, groups: list[str], cells: Column, seed: int, out: str) -> DataFrame:
    """Numbers the rows of each group from 0 without gaps, in a random order.

    A group's rows are dealt over ``cells`` cells by hash. The cells are counted in a
    first pass; a row's number is its rank in its cell plus the rows of the cells before,
    so no task ever holds a group, only a cell. NULL is a group of its own.
    """
    cell = F.pmod(row_hash(seed), F.greatest(cells, F.lit(1)).cast("long")).alias("__cell")
    named = [F.col(g).alias(f"__g{i}") for i, g in enumerate(groups)]
    keys = [f"__g{i}" for i in range(len(groups))]
    before = Window.partitionBy(*keys).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = df.select(*named, cell).groupBy(*keys, "__cell").count()
    starts = counts.select(*keys, F.col("__cell").alias("__c"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__start"))
    within = Window.partitionBy(*groups, "__cell").orderBy(row_hash(seed + 1), FILE, ROW)
    ranked = df.withColumn("__cell", cell).withColumn("__rank", F.row_number().over(within) - 1)
    same = F.col("__cell") == F.col("__c")
    for g, k in zip(groups, keys):
        same = same & F.col(g).eqNullSafe(F.col(k))
    return ranked.join(starts, same).withColumn(out, F.col("__start") + F.col("__rank")).drop("__cell", "__rank", "__c", "__start", *keys)


def crc_mod(name: str, base: int) -> Column:
    """crc32 of a column as text, modulo ``base``; NULL stays NULL."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % base


def text_slices(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """A batch in parts of ``SLICE`` rows with their texts, NULL as the empty text."""
    for at in range(0, batch.num_rows, SLICE):
        part = batch.slice(at, SLICE)
        yield part, [t or "" for t in part.column(column).to_pylist()]


KINDS = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "float": pa.float32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
KINDS |= {"bigint": KINDS["long"]} | {f"array<{k}>": pa.list_(v) for k, v in KINDS.items()}


def arrow(schema: str) -> pa.Schema:
    """The Arrow form of a DDL schema of plain types and arrays of them."""
    return pa.schema([(name, KINDS[kind]) for name, kind in (field.split() for field in schema.split(","))])


def driver_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of rows that the driver holds, whose size Spark's planner knows."""
    kinds = arrow(schema)
    columns = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(kinds)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=kinds))


def logistic(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
