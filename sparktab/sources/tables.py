"""Reading tables and shaping their columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, header: bool = True, sep: str = ","
) -> DataFrame:
    """A delimited file. With a schema the file is read once and a header that names
    other columns, or another order, is an error; without one types are inferred."""
    reader = spark.read.option("header", header).option("sep", sep)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).option("enforceSchema", not header).csv(path)


def read_table(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    return spark.read.format(kind).load(path)


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rename by position. Another number of names is an error."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def rename_some(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by name, safe against reordered columns. A missing column is an error."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    return df.withColumnsRenamed(dict(names))


def without_nan(df: DataFrame) -> DataFrame:
    """NaN becomes NULL in every floating column, once, where data comes in."""
    kinds = (T.DoubleType, T.FloatType)
    found = [f for f in df.schema.fields if isinstance(f.dataType, kinds)]
    return df.withColumns({f.name: F.nanvl(f.name, F.lit(None).cast(f.dataType)) for f in found}) if found else df


def from_records(spark: SparkSession, records: Sequence[Mapping], schema: T.StructType | str, order: Sequence[str]) -> DataFrame:
    """A frame of literal records, its columns in the trained order."""
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = [tuple(r.get(f.name) for f in kinds.fields) for r in records]
    return spark.createDataFrame(rows, kinds).select(*order)
