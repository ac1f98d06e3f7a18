"""Engine-independent row digests and the even buckets derived from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def key_digest(keys: Sequence[str], seed: int) -> Column:
    """md5 of ``seed|key|...`` as hex text: a repeatable pseudo-random order."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def digest_prefix(digest: Column, hex_digits: int) -> Column:
    """The first hex digits of a digest as a number."""
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("long")


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of a row, so that equality is tested without shuffling wide text.

    Each value is preceded by its length and NULL has a mark of its own, so values
    cannot run into each other. Zero is unsigned first, as in Spark's own grouping.
    """
    parts = []
    types = {f.name: f.dataType for f in df.schema.fields}
    for name in columns:
        col = F.col(name)
        if isinstance(types[name], (T.DoubleType, T.FloatType)):
            col = col + F.lit(0.0)
        text = col.cast("string") if isinstance(types[name], T.AtomicType) else F.to_json(F.struct(col))
        parts.append(F.when(col.isNull(), F.lit("n;")).otherwise(F.concat(F.length(text), F.lit(":"), text)))
    return F.sha2(F.concat(*parts), 256)
