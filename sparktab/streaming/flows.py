"""Scoring, validating, deduplicating and counting records as they arrive.

The transformations are the batch ones. Only the sinks and the watermarks are added
here; progress and state live in the caller's checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparktab.operators import evaluate, validate
from sparktab.operators.attribution import LinearModel, score


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str | None = None, kind: str = "parquet"
) -> DataFrame:
    """Files of a folder as they appear, optionally only those that match a pattern."""
    reader = spark.readStream.format(kind).schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(folder)


def read_table_stream(spark: SparkSession, folder: str, schema: T.StructType, name: str, kind: str = "parquet") -> DataFrame:
    """One table of a folder, whether it is a file or a folder of files. A file filter sees the names
    of the files alone, so the table is named by a glob, which may match either."""
    return spark.readStream.format(kind).schema(schema).load(f"{folder.rstrip('/')}/{{{name}}}")


def score_stream(records: DataFrame, model: LinearModel, keys: Sequence[str], k: int = 3) -> DataFrame:
    """The batch scoring function; it has no shuffle and keeps no state."""
    return score(records, model, keys, k)


def dedup_stream(records: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """One record per key within ``delay`` of event time; older state is dropped."""
    return records.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def triage_stream(scored: DataFrame, time: str, window: str, delay: str, threshold: float = 70.0) -> DataFrame:
    """window_start, prediction, borderline, n per event-time window."""
    timed = scored.withWatermark(time, delay)
    counts = evaluate.triage(timed, threshold, [F.window(time, window).alias("window")])
    return counts.select(F.col("window.start").alias("window_start"), "prediction", "borderline", "n")


def write_tables(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process what is there and stop; the file sink commits each batch once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )


def _sink(path: str) -> Callable[[DataFrame, int], None]:
    """Writes a batch to a folder of its own, so that a repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def write_batches(stream: DataFrame, path: str, checkpoint: str, mode: str = "update") -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(_sink(path))
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(availableNow=True)
        .start()
    )


def route_stream(
    records: DataFrame, rules: Sequence[validate.Rule], accepted: str, rejected: str, checkpoint: str
) -> StreamingQuery:
    """Sends each record to the accepted or the rejected folder, checked once per batch."""

    def route(batch: DataFrame, batch_id: int) -> None:
        checked = validate.with_violations(batch, rules).persist()
        try:
            _sink(accepted)(validate.accepted(checked), batch_id)
            _sink(rejected)(validate.rejected(checked), batch_id)
        finally:
            checked.unpersist()

    return (
        records.writeStream.foreachBatch(route)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
