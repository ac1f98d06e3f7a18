"""Repeats over the whole history of a stream.

A watermark bounds state by forgetting; here nothing is forgotten and state is bounded in
memory instead: the digests of all records kept so far lie in files, cut by digest prefix.
A batch is joined with those of its own prefixes. What a batch reads depends on its number
alone: the last snapshot before it and the batches after that, so a batch that runs again after
a failure finds what it found and writes the same folders again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sparktab.functions.hashing import row_digest

SEEN = "digest binary, prefix int"


def _exists(spark: SparkSession, path: str, remove: bool = False) -> bool:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.delete(place, True) if remove else system.exists(place)


class History:
    """The records kept so far, as digests in files under ``path``.

    Every ``snapshot_every`` batches all digests are written anew as one snapshot, so a batch
    reads at most that many folders; what the snapshot before last replaced is deleted.
    """

    def __init__(self, spark: SparkSession, path: str, prefixes: int = 64, snapshot_every: int = 16) -> None:
        self.spark, self.path, self.prefixes, self.every = spark, path.rstrip("/"), prefixes, snapshot_every

    def _folder(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}-{number:09d}"

    def before(self, batch: int, prefixes: Sequence[int] | None = None) -> DataFrame:
        """The digests that batches before this one kept."""
        last = batch // self.every * self.every - 1  # the last snapshot's batch
        folders = [self._folder("all", last)] if last >= 0 else []
        folders += [self._folder("new", k) for k in range(last + 1, batch)]
        out = self.spark.createDataFrame([], SEEN)
        for folder in folders:
            if _exists(self.spark, folder):
                rows = self.spark.read.schema(SEEN).parquet(folder)
                out = out.unionByName(rows if prefixes is None else rows.where(F.col("prefix").isin(list(prefixes))))
        return out

    def keep(self, digests: DataFrame, batch: int) -> None:
        digests.select("digest", "prefix").write.mode("overwrite").partitionBy("prefix").parquet(self._folder("new", batch))
        if (batch + 1) % self.every == 0:
            whole = self.before(batch).unionByName(self.spark.read.schema(SEEN).parquet(self._folder("new", batch)))
            whole.repartition("prefix").write.mode("overwrite").partitionBy("prefix").parquet(self._folder("all", batch))
            old = batch - self.every
            if old >= 0:  # no batch up to the last snapshot can run again
                for k in range(old - self.every + 1, old + 1):
                    _exists(self.spark, self._folder("new", k), remove=True)
                _exists(self.spark, self._folder("all", old - self.every), remove=True)


def first_seen(
    records: DataFrame, keys: Sequence[str], path: str, state: str, checkpoint: str, prefixes: int = 64, snapshot_every: int = 16
) -> StreamingQuery:
    """Writes each batch's records whose keys no record before had to ``path``/batch=N.

    Of equal keys in one batch the least row stays. However late a repeat comes, it is found.
    NULL is a value like any other.
    """
    spark, columns = records.sparkSession, records.columns
    history = History(spark, state, prefixes, snapshot_every)

    def step(batch: DataFrame, number: int) -> None:
        digest = row_digest(batch, keys)
        one = batch.groupBy(F.unhex(digest).alias("digest")).agg(F.min(F.struct(*columns)).alias("row"))
        marked = one.withColumn("prefix", F.pmod(F.conv(F.hex(F.substring("digest", 1, 2)), 16, 10).cast("int"), F.lit(prefixes))).persist()
        try:
            there = [r["prefix"] for r in marked.select("prefix").distinct().collect()]  # at most ``prefixes``
            new = marked.join(history.before(number, there), ["prefix", "digest"], "left_anti")
            folder = f"{path}/batch={number}"
            new.select("row.*", "digest", "prefix").write.mode("overwrite").parquet(folder)
            history.keep(spark.read.parquet(folder), number)
        finally:
            marked.unpersist()

    return records.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def kept(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """All records that ``first_seen`` wrote."""
    return spark.read.parquet(path).select(*columns)
