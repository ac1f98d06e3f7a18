"""Report tables on disk, and the manifest that counts them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class ReportStore:
    """Writes each report as one table under ``root/group/report``."""

    spark: SparkSession
    root: str

    def path(self, group: str, report: str) -> str:
        return f"{self.root}/{group}/{report}"

    def save(self, group: str, report: str, df: DataFrame) -> tuple[str, str]:
        """Replaces an earlier report of the same name; returns its key."""
        df.write.mode("overwrite").parquet(self.path(group, report))
        return group, report

    def load(self, group: str, report: str) -> DataFrame:
        return self.spark.read.parquet(self.path(group, report))

    def manifest(self, saved: list[tuple[str, str]]) -> DataFrame:
        """report_group, n_reports, n_rows over the reports saved in a run."""
        if not saved:
            kinds = "report_group string, n_reports bigint, n_rows bigint"
            return self.spark.createDataFrame([], T.StructType.fromDDL(kinds))
        listed = None
        for group, report in sorted(set(saved)):
            line = self.load(group, report).agg(
                F.lit(group).alias("report_group"), F.lit(report).alias("report"), F.count("*").alias("n")
            )
            listed = line if listed is None else listed.unionByName(line)
        return listed.groupBy("report_group").agg(
            F.count("*").alias("n_reports"), F.sum("n").cast("bigint").alias("n_rows")
        )
