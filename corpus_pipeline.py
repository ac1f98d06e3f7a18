"""The corpus pipeline: what is kept of `documents`, mixed and sharded for training.

Each stage gets the documents that the stage before kept, written as Parquet and read
again. NULL, empty and very long texts pass through every stage as the operators define;
an empty table gives an empty result with the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparktab.llm import decontaminate, mixing, shards, simhash, toxicity
from sparktab.llm.common import documents
from sparktab.session import settled


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine scores under 0.3."""
    return toxicity.without_toxic(docs, documents(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each SimHash component (3-word shingles, 2 bits)."""
    return simhash.without_near_duplicates(docs, shingle=3, bits=2, scan=True)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item's question and answer."""
    return decontaminate.without_leaks(docs, documents(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once per turn that its source's weight (its count to the power 0.7) asks for, in the mix's order."""
    mix = mixing.mixed(docs, scan=True)
    return mix.repartitionByRange("block_slot", "place").sortWithinPartitions("block_slot", "place").select(*[f"`{c}`" for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, uniformly shuffled into 8 shards of equal size, with shard and slot."""
    return shards.shuffled(docs, 8, scan=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark_leaks),
    ("mixing to target weights", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the stages before give is written to the shared folder."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = settled(docs, "stage")
    return docs


#: Trained models, graph components and seeded draws have no SQL form; tests compare with brute force.
ORACLE_SQL = None
