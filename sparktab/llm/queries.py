"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparktab.llm import decontaminate, language, merkle, mixing, prefix_trie, pu_quality, shards, simhash, spans, token_planes, toxicity, warc_bundles, weak_rules
from sparktab.llm.common import documents

Query = Callable[[SparkSession, str], DataFrame]


def op1_bm25_wand_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that a document leaks."""
    return decontaminate.leak_table(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op2_hypergeometric_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 8 shards of equal row counts, uniformly shuffled."""
    return shards.shard_table(documents(spark, sf_dir), shards=8, scan=True)


def op3_byte_plane_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written as shuffled byte planes and read back."""
    import public_tokenizers

    return token_planes.token_table(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), scan=True)


def op4_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule votes of all documents, weighed by the accuracies that EM estimates."""
    return weak_rules.rule_table(documents(spark, sf_dir))


def op5_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from good labels and unlabelled text."""
    return pu_quality.quality_table(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op6_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: 3-word shingles, at most 2 differing bits."""
    return simhash.near_duplicates(documents(spark, sf_dir), shingle=3, bits=2, scan=True)


def op7_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of sentences that all documents repeat: 3 sentences and 13 words or more."""
    return spans.repeat_table(documents(spark, sf_dir), scan=True)


def op8_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in the order of a mix with source weights of their counts to the power 0.7."""
    return mixing.mix_table(documents(spark, sf_dir), scan=True)


def op9_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The languages of all documents."""
    return language.language_table(documents(spark, sf_dir))


def op10_string_kernel_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    return toxicity.toxicity_table(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


def op11_merkle_proofs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inclusion proofs of all documents in a manifest of one subtree per source."""
    return merkle.proof_table(documents(spark, sf_dir), scan=True)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations, with what a shared prefix saves."""
    return prefix_trie.trie_table(documents(spark, sf_dir, "conversations"))


def op13_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records in seekable bundles and read back."""
    return warc_bundles.page_table(documents(spark, sf_dir, "pages"), scan=True)


ALL = (
    op1_bm25_wand_decontamination,
    op2_hypergeometric_shards,
    op3_byte_plane_ids,
    op4_weak_supervision,
    op5_pu_quality,
    op6_simhash_bktree,
    op7_sentence_spans,
    op8_pfair_mix,
    op9_centroid_language,
    op10_string_kernel_toxicity,
    op11_merkle_proofs,
    op12_prefix_trie,
    op13_warc_bundles,
)
QUERIES: dict[str, Query] = {f.__name__: f for f in ALL}
#: Models, draws, components and file formats have no SQL form; tests/llm holds them against brute force.
ORACLES: dict[str, str] = {}
