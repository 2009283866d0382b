"""From raw documents to a sharded training mix: each stage reads what the one before it wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketstream.llm import decontaminate, mixing, quality, queries, sharding, simhash
from marketstream.llm.common import table, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for toxic or of low quality go."""
    return quality.accepted(docs, queries.quality_model(spark, sf_dir))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays."""
    return simhash.one_row_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents go of which at least a twentieth stands in the benchmark."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document stands as often as the mix takes it."""
    return mixing.mixed(docs)


def rendezvous_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot."""
    return sharding.sharded(docs, "doc_id", [1.0] * queries.SHARDS)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", source_mixture),
    ("sharding", rendezvous_shards),
]

#: The classifier's training, the fingerprints and the random rounding are not expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
