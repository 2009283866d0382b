"""The registered queries of the text operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketstream.llm import (
    decontaminate, fill_in_middle, fingerprints, katz, licenses, lines, mixing, quality, sentencepieces, sharding, simhash, spans,
    vector_file,
)
from marketstream.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

SHARDS = 40
#: The vocabulary of op11, a file of the package of public tokenizers.
PIECES = "piece_bpe_32k.model"


def op1_weighted_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.report(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(table(spark, sf_dir, "documents"), [1.0] * SHARDS)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.NOTICES)


def quality_model(spark: SparkSession, sf_dir: str) -> quality.Model:
    """Fitted on the labelled rows of the table itself, which a stage's input may hold only in part."""
    ratings = quality.grades(table(spark, sf_dir, "labels"))
    return quality.fit(table(spark, sf_dir, "documents"), ratings, quality.N_GRADES)


def op5_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))


def op6_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.report(table(spark, sf_dir, "documents"))


def op7_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.deduplicated(table(spark, sf_dir, "documents"), both_ways=True)


def op8_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_pivotal_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixture(table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op10_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.deduplicated(table(spark, sf_dir, "documents"))


def op11_sentencepiece_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sentencepieces.report(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.report(table(spark, sf_dir, "documents"))


def op13_vector_file_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_file.report(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_weighted_fingerprints,
        op2_decontaminate,
        op3_rendezvous_shards,
        op4_license_scan,
        op5_ordinal_quality,
        op6_katz_backoff,
        op7_sentence_spans,
        op8_simhash_pivots,
        op9_pivotal_mixture,
        op10_line_templates,
        op11_sentencepiece_rounds,
        op12_fill_in_middle,
        op13_vector_file_clusters,
    )
}
