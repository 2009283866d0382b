"""Copy topics to another cluster under a prefixed name."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream.sources import kafka

# What is copied and what never is.
MIRRORED_TOPICS = ["products-raw", "products-filtered", "client-events"]
EXCLUDED_TOPICS = [r".*[\-\.]internal", r".*\.replica", r"__.*"]


def mirror(
    messages: DataFrame,
    prefix: str = "cluster1",
    topics: Iterable[str] | None = tuple(MIRRORED_TOPICS),
    exclude: Iterable[str] = tuple(EXCLUDED_TOPICS),
) -> DataFrame:
    """Key, value and partition stay; only the topic gets its source's prefix."""
    kept = kafka.keep_topics(messages, topics, exclude)
    return kept.withColumn("topic", F.concat(F.lit(f"{prefix}."), F.col("topic")))
