"""Keyed messages to topics. Delivery is at least once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from marketstream import schemas
from marketstream.functions import codec
from marketstream.sinks import triggered
from marketstream.sources import kafka


def publish(messages: DataFrame, brokers: str, topic: str | None = None, security: dict[str, str] | None = None) -> None:
    """Write a table of messages; Spark's default partitioner keeps equal keys in one partition."""
    messages.write.format("kafka").options(**kafka.write_options(brokers, topic, security)).save()


def publish_stream(
    messages: DataFrame,
    brokers: str,
    checkpoint: str,
    topic: str | None = None,
    mode: str = "append",
    trigger: str | None = "60 seconds",
    security: dict[str, str] | None = None,
) -> StreamingQuery:
    writer = (
        messages.writeStream.format("kafka")
        .options(**kafka.write_options(brokers, topic, security))
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
    )
    return triggered(writer, trigger).start()


def product_messages(products: DataFrame) -> DataFrame:
    """Catalogue rows as messages keyed by product id, absent fields as empty values."""
    return codec.encode(codec.zero_values(products), schemas.PRODUCT, "id")


def passed_messages(products: DataFrame, key: str = "key") -> DataFrame:
    """Screened products under the key they came with."""
    return codec.encode(codec.zero_values(products), schemas.PRODUCT, key)
