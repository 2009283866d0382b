"""Streaming topic replication."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from marketstream.operators.mirror import mirror
from marketstream.sinks import kafka as kafka_sink
from marketstream.sinks import triggered


def start_to_table(messages: DataFrame, output: str, checkpoint: str, prefix: str = "cluster1", trigger: str | None = "60 seconds") -> StreamingQuery:
    """Copy messages to Parquet, by topic."""
    writer = (
        mirror(messages, prefix)
        .writeStream.format("parquet")
        .partitionBy("topic")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    return triggered(writer, trigger).start(output)


def start_to_kafka(
    messages: DataFrame, brokers: str, checkpoint: str, prefix: str = "cluster1", trigger: str | None = "60 seconds",
    security: dict[str, str] | None = None,
) -> StreamingQuery:
    """Copy messages to another cluster; topic and partition travel with each row."""
    rows = mirror(messages, prefix).select("topic", "partition", "key", "value")
    return kafka_sink.publish_stream(rows, brokers, checkpoint, trigger=trigger, security=security)
