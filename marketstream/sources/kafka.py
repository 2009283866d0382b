"""Message topics through Spark's Kafka source."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstream.config import StreamConfig


def security_options(user: str | None, password: str | None, ca_path: str | None = None) -> dict[str, str]:
    """SCRAM over TLS when credentials are given, nothing otherwise. Credentials never have defaults."""
    if not user and not password:
        return {}
    if not user or not password:
        raise ValueError("user and password go together")
    if '"' in user + password or "\\" in user + password:
        raise ValueError("quotes and backslashes are not allowed in credentials")
    options = {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.sasl.mechanism": "SCRAM-SHA-512",
        "kafka.sasl.jaas.config": (
            "org.apache.kafka.common.security.scram.ScramLoginModule required "
            f'username="{user}" password="{password}";'
        ),
    }
    if ca_path:
        options["kafka.ssl.truststore.location"] = ca_path
        options["kafka.ssl.truststore.type"] = "PEM"
    return options


def read_options(
    brokers: str,
    topics: str | Iterable[str] | None = None,
    pattern: str | None = None,
    starting: str = "earliest",
    security: dict[str, str] | None = None,
) -> dict[str, str]:
    """Options for one topic, several, or a name pattern. ``starting`` counts on the first start only."""
    if (topics is None) == (pattern is None):
        raise ValueError("give either topics or a pattern")
    if starting not in ("earliest", "latest"):
        raise ValueError("starting is earliest or latest")
    options = {"kafka.bootstrap.servers": brokers, "startingOffsets": starting, **(security or {})}
    if pattern is not None:
        options["subscribePattern"] = pattern
    else:
        options["subscribe"] = topics if isinstance(topics, str) else ",".join(topics)
    return options


def write_options(brokers: str, topic: str | None = None, security: dict[str, str] | None = None) -> dict[str, str]:
    """Every in-sync replica confirms a write. Without a topic, the rows carry it in a column."""
    options = {"kafka.bootstrap.servers": brokers, "kafka.acks": "all", **(security or {})}
    if topic:
        options["topic"] = topic
    return options


def stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def client_events(spark: SparkSession, config: StreamConfig) -> DataFrame:
    """All events of the input topic; progress lives in the query's checkpoint."""
    security = security_options(config.user, config.password, config.ca_path)
    return stream(spark, read_options(config.brokers, config.topic_in, security=security))


def recommendation_tail(spark: SparkSession, config: StreamConfig) -> DataFrame:
    """Recommendations written after the reader starts, from every partition."""
    security = security_options(config.user, config.password, config.ca_path)
    return stream(spark, read_options(config.brokers, config.topic_out, starting="latest", security=security))


def keep_topics(
    messages: DataFrame, include: Iterable[str] | None = None, exclude: Iterable[str] = ()
) -> DataFrame:
    """Include by name, then exclude by pattern; a pattern must cover the whole name."""
    if include is not None:
        messages = messages.filter(F.col("topic").isin(*include))
    for pattern in exclude:
        messages = messages.filter(~F.col("topic").rlike(f"^(?:{pattern})$"))
    return messages
