"""The driver's tables in the roles of the engine's inputs.

``events`` plays the client events, the messages and the metric samples; ``part`` plays the catalogue.
Each view is narrow (no shuffle) except the message offsets.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstream import schemas
from marketstream.functions import codec, times
from marketstream.sources import files

PRODUCT_EVENT_TYPES = ["view", "click", "purchase"]

TOPIC_BY_TYPE = {
    "view": "client-events",
    "click": "products-raw",
    "purchase": "products-filtered",
    "signup": "heartbeats.internal",
    "error": "__consumer_offsets",
}


def events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """The table with ``ts`` as a zoned timestamp, which watermarks need."""
    path = f"{sf_dir}/events.parquet"
    table = files.table_stream(spark, path) if streaming else spark.read.parquet(path)
    return table.withColumn("ts", F.col("ts").cast("timestamp"))


def parts(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    path = f"{sf_dir}/part.parquet"
    return files.table_stream(spark, path) if streaming else spark.read.parquet(path)


def prop_k(props: Column) -> Column:
    return F.from_json(props, "k int")["k"]


def padded(prefix: str, number: Column) -> Column:
    """The prefix and the number with at least three digits."""
    digits = number.cast("string")
    return F.concat(F.lit(prefix), F.when(number < 1000, F.lpad(digits, 3, "0")).otherwise(digits))


def client_event_columns(wide: DataFrame, *keep: str) -> DataFrame:
    product = F.when(
        F.col("event_type").isin(*PRODUCT_EVENT_TYPES),
        F.concat(F.lit("prod-"), F.lpad(prop_k(F.col("props")).cast("string"), 3, "0")),
    ).otherwise(F.lit(""))
    return codec.computed_once(wide, "product_id", product).select(
        *keep,
        F.concat_ws("-", "event_type", F.col("event_id").cast("string")).alias("event_id"),
        "event_type",
        padded("user-", F.col("user_id")).alias("user_id"),
        "product_id",
        F.lit("").alias("query"),
        times.format_rfc3339(F.col("ts")).alias("timestamp"),
    )


def client_events(spark: SparkSession, sf_dir: str, streaming: bool = False, with_product: bool = False) -> DataFrame:
    """``with_product`` adds a filter on the stored event type, which the Parquet scan can use to skip rows
    that could never name a product; the rule on ``product_id`` itself stays with the caller."""
    wide = events(spark, sf_dir, streaming)
    if with_product:
        wide = wide.filter(F.col("event_type").isin(*PRODUCT_EVENT_TYPES))
    return client_event_columns(wide)


def catalogue(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    part_type = F.lower("p_type")
    category = (
        F.when(F.col("p_partkey") % 37 == 0, F.lit(None).cast("string"))
        .when(F.col("p_partkey") % 41 == 0, F.lit("Promo"))
        .otherwise(part_type)
    )
    return parts(spark, sf_dir, streaming).select(
        padded("prod-", F.col("p_partkey")).alias("id"),
        F.col("p_name").alias("name"),
        category.alias("category"),
        F.concat_ws(" ", F.col("p_name"), part_type).alias("description"),
        F.col("p_retailprice").alias("price"),
        F.lit("RUB").alias("currency"),
        F.col("p_size").cast("bigint").alias("quantity"),
        F.concat(F.lit("seller-"), (F.col("p_partkey") % 10).cast("string")).alias("seller_id"),
        F.col("p_brand").alias("brand"),
        F.split("p_name", " ").alias("tags"),
        F.lit("2024-01-10T08:00:00Z").alias("created_at"),
    )


def topic_of(event_type: Column) -> Column:
    topic = F.lit(None).cast("string")
    for name, value in TOPIC_BY_TYPE.items():
        topic = F.when(event_type == name, F.lit(value)).otherwise(topic)
    return topic


def unnumbered_messages(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    """Client events as keyed JSON messages, before offsets are given out; ``seq`` is their order."""
    wide = events(spark, sf_dir, streaming).select(
        "*",
        F.col("event_id").alias("seq"),
        topic_of(F.col("event_type")).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("ts").alias("sent_at"),
    )
    records = client_event_columns(wide, "seq", "topic", "partition", "sent_at")
    return codec.encode(records, schemas.CLIENT_EVENT, "user_id", ("seq", "topic", "partition", "sent_at"))


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of the Kafka source; the event id is the offset, with gaps as in a compacted topic."""
    return unnumbered_messages(spark, sf_dir).select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        "topic",
        "partition",
        F.col("seq").alias("offset"),
        F.col("sent_at").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def metric_samples(spark: SparkSession, sf_dir: str, metrics: Iterable[str] | None = None) -> DataFrame:
    """Each event gives one sample of every metric below, or of the named ones (one scan, one explode)."""
    number = (F.col("user_id") % 3 + 1).cast("string")
    wide = events(spark, sf_dir).select(
        "ts", "value",
        (F.col("event_type") == "error").alias("is_error"),
        F.concat(F.lit("kafka-"), number).alias("broker"),
        F.concat(F.lit("kafka-"), number, F.lit(":910"), number).alias("instance"),
        F.when(F.col("event_type") == "view", F.lit("products-raw")).otherwise(F.col("event_type")).alias("topic"),
        F.when(F.col("user_id") % 2 == 0, F.lit("stream-processor")).otherwise(F.lit("connect-filesink-group")).alias("group"),
        (F.col("user_id") % 3).cast("string").alias("partition"),
    )
    value, is_error = F.col("value"), F.col("is_error")
    families = {
        "up": (["broker"], F.when(is_error, 0.0).otherwise(1.0)),
        "kafka_consumer_group_lag": (["topic", "partition", "group"], value * 10),
        "kafka_server_replicamanager_underreplicatedpartitions": (
            ["broker"], F.when(is_error, F.floor(value / 10)).otherwise(0)),
        "kafka_controller_kafkacontroller_activecontrollercount": (
            ["broker"], F.when((F.col("broker") == "kafka-1") & ~is_error, 1.0).otherwise(0.0)),
        "kafka_log_log_size": (["topic", "partition", "broker"], F.round(value * 1e8)),
        "kafka_server_brokertopicmetrics_MessagesInPerSec_OneMinuteRate": (["topic", "broker"], value),
        "kafka_server_brokertopicmetrics_BytesInPerSec_OneMinuteRate": (["topic", "broker"], F.round(value * 1000)),
    }

    def sample(name: str, label_names: list[str], sampled: Column) -> Column:
        # Every label here has a text of its own, so the map needs no check for empty ones.
        pairs = [(F.lit("job"), F.lit("kafka")), (F.lit("cluster"), F.lit("cluster-1"))]
        pairs += [(F.lit(n), F.col(n)) for n in ["instance", *label_names]]
        tags = F.create_map(*[c for pair in pairs for c in pair])
        return F.struct(F.lit(name).alias("metric"), tags.alias("labels"), sampled.cast("double").alias("value"))

    chosen = families if metrics is None else {name: families[name] for name in families if name in set(metrics)}
    samples = F.array(*[sample(name, *family) for name, family in chosen.items()])
    return wide.select("ts", F.explode(samples).alias("s")).select("ts", "s.metric", "s.labels", "s.value")
