"""Runnable jobs: a source, the operators, a sink, until the process is stopped.

Source and sink are functions of the session and the settings; by default they are the topics that the settings name.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketstream import schemas
from marketstream.config import ScreeningConfig, StreamConfig
from marketstream.functions import codec
from marketstream.operators import events as event_operators
from marketstream.operators import readback
from marketstream.session import prepare
from marketstream.sinks import files as sink_files
from marketstream.sinks import kafka as kafka_sink
from marketstream.sinks import triggered
from marketstream.sources import files, kafka
from marketstream.streaming import graph, progress, recommend
from marketstream.streaming import screening as screening_stream

Source = Callable[[SparkSession], DataFrame]


def start_recommendations(
    spark: SparkSession, config: StreamConfig, output: str, source: Source | None = None, publish: recommend.Publish | None = None,
    trigger: str | None = None,
) -> StreamingQuery:
    """Client events in, the lists of every user whose counts changed out. Tables and checkpoint lie below ``output``."""
    prepare(spark)
    messages = source(spark) if source else kafka.client_events(spark, config)
    security = kafka.security_options(config.user, config.password, config.ca_path)
    send = publish or recommend.to_kafka(config.brokers, config.topic_out, security)
    return recommend.start_update(
        event_operators.activity(messages, config.lateness), output, f"{output}/checkpoint", config.window, config.slide,
        config.lateness, config.top_k, trigger=trigger, publish=send,
    )


def run_recommendations(spark: SparkSession, config: StreamConfig, output: str, **ends) -> None:
    progress.run_until_stopped(start_recommendations(spark, config, output, trigger=config.trigger, **ends))


def start_screening(
    spark: SparkSession, config: ScreeningConfig, output: str, source: Source | None = None,
    publish: Callable[[DataFrame], None] | None = None, trigger: str | None = None,
) -> StreamingQuery:
    """Products in, allowed products under their own key out; the audit table, dead letters and totals lie below ``output``."""
    prepare(spark)
    security = kafka.security_options(config.user, config.password, config.ca_path)
    options = kafka.read_options(config.brokers, config.topic_in, security=security)
    messages = source(spark) if source else kafka.stream(spark, options)
    send = publish or (lambda passed: kafka_sink.publish(passed, config.brokers, config.topic_out, security))
    banned = files.control_set(spark, config.banned_path)
    return screening_stream.start(messages, banned, output, f"{output}/checkpoint", config.normalise, trigger, send)


def run_screening(spark: SparkSession, config: ScreeningConfig, output: str, **ends) -> None:
    progress.run_until_stopped(start_screening(spark, config, output, trigger=config.trigger, **ends))


def start_storage(
    spark: SparkSession, config: ScreeningConfig, output: str, source: Source | None = None, trigger: str | None = None,
) -> StreamingQuery:
    """Allowed products from their topic, from its begin, into JSON lines below ``output``; what is not a product is left out."""
    prepare(spark)
    security = kafka.security_options(config.user, config.password, config.ca_path)
    messages = source(spark) if source else kafka.stream(spark, kafka.read_options(config.brokers, config.topic_out, security=security))
    products = codec.decode(messages, schemas.PRODUCT)
    return sink_files.append_json_lines(products, f"{output}/products", f"{output}/checkpoint", trigger)


def start_read_back(
    spark: SparkSession, config: StreamConfig, output: str, source: Source | None = None, trigger: str | None = None,
) -> StreamingQuery:
    """Recommendations written from now on, one row per listed product, as a table below ``output``."""
    prepare(spark)
    messages = source(spark) if source else kafka.recommendation_tail(spark, config)
    read = recommendations_read(messages)
    writer = read.writeStream.format("parquet").option("checkpointLocation", f"{output}/checkpoint").outputMode("append")
    return triggered(writer, trigger).start(f"{output}/read")


def marketplace(
    spark: SparkSession, events: StreamConfig, products: ScreeningConfig, output: str,
    sources: Mapping[str, Source] | None = None, publish: Mapping[str, Callable[[DataFrame], None]] | None = None, trigger: str | None = None,
) -> graph.Graph:
    """All jobs as one graph: events to recommendations and their readers, products to allowed products and their store.

    ``sources`` and ``publish`` replace topics by name.
    """
    read, send = sources or {}, publish or {}
    raw, allowed, clicks, lists = products.topic_in, products.topic_out, events.topic_in, events.topic_out
    return graph.Graph(
        [
            graph.Edge(clicks, schemas.CLIENT_EVENT, outside=True), graph.Edge(lists, schemas.RECOMMENDATION),
            graph.Edge(raw, schemas.PRODUCT, outside=True), graph.Edge(allowed, schemas.PRODUCT),
        ],
        [
            graph.Node(
                "recommendations", lambda: start_recommendations(spark, events, f"{output}/recommendations", read.get(clicks), send.get(lists), trigger),
                reads={clicks: schemas.PRODUCT_ACTIVITY}, writes={lists: schemas.RECOMMENDATION}),
            graph.Node(
                "screening", lambda: start_screening(spark, products, f"{output}/screening", read.get(raw), send.get(allowed), trigger),
                reads={raw: schemas.PRODUCT}, writes={allowed: schemas.PRODUCT}),
            graph.Node(
                "storage", lambda: start_storage(spark, products, f"{output}/storage", read.get(allowed), trigger), reads={allowed: schemas.PRODUCT}),
            graph.Node(
                "read-back", lambda: start_read_back(spark, events, f"{output}/read-back", read.get(lists), trigger), reads={lists: schemas.RECOMMENDATION}),
        ],
    )


def recommendations_read(messages: DataFrame) -> DataFrame:
    """A stream or table of recommendation messages: the products in order, or the raw text of what cannot be read."""
    read = readback.read(messages)
    numbered = F.when(F.col("raw").isNull(), F.col("product_ids"))
    return read.select("user_id", "generated_at", "raw", F.posexplode_outer(numbered).alias("_at", "product_id")).select(
        "user_id", "generated_at", "raw", (F.col("_at") + 1).cast("bigint").alias("position"), "product_id")
