"""Client events: construction, the product filter, event time, duplicates and lateness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketstream import schemas
from marketstream.config import or_default
from marketstream.functions import codec, times
from marketstream.operators import numbering

# Fixed value: the user an event without one belongs to.
DEFAULT_USER = "user-demo-001"


def construct(df: DataFrame, event_type: Column, argument: Column, user: Column, at: Column) -> DataFrame:
    """Build events; a search carries its argument as the query and names no product."""
    is_search = event_type == "search"
    return df.select(
        F.concat_ws("-", event_type, times.unix_nanos(at).cast("string")).alias("event_id"),
        event_type.alias("event_type"),
        or_default(user, DEFAULT_USER).alias("user_id"),
        F.when(is_search, F.lit("")).otherwise(argument).alias("product_id"),
        F.when(is_search, argument).otherwise(F.lit("")).alias("query"),
        times.format_rfc3339(at).alias("timestamp"),
    )


def keyed(events: DataFrame) -> DataFrame:
    """Events as messages: the user is the key, so one user's events stay in one partition, in order."""
    return codec.encode(events, schemas.CLIENT_EVENT, "user_id")


def in_key_order(messages: DataFrame, key: str = "key", order: str = "seq") -> DataFrame:
    """Equal keys in one task, their messages in order."""
    return messages.repartition(key).sortWithinPartitions(key, order)


def with_product(events: DataFrame) -> DataFrame:
    """Events that name a product, whatever their type."""
    return events.filter(F.col("product_id").isNotNull() & (F.col("product_id") != ""))


def with_event_time(events: DataFrame, lateness: str | None = None) -> DataFrame:
    """Add ``event_time`` (null for unreadable text) and, if asked, the watermark."""
    timed = codec.computed_once(events, "event_time", times.parse_rfc3339(F.col("timestamp")))
    return timed.withWatermark("event_time", lateness) if lateness else timed


def activity(messages: DataFrame, lateness: str | None = None) -> DataFrame:
    """Messages to the timed product events that the counts need, parsing only their three fields."""
    return with_event_time(with_product(codec.decode(messages, schemas.PRODUCT_ACTIVITY)), lateness)


def drop_duplicates(events: DataFrame, key: str = "event_id", lateness: str = "10 minutes") -> DataFrame:
    """One row per event id.

    A table keeps the copy with the earliest event time, ties by the other columns; a copy whose time cannot be read
    comes last. A stream keeps the copy that arrives first within the watermark. The rank limit runs before the shuffle.
    """
    if events.isStreaming:
        return events.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark([key])
    at = F.col("event_time") if "event_time" in events.columns else times.parse_rfc3339(F.col("timestamp"))
    timed = codec.computed_once(events, "_at", at)
    rest = [F.col(c).asc_nulls_last() for c in events.columns if c != key]
    ordered = W.partitionBy(key).orderBy(F.col("_at").asc_nulls_last(), *rest)
    return timed.withColumn("_copy", F.row_number().over(ordered)).filter("_copy = 1").select(*events.columns)


def mark_late(events: DataFrame, batch: str, lateness: str | int, window: str | int, slide: str | int) -> DataFrame:
    """Flag the events a stream would drop because every window they fall in was already closed.

    ``batch`` is the arrival batch, a whole number from 0. The watermark of a batch is the latest event time of the batches
    before it less ``lateness``; batches are summed up first, and the maxima run in ranges of batches side by side.
    """
    latest = events.groupBy(batch).agg(F.max("event_time").alias("_latest"))
    before = numbering.before(latest, [], batch, "_latest", F.max, "_mark")
    marks = before.select(batch, (F.col("_mark") - F.expr(f"INTERVAL {times.seconds(lateness)} SECONDS")).alias("watermark"))
    slide_s, window_s = times.seconds(slide), times.seconds(window)
    at = F.col("event_time").cast("bigint")
    last_end = F.timestamp_seconds(F.floor(at / slide_s) * slide_s + window_s)
    return (
        events.join(marks, batch)
        .withColumn("late", F.coalesce(last_end <= F.col("watermark"), F.lit(False)))
    )
