"""Event and recommendation queries over the ``events`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketstream import schemas
from marketstream.functions import codec, times
from marketstream.operators import activity, events, ranking, readback
from marketstream.session import scratch_dir
from marketstream.sinks import triggered
from marketstream.sinks.files import write_batch
from marketstream.sources import files, tables
from marketstream.streaming import jobs, lateness, recommend

SPARSE = ("7 days", "1 day")
REFERENCE = ("5 minutes", "2 minutes")
#: Micro-batches of ``late_stream``.
LATE_BATCHES = 4


def timed_events(spark: SparkSession, sf_dir: str, streaming: bool = False, wait: str | None = None) -> DataFrame:
    source = tables.client_events(spark, sf_dir, streaming, with_product=True)
    return events.with_event_time(events.with_product(source), wait)


def bounds(df: DataFrame) -> DataFrame:
    """The window column as two text columns."""
    return df.select(
        times.format_rfc3339(F.col("window.start")).alias("window_start"),
        times.format_rfc3339(F.col("window.end")).alias("window_end"),
        *[c for c in df.columns if c != "window"],
    )


def counts(size: str, slide: str | None):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return bounds(activity.sliding_counts(timed_events(spark, sf_dir), size, slide))

    return query


def topk_user(size: str, slide: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return bounds(ranking.top_k(activity.sliding_counts(timed_events(spark, sf_dir), size, slide)))

    return query


def topk_global(size: str, slide: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        per_product = activity.sliding_counts(timed_events(spark, sf_dir), size, slide, by=["product_id"])
        return bounds(ranking.top_k(per_product, within=["window"]))

    return query


def lists(spark: SparkSession, sf_dir: str, size: str, slide: str) -> DataFrame:
    per_user = activity.sliding_counts(timed_events(spark, sf_dir), size, slide)
    return ranking.recommendations(ranking.as_lists(ranking.top_k(per_user)))


def recommend_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without the processing time, which no oracle can know."""
    found = lists(spark, sf_dir, *SPARSE).withColumn("generated_at", F.lit(None).cast("string"))
    return ranking.as_messages(found)


def event_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.decode(tables.unnumbered_messages(spark, sf_dir), schemas.CLIENT_EVENT, keep=("topic",))


def event_construct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sign-ups play searches, every tenth user is missing."""
    source = tables.events(spark, sf_dir)
    kind = F.when(F.col("event_type") == "signup", F.lit("search")).otherwise(F.col("event_type"))
    user = F.when(F.col("user_id") % 10 == 0, F.lit(None)).otherwise(F.format_string("user-%03d", F.col("user_id")))
    argument = F.concat(F.lit("item "), tables.prop_k(F.col("props")).cast("string"))
    return events.construct(source, kind, argument, user, F.col("ts"))


def event_keying(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.keyed(tables.client_events(spark, sf_dir))


def event_key_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a reader of each key sees: its messages, and how many of them stand after all older ones."""
    placed = events.in_key_order(tables.unnumbered_messages(spark, sf_dir).select("key", "seq"))
    stored = placed.withColumn("_row", F.monotonically_increasing_id())
    above = F.max("seq").over(W.partitionBy("key").orderBy("_row").rowsBetween(W.unboundedPreceding, -1))
    in_order = F.coalesce(F.col("seq") > above, F.lit(True))
    return stored.withColumn("_in_order", in_order).groupBy("key").agg(
        F.count("*").alias("n"), F.count_if("_in_order").alias("in_order"), F.max("seq").alias("newest"))


def damaged_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of which some values are cut short, emptied or missing."""
    seq, value = F.col("seq"), F.col("value")
    damaged = (
        F.when(seq % 97 == 0, F.substring(value, 1, 20))
        .when(seq % 101 == 0, F.lit(""))
        .when(seq % 103 == 0, F.lit(None))
        .otherwise(value)
    )
    return tables.unnumbered_messages(spark, sf_dir).withColumn("value", damaged)


def event_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codec.dead_letters(damaged_messages(spark, sf_dir), schemas.CLIENT_EVENT, keep=("key", "seq"))


def event_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged messages to timed product events; unreadable ones fall out."""
    source = damaged_messages(spark, sf_dir)
    return events.activity(source).select(
        "user_id", "product_id", times.format_rfc3339(F.col("event_time")).alias("event_time"))


def events_with_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events.with_product(tables.client_events(spark, sf_dir))


def event_time_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 50th timestamp is unreadable: such events have no time and fall in no window."""
    source = tables.events(spark, sf_dir)
    text = F.when(F.col("event_id") % 50 == 0, F.lit("not a time")).otherwise(times.format_rfc3339(F.col("ts")))
    timed = events.with_event_time(source.select("event_id", text.alias("timestamp")))
    return timed.select("event_id", F.unix_seconds("event_time").alias("event_seconds"))


def dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each third event arrives twice; the copy is an hour younger, though its other columns sort before the event's."""
    source = tables.events(spark, sf_dir)
    late = source.filter(F.col("event_id") % 3 == 0).withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    copies = tables.client_event_columns(late).withColumns({"event_type": F.lit("again"), "user_id": F.lit("user")})
    return events.drop_duplicates(tables.client_event_columns(source).unionByName(copies))


def late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive in batches of 500 by id; every 40th carries a time two days in the past."""
    source = tables.events(spark, sf_dir)
    shifted = F.when(F.col("event_id") % 40 == 7, F.col("ts") - F.expr("INTERVAL 2 DAYS")).otherwise(F.col("ts"))
    arriving = source.select("event_id", F.date_trunc("second", shifted).alias("event_time"),
                             F.floor(F.col("event_id") / 500).cast("bigint").alias("batch"))
    late = events.mark_late(arriving, "batch", "10 minutes", *REFERENCE).filter("late")
    return late.select("event_id", "batch", times.format_rfc3339(F.col("watermark")).alias("watermark"))


def listed(found: DataFrame) -> DataFrame:
    return found.select(
        times.format_rfc3339(F.col("window_start")).alias("window_start"),
        times.format_rfc3339(F.col("window_end")).alias("window_end"),
        "user_id",
        F.array_join("product_ids", ",").alias("product_ids"),
    )


def recommend_lists(size: str, slide: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return listed(lists(spark, sf_dir, size, slide))

    return query


def recommend_stream_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest list of each (window, user) after the whole table has been streamed."""
    work = scratch_dir(spark, "recommend-update")
    stream = timed_events(spark, sf_dir, streaming=True, wait="10 minutes")
    query = recommend.start_update(stream, work, f"{work}/checkpoint", *SPARSE, trigger=None)
    query.awaitTermination()
    return listed(recommend.current(spark, work))


def recommend_stream_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lists of the windows that the final watermark has closed."""
    work = scratch_dir(spark, "recommend-append")
    stream = timed_events(spark, sf_dir, streaming=True, wait="10 minutes")
    query = recommend.start_append(stream, work, f"{work}/checkpoint", *SPARSE, trigger=None)
    query.awaitTermination()
    return listed(recommend.results(spark, work))


def recommendation_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily lists as messages, some of them unreadable."""
    found = lists(spark, sf_dir, "1 day", "1 day").withColumn("generated_at", F.lit("2024-02-01T00:00:00Z"))
    odd = F.dayofmonth("window_start") % 7 == 0
    record = F.to_json(F.struct("user_id", "product_ids", "generated_at"))
    value = F.when(odd, F.concat(F.lit("plain text for "), F.col("user_id"))).otherwise(record)
    return found.select(times.format_rfc3339(F.col("window_start")).alias("window_start"), value.alias("value"))


def recommendation_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = readback.read(recommendation_messages(spark, sf_dir), keep=("window_start",))
    return read.withColumn("product_ids", F.array_join("product_ids", ","))


def recommendation_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = readback.read(recommendation_messages(spark, sf_dir), keep=("window_start",))
    return readback.numbered(read).withColumn("position", F.col("position").cast("bigint"))


def recommendation_stream_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily messages as a stream, as a reader sees them: numbered products, or the raw text."""
    work = scratch_dir(spark, "read-back")
    sent = recommendation_messages(spark, sf_dir).select(F.lit(None).cast("string").alias("key"), "value")
    sent.write.parquet(f"{work}/topic")
    read = jobs.recommendations_read(files.table_stream(spark, f"{work}/topic"))
    writer = read.writeStream.format("parquet").option("checkpointLocation", f"{work}/checkpoint").outputMode("append")
    triggered(writer, None).start(f"{work}/read").awaitTermination()
    return spark.read.schema(read.schema).parquet(f"{work}/read")


def in_order(spark: SparkSession, sf_dir: str, parts: int) -> DataFrame:
    """The stragglers of ``late_rows`` with the ``part`` they arrive in, by the order of their ids."""
    source = tables.events(spark, sf_dir)
    shifted = F.when(F.col("event_id") % 40 == 7, F.col("ts") - F.expr("INTERVAL 2 DAYS")).otherwise(F.col("ts"))
    n = source.count()
    return source.select("event_id", F.date_trunc("second", shifted).alias("event_time"),
                         F.least(F.floor(F.col("event_id") * parts / n), F.lit(parts - 1)).alias("part"))


def late_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event once: put aside as late by the split stream, with its watermark, or counted by the stream behind it.

    A part, in files of any number, is one micro-batch of the split; the counting stream takes two whole ones of these at a time.
    """
    work = scratch_dir(spark, "late")
    arriving = in_order(spark, sf_dir, LATE_BATCHES)
    schema = arriving.drop("part").schema
    for part in range(LATE_BATCHES):
        arriving.filter(F.col("part") == part).drop("part").write.mode("append").parquet(f"{work}/in")
        stream = spark.readStream.schema(schema).parquet(f"{work}/in")
        lateness.start(stream, work, f"{work}/checkpoint", *REFERENCE, "10 minutes", trigger=None).awaitTermination()
        if part % 2 or part == LATE_BATCHES - 1:
            counted = activity.sliding_counts(lateness.on_time(spark, work, schema, "10 minutes"), *REFERENCE, by=["event_id"])
            writer = counted.writeStream.outputMode("update").option("checkpointLocation", f"{work}/counting")
            triggered(writer.foreachBatch(lambda batch, i: write_batch(batch, f"{work}/counts", i)), None).start().awaitTermination()
    counts = spark.read.schema(counted.schema).parquet(f"{work}/counts").select("event_id").distinct()
    aside = lateness.late(spark, work, schema).select("event_id", times.format_rfc3339(F.col("watermark")).alias("watermark"))
    return aside.withColumn("late", F.lit(True)).unionByName(counts.withColumn("late", F.lit(False)), allowMissingColumns=True)


QUERIES = {
    "recommendation_stream_read": recommendation_stream_read,
    "event_decode": event_decode,
    "event_construct": event_construct,
    "event_keying": event_keying,
    "event_key_order": event_key_order,
    "event_dead_letters": event_dead_letters,
    "event_activity": event_activity,
    "events_with_product": events_with_product,
    "event_time_parse": event_time_parse,
    "dedup_events": dedup_events,
    "late_rows": late_rows,
    "late_stream": late_stream,
    "sliding_counts_5m_2m": counts(*REFERENCE),
    "sliding_counts_1d_12h": counts("1 day", "12 hours"),
    "sliding_counts_7d_1d": counts(*SPARSE),
    "tumbling_counts_1d": counts("1 day", None),
    "recommend_topk_user": topk_user(*SPARSE),
    "recommend_topk_user_5m": topk_user(*REFERENCE),
    "recommend_topk_global": topk_global(*SPARSE),
    "recommend_topk_global_5m": topk_global(*REFERENCE),
    "recommend_lists": recommend_lists(*SPARSE),
    "recommend_json": recommend_json,
    "recommend_stream_update": recommend_stream_update,
    "recommend_stream_append": recommend_stream_append,
    "recommendation_read": recommendation_read,
    "recommendation_numbered": recommendation_numbered,
}
