"""Late events as a table of their own, in place of a silent drop.

A stateful aggregate drops events whose windows are all closed and only counts how many. Here a stream is split before
it is counted: every batch is written once, each row with the watermark that held for its batch and whether that made it late. The
watermark of a batch is the latest event time of all batches before it less the lateness, kept batch by batch beside the rows, so
a restart or a replayed batch splits in the same way.

Counting reads the rows that are not late. Its own watermark comes from batches that hold whole batches of the split,
so it is never ahead of theirs, and it drops nothing more: late rows and counted rows are all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketstream.functions import times
from marketstream.session import delete_folder
from marketstream.sinks import triggered
from marketstream.sinks.files import batch_folder, write_batch

ROWS, MARKS = "rows", "marks"
MARK = "latest bigint"
ADDED = [T.StructField("watermark", T.TimestampType()), T.StructField("late", T.BooleanType())]


def is_late(at: Column, watermark: Column, size: str | int, slide: str | int) -> Column:
    """True when the last window of an event time has ended by the watermark. An event without a time is not late."""
    slide_s = times.seconds(slide)
    last_end = F.timestamp_seconds(F.floor(at.cast("bigint") / slide_s) * slide_s + times.seconds(size))
    return F.coalesce(last_end <= watermark, F.lit(False))


def start(
    events: DataFrame, output: str, checkpoint: str, size: str | int = "5 minutes", slide: str | int = "2 minutes",
    lateness: str | int = "10 minutes", trigger: str | None = "60 seconds",
) -> StreamingQuery:
    """Write the events with ``event_time`` below ``output``, each batch once, with ``watermark`` and ``late``."""
    late_us = times.seconds(lateness) * 1_000_000
    rows_path, marks_path = f"{output}/{ROWS}", f"{output}/{MARKS}"

    def split(batch: DataFrame, batch_id: int) -> None:
        spark, seen, before = batch.sparkSession, Observation(), None
        if batch_id > 0:
            before = spark.read.schema(MARK).parquet(batch_folder(marks_path, batch_id - 1)).first()["latest"]
        mark = F.lit(None).cast("timestamp") if before is None else F.timestamp_micros(F.lit(before - late_us))
        marked = batch.observe(seen, F.max(F.unix_micros("event_time")).alias("latest")).withColumn("watermark", mark)
        write_batch(marked.withColumn("late", is_late(F.col("event_time"), F.col("watermark"), size, slide)), rows_path, batch_id)
        latest = max((t for t in (before, seen.get["latest"]) if t is not None), default=None)
        write_batch(spark.createDataFrame([(latest,)], MARK), marks_path, batch_id)
        if batch_id > 1:
            delete_folder(spark, batch_folder(marks_path, batch_id - 2))

    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(split)
    return triggered(writer, trigger).start()


def _schema(events: T.StructType) -> T.StructType:
    return T.StructType([*events.fields, *ADDED, T.StructField("batch_id", T.LongType())])


def late(spark: SparkSession, output: str, schema: T.StructType) -> DataFrame:
    """The late events so far, with the ``watermark`` that each came after and the ``batch_id``; ``schema`` is that of the events."""
    return spark.read.schema(_schema(schema)).parquet(f"{output}/{ROWS}").filter("late").drop("late")


def on_time(spark: SparkSession, output: str, schema: T.StructType, lateness: str | int = "10 minutes", **options: str) -> DataFrame:
    """The other events as a stream with a watermark, to be counted. A limit of files is for splits that write one file a batch."""
    rows = spark.readStream.schema(_schema(schema)).options(**options).parquet(f"{output}/{ROWS}")
    kept = rows.filter(~F.col("late")).select(*schema.names)
    return kept.withWatermark("event_time", f"{times.seconds(lateness)} seconds")
