"""How far streams have come: running totals, offsets, a table of their batches, and running a stream until it is stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from marketstream.session import delete_folder
from marketstream.sinks.files import batch_folder, write_batch

Sink = Callable[[DataFrame, int], None]
TOTAL = "total bigint"


def counted(sink: Sink, counts: str) -> Sink:
    """A ``foreachBatch`` function that hands each micro-batch to ``sink`` and keeps the number of rows so far below ``counts``.

    The rows are counted while ``sink`` reads them, so it has to read its batch whole. Each batch writes the total up to it, from
    that of the batch before; a batch that runs again writes the same total, and a restart goes on from the last one.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        seen, spark = Observation(), batch.sparkSession
        sink(batch.observe(seen, F.count(F.lit(1)).alias("n")), batch_id)
        before = 0
        if batch_id > 0:
            before = spark.read.schema(TOTAL).parquet(batch_folder(counts, batch_id - 1)).first()["total"]
        write_batch(spark.createDataFrame([(before + seen.get["n"],)], TOTAL), counts, batch_id)
        delete_folder(spark, batch_folder(counts, batch_id - 2))

    return run


def total(spark: SparkSession, counts: str) -> int:
    """Rows that all batches of the stream have had, over all its starts."""
    return spark.read.schema(TOTAL).parquet(counts).agg(F.max("total")).first()[0] or 0


OFFSETS = "topic string, partition int, current_offset bigint, n bigint"


def tracked(sink: Sink, offsets: str) -> Sink:
    """A ``foreachBatch`` function that hands each batch of messages to ``sink`` and then commits the offsets it has read.

    Each batch writes, for every partition read so far, the offset after the newest message and the number of messages. It adds its own
    to those of the batch before, so a batch that runs again commits the same and a restart goes on from there.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        sink(batch, batch_id)
        read = batch.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("current_offset"), F.count("*").alias("n"))
        if batch_id > 0:
            before = spark.read.schema(OFFSETS).parquet(batch_folder(offsets, batch_id - 1))
            read = read.unionByName(before).groupBy("topic", "partition").agg(F.max("current_offset").alias("current_offset"), F.sum("n").alias("n"))
        write_batch(read, offsets, batch_id)
        delete_folder(spark, batch_folder(offsets, batch_id - 2))

    return run


def committed(spark: SparkSession, offsets: str, group: str) -> DataFrame:
    """The offsets that a stream has committed, ``group, topic, partition, current_offset, n``: those of its newest batch."""
    rows = spark.read.schema(f"{OFFSETS}, batch_id bigint").parquet(offsets)
    newest = rows.groupBy("topic", "partition").agg(F.max_by(F.struct("current_offset", "n"), "batch_id").alias("_r"))
    return newest.select(F.lit(group).alias("group"), "topic", "partition", "_r.current_offset", "_r.n")


PROGRESS = (
    "name string, batch_id bigint, at string, rows bigint, rows_per_second double, watermark string, late_rows bigint, state_rows bigint, "
    "sources array<struct<source: string, start: string, end: string, latest: string>>"
)


class ProgressTable(StreamingQueryListener):
    """Writes a row for each micro-batch of the session's queries below ``path``: rows, offsets, watermark, state.

    A batch that runs again replaces its row. Add it with ``spark.streams.addListener``; events come a little after their batch.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        sources = [(s.description, s.startOffset, s.endOffset, s.latestOffset) for s in p.sources]
        states = p.stateOperators
        row = (
            p.name, p.batchId, p.timestamp, p.numInputRows, float(p.processedRowsPerSecond), dict(p.eventTime).get("watermark"),
            sum(s.numRowsDroppedByWatermark for s in states), sum(s.numRowsTotal for s in states), sources,
        )
        table = self.spark.createDataFrame([row], PROGRESS).drop("batch_id").coalesce(1)
        write_batch(table, f"{self.path}/query={p.id}", p.batchId)


def batches(spark: SparkSession, path: str) -> DataFrame:
    """The table of all queries' batches, with the id of the ``query``."""
    return spark.read.schema(f"{PROGRESS}, query string").parquet(path)


def run_until_stopped(query: StreamingQuery) -> None:
    """Block until the query ends; an interrupt ends it between micro-batches."""
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()
