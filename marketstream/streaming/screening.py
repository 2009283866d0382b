"""Streaming catalogue screening: one read, two outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketstream import schemas
from marketstream.functions import codec
from marketstream.operators import membership, screening
from marketstream.session import materialise
from marketstream.sinks import kafka as kafka_sink
from marketstream.sinks import once, triggered
from marketstream.sinks.files import batch_folder, write_batch
from marketstream.streaming import progress


def screen_stream(products: DataFrame, banned: DataFrame, normalise: bool = False) -> DataFrame:
    """Allowed products of a stream. The banned set is written down now and stays as it is for the query's life."""
    fixed = materialise(banned, "banned")
    return screening.passed(products, fixed, normalise, small=membership.is_small(fixed))


def start(
    messages: DataFrame, banned: DataFrame, output: str, checkpoint: str, normalise: bool = False,
    trigger: str | None = "60 seconds", publish: Callable[[DataFrame], None] | None = None, recorded: once.Recorded | None = None,
) -> StreamingQuery:
    """Screen product messages into ``output``: ``passed`` (key, value), ``audit`` and ``dead`` tables.

    ``publish`` gets each batch's passed messages as well. A batch that runs again is published again, or only what the sink
    lacks of it where ``recorded`` reads what the sink has. The banned set is written down at the start; changes of its source
    count from the next start on.
    Each micro-batch is decoded and matched once; the audited rows are written and the other outputs read them.
    """
    fixed = materialise(banned, "banned")
    small = membership.is_small(fixed)

    def screen(batch: DataFrame, batch_id: int) -> None:
        parsed = codec.parse_json(batch.select("key", "value"), schemas.PRODUCT)
        flat = parsed.select("key", "dead", F.when(F.col("dead"), codec.as_text(F.col("value"))).alias("raw"), "data.*")
        audited = screening.audit(flat, fixed, normalise, small)
        audited = audited.withColumn("status", F.when(F.col("dead"), F.lit("DEAD")).otherwise(F.col("status")))
        write_batch(audited, f"{output}/audit", batch_id)
        spark = batch.sparkSession
        done = spark.read.parquet(batch_folder(f"{output}/audit", batch_id))
        passed = kafka_sink.passed_messages(done.filter(F.col("status") == screening.PASSED))
        write_batch(passed, f"{output}/passed", batch_id)
        if publish:
            stored = spark.read.schema(passed.schema).parquet(batch_folder(f"{output}/passed", batch_id))
            if recorded:
                once.send(stored, batch_id, f"{output}/ledger", publish, recorded)
            else:
                publish(stored)
        write_batch(done.filter("dead").select("key", "raw"), f"{output}/dead", batch_id)

    run = progress.counted(screen, f"{output}/totals")
    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run)
    return triggered(writer, trigger).start()
