"""Publishing that a replayed batch does not repeat.

A stream publishes a batch and then commits it; between the two it can fail, and the batch runs again. A ledger beside the
publish says how far it came: before the first message a batch notes that it begins, after the last one that it is done. A batch that
is done sends nothing. One that had only begun asks the sink, which can be read, what it has of the batch, and sends the rest. All
others send everything and ask nothing, so the usual batch costs two small rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from marketstream.sinks.files import batch_folder, write_batch

BEGUN, DONE = "begun", "done"
Publish = Callable[[DataFrame], None]
#: The messages of a batch that a sink already has, with the columns that are published.
Recorded = Callable[[SparkSession, int], DataFrame]


def noted(spark: SparkSession, ledger: str, step: str, batch_id: int) -> bool:
    """Whether the batch has come to this step; a folder without a row was not finished."""
    try:
        return not spark.read.schema("step string").parquet(batch_folder(f"{ledger}/{step}", batch_id)).isEmpty()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def note(spark: SparkSession, ledger: str, step: str, batch_id: int) -> None:
    write_batch(spark.createDataFrame([(step,)], "step string").coalesce(1), f"{ledger}/{step}", batch_id)


def send(messages: DataFrame, batch_id: int, ledger: str, publish: Publish, recorded: Recorded) -> None:
    """Publish the messages of a batch, each once, though the batch may run several times.

    ``messages`` must be the same in every run of a batch, so they are best read from what the first run wrote. Equal messages
    are counted: a sink that has one of two gets the other.
    """
    spark = messages.sparkSession
    if noted(spark, ledger, DONE, batch_id):
        return
    if noted(spark, ledger, BEGUN, batch_id):
        messages = messages.exceptAll(recorded(spark, batch_id).select(*messages.columns))
    else:
        note(spark, ledger, BEGUN, batch_id)
    publish(messages)
    note(spark, ledger, DONE, batch_id)
