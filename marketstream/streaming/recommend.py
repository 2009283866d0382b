"""Streaming top-k recommendations.

One stateful aggregate counts (window, user, product), with a partial count before the shuffle, so a user or
product that owns a large share of the events still sends few rows per task and its state is spread over many
products. Ranking happens per micro-batch in ``foreachBatch``, as a table query with the rank limit pushed
before its shuffle. No list of a user's events is ever kept, and Spark's check of stateful operators stays on.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketstream.operators import activity, ranking
from marketstream.session import delete_folder
from marketstream.sinks import kafka as kafka_sink
from marketstream.sinks import once, triggered, upsert
from marketstream.sinks.files import batch_folder, write_batch

COUNTS, CHANGES, RESULTS, TABLE, LEDGER = "counts", "changes", "results", "table", "ledger"

#: Batches between two snapshots of the open counts.
SNAPSHOT = 10

Publish = Callable[[DataFrame], None]


def to_kafka(brokers: str, topic: str, security: dict[str, str] | None = None) -> Publish:
    """Send each batch's recommendations to a topic, keyed by user. A replayed batch is sent again, unless the stream is
    given a way to read what the topic has (``recorded``)."""
    return lambda recommended: kafka_sink.publish(ranking.as_messages(recommended), brokers, topic, security)


def _write(lists: DataFrame, output: str, batch_id: int, publish: Publish | None, recorded: once.Recorded | None) -> None:
    """Write the batch's recommendations and publish the written rows, so both agree.

    With ``recorded`` each message is published once: a batch whose publishing had begun keeps the rows it wrote, which
    bear the time they were made at.
    """
    spark, recommended = lists.sparkSession, ranking.recommendations(lists)
    ledger, schema = f"{output}/{LEDGER}", recommended.schema
    if not (recorded and once.noted(spark, ledger, once.BEGUN, batch_id)):
        write_batch(recommended, f"{output}/{RESULTS}", batch_id)
    if publish:
        stored = spark.read.schema(schema).parquet(batch_folder(f"{output}/{RESULTS}", batch_id))
        if recorded:
            once.send(stored, batch_id, ledger, publish, recorded)
        else:
            publish(stored)


def start_append(
    timed_events: DataFrame,
    output: str,
    checkpoint: str,
    size: str = "5 minutes",
    slide: str = "2 minutes",
    k: int = 5,
    within: Sequence[str] = ("window", "user_id"),
    trigger: str | None = "60 seconds",
    publish: Publish | None = None,
    recorded: once.Recorded | None = None,
) -> StreamingQuery:
    """Write each window's lists once, after the watermark has passed its end.

    All counts of a window reach the sink in the same micro-batch, because one watermark closes them.
    """
    by = [c for c in within if c != "window"] + ["product_id"]
    counts = activity.sliding_counts(timed_events, size, slide, by)

    def rank(closed: DataFrame, batch_id: int) -> None:
        lists = ranking.as_lists(ranking.top_k(closed, within, k), within)
        _write(lists, output, batch_id, publish, recorded)

    writer = counts.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(rank)
    return triggered(writer, trigger).start()


def _open_counts(older: list[DataFrame], by: Sequence[str], size: str, lateness: str) -> DataFrame:
    """The newest counts of the windows that events can still reach."""
    known = functools.reduce(DataFrame.unionByName, older)
    latest = known.agg(F.max("window.end").alias("_latest"))
    newest = known.groupBy("window", *by).agg(F.max("n").alias("n"))
    # Spark drops late events by the watermark of the batch before, so windows that all older batches left open stay.
    horizon = F.col("_latest") - F.expr(f"INTERVAL {size}") - F.expr(f"INTERVAL {lateness}")
    return newest.join(F.broadcast(latest), F.col("window.end") > horizon).drop("_latest")


def start_update(
    timed_events: DataFrame,
    output: str,
    checkpoint: str,
    size: str = "5 minutes",
    slide: str = "2 minutes",
    lateness: str = "10 minutes",
    k: int = 5,
    within: Sequence[str] = ("window", "user_id"),
    trigger: str | None = "60 seconds",
    publish: Publish | None = None,
    recorded: once.Recorded | None = None,
) -> StreamingQuery:
    """After every micro-batch, write the current list of each group whose counts changed.

    The aggregate emits changed counts only, but a rank also depends on the unchanged ones. So each batch writes its
    changes, and every ``SNAPSHOT`` batches the counts of all windows still open are put together into a snapshot. A batch
    reads the last snapshot and the changes since, keeps the groups it touches and ranks those alone. A batch that runs
    again reads the same tables and replaces its own folders. ``current`` reads the newest lists. ``recorded`` reads what the
    sink has of a batch; with it, a batch that runs again publishes only what is missing.
    """
    by = [c for c in within if c != "window"] + ["product_id"]
    counts = activity.sliding_counts(timed_events, size, slide, by)
    counts_path, changes_path = f"{output}/{COUNTS}", f"{output}/{CHANGES}"

    def rank(changes: DataFrame, batch_id: int) -> None:
        spark = changes.sparkSession

        def stored(path: str, batches: Iterable[int]) -> list[DataFrame]:
            return [spark.read.schema(changes.schema).parquet(batch_folder(path, b)) for b in batches]

        write_batch(changes, changes_path, batch_id)
        base = batch_id // SNAPSHOT * SNAPSHOT
        if batch_id == base:
            older = stored(counts_path, [base - SNAPSHOT] if base else []) + stored(changes_path, range(max(base - SNAPSHOT, 0), base))
            write_batch(_open_counts(older, by, size, lateness) if older else changes.limit(0), counts_path, base)
        if batch_id == base + 1:
            # The snapshot's batch is done, so nothing reads what it was made from again.
            delete_folder(spark, batch_folder(counts_path, base - SNAPSHOT))
            for done in range(base - SNAPSHOT, base):
                delete_folder(spark, batch_folder(changes_path, done))
        now = stored(changes_path, [batch_id])[0]
        if batch_id > 0 and now.isEmpty():
            return  # a batch that only moves the watermark changes no list
        touched = now.select(*within).distinct()
        known = functools.reduce(DataFrame.unionByName, stored(counts_path, [base]) + stored(changes_path, range(base, batch_id + 1)))
        # Null-safe: events without a user form a group too. The touched groups are picked before anything is ranked.
        same = functools.reduce(operator.and_, [known[c].eqNullSafe(touched[c]) for c in within])
        picked = known.join(touched, same, "left_semi")
        # Counts only grow, so the larger one is the newer one. The first batch has no older ones.
        newest = picked.groupBy("window", *by).agg(F.max("n").alias("n")) if batch_id > 0 else now
        _write(ranking.as_lists(ranking.top_k(newest, within, k), within), output, batch_id, publish, recorded)
        upsert.commit(spark, f"{output}/{RESULTS}", f"{output}/{TABLE}", batch_id, *_lists(within))

    writer = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(rank)
    return triggered(writer, trigger).start()


def _lists(within: Sequence[str]) -> tuple[T.StructType, list[str]]:
    """The type and the key of a list of the groups ``within``."""
    groups = [T.StructField(c, T.StringType()) for c in within if c != "window"]
    bounds = [T.StructField(c, T.TimestampType()) for c in ("window_start", "window_end")]
    rest = [T.StructField("product_ids", T.ArrayType(T.StringType())), T.StructField("generated_at", T.StringType())]
    return T.StructType([*groups, *rest, *bounds]), [f.name for f in (*groups, *bounds)]


def current(spark: SparkSession, output: str, within: Sequence[str] = ("window", "user_id")) -> DataFrame:
    """The newest list of each group; reads the base of the table and the batches since, however many there were."""
    return upsert.current(spark, f"{output}/{RESULTS}", f"{output}/{TABLE}", *_lists(within)).drop("version")


def results(spark: SparkSession, output: str) -> DataFrame:
    """All lists written so far, with the ``batch_id`` that wrote them."""
    return spark.read.parquet(f"{output}/{RESULTS}")


def latest(written: DataFrame, within: Sequence[str] = ("window_start", "window_end", "user_id")) -> DataFrame:
    """The newest list of each group of a table of all lists."""
    return upsert.newest(written, within).drop("batch_id")
