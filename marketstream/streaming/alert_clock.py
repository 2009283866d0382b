"""Rules evaluated as samples arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketstream.functions import times
from marketstream.operators import rules as alert_rules
from marketstream.operators import series
from marketstream.session import delete_folder
from marketstream.sinks import triggered
from marketstream.sinks.files import batch_folder, write_batch


#: Rows of ``ticks``: the firing alerts of each tick and, without an alert name, the last tick that was evaluated.
TICK = "alertname string, severity string, labels map<string,string>, ts timestamp, value double"
NAMES = ["alertname", "severity", "labels", "ts", "value"]
STATE = "alertname string, labels map<string,string>, ts timestamp, value double, active_at timestamp, state string, severity string"


def start(
    samples: DataFrame,
    output: str,
    checkpoint: str,
    rules: Sequence[alert_rules.Rule] = tuple(alert_rules.RULES),
    step: str | int = 30,
    max_age: str | int = 300,
    trigger: str | None = "30 seconds",
) -> StreamingQuery:
    """Write ``states`` for each tick once a sample at or after it has been seen.

    A micro-batch evaluates the ticks since the one before. Its samples are read once, and of each series only the last one
    up to each tick is written and looked at again. From batch to batch it keeps those that later ticks can
    look back at, and one row for each alert open at the last tick, with the time it has held since; so its cost does not
    grow with the stream's age, and a state is that of a table of all samples however old the alert is. Samples that
    arrive after their tick was evaluated count for later ticks only.

    ``ticks`` gets the firing rows of each batch with one row for the batch's last tick, so that a reader knows how far
    evaluation has come even when nothing fires.
    """
    step_s, age_s = times.seconds(step), times.seconds(max_age)
    recent_path, states_path, open_path = f"{output}/recent", f"{output}/states", f"{output}/open"

    def last_tick(df: DataFrame) -> int | None:
        newest = df.agg(F.unix_seconds(F.max("ts"))).first()[0]
        return None if newest is None else newest // step_s * step_s

    def evaluate(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = series.last_in_ticks(batch, step)

        def stored(df: DataFrame, path: str, number: int) -> DataFrame:
            return spark.read.schema(df.schema).parquet(batch_folder(path, number))

        write_batch(batch, f"{output}/arrived", batch_id)
        recent, done = stored(batch, f"{output}/arrived", batch_id), None
        still_open = spark.createDataFrame([], STATE)
        if batch_id > 0:
            older = stored(batch, recent_path, batch_id - 1)
            done = last_tick(older)
            recent, still_open = older.unionByName(recent), stored(still_open, open_path, batch_id - 1)
        end = last_tick(recent)
        found = still_open.limit(0)
        if end is not None and (done is None or end > done):
            ticks = alert_rules.evaluate(recent, rules, step, max_age, end)
            if done is not None:
                ticks = ticks.filter(F.col("ts") > F.timestamp_seconds(F.lit(done)))
            ticks = ticks.withColumn("since", F.lit(None).cast("timestamp"))
            known = still_open.select("alertname", "labels", "ts", "value", F.col("active_at").alias("since"))
            both = alert_rules.states(ticks.unionByName(known), rules, step, F.col("since")).drop("since")
            found = both if done is None else both.filter(F.col("ts") > F.timestamp_seconds(F.lit(done)))
        write_batch(found.select(*still_open.columns), states_path, batch_id)
        told = stored(still_open, states_path, batch_id).filter(F.col("state") == "firing")
        clock = spark.range(0 if end is None else 1).select(F.timestamp_seconds(F.lit(end)).alias("ts"))
        write_batch(told.unionByName(clock, allowMissingColumns=True).select(*NAMES), f"{output}/ticks", batch_id)
        if end is not None and (done is None or end > done):
            # An alert that does not hold at the last tick starts over when it holds again.
            still_open = stored(still_open, states_path, batch_id).filter(F.col("ts") == F.timestamp_seconds(F.lit(end)))
        write_batch(still_open, open_path, batch_id)
        kept = recent if end is None else recent.filter(F.col("ts") >= F.timestamp_seconds(F.lit(end - age_s)))
        write_batch(kept, recent_path, batch_id)
        for folder in ("arrived", "recent", "open"):
            delete_folder(spark, batch_folder(f"{output}/{folder}", batch_id - 2))

    writer = samples.writeStream.option("checkpointLocation", checkpoint).foreachBatch(evaluate)
    return triggered(writer, trigger).start()


def ticks(spark: SparkSession, output: str) -> DataFrame:
    """The clock's ``ticks`` as a stream, which ``transitions.changes`` takes."""
    return spark.readStream.schema(TICK).parquet(f"{output}/ticks")
