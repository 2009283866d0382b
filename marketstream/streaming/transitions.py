"""Firing and resolved alerts as a stream: keyed state with event-time timers.

An alert resolves because nothing arrives, so no row can say it. Each alert keeps its last firing tick and a timer one quiet
time after it; when the watermark passes the timer and no newer tick has come, the alert resolves.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from marketstream.functions import labels as lb
from marketstream.functions import times
from marketstream.sinks import triggered
from marketstream.sinks.files import write_batch

KEY = ["alertname", "severity", "series"]
CHANGE = "alertname string, severity string, series string, at bigint, status string, value double"
CHANGES = "alertname string, severity string, labels map<string,string>, at timestamp, status string, value double"
ENTRIES = "array<struct<key: string, value: string>>"
MILLIS = 1000


class Alert(StatefulProcessor):
    """The changes of one alert. Ticks wait until the watermark has passed them, so they are taken in order."""

    def __init__(self, quiet: int):
        self.quiet = quiet

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at bigint, value double")
        self.waiting = handle.getMapState("waiting", "at bigint", "value double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        if key[0] is not None:  # rows without a name only move the watermark
            for part in rows:
                for at, value in zip(part["at"].tolist(), part["value"].tolist(), strict=True):
                    self.waiting.updateValue((at,), (None if pd.isna(value) else value,))
                    self.handle.registerTimer(at * MILLIS)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Everything up to the watermark, whichever timer came first; the others then find nothing to do."""
        now = timerValues.getCurrentWatermarkInMs() // MILLIS
        changes, last = [], self.last.get() if self.last.exists() else None
        due = sorted((at, value) for (at,), (value,) in self.waiting.iterator() if at <= now)
        for at, value in due:
            self.waiting.removeKey((at,))
            if last is not None and at <= last[0]:
                continue  # a tick that was written again
            if last is not None and at - last[0] > self.quiet:
                changes.append((last[0] + self.quiet, "resolved", last[1]))
                last = None
            if last is None:
                changes.append((at, "firing", value))
            last = (at, value)
        if last is not None and last[0] + self.quiet <= now:
            changes.append((last[0] + self.quiet, "resolved", last[1]))
            last = None
        if last is None:
            self.last.clear()
        else:
            self.last.update(last)
            if due:
                self.handle.registerTimer((last[0] + self.quiet) * MILLIS)
        if changes:
            yield pd.DataFrame([(*key, *c) for c in changes], columns=[*KEY, "at", "status", "value"])


def changes(
    firing: DataFrame, step: str | int = 30, resolve_after: str | int = 300, lateness: str | int = 0,
) -> DataFrame:
    """The stream of ``rules.transitions``: ``alertname, severity, labels, at, status, value``.

    ``firing`` has a row per alert and firing tick (``alertname, severity, labels, ts, value``) and rows without an
    ``alertname`` for ticks at which nothing fires: time moves on with either. A change comes out once all rows up to its
    time less ``lateness`` have been seen; ticks that arrive later than that are dropped. A tick that arrives twice counts once.
    """
    quiet = max(times.seconds(resolve_after), times.seconds(step))
    ticks = firing.withWatermark("ts", f"{times.seconds(lateness)} seconds").select(
        "alertname", "severity", F.to_json(lb.series_key(F.col("labels"))).alias("series"),
        "ts", F.unix_seconds("ts").alias("at"), "value",
    )
    found = ticks.groupBy(*KEY).transformWithStateInPandas(Alert(quiet), CHANGE, "append", "EventTime")
    return found.select(
        "alertname", "severity", lb.from_series_key(F.from_json("series", ENTRIES)).alias("labels"), F.timestamp_seconds("at").alias("at"), "status", "value"
    )


def start(
    firing: DataFrame, output: str, checkpoint: str, step: str | int = 30, resolve_after: str | int = 300,
    lateness: str | int = 0, trigger: str | None = "30 seconds",
) -> StreamingQuery:
    """Write each batch's changes below ``output``; a batch that runs again replaces its own."""
    found = changes(firing, step, resolve_after, lateness)
    writer = found.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return triggered(writer.foreachBatch(lambda batch, batch_id: write_batch(batch, output, batch_id)), trigger).start()
