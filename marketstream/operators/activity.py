"""Counts of product activity in sliding event-time windows."""

from __future__ import annotations

import math
import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketstream.functions import times

# From this many windows per event on, counting whole panes first saves more than its extra shuffle costs.
PANES_FROM = 4


def sliding_counts(
    events: DataFrame,
    size: str | int = "5 minutes",
    slide: str | int | None = "2 minutes",
    by: Sequence[str] = ("user_id", "product_id"),
    panes: bool | None = None,
) -> DataFrame:
    """Events per window and ``by`` columns, as ``window, *by, n``. No slide means tumbling windows.

    An event falls in up to ``ceil(size / slide)`` windows. When that is many, a table is first counted in
    panes (the common divisor of size and slide, so no pane crosses a window edge) and only the pane counts
    are copied into their windows. A stream always counts directly: it needs a single aggregate.
    """
    size_s = times.seconds(size)
    slide_s = times.seconds(slide) if slide is not None else size_s
    if size_s / slide_s > 100:
        warnings.warn(f"every event falls in {math.ceil(size_s / slide_s)} windows", stacklevel=2)
    if panes is None:
        panes = not events.isStreaming and size_s / slide_s >= PANES_FROM
    window = F.window("event_time", f"{size_s} seconds", f"{slide_s} seconds").alias("window")
    if not panes:
        return events.groupBy(window, *by).agg(F.count("*").alias("n"))
    pane = F.window("event_time", f"{math.gcd(size_s, slide_s)} seconds")
    per_pane = events.groupBy(pane.alias("pane"), *by).agg(F.count("*").alias("pane_n"))
    return (
        per_pane.withColumn("event_time", F.col("pane.start"))
        .groupBy(window, *by)
        .agg(F.sum("pane_n").alias("n"))
    )
