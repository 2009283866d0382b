"""Message counts, log ends and consumer lag."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def partition_counts(messages: DataFrame) -> DataFrame:
    return messages.groupBy("topic", "partition").agg(
        F.count("*").alias("n"), (F.max("offset") + 1).alias("log_end_offset")
    )


def consumer_lag(committed: DataFrame, log_ends: DataFrame) -> DataFrame:
    """``committed`` has ``group, topic, partition, current_offset``; an unknown offset leaves the lag null.

    Both sides have one row per partition at most per group, so the join's type is left to Spark's measurement.
    """
    ends = log_ends.select("topic", "partition", "log_end_offset")
    return committed.join(ends, ["topic", "partition"], "left").withColumn(
        "lag", F.col("log_end_offset") - F.col("current_offset")
    )


def total_lag(lags: DataFrame) -> DataFrame:
    return lags.groupBy("group", "topic").agg(F.sum("lag").alias("lag"))
