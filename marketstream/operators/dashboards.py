"""The numbers behind the overview dashboard and the target report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstream.functions import labels as lb
from marketstream.functions import times
from marketstream.operators import series

# Colour bands as (lower bound, colour), lowest first.
STATUS_BANDS = [(None, "red"), (1.0, "green")]
UNDER_REPLICATED_BANDS = [(None, "green"), (1.0, "red")]
LAG_BANDS = [(None, "green"), (100.0, "yellow"), (1000.0, "red")]

LAG = "kafka_consumer_group_lag"
UNDER_REPLICATED = "kafka_server_replicamanager_underreplicatedpartitions"
MESSAGES_IN = "kafka_server_brokertopicmetrics_MessagesInPerSec_OneMinuteRate"
BYTES_IN = "kafka_server_brokertopicmetrics_BytesInPerSec_OneMinuteRate"


def colour(value: Column, bands: Sequence[tuple[float | None, str]]) -> Column:
    """The colour of the highest band the value reaches."""
    result = F.lit(bands[0][1])
    for bound, name in bands[1:]:
        result = F.when(value >= bound, F.lit(name)).otherwise(result)
    return result


def since(samples: DataFrame, start: int | None) -> DataFrame:
    """Samples from ``start`` (epoch seconds) on; a dashboard shows the last hour."""
    if start is None:
        return samples
    return samples.filter(F.col("ts") >= F.timestamp_seconds(F.lit(start)))


def broker_status(samples: DataFrame, job: str = "kafka") -> DataFrame:
    """Up or down for every broker of a job, from its newest value."""
    value = F.col("value")
    text = F.when(value == 0, F.lit("DOWN")).when(value == 1, F.lit("UP")).otherwise(value.cast("string"))
    up = series.matching(samples, "up", {"job": job}).withColumn("broker", lb.label(F.col("labels"), "broker"))
    return series.newest(up, ["broker"]).select(
        "broker", value, text.alias("status"), colour(value, STATUS_BANDS).alias("colour"))


def under_replicated(samples: DataFrame, step: str | int, max_age: str | int, end: int | None = None) -> DataFrame:
    at = series.at_ticks(series.matching(samples, UNDER_REPLICATED, {"job": "kafka"}), step, max_age, end)
    total = series.sum_by(at)
    return total.select("ts", "value", colour(F.col("value"), UNDER_REPLICATED_BANDS).alias("colour"))


def lag(samples: DataFrame, step: str | int, max_age: str | int, end: int | None = None) -> DataFrame:
    at = series.at_ticks(series.matching(samples, LAG, {"job": "kafka"}), step, max_age, end)
    total = series.sum_by(at, ["group", "topic"])
    return total.select(
        "ts",
        lb.label(F.col("labels"), "group").alias("group"),
        lb.label(F.col("labels"), "topic").alias("topic"),
        "value",
        colour(F.col("value"), LAG_BANDS).alias("colour"),
    )


def throughput(
    samples: DataFrame, metric: str, by: str, span: str | int, step: str | int, end: int | None = None
) -> DataFrame:
    """``sum by (label) (rate(metric[span]))`` at the ticks."""
    rates = series.rate_at_ticks(series.matching(samples, metric, {"job": "kafka"}), span, step, end=end)
    total = series.sum_by(rates, [by])
    return total.select("ts", lb.label(F.col("labels"), by).alias(by), "value")


def target_health(samples: DataFrame) -> DataFrame:
    """The newest ``up`` of every (job, instance) as up or down."""
    labels = F.col("labels")
    up = samples.filter(F.col("metric") == "up").select(
        "ts", "value", lb.label(labels, "job").alias("job"), lb.label(labels, "instance").alias("instance"))
    health = F.when(F.col("value") == 1, F.lit("up")).otherwise(F.lit("down"))
    return series.newest(up, ["job", "instance"]).select("job", "instance", health.alias("health"))
