"""Metric and alert queries over samples made from the ``events`` table.

The table has one event in minutes to hours per series, so these queries look every 6 hours at samples up to 12
hours old where a live system looks every 30 seconds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketstream.functions import labels as lb
from marketstream.functions import text, times
from marketstream.operators import dashboards, relabel, routing, rules, series
from marketstream.session import materialise, scratch_dir
from marketstream.sources import tables
from marketstream.streaming import alert_clock, transitions

STEP, MAX_AGE = "6 hours", "12 hours"
SPAN = "1 day"

LAG_METRIC = dashboards.LAG


def shown(df: DataFrame) -> DataFrame:
    """Label maps and times as text, so that results compare by value."""
    for name, kind in df.dtypes:
        if kind.startswith("map"):
            df = df.withColumn(name, lb.label_text(F.col(name)))
        elif kind == "timestamp":
            df = df.withColumn(name, times.format_rfc3339(F.col(name)))
    return df


def rounded(df: DataFrame, places: int = 2) -> DataFrame:
    """Sums of doubles depend on the order of the rows in their last digits; results are compared without these."""
    return df.withColumn("value", F.round("value", places))


def bean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Management-bean lines, one form per event in turn."""
    topic, n = F.col("event_type"), F.col("user_id").cast("string")
    forms = [
        F.concat(F.lit("kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec><>"), F.initcap(topic)),
        F.concat(F.lit("kafka.server<type=BrokerTopicMetrics, name=BytesInPerSec, topic="), topic, F.lit("><>OneMinuteRate")),
        F.lit("kafka.network<type=RequestMetrics, name=TotalTimeMs, request=FetchConsumer><>Mean"),
        F.lit("kafka.network<type=RequestMetrics, name=TotalTimeMs, request=Produce><>Max"),
        F.concat(F.lit("kafka.consumer<type=consumer-fetch-manager-metrics, client-id=c"), n, F.lit(", topic="), topic,
                 F.lit(", partition="), n, F.lit("><>records-lag")),
        F.lit("kafka.server<type=ReplicaManager, name=UnderReplicatedPartitions><>Value"),
        F.lit("kafka.server<type=ReplicaManager, name=LeaderCount><>Value"),
        F.lit("kafka.server<type=ReplicaManager, name=PartitionCount><>Value"),
        F.lit("kafka.controller<type=KafkaController, name=ActiveControllerCount><>Value"),
        F.concat(F.lit("kafka.log<type=Log, name=Size, topic="), topic, F.lit(", partition="), n, F.lit("><>Value")),
        F.concat(F.lit("kafka.server<type=socket-server-metrics, listener=SSL, networkProcessor="), n,
                 F.lit("><>connection-count")),
        F.concat(F.lit("kafka.Cluster<type=Partition, name=InSyncReplicas, topic="), topic, F.lit("><>Value")),
        F.concat(F.lit("java.lang<type=Memory><>HeapMemoryUsage "), n),
    ]
    line = F.element_at(F.array(*forms), (F.col("event_id") % len(forms) + 1).cast("int"))
    return tables.events(spark, sf_dir).select("event_id", line.alias("line"))


def bean_to_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(relabel.bean_metrics(bean_lines(spark, sf_dir)).select("event_id", "metric", "labels"))


def metric_relabel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples as scraped: an address label only; the broker and the job's labels are added."""
    address = F.when(F.col("user_id") % 4 == 3, F.lit("kafka-analytics:9104")).otherwise(
        F.format_string("kafka-%d:910%d", F.col("user_id") % 3 + 1, F.col("user_id") % 3 + 1))
    scraped = tables.events(spark, sf_dir).select("event_id", lb.label_map({"instance": address}).alias("labels"))
    return shown(relabel.add_target_labels(relabel.add_broker(scraped), "kafka", "cluster-1"))


def metric_instant(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(series.at_ticks(tables.metric_samples(spark, sf_dir), STEP, MAX_AGE))


def metric_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An absent label equals the empty text: lag series have no broker."""
    wanted = {"job": "kafka", "group": "stream-processor", "topic": "products-raw", "broker": ""}
    found = series.matching(tables.metric_samples(spark, sf_dir, [LAG_METRIC]), LAG_METRIC, wanted)
    return shown(found.select("ts", "labels", "value"))


def lag_at_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    lag = series.matching(tables.metric_samples(spark, sf_dir, [LAG_METRIC]), LAG_METRIC, {"job": "kafka"})
    return series.at_ticks(lag, STEP, MAX_AGE)


def metric_sum_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(rounded(series.sum_by(lag_at_ticks(spark, sf_dir), ["group", "topic"])))


def metric_sum_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(rounded(series.sum_by(lag_at_ticks(spark, sf_dir))).select("ts", "value"))


def metric_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(series.last_values(tables.metric_samples(spark, sf_dir)))


def byte_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.matching(tables.metric_samples(spark, sf_dir, [dashboards.BYTES_IN]), dashboards.BYTES_IN)


def metric_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = series.rate(byte_samples(spark, sf_dir), SPAN)
    return shown(found.select("labels", "ts", "value", F.round("rate", 6).alias("rate")))


def metric_rate_at_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = series.rate_at_ticks(byte_samples(spark, sf_dir), SPAN, STEP)
    return shown(found.select("labels", "ts", F.round("value", 6).alias("value")))


def dash_broker_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.broker_status(tables.metric_samples(spark, sf_dir, ["up"]))


def dash_under_replicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(rounded(dashboards.under_replicated(tables.metric_samples(spark, sf_dir, [dashboards.UNDER_REPLICATED]), STEP, MAX_AGE)))


def dash_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(rounded(dashboards.lag(tables.metric_samples(spark, sf_dir, [LAG_METRIC]), STEP, MAX_AGE)))


def dash_last_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard's time filter, at the table's pace: the week up to the newest sample instead of an hour."""
    samples = tables.metric_samples(spark, sf_dir, [LAG_METRIC])
    newest = tables.events(spark, sf_dir).agg(F.unix_seconds(F.max("ts"))).first()[0]
    recent = dashboards.since(samples, None if newest is None else newest - times.seconds("7 days"))
    return shown(rounded(dashboards.lag(recent, STEP, MAX_AGE)))


def throughput(metric: str, by: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = dashboards.throughput(tables.metric_samples(spark, sf_dir, [metric]), metric, by, SPAN, STEP)
        return shown(found.withColumn("value", F.round("value", 4)))

    return query


def target_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboards.target_health(tables.metric_samples(spark, sf_dir, ["up"]))


# Shipped thresholds where the table's values reach them. The holds are all different, and long enough to matter at steps of
# six hours.
HOLDS = {
    "KafkaBrokerDown": "6 hours", "KafkaConsumerGroupLag": "12 hours", "KafkaUnderReplicatedPartitions": "18 hours",
    "KafkaNoActiveController": "1 day", "KafkaDiskUsageHigh": "30 hours", "StreamProcessorDown": "36 hours",
}
RULES = [replace(r, hold=HOLDS[r.alertname]) for r in rules.RULES]
# The inhibition and grouping that full labels would give: disk use by cluster and broker.
FULL_LABEL_RULES = [
    RULES[0],
    replace(RULES[4], by=("broker", "cluster"), threshold=1e9),
]


def active(spark: SparkSession, sf_dir: str, chosen=None) -> DataFrame:
    chosen = chosen or RULES
    samples = tables.metric_samples(spark, sf_dir, {r.metric for r in chosen})
    return rounded(rules.evaluate(samples, chosen, STEP, MAX_AGE))


def states(spark: SparkSession, sf_dir: str, chosen=None) -> DataFrame:
    return rules.states(active(spark, sf_dir, chosen), chosen or RULES, STEP)


def firing(spark: SparkSession, sf_dir: str, chosen=None) -> DataFrame:
    return states(spark, sf_dir, chosen).filter(F.col("state") == "firing")


def alert_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(active(spark, sf_dir))


def alert_rule(rule: rules.Rule):
    """One rule from samples to state."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = states(spark, sf_dir, [rule])
        return shown(found.select("labels", "ts", "value", "active_at", "state"))

    return query


def alert_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(states(spark, sf_dir))


def alert_hold_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hold of one day with false ticks kept: is the lag of a (group, topic) above 300?"""
    ticks = rounded(series.sum_by(lag_at_ticks(spark, sf_dir), ["group", "topic"]))
    keyed = ticks.withColumn("series", lb.series_key(F.col("labels")))
    held = rules.hold(keyed, ["series"], F.lit(86400), STEP, F.col("value") > 300)
    return shown(held.drop("series"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.transitions(firing(spark, sf_dir), STEP, routing.RESOLVE_TIMEOUT)


def alert_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(changes(spark, sf_dir).drop("value"))


def alert_annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(rules.annotate(firing(spark, sf_dir)).select("alertname", "labels", "ts", "value", "summary", "description"))


def alert_routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(routing.route(firing(spark, sf_dir)).drop("active_at", "state", "value"))


def alert_inhibited(chosen=None):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = routing.inhibit(materialise(firing(spark, sf_dir, chosen), "firing"))
        return shown(found.select("alertname", "labels", "ts", "severity", "inhibited"))

    return query


def audible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Firing alerts that nothing inhibits."""
    found = routing.inhibit(materialise(firing(spark, sf_dir), "firing"))
    return found.filter(~F.col("inhibited")).drop("inhibited")


ALERT_LABELS = ["broker", "cluster", "group", "instance", "job", "topic"]


def alert_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(routing.groups(rules.annotate(audible(spark, sf_dir)), ALERT_LABELS))


def alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who fires and who resolves at each time."""
    heard = materialise(audible(spark, sf_dir), "audible")
    resolved = rules.transitions(heard, STEP, routing.RESOLVE_TIMEOUT)
    return shown(routing.messages(rules.annotate(routing.notified(heard, resolved))))


def humanised_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table's values moved over the SI ranges from thousandths to billions, a thousand at a time."""
    scales = F.array(*[F.lit(x) for x in (0.001, 1.0, 1000.0, 1e6, 1e9)])
    value = F.round("value", 0) * F.element_at(scales, (F.col("event_id") % 5 + 1).cast("int"))
    return tables.events(spark, sf_dir).select("event_id", text.humanise(value).alias("human"))


def clock_slices(spark: SparkSession, sf_dir: str, work: str, slices: int) -> Iterator[None]:
    """The table's samples as they arrive: after each slice of time the alert clock has run below ``work``."""
    samples = tables.metric_samples(spark, sf_dir, {r.metric for r in RULES})
    first, last = tables.events(spark, sf_dir).agg(F.unix_seconds(F.min("ts")), F.unix_seconds(F.max("ts"))).first()
    at = F.unix_seconds("ts")
    for i in range(slices):
        edges = [(first or 0) + ((last or 0) + 1 - (first or 0)) * k // slices for k in (i, i + 1)]
        samples.filter((at >= edges[0]) & (at < edges[1])).write.mode("append").parquet(f"{work}/samples")
        stream = spark.readStream.schema(samples.schema).parquet(f"{work}/samples")
        alert_clock.start(stream, work, f"{work}/checkpoint", RULES, STEP, MAX_AGE, trigger=None).awaitTermination()
        yield


def alert_clock_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The states of the table's samples, a slice of time in each start of the stream."""
    work = scratch_dir(spark, "clock")
    for _ in clock_slices(spark, sf_dir, work, 5):
        pass
    return shown(rounded(spark.read.schema(alert_clock.STATE).parquet(f"{work}/states")).drop("batch_id"))


def alert_stream_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who fires and who resolves, from the clock's ticks and timers, up to the last tick of the table."""
    work = scratch_dir(spark, "changes")
    for _ in clock_slices(spark, sf_dir, work, 3):
        transitions.start(
            alert_clock.ticks(spark, work), f"{work}/changes", f"{work}/timers", STEP, routing.RESOLVE_TIMEOUT, trigger=None
        ).awaitTermination()
    return shown(spark.read.schema(transitions.CHANGES).parquet(f"{work}/changes").drop("batch_id", "value"))


QUERIES = {
    "bean_to_metric": bean_to_metric,
    "metric_relabel": metric_relabel,
    "metric_instant": metric_instant,
    "metric_matching": metric_matching,
    "metric_sum_by": metric_sum_by,
    "metric_sum_all": metric_sum_all,
    "metric_last": metric_last,
    "metric_rate": metric_rate,
    "metric_rate_at_ticks": metric_rate_at_ticks,
    "dash_broker_status": dash_broker_status,
    "dash_under_replicated": dash_under_replicated,
    "dash_lag": dash_lag,
    "dash_last_days": dash_last_days,
    "dash_messages_by_topic": throughput(dashboards.MESSAGES_IN, "topic"),
    "dash_bytes_by_broker": throughput(dashboards.BYTES_IN, "broker"),
    "target_health": target_health,
    "alert_threshold": alert_threshold,
    "alert_broker_down": alert_rule(RULES[0]),
    "alert_consumer_lag": alert_rule(RULES[1]),
    "alert_under_replicated": alert_rule(RULES[2]),
    "alert_no_controller": alert_rule(RULES[3]),
    "alert_disk_usage": alert_rule(RULES[4]),
    "alert_processor_down": alert_rule(RULES[5]),
    "alert_states": alert_states,
    "alert_hold_ticks": alert_hold_ticks,
    "alert_transitions": alert_transitions,
    "alert_annotated": alert_annotated,
    "alert_routed": alert_routed,
    "alert_inhibited": alert_inhibited(),
    "alert_inhibited_full_labels": alert_inhibited(FULL_LABEL_RULES),
    "alert_groups": alert_groups,
    "alert_messages": alert_messages,
    "humanised_values": humanised_values,
    "alert_clock_states": alert_clock_states,
    "alert_stream_transitions": alert_stream_transitions,
}
