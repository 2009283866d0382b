"""Alert rules as data, evaluated together in one plan."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marketstream.functions import labels as lb
from marketstream.functions import text, times
from marketstream.operators import series

_COMPARE = {"==": operator.eq, "!=": operator.ne, ">": operator.gt}


@dataclass(frozen=True)
class Rule:
    """``metric{matchers}`` compared with a threshold; with ``by`` (even empty) the series are summed first."""

    alertname: str
    metric: str
    op: str
    threshold: float
    hold: str
    severity: str
    summary: str
    description: str
    matchers: dict[str, str] = field(default_factory=dict, hash=False)
    by: tuple[str, ...] | None = None

    def __post_init__(self):
        if self.op not in _COMPARE:
            raise ValueError(f"unsupported comparison {self.op!r}")

    def holds(self, value: Column) -> Column:
        return _COMPARE[self.op](value, F.lit(self.threshold))


# The shipped rules. Only the end of the last description differs, a plain hint in place of a command.
RULES = [
    Rule(
        alertname="KafkaBrokerDown", metric="up", matchers={"job": "kafka"},
        op="==", threshold=0.0, hold="1m", severity="critical",
        summary="Kafka брокер {{ $labels.broker }} недоступен",
        description="Брокер {{ $labels.broker }} (cluster={{ $labels.cluster }}) не отвечает более 1 минуты. "
                    "Проверьте: docker logs {{ $labels.broker }}",
    ),
    Rule(
        alertname="KafkaConsumerGroupLag", metric="kafka_consumer_group_lag", matchers={"job": "kafka"},
        by=("group", "topic"), op=">", threshold=1000.0, hold="5m", severity="warning",
        summary="Consumer group {{ $labels.group }} отстаёт в топике {{ $labels.topic }}",
        description="Отставание: {{ $value }} сообщений. Consumer группа {{ $labels.group }} не успевает "
                    "обрабатывать сообщения из {{ $labels.topic }}. Проверьте stream-processor.",
    ),
    Rule(
        alertname="KafkaUnderReplicatedPartitions", metric="kafka_server_replicamanager_underreplicatedpartitions",
        matchers={"job": "kafka"}, op=">", threshold=0.0, hold="2m", severity="critical",
        summary="Под-реплицированные партиции на {{ $labels.broker }}",
        description="{{ $value }} партиций не имеют полного набора реплик на брокере {{ $labels.broker }}. "
                    "Это снижает надёжность (при отказе брокера данные могут быть потеряны).",
    ),
    Rule(
        alertname="KafkaNoActiveController", metric="kafka_controller_kafkacontroller_activecontrollercount",
        matchers={"job": "kafka"}, by=(), op="!=", threshold=1.0, hold="30s", severity="critical",
        summary="Kafka: нет активного контроллера",
        description="Активных контроллеров: {{ $value }} (должен быть ровно 1). Кластер не может обрабатывать "
                    "metadata запросы. Проверьте KRaft quorum: docker logs kafka-1",
    ),
    Rule(
        alertname="KafkaDiskUsageHigh", metric="kafka_log_log_size", matchers={"job": "kafka"},
        by=("broker",), op=">", threshold=10737418240.0, hold="5m", severity="warning",
        summary="Kafka: высокое использование диска на {{ $labels.broker }}",
        description="Брокер {{ $labels.broker }} использует {{ $value | humanize }}B дискового пространства. "
                    "Рассмотрите уменьшение retention.ms или увеличение диска.",
    ),
    Rule(
        alertname="StreamProcessorDown", metric="kafka_consumer_group_lag",
        matchers={"job": "kafka", "group": "stream-processor", "topic": "products-raw"},
        by=("group",), op=">", threshold=100.0, hold="2m", severity="warning",
        summary="Stream Processor остановлен или отстаёт",
        description="Consumer group stream-processor отстаёт на {{ $value }} сообщений в топике products-raw. "
                    "Проверьте stream-processor.",
    ),
]


def _per_rule(rules: Sequence[Rule], value) -> Column:
    """A column that depends on the row's rule."""
    result = F.lit(None)
    for rule in rules:
        result = F.when(F.col("alertname") == rule.alertname, value(rule)).otherwise(result)
    return result


def evaluate(
    samples: DataFrame,
    rules: Sequence[Rule] = tuple(RULES),
    step: str | int = 30,
    max_age: str | int = 300,
    end: int | None = None,
) -> DataFrame:
    """Ticks at which a rule's comparison holds: ``alertname, labels, ts, value``.

    All rules share one scan, one lookup at the ticks and one sum. A sample is copied once per rule that selects
    it (at most once per rule), with the labels that rule keeps. An absent metric gives no row, so nothing holds.
    """
    def selected(rule: Rule) -> Column:
        return (F.col("metric") == rule.metric) & lb.matches(F.col("labels"), rule.matchers)

    selects = F.filter(F.array(*[F.when(selected(r), F.lit(r.alertname)) for r in rules]), lambda name: name.isNotNull())
    # The plain list of names can reach the scan; the matchers keep other series out of the shuffle.
    wanted = samples.filter(F.col("metric").isin(sorted({r.metric for r in rules})))
    wanted = wanted.filter(functools.reduce(operator.or_, map(selected, rules)))
    instant = series.at_ticks(wanted, step, max_age, end)
    # A rule with ``by`` keeps only those labels; one without keeps all, so its "sum" has a single term.
    kept = _per_rule(rules, lambda r: F.col("labels") if r.by is None else lb.keep_labels(F.col("labels"), r.by))
    sums = (
        instant.withColumn("alertname", F.explode(selects))
        .groupBy("alertname", "ts", lb.series_key(kept).alias("series"))
        .agg(F.sum("value").alias("value"))
    )
    return sums.filter(_per_rule(rules, lambda r: r.holds(F.col("value")))).select(
        "alertname", lb.from_series_key(F.col("series")).alias("labels"), "ts", "value"
    )


def hold(
    ticks: DataFrame, keys: Sequence[Column | str], hold_s: Column, step: str | int, holds: Column | None = None,
    since: Column | None = None,
) -> DataFrame:
    """Add ``active_at`` and ``state`` (inactive, pending, firing) to the ticks of a condition.

    The condition must hold at every tick for ``hold_s`` seconds before it fires; a false or missing tick starts
    over. ``holds`` is the condition, when false ticks are rows too. Each key has at most one row per tick. A row
    whose ``since`` is not null is known to hold since then, from ticks that are no rows any more.
    """
    step_s = times.seconds(step)
    ordered = W.partitionBy(*keys).orderBy("ts")
    at = series.as_seconds(F.col("ts"))
    df = ticks.withColumn("_true", F.coalesce(holds, F.lit(False)) if holds is not None else F.lit(True))
    starts = F.col("_true") & (
        ~F.coalesce(F.lag("_true").over(ordered), F.lit(False)) | (at - F.lag(at).over(ordered) > step_s)
    )
    begun = F.when(starts, F.col("ts"))
    df = df.withColumn("_start", begun if since is None else F.coalesce(since, begun))
    active = F.last("_start", ignorenulls=True).over(ordered.rowsBetween(W.unboundedPreceding, 0))
    df = df.withColumn("active_at", F.when(F.col("_true"), active))
    state = (
        F.when(~F.col("_true"), F.lit("inactive"))
        .when(at - series.as_seconds(F.col("active_at")) >= hold_s, F.lit("firing"))
        .otherwise(F.lit("pending"))
    )
    return df.withColumn("state", state).drop("_true", "_start")


def states(
    active: DataFrame, rules: Sequence[Rule] = tuple(RULES), step: str | int = 30, since: Column | None = None
) -> DataFrame:
    """Pending and firing alerts at each tick, with severity; ``since`` as for ``hold``."""
    hold_s = _per_rule(rules, lambda r: F.lit(times.seconds(r.hold)))
    keyed = active.withColumn("series", lb.series_key(F.col("labels")))
    return (
        hold(keyed, ["alertname", "series"], hold_s, step, since=since)
        .withColumn("severity", _per_rule(rules, lambda r: F.lit(r.severity)))
        .drop("series")
    )


def annotate(alerts: DataFrame, rules: Sequence[Rule] = tuple(RULES)) -> DataFrame:
    """Add ``summary`` and ``description`` from the rule's templates."""
    def rendered(template: str) -> Column:
        return text.render_template(
            template, lambda name: lb.label(F.col("labels"), name), F.col("_plain"), F.col("_human"))

    value = F.col("value")
    return (
        alerts.withColumns({"_plain": text.plain_number(value), "_human": text.humanise(value)})
        .withColumns({
            "summary": _per_rule(rules, lambda r: rendered(r.summary)),
            "description": _per_rule(rules, lambda r: rendered(r.description)),
        })
        .drop("_plain", "_human")
    )


def transitions(firing: DataFrame, step: str | int = 30, resolve_after: str | int = 300) -> DataFrame:
    """When alerts start firing and when they resolve: ``alertname, severity, labels, at, status, value``.

    ``firing`` has one row per alert and firing tick. An alert resolves once it has not fired for
    ``resolve_after`` (at least one step), and its next firing tick then starts it anew. ``value`` is that of the
    first or last firing tick.
    """
    quiet = max(times.seconds(resolve_after), times.seconds(step))
    ordered = W.partitionBy("alertname", "severity", "series").orderBy("at")
    ticks = firing.select(
        "alertname", "severity", lb.series_key(F.col("labels")).alias("series"), series.as_seconds(F.col("ts")).alias("at"), "value"
    )
    begins = F.coalesce(F.col("at") - F.lag("at").over(ordered) > quiet, F.lit(True))
    ends = F.coalesce(F.lead("at").over(ordered) - F.col("at") > quiet, F.lit(True))
    marks = F.filter(
        F.array(
            F.when(F.col("_begins"), F.struct(F.col("at").alias("at"), F.lit("firing").alias("status"))),
            F.when(F.col("_ends"), F.struct((F.col("at") + quiet).alias("at"), F.lit("resolved").alias("status"))),
        ),
        lambda m: m.isNotNull(),
    )
    return (
        ticks.withColumn("_begins", begins).withColumn("_ends", ends)
        .select("alertname", "severity", lb.from_series_key(F.col("series")).alias("labels"), "value", F.explode(marks).alias("m"))
        .select("alertname", "severity", "labels", F.timestamp_seconds("m.at").alias("at"), "m.status", "value")
    )
