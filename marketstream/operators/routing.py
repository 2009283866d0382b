"""What happens to alerts after they fire: routes, inhibition, groups, messages."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstream.functions import labels as lb
from marketstream.functions import times

# Fixed value: the labels alerts are grouped by.
GROUP_BY = ("alertname", "cluster", "broker")
# Fixed value: the labels a source alert and the alert it silences must share.
INHIBIT_EQUAL = ("cluster", "broker")
# Fixed value: an alert not seen for this long counts as resolved.
RESOLVE_TIMEOUT = "5m"


@dataclass(frozen=True)
class Route:
    receiver: str
    group_wait: str
    group_interval: str
    repeat_interval: str
    severity: str | None = None


# The first child whose severity matches wins, otherwise the root; unset values are the root's.
ROOT_ROUTE = Route("telegram-notifications", group_wait="30s", group_interval="5m", repeat_interval="1h")
CHILD_ROUTES = [
    Route("telegram-notifications", group_wait="5s", group_interval="5m", repeat_interval="15m", severity="critical"),
    Route("telegram-notifications", group_wait="30s", group_interval="5m", repeat_interval="2h", severity="warning"),
]


def route(alerts: DataFrame, root: Route = ROOT_ROUTE, children: Sequence[Route] = tuple(CHILD_ROUTES)) -> DataFrame:
    """Add ``receiver`` and the pacing seconds ``group_wait, group_interval, repeat_interval``."""
    def pick(value) -> Column:
        result = F.lit(value(root))
        for child in reversed(children):
            result = F.when(F.col("severity") == child.severity, F.lit(value(child))).otherwise(result)
        return result

    return alerts.withColumns({
        "receiver": pick(lambda r: r.receiver),
        "group_wait": pick(lambda r: times.seconds(r.group_wait)),
        "group_interval": pick(lambda r: times.seconds(r.group_interval)),
        "repeat_interval": pick(lambda r: times.seconds(r.repeat_interval)),
    })


def inhibit(alerts: DataFrame, equal: Sequence[str] = INHIBIT_EQUAL) -> DataFrame:
    """Add ``inhibited``: a warning, while a critical broker-down alert with equal labels fires.

    Two absent labels are equal. ``alerts`` holds firing alerts, one row each per ``ts``.
    """
    names = [f"_{name}" for name in equal]
    labelled = alerts.withColumns({f"_{n}": lb.label(F.col("labels"), n) for n in equal})
    is_source = (F.col("alertname") == "KafkaBrokerDown") & (F.col("severity") == "critical")
    sources = labelled.filter(is_source).select("ts", *names).distinct().withColumn("_source", F.lit(True))
    found = labelled.join(sources, ["ts", *names], "left")
    silenced = (F.col("severity") == "warning") & F.coalesce("_source", F.lit(False))
    return found.withColumn("inhibited", silenced).select(*alerts.columns, "inhibited")


def with_group(alerts: DataFrame, by: Sequence[str] = GROUP_BY) -> DataFrame:
    """Add the grouping labels as columns ``group_<label>``; an absent one is empty."""
    def value(name: str) -> Column:
        return F.col("alertname") if name == "alertname" else lb.label(F.col("labels"), name)

    return alerts.withColumns({f"group_{name}": value(name) for name in by})


def group_columns(by: Sequence[str] = GROUP_BY) -> list[str]:
    return [f"group_{name}" for name in by]


def groups(alerts: DataFrame, names: Sequence[str], by: Sequence[str] = GROUP_BY) -> DataFrame:
    """One row per group and time: the number of alerts and the labels all of them share.

    ``names`` are the labels that alerts can have, which the rules tell. Each is compared by count, minimum and maximum, so
    one aggregate does for a group of any size. ``common_summary`` is filled when all alerts have the same summary.
    """
    keys = ["ts", *group_columns(by)]
    value = {n: F.nullif(lb.label(F.col("labels"), n), F.lit("")) for n in names}
    same = {n: F.when((F.count(v) == F.count(F.lit(1))) & (F.min(v) == F.max(v)), F.min(v)) for n, v in value.items()}
    sums = with_group(alerts, by).groupBy(*keys).agg(
        F.count("*").alias("n_alerts"),
        F.when(F.min("summary") == F.max("summary"), F.min("summary")).otherwise(F.lit("")).alias("common_summary"),
        *[column.alias(f"_{n}") for n, column in same.items()],
    )
    shared = lb.label_map({n: F.col(f"_{n}") for n in names})
    return sums.withColumn("common_labels", shared).drop(*[f"_{n}" for n in names])


# The marks of a notification.
FIRING_MARK, RESOLVED_MARK = "🔴", "🟢"
HEAD, LINE, FOOT = 0, 1, 2


def message_lines(alerts: DataFrame) -> DataFrame:
    """Add ``line``, the part of a notification that describes one alert; ``status`` is firing or resolved."""
    broker = lb.label(F.col("labels"), "broker")
    return alerts.withColumn("line", F.concat(
        F.lit("<b>Статус:</b> "), F.upper("status"),
        F.lit("\n<b>Кластер:</b> "), lb.label(F.col("labels"), "cluster"),
        F.when(broker != "", F.concat(F.lit("\n<b>Брокер:</b> "), broker)).otherwise(F.lit("\n")),
        F.lit("\n<b>Описание:</b> "), F.col("description"),
    ))


def messages(alerts: DataFrame, by: Sequence[str] = GROUP_BY) -> DataFrame:
    """The notification of each group and time, one row per part: ``ts, group_*, place, alert, text``.

    The head (place 0) says whether anything still fires, each alert has a line of its own (place 1, in the order of
    ``alert``, its labels), and the foot (place 2) has the summary that all alerts share. No part grows with the group, so
    a group of any size has the same form. ``alerts`` have a ``status``, firing or resolved.
    """
    keys = ["ts", *group_columns(by)]
    grouped = with_group(alerts, by)
    lines = message_lines(grouped).select(
        *keys, F.lit(LINE).alias("place"), lb.label_text(F.col("labels")).alias("alert"), F.col("line").alias("text"))
    # Minimum and maximum of the status and the summary are all that head and foot need.
    whole = grouped.groupBy(*keys).agg(
        F.min("status").alias("_status"),
        F.when(F.min("summary") == F.max("summary"), F.min("summary")).otherwise(F.lit("")).alias("_summary"),
    )
    mark = F.when(F.col("_status") == "firing", F.lit(FIRING_MARK)).otherwise(F.lit(RESOLVED_MARK))
    ends = F.array(
        F.struct(F.lit(HEAD).alias("place"), F.concat(mark, F.lit(" <b>"), F.col("group_alertname"), F.lit("</b>")).alias("text")),
        F.struct(F.lit(FOOT).alias("place"), F.concat(F.lit("<i>Время: "), F.col("_summary"), F.lit("</i>")).alias("text")),
    )
    edges = whole.select(*keys, F.explode(ends).alias("e")).select(*keys, "e.place", F.lit("").alias("alert"), "e.text")
    return edges.unionByName(lines)


def notified(firing: DataFrame, changes: DataFrame) -> DataFrame:
    """Firing alerts at each time, and with them the alerts that resolve then: ``alertname, severity, labels, ts, value, status``."""
    resolved = changes.filter(F.col("status") == "resolved").withColumnRenamed("at", "ts")
    columns = ["alertname", "severity", "labels", "ts", "value", "status"]
    return firing.withColumn("status", F.lit("firing")).select(*columns).unionByName(resolved.select(*columns))
