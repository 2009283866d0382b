"""Names and labels of metrics: target relabelling and management-bean lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketstream.functions import codec
from marketstream.functions import labels as lb

# Fixed value: broker name inside a scrape address.
BROKER_ADDRESS = r"^(kafka-\d+):.*$"

# Scrape targets by job, with the cluster label where one is set.
TARGETS = [
    ("prometheus", "prometheus:9090", None),
    ("kafka", "kafka-1:9101", "cluster-1"),
    ("kafka", "kafka-2:9102", "cluster-1"),
    ("kafka", "kafka-3:9103", "cluster-1"),
    ("kafka-analytics", "kafka-analytics:9104", "cluster-2"),
    ("alertmanager", "alertmanager:9093", None),
]

# Bean patterns in order, the metric's name and its labels; $n is a captured group.
BEAN_RULES = [
    (r"kafka.server<type=BrokerTopicMetrics, name=(\w+)><>(\w+)",
     "kafka_server_brokertopicmetrics_$1_$2", {"topic": ""}),
    (r"kafka.server<type=BrokerTopicMetrics, name=(BytesInPerSec|BytesOutPerSec), topic=(.+)><>(\w+)",
     "kafka_server_brokertopicmetrics_$1_$3", {"topic": "$2"}),
    (r"kafka.network<type=RequestMetrics, name=(\w+), request=FetchConsumer><>(\w+)",
     "kafka_network_requestmetrics_fetchconsumer_$1_$2", {}),
    (r"kafka.network<type=RequestMetrics, name=(\w+), request=Produce><>(\w+)",
     "kafka_network_requestmetrics_produce_$1_$2", {}),
    (r"kafka.consumer<type=consumer-fetch-manager-metrics, client-id=(.+), topic=(.+), partition=(\d+)><>records-lag",
     "kafka_consumer_group_lag", {"client": "$1", "topic": "$2", "partition": "$3"}),
    (r"kafka.server<type=ReplicaManager, name=UnderReplicatedPartitions><>Value",
     "kafka_server_replicamanager_underreplicatedpartitions", {}),
    (r"kafka.server<type=ReplicaManager, name=LeaderCount><>Value",
     "kafka_server_replicamanager_leadercount", {}),
    (r"kafka.server<type=ReplicaManager, name=PartitionCount><>Value",
     "kafka_server_replicamanager_partitioncount", {}),
    (r"kafka.controller<type=KafkaController, name=ActiveControllerCount><>Value",
     "kafka_controller_kafkacontroller_activecontrollercount", {}),
    (r"kafka.log<type=Log, name=Size, topic=(.+), partition=(\d+)><>Value",
     "kafka_log_log_size", {"topic": "$1", "partition": "$2"}),
    (r"kafka.server<type=socket-server-metrics, listener=(.+), networkProcessor=(\d+)><>connection-count",
     "kafka_server_socket_server_connection_count", {"listener": "$1", "processor": "$2"}),
    (r"kafka.(\w+)<type=(.+), name=(.+)><>Value",
     "kafka_$1_$2_$3", {}),
]


def add_broker(samples: DataFrame, address: str = "instance") -> DataFrame:
    """The ``broker`` label from an address label; an address of another form leaves the labels alone."""
    where = lb.label(F.col("labels"), address)
    broker = F.regexp_extract(where, BROKER_ADDRESS, 1)
    return samples.withColumn(
        "labels", F.when(broker != "", lb.add_label(F.col("labels"), "broker", broker)).otherwise(F.col("labels"))
    )


def add_target_labels(samples: DataFrame, job: str, cluster: str | None = None) -> DataFrame:
    """What a scrape job adds to each of its samples."""
    labels = lb.add_label(F.col("labels"), "job", F.lit(job))
    if cluster:
        labels = lb.add_label(labels, "cluster", F.lit(cluster))
    return samples.withColumn("labels", labels)


def _filled(line: Column, pattern: str, template: str) -> Column:
    """A template with the pattern's groups put in."""
    parts = []
    for i, piece in enumerate(template.split("$")):
        if i == 0:
            parts.append(F.lit(piece))
        else:
            parts += [F.regexp_extract(line, pattern, int(piece[0])), F.lit(piece[1:])]
    return F.concat(*parts)


def bean_metrics(lines: DataFrame, line: str = "line") -> DataFrame:
    """Add ``metric`` and ``labels`` by the first rule whose pattern occurs in the line; null where none does.

    The last rule takes what is left and lower-cases the name. Empty labels are left out.
    """
    text, number = F.col(line), F.lit(None).cast("int")
    for i, (pattern, _, _) in reversed(list(enumerate(BEAN_RULES))):
        number = F.when(text.rlike(pattern), i).otherwise(number)
    # The rule is found once; metric and labels then take their groups from that rule's pattern alone.
    ruled = codec.computed_once(lines, "_rule", number)
    metric, labels = F.lit(None).cast("string"), F.lit(None).cast("map<string,string>")
    for i, (pattern, name, label_templates) in enumerate(BEAN_RULES):
        built = _filled(text, pattern, name)
        if i == len(BEAN_RULES) - 1:
            built = F.lower(built)
        label_values = lb.label_map({k: _filled(text, pattern, t) for k, t in label_templates.items()})
        metric = F.when(F.col("_rule") == i, built).otherwise(metric)
        labels = F.when(F.col("_rule") == i, label_values).otherwise(labels)
    return ruled.withColumn("metric", metric).withColumn("labels", labels).drop("_rule")
