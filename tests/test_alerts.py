import random

import pytest
from pyspark.sql import functions as F

from marketstream.functions import labels as lb
from marketstream.operators import dashboards, relabel, routing, rules, series
from marketstream.streaming import alert_clock

T0 = 1704067200
SAMPLE = "ts long, metric string, labels map<string,string>, value double"


def samples(spark, rows):
    return spark.createDataFrame(rows, SAMPLE).withColumn("ts", F.timestamp_seconds("ts"))


def at_seconds(df, *columns, ts="ts"):
    return sorted(df.select((F.unix_seconds(ts) - T0).alias("t"), *columns).collect(), key=lambda r: tuple(map(str, r)))


def test_hold_fires_on_the_third_true_tick_and_starts_over(spark):
    values = [0, 1, 1, 1, 0, 1, 1, 1, 1, 1]
    ticks = spark.createDataFrame([("s", T0 + 30 * i, float(v)) for i, v in enumerate(values)], "series string, t long, value double")
    held = rules.hold(ticks.withColumn("ts", F.timestamp_seconds("t")), ["series"], F.lit(60), 30, F.col("value") > 0)
    assert [r.state for r in held.orderBy("ts").collect()] == [
        "inactive", "pending", "pending", "firing", "inactive", "pending", "pending", "firing", "firing", "firing"]


def test_hold_starts_over_after_a_missing_tick(spark):
    ticks = spark.createDataFrame([("s", T0 + 30 * i) for i in (0, 1, 2, 4, 5, 6)], "series string, t long")
    held = rules.hold(ticks.withColumn("ts", F.timestamp_seconds("t")), ["series"], F.lit(60), 30).orderBy("ts").collect()
    assert [r.state for r in held] == ["pending", "pending", "firing", "pending", "pending", "firing"]


def test_one_more_false_tick_never_fires_earlier(spark):
    rng = random.Random(7)
    truth = [rng.random() < 0.8 for _ in range(60)]
    rows = [("all", i, v) for i, v in enumerate(truth)]
    for gap in range(60):
        rows += [(f"gap{gap}", i, v and i != gap) for i, v in enumerate(truth)]
    ticks = spark.createDataFrame(rows, "series string, i long, ok boolean").withColumn("ts", F.timestamp_seconds(F.col("i") * 30))
    held = rules.hold(ticks, ["series"], F.lit(90), 30, F.col("ok"))
    fired = {(r.series, r.i) for r in held.filter("state = 'firing'").collect()}
    assert all(("all", i) in fired for s, i in fired if s != "all")
    assert fired


def test_lookup_uses_the_latest_sample_within_its_age(spark):
    rows = [(T0 + 5, "m", {"a": "x"}, 1.0), (T0 + 29, "m", {"a": "x"}, 2.0), (T0 + 30, "m", {"a": "x"}, 3.0),
            (T0 + 95, "m", {"a": "x"}, 4.0), (T0 + 95, "m", {"a": "x"}, 3.5), (T0 + 60, "m", {"a": "y"}, 9.0)]
    found = series.at_ticks(samples(spark, rows), 30, 60, end=T0 + 180)
    x = [(r.t, r.value) for r in at_seconds(found.filter(F.col("labels")["a"] == "x"), "value")]
    assert sorted(x) == [(30, 3.0), (60, 3.0), (90, 3.0), (120, 4.0), (150, 4.0)]


def test_sum_of_nothing_has_no_row(spark):
    nothing = samples(spark, [(T0, "m", {"a": "x"}, 1.0)]).filter("metric = 'other'")
    assert series.sum_by(series.at_ticks(nothing)).count() == 0
    controller = [r for r in rules.RULES if r.alertname == "KafkaNoActiveController"]
    assert rules.evaluate(nothing, controller).count() == 0


@pytest.mark.parametrize("bucket", [7, 60, 90, 3600, None])
def test_rate(spark, bucket):
    rows = [(T0 + 30 * i, "m", {}, float(v)) for i, v in enumerate([10, 40, 70, 5])]
    found = series.rate(samples(spark, rows), 60, bucket).orderBy("ts").collect()
    assert [r.rate if r.rate is None else round(r.rate, 4) for r in found] == [None, 1.0, 1.0, 0.5833]


def test_rate_by_brute_force(spark):
    rng = random.Random(3)
    times = sorted(rng.sample(range(2000), 300))
    points, value = [], 0.0
    for t in times:
        value = rng.randint(0, 5) if rng.random() < 0.1 else value + rng.randint(0, 9)
        points.append((t, float(value)))

    def expected(end, span):
        inside = [(t, v) for t, v in points if end - span <= t <= end]
        if len(inside) < 2:
            return None
        climbed = sum(b[1] - a[1] if b[1] >= a[1] else b[1] for a, b in zip(inside, inside[1:]))
        return round(climbed / (inside[-1][0] - inside[0][0]), 9)

    df = samples(spark, [(T0 + t, "m", {"a": "1"}, v) for t, v in points])
    for bucket in (13, 100, 777, None):
        got = {r.t: r.rate and round(r.rate, 9) for r in at_seconds(series.rate(df, 60, bucket), "rate")}
        assert got == {t: expected(t, 60) for t, _ in points}
        ticks = {r.t: round(r.value, 9) for r in at_seconds(series.rate_at_ticks(df, 60, 30, bucket), "value")}
        assert ticks == {t: expected(t, 60) for t in range(0, 2070, 30) if expected(t, 60) is not None}


def test_rate_of_a_hot_series(spark):
    """A third of all samples belong to one series and one day; no ordered group of rows holds more than a bucket of it."""
    hot = spark.range(6000).select((F.col("id") * 14).alias("t"), F.lit("hot").alias("who"))
    cold = spark.range(12000).select((F.col("id") * 7).alias("t"), F.concat(F.lit("s"), F.col("id") % 200).alias("who"))
    rows = hot.union(cold).select(
        F.timestamp_seconds(F.lit(T0) + F.col("t")).alias("ts"), F.lit("m").alias("metric"),
        F.create_map(F.lit("a"), "who").alias("labels"), (F.col("t") % 1000).cast("double").alias("value"))
    placed = series._in_buckets(series._identified(rows), 300 * series.MICROS, 3600 * series.MICROS)
    sizes = [r["count"] for r in placed.groupBy("id", "bucket").count().collect()]
    assert sum(sizes) == 2 * 18000 and max(sizes) <= 2 * (300 / 14 + 1)
    assert series.bucket_width("1 hour", None) == 450 * series.MICROS and series.bucket_width("1 minute", None) == 300 * series.MICROS
    found = series.rate(rows, "1 hour")
    assert found.count() == 18000
    # Near 1 a second but for resets, which lose at most one step.
    assert found.filter("labels.a = 'hot' and (rate > 1.001 or rate < 0.9)").filter(F.unix_seconds("ts") > T0 + 3600).count() == 0


def test_rate_over_gaps_and_equal_times(spark):
    """Spans across empty buckets; of samples at one time the larger counts; samples without a value or a time do not."""
    rows = [(T0, 5.0), (T0, 9.0), (T0, 9.0), (T0 + 10, None), (T0 + 1000, 20.0), (T0 + 1000, 1.0), (None, 3.0), (T0 + 5000, 2.0), (T0 + 5001, 4.0)]
    df = spark.createDataFrame([(t, "m", {"a": "1"}, v) for t, v in rows], "s bigint, metric string, labels map<string,string>, value double")
    df = df.select(F.timestamp_seconds("s").alias("ts"), "metric", "labels", "value")
    for bucket in (3, 100, None):
        got = [(r.t, r.value, r.rate) for r in at_seconds(series.rate(df, 1000, bucket), "value", "rate")]
        assert got == [(0, 9.0, None), (1000, 20.0, 0.011), (5000, 2.0, None), (5001, 4.0, 2.0)]
        ticks = {r.t: r.value for r in at_seconds(series.rate_at_ticks(df, 1000, 200, bucket), "value")}
        assert ticks == {1000: 0.011} | {t: 2.0 for t in range(5200, 6001, 200)}
        assert series.rate_at_ticks(df, 1000, 200, bucket, end=T0 + 5400).count() == 3
    assert series.rate(df.limit(0)).collect() == [] and series.rate_at_ticks(df.limit(0)).collect() == []


def test_rates_shuffle_each_sample_once(spark):
    """Samples are not copied to ticks, and the plan has few shuffles."""
    df = samples(spark, [(T0 + 15 * i, "m", {"a": "1"}, float(i)) for i in range(100)])
    for found, most in ((series.rate(df, "1 day"), 6), (series.rate_at_ticks(df, "1 day", 30), 6)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= most
    sent = series.rate_at_ticks(df, "1 day", 30)
    assert sent.count() == (100 * 15 + 86400) // 30 - 1


def test_beans(spark):
    lines = [
        ("kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec><>OneMinuteRate",
         "kafka_server_brokertopicmetrics_MessagesInPerSec_OneMinuteRate", ""),
        ("kafka.server<type=BrokerTopicMetrics, name=BytesInPerSec, topic=a.b><>Count",
         "kafka_server_brokertopicmetrics_BytesInPerSec_Count", "topic=a.b"),
        ("kafka.consumer<type=consumer-fetch-manager-metrics, client-id=c-1, topic=t, partition=3><>records-lag",
         "kafka_consumer_group_lag", "client=c-1,partition=3,topic=t"),
        ("kafka.Cluster<type=Partition, name=UnderMinIsr><>Value", "kafka_cluster_partition_underminisr", ""),
        ("java.lang<type=Memory><>Used", None, None),
    ]
    found = relabel.bean_metrics(spark.createDataFrame([(l,) for l, _, _ in lines], "line string"))
    got = {r.line: (r.metric, r.text) for r in found.withColumn("text", lb.label_text(F.col("labels"))).collect()}
    assert got == {line: (metric, text) for line, metric, text in lines}


def test_target_health(spark):
    rows = [(T0 + 30 * i, "up", {"job": job, "instance": instance}, 0.0 if i == 2 and job == "kafka-analytics" else 1.0)
            for job, instance, _ in relabel.TARGETS for i in range(3)]
    found = {r.instance: r.health for r in dashboards.target_health(samples(spark, rows)).collect()}
    assert sorted(found.values()) == ["down"] + ["up"] * 5
    assert found["kafka-analytics:9104"] == "down"


def firing_rows(spark, rows):
    """(alertname, severity, labels) rows firing at one time, with texts."""
    df = spark.createDataFrame([(n, s, l, f"{n} summary") for n, s, l in rows],
                               "alertname string, severity string, labels map<string,string>, summary string")
    return df.withColumn("ts", F.timestamp_seconds(F.lit(T0))).withColumn("description", F.lit("d"))


def test_inhibition_needs_equal_labels(spark):
    down = ("KafkaBrokerDown", "critical", {"cluster": "c", "broker": "b1"})
    rows = [down, ("Lag", "warning", {"group": "g"}), ("Lag", "warning", {"cluster": "c", "broker": "b2"})]
    assert routing.inhibit(firing_rows(spark, rows)).filter("inhibited").count() == 0
    rows += [("Lag", "warning", {"cluster": "c", "broker": "b1"}), ("Lag", "critical", {"cluster": "c", "broker": "b1"})]
    silenced = routing.inhibit(firing_rows(spark, rows)).filter("inhibited").collect()
    assert [(r.alertname, r.severity) for r in silenced] == [("Lag", "warning")]
    bare = [("KafkaBrokerDown", "critical", {}), ("Lag", "warning", {"group": "g"})]
    assert routing.inhibit(firing_rows(spark, bare)).filter("inhibited").count() == 1


@pytest.mark.parametrize("n", [1, 50, 51, 400])
def test_groups_and_messages_have_one_form_at_any_size(spark, n):
    rows = [("Lag", "warning", {"group": f"g{i}", "topic": "t"}) for i in range(n)] + [("Disk", "warning", {"broker": "b"})]
    alerts = firing_rows(spark, rows).withColumn("status", F.lit("firing"))
    found = {r.group_alertname: r for r in routing.groups(alerts, ["group", "topic", "broker"]).collect()}
    shared = {"topic": "t"} if n > 1 else {"topic": "t", "group": "g0"}
    assert found["Lag"].n_alerts == n and found["Lag"].common_labels == shared
    assert found["Disk"].group_broker == "b" and found["Disk"].common_labels == {"broker": "b"}
    parts = routing.messages(alerts.withColumn("description", lb.label_text(F.col("labels")))).filter("group_alertname = 'Lag'")
    told = [(r.place, r.alert, r.text) for r in parts.orderBy("place", "alert").collect()]
    assert [t for t in told if t[0] != routing.LINE] == [(0, "", "🔴 <b>Lag</b>"), (2, "", "<i>Время: Lag summary</i>")]
    assert sorted(t[2].split("\n")[-1] for t in told[1:-1]) == sorted(f"<b>Описание:</b> group=g{i},topic=t" for i in range(n))


def test_resolved_alerts_are_told(spark):
    rows = [("A", "critical", {"x": "1"}), ("A", "critical", {"x": "2"})]
    firing = firing_rows(spark, rows).withColumn("value", F.lit(1.0))
    changes = rules.transitions(firing.filter(F.col("labels")["x"] == "1"), 30, 300)
    told = routing.notified(firing, changes).withColumns({"summary": F.lit("s"), "description": F.lit("d")})
    parts = at_seconds(routing.messages(told), "place", "text")
    assert [(r.t, r.text.split("\n")[0]) for r in parts if r.place < 2] == [
        (0, "🔴 <b>A</b>"), (0, "<b>Статус:</b> FIRING"), (0, "<b>Статус:</b> FIRING"),
        (300, "🟢 <b>A</b>"), (300, "<b>Статус:</b> RESOLVED")]


def test_routes(spark):
    rows = [("A", "critical", {}), ("B", "warning", {}), ("C", "info", {})]
    found = {r.alertname: (r.group_wait, r.group_interval, r.repeat_interval) for r in routing.route(firing_rows(spark, rows)).collect()}
    assert found == {"A": (5, 300, 900), "B": (30, 300, 7200), "C": (30, 300, 3600)}


def test_transitions(spark):
    ticks = [0, 30, 60, 500, 530]
    df = firing_rows(spark, [("A", "critical", {"x": str(t)}) for t in ticks]).withColumn("value", F.lit(1.0))
    df = df.withColumn("ts", F.timestamp_seconds(T0 + F.col("labels")["x"].cast("long"))).withColumn("labels", lb.label_map({"k": F.lit("v")}))
    assert [(r.t, r.status) for r in at_seconds(rules.transitions(df, 30, 300), "status", ts="at")] == sorted(
        [(0, "firing"), (360, "resolved"), (500, "firing"), (830, "resolved")], key=lambda r: tuple(map(str, r)))


def test_clock_agrees_with_the_table(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for t in range(0, 1800, 30):
        for b in (1, 2, 3):
            tags = {"job": "kafka", "cluster": "c", "broker": f"kafka-{b}"}
            if rng.random() < 0.9:
                rows.append((T0 + t + b, "up", tags, float(rng.random() < 0.6 or b == 1)))
            rows.append((T0 + t + b, "kafka_log_log_size", {**tags, "topic": "t"}, float(rng.choice([1e9, 2e10, 2e10, 2e10]))))
    chosen = [r for r in rules.RULES if r.alertname in ("KafkaBrokerDown", "KafkaDiskUsageHigh")]
    chunk = 6 * 20
    for i in range(0, len(rows), chunk):
        samples(spark, rows[i:i + chunk]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = samples(spark, rows[:1]).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    alert_clock.start(stream, str(tmp_path / "out"), str(tmp_path / "cp"), chosen, trigger=None).awaitTermination()
    columns = ["alertname", lb.label_text(F.col("labels")).alias("l"), "state", "value", F.unix_seconds("active_at"), "severity"]
    got = at_seconds(spark.read.parquet(str(tmp_path / "out/states")), *columns)
    last = max(t for t, *_ in rows) // 30 * 30
    table = rules.states(rules.evaluate(samples(spark, rows), chosen, end=last), chosen)
    expected = at_seconds(table, *columns)
    assert {r.state for r in expected} == {"pending", "firing"}
    assert got == expected


def test_clock_remembers_since_when_an_alert_holds(spark, tmp_path):
    tags = {"job": "kafka", "cluster": "c", "broker": "kafka-1"}
    rows = [(T0 + 30 * i, "up", tags, 0.0) for i in range(100)]
    chosen = [r for r in rules.RULES if r.alertname == "KafkaBrokerDown"]
    for i in range(0, 100, 20):
        samples(spark, rows[i:i + 20]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    schema = samples(spark, rows[:1]).schema
    for _ in range(2):  # the second start finds nothing new
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        alert_clock.start(stream, str(tmp_path / "out"), str(tmp_path / "cp"), chosen, trigger=None).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out/states"))
    assert got.count() == 100 and [r.t for r in got.select((F.unix_seconds("active_at") - T0).alias("t")).distinct().collect()] == [0]


def test_sums_keep_small_values(spark):
    rows = [(T0, "m", {"a": str(i)}, 0.001) for i in range(3)]
    assert series.sum_by(series.at_ticks(samples(spark, rows))).filter(F.unix_seconds("ts") == T0).first().value == pytest.approx(0.003)


def test_clock_keeps_one_sample_of_a_series_and_tick(spark, tmp_path):
    """However many samples a batch has, some late, at equal times or null; states are those of the table."""
    rng, rows = random.Random(9), []
    for i in range(2000):
        at = T0 + rng.randrange(300) + 300 * (i // 1000) - rng.choice([0, 0, 0, 40])
        rows.append((at, "up", {"job": "kafka", "broker": f"kafka-{i % 3}"}, rng.choice([0.0, 0.0, 1.0, None])))
    rows += [(None, "up", {"job": "kafka"}, 0.0), (T0 + 599, "up", None, 0.0)]
    chosen, out = [r for r in rules.RULES if r.alertname == "KafkaBrokerDown"], str(tmp_path / "out")
    schema = "s bigint, metric string, labels map<string,string>, value double"
    table = spark.createDataFrame(rows, schema).select(F.timestamp_seconds("s").alias("ts"), "metric", "labels", "value")
    table.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(table.schema).parquet(str(tmp_path / "in"))
    alert_clock.start(stream, out, str(tmp_path / "cp"), chosen, trigger=None).awaitTermination()
    assert 60 <= spark.read.parquet(f"{out}/arrived").count() <= 3 * 22 + 2
    columns = ["alertname", lb.label_text(F.col("labels")).alias("l"), "state", "value", F.unix_seconds("active_at"), "severity"]
    expected = at_seconds(rules.states(rules.evaluate(table, chosen, end=(T0 + 599) // 30 * 30), chosen), *columns)
    assert expected and at_seconds(spark.read.parquet(f"{out}/states"), *columns) == expected
