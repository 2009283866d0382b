import collections
import json
import random

import pytest
from pyspark.sql import functions as F

from marketstream import schemas
from marketstream.functions import codec
from marketstream.operators import activity, events, ranking
from marketstream.sources import files, tables
from marketstream.streaming import mirror as mirror_stream
from marketstream.streaming import progress, recommend, screening as screening_stream
from marketstream.sinks import kafka as kafka_sink

T0 = 1704067200  # 2024-01-01T00:00:00Z, a multiple of two minutes


def event(second, user, product, event_id=None, kind="view"):
    return {
        "event_id": event_id or f"{kind}-{second}-{user}-{product}", "event_type": kind, "user_id": user,
        "product_id": product, "query": "",
        "timestamp": f"2024-01-01T{second // 3600:02d}:{second // 60 % 60:02d}:{second % 60:02d}Z",
    }


def write(path, batches):
    """One JSON lines file per batch, in order of modification."""
    import os
    import time

    path.mkdir(parents=True, exist_ok=True)
    for i, batch in enumerate(batches):
        name = path / f"{i:03d}.json"
        lines = [row if isinstance(row, str) else json.dumps(row, ensure_ascii=False) for row in batch]
        name.write_text("\n".join(lines) + "\n", encoding="utf-8")
        stamp = time.time() - 1000 + i * 10
        os.utime(name, (stamp, stamp))
    return str(path)


def stream_of(spark, path, lateness="10 minutes"):
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(path)
    messages = lines.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    return events.activity(messages, lateness)


def table_of(spark, path):
    return events.activity(files.text_messages(spark, path))


def as_dict(df):
    return {((r.s - T0) // 60, r.user_id): list(r.product_ids)
            for r in df.withColumn("s", F.unix_seconds("window_start")).collect()}


def timed(spark, rows):
    return events.with_event_time(spark.createDataFrame(rows, schemas.CLIENT_EVENT))


def test_event_is_in_two_or_three_windows(spark):
    rows = [event(s, "u", f"p{s}") for s in range(0, 240, 7)]
    counts = activity.sliding_counts(timed(spark, rows)).groupBy("product_id").count().collect()
    for r in counts:
        second = int(r.product_id[1:])
        assert r["count"] == (3 if second % 120 < 60 else 2)


@pytest.mark.parametrize("size, slide", [("5 minutes", "2 minutes"), ("10 minutes", "1 minute"), ("5 minutes", None)])
def test_panes_change_nothing(spark, size, slide):
    rng = random.Random(1)
    rows = [event(rng.randrange(3600), f"u{rng.randrange(3)}", f"p{rng.randrange(4)}", str(i)) for i in range(500)]
    df = timed(spark, rows)
    direct = activity.sliding_counts(df, size, slide, panes=False).collect()
    panes = activity.sliding_counts(df, size, slide, panes=True).collect()
    assert sorted(map(str, direct)) == sorted(map(str, panes))


def test_wide_windows_warn(spark):
    with pytest.warns(UserWarning, match="windows"):
        activity.sliding_counts(timed(spark, [event(0, "u", "p")]), "1 day", "1 minute")


def test_rank_is_a_prefix_of_the_full_order(spark):
    rng = random.Random(2)
    rows = [event(rng.randrange(300), "hot" if rng.random() < 0.4 else f"u{rng.randrange(5)}", f"p{rng.randrange(30):02d}", str(i))
            for i in range(2000)]
    counts = activity.sliding_counts(timed(spark, rows))
    full = collections.defaultdict(list)
    for r in counts.collect():
        full[(r.window, r.user_id)].append((-r.n, r.product_id))
    lists = ranking.as_lists(ranking.top_k(counts)).collect()
    assert {(r.window, r.user_id): r.product_ids for r in lists} == {
        key: [p for _, p in sorted(items)[:5]] for key, items in full.items()}


def test_rank_limit_is_applied_before_the_shuffle(spark):
    counts = activity.sliding_counts(timed(spark, [event(0, "u", "p")]))
    plan = ranking.top_k(counts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert "partial_count" in plan


def test_scan_reads_only_needed_columns(spark, sf_dir):
    source = tables.client_events(spark, sf_dir, with_product=True)
    plan = activity.sliding_counts(events.with_event_time(events.with_product(source)))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,props:string>" in plan
    assert "In(event_type, [click,purchase,view])" in plan


def test_null_user_is_a_group(spark):
    rows = [event(0, None, "p1"), event(1, None, "p2"), event(2, None, "p2")]
    found = ranking.as_lists(ranking.top_k(activity.sliding_counts(timed(spark, rows)))).collect()
    assert all(r.user_id is None and r.product_ids == ["p2", "p1"] for r in found)


def test_unusable_events_fall_out(spark, tmp_path):
    path = write(tmp_path / "in", [[
        event(0, "u", "p1"), event(0, "u", ""), event(0, "u", None), {**event(0, "u", "p2"), "timestamp": "yesterday"},
        "not json", '{"user_id":"u","product_id":"p3"}']])
    counts = activity.sliding_counts(table_of(spark, path)).collect()
    assert {r.product_id for r in counts} == {"p1"}


MINUTE = 60
BATCHES = [
    [event(0, "u1", "p1"), event(5, "u1", "p2"), event(10, "u2", "p9")],
    [event(20, "u1", "p2"), event(20, None, "p7")],  # p2 overtakes p1
    [event(30 * MINUTE, "u1", "p3")],  # moves the watermark to minute 20
    [event(30 * MINUTE + 1, "u1", "p3")],  # Spark drops late events from the second batch after that on
    [event(15, "u1", "p1", "late-1"), event(15, "u1", "p1", "late-2")],  # too late
    [event(31 * MINUTE, "u1", "p4"), event(31 * MINUTE + 1, "u1", "p4")],
]


# A straggler that Spark still accepts, in the batch right after the watermark has passed its windows.
STRAGGLER = [*BATCHES[:3], [event(15, "u1", "p1", "s1"), event(15, "u1", "p1", "s2")], *BATCHES[3:]]


def without_late(batches):
    return [[e for e in b if not e["event_id"].startswith("late")] for b in batches]


def batch_lists(spark, path):
    counts = activity.sliding_counts(table_of(spark, path))
    return as_dict(ranking.recommendations(ranking.as_lists(ranking.top_k(counts))))


def test_update_stream_re_ranks_and_drops_late_events(spark, tmp_path):
    path = write(tmp_path / "in", BATCHES)
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    recommend.start_update(stream_of(spark, path), out, cp, trigger=None).awaitTermination()
    written = recommend.results(spark, out)
    expected = batch_lists(spark, write(tmp_path / "kept", without_late(BATCHES)))
    assert as_dict(recommend.latest(written)) == expected
    assert expected[(0, "u1")] == ["p2", "p1"]
    first = as_dict(written.filter("batch_id = 0"))
    assert first[(0, "u1")] == ["p1", "p2"]
    second = as_dict(written.filter("batch_id = 1"))
    assert (0, "u2") not in second and second[(0, "u1")] == ["p2", "p1"] and second[(0, None)] == ["p7"]


def test_straggler_is_ranked_among_the_older_counts(spark, tmp_path):
    path = write(tmp_path / "in", STRAGGLER)
    out = str(tmp_path / "out")
    recommend.start_update(stream_of(spark, path), out, str(tmp_path / "cp"), trigger=None).awaitTermination()
    expected = batch_lists(spark, write(tmp_path / "kept", without_late(STRAGGLER)))
    assert expected[(0, "u1")] == ["p1", "p2"]
    assert as_dict(recommend.latest(recommend.results(spark, out))) == expected


def test_closed_counts_are_not_carried_on(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(recommend, "SNAPSHOT", 2)
    path = write(tmp_path / "in", [*BATCHES, BATCHES[-1], BATCHES[-1]])
    out = str(tmp_path / "out")
    recommend.start_update(stream_of(spark, path), out, str(tmp_path / "cp"), trigger=None).awaitTermination()
    kept = spark.read.parquet(f"{out}/counts")
    assert kept.count() > 0
    last = kept.agg(F.max("batch_id")).first()[0]
    assert kept.filter(F.col("batch_id") == last).agg(F.min(F.unix_seconds("window.end")) - T0).first()[0] > 15 * MINUTE
    assert kept.select("batch_id").distinct().count() <= 2


def test_touched_groups_are_picked_before_they_are_ranked(spark):
    counts = activity.sliding_counts(timed(spark, [event(0, "u", "p")]))
    touched = counts.select("window", "user_id").distinct()
    same = counts["window"].eqNullSafe(touched["window"]) & counts["user_id"].eqNullSafe(touched["user_id"])
    plan = ranking.top_k(counts.join(touched, same, "left_semi"))._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("WindowGroupLimit") < plan.index("LeftSemi")


def test_update_stream_goes_on_after_a_restart(spark, tmp_path):
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    path = write(tmp_path / "in", BATCHES[:1])
    recommend.start_update(stream_of(spark, path), out, cp, trigger=None).awaitTermination()
    for i in range(2, len(BATCHES) + 1):
        write(tmp_path / "in", BATCHES[:i])
        recommend.start_update(stream_of(spark, path), out, cp, trigger=None).awaitTermination()
    expected = batch_lists(spark, write(tmp_path / "kept", without_late(BATCHES)))
    assert as_dict(recommend.latest(recommend.results(spark, out))) == expected


@pytest.mark.parametrize("snapshot", [3, 100])
def test_update_stream_random(spark, tmp_path, monkeypatch, snapshot):
    """In-order batches: the final lists equal the table's, though old counts are dropped on the way."""
    monkeypatch.setattr(recommend, "SNAPSHOT", snapshot)
    rng = random.Random(4)
    batches = [[event(b * 400 + rng.randrange(400), "hot" if rng.random() < 0.5 else f"u{rng.randrange(4)}", f"p{rng.randrange(8)}",
                      f"{b}-{i}") for i in range(40)] for b in range(8)]
    path = write(tmp_path / "in", batches)
    out = str(tmp_path / "out")
    recommend.start_update(stream_of(spark, path), out, str(tmp_path / "cp"), k=3, trigger=None).awaitTermination()
    counts = activity.sliding_counts(table_of(spark, path))
    expected = as_dict(ranking.recommendations(ranking.as_lists(ranking.top_k(counts, k=3))))
    assert as_dict(recommend.latest(recommend.results(spark, out))) == expected


def test_global_update_stream(spark, tmp_path):
    path = write(tmp_path / "in", BATCHES[:3])
    out = str(tmp_path / "out")
    recommend.start_update(stream_of(spark, path), out, str(tmp_path / "cp"), within=["window"], trigger=None).awaitTermination()
    found = recommend.latest(recommend.results(spark, out), ("window_start", "window_end"))
    lists = {(r.s - T0) // 60: r.product_ids for r in found.withColumn("s", F.unix_seconds("window_start")).collect()}
    assert lists[0] == ["p2", "p1", "p7", "p9"]


def test_append_stream_writes_closed_windows_once(spark, tmp_path):
    path = write(tmp_path / "in", BATCHES)
    out = str(tmp_path / "out")
    recommend.start_append(stream_of(spark, path), out, str(tmp_path / "cp"), trigger=None).awaitTermination()
    found = as_dict(recommend.results(spark, out))
    mark = 31 * MINUTE + 1 - 10 * MINUTE
    expected = {key: products for key, products in batch_lists(spark, write(tmp_path / "kept", without_late(BATCHES))).items()
                if (key[0] + 5) * MINUTE <= mark}
    assert found == expected and len(found) == recommend.results(spark, out).count()


def test_published_messages_are_the_written_ones(spark, tmp_path):
    path = write(tmp_path / "in", BATCHES[:2])
    out, sent = str(tmp_path / "out"), []

    def publish(recommended):
        sent.extend((r.key, json.loads(r.value)) for r in ranking.as_messages(recommended).collect())

    recommend.start_update(stream_of(spark, path), out, str(tmp_path / "cp"), trigger=None, publish=publish).awaitTermination()
    written = recommend.results(spark, out).collect()
    assert len(sent) == len(written)
    assert sorted((k or "", m["product_ids"], m["generated_at"]) for k, m in sent) == sorted(
        (r.user_id or "", r.product_ids, r.generated_at) for r in written)
    assert all("user_id" not in m for k, m in sent if k is None)


def test_running_total(spark, tmp_path):
    """More batches than a query's progress remembers, with a restart among them."""
    seen = []

    def sink(batch, batch_id):
        seen.extend(r.value for r in batch.collect())

    counts = str(tmp_path / "counts")
    for part in range(2):
        path = write(tmp_path / "in", [[f"{i}"] for i in range(60 * (part + 1))])
        lines = spark.readStream.option("maxFilesPerTrigger", 1).text(path)
        query = (lines.writeStream.option("checkpointLocation", str(tmp_path / "cp"))
                 .foreachBatch(progress.counted(sink, counts)).trigger(availableNow=True).start())
        progress.run_until_stopped(query)
        assert progress.total(spark, counts) == len(seen) == 60 * (part + 1)
    assert len(list((tmp_path / "counts").glob("batch_id=*"))) <= 2


def test_stateful_check_stays_on(spark):
    assert spark.conf.get("spark.sql.streaming.statefulOperator.checkCorrectness.enabled") == "true"


def test_duplicates_in_a_stream_and_a_table(spark, tmp_path):
    """The earlier copy wins though the later one's other columns sort first."""
    rows = [event(2, "u", "p1", "a", "view"), event(3, "u", "p1", "a", "click"), event(2, "u", "p1", "b")]
    path = write(tmp_path / "in", [rows[:1], rows[1:]])
    lines = spark.readStream.option("maxFilesPerTrigger", 1).text(path)
    decoded = events.with_event_time(codec.decode(lines, schemas.CLIENT_EVENT))
    query = (events.drop_duplicates(decoded).writeStream.format("memory").queryName("dedup")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    expected = [("a", "view", "02Z"), ("b", "view", "02Z")]
    assert sorted((r.event_id, r.event_type, r.timestamp[-3:]) for r in spark.table("dedup").collect()) == expected
    plain = codec.decode(spark.read.text(path), schemas.CLIENT_EVENT)
    unreadable = plain.limit(1).withColumns({"timestamp": F.lit("?"), "event_id": F.lit("a"), "event_type": F.lit("a")})
    for table in (plain, events.with_event_time(plain), plain.unionByName(unreadable)):
        found = events.drop_duplicates(table)
        assert sorted((r.event_id, r.event_type, r.timestamp[-3:]) for r in found.collect()) == expected
        assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()


def test_screening_stream(spark, tmp_path):
    messages = [json.dumps({"id": f"p{i}", "name": "n", "category": c}) for i, c in enumerate(["tobacco", "books", "Tobacco"])]
    path = write(tmp_path / "in", [[*messages, "broken"], ['{"id":"p9","name":"no category"}']])
    banned = files.control_set(spark, "/nonexistent")
    stream = spark.readStream.option("maxFilesPerTrigger", 1).text(path).select(
        F.col("value").cast("binary").alias("value"), F.lit("k").cast("binary").alias("key"))
    out = str(tmp_path / "out")
    screening_stream.start(stream, banned, out, str(tmp_path / "cp"), trigger=None).awaitTermination()
    passed = [json.loads(r.value) for r in spark.read.parquet(f"{out}/passed").collect()]
    assert sorted(p["id"] for p in passed) == ["p1", "p2", "p9"]
    assert next(p for p in passed if p["id"] == "p9")["category"] == ""
    assert [r.raw for r in spark.read.parquet(f"{out}/dead").collect()] == ["broken"]
    audit = {r.id: r.status for r in spark.read.parquet(f"{out}/audit").collect()}
    assert audit == {"p0": "FILTERED", "p1": "PASSED", "p2": "PASSED", None: "DEAD", "p9": "PASSED"}


@pytest.mark.parametrize("job", [False, True])
def test_banned_set_is_fixed_at_the_start(spark, tmp_path, job):
    """The file changes while the stream runs; all batches see the set of the start, and the next start sees the new one."""
    from marketstream.config import ScreeningConfig
    from marketstream.streaming import jobs

    banned = tmp_path / "banned.json"
    banned.write_text('["weapons"]')
    path = write(tmp_path / "in", [[json.dumps({"id": f"{b}-{c}", "category": c}) for c in ("weapons", "alcohol")] for b in range(4)])
    out, sent = str(tmp_path / "out"), []

    def publish(passed):
        banned.write_text('["alcohol"]')
        sent.extend(json.loads(r.value)["id"] for r in passed.collect())

    def source(_):
        return spark.readStream.option("maxFilesPerTrigger", 1).text(path).select(
            F.lit("k").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))

    def start():
        if job:
            return jobs.start_screening(spark, ScreeningConfig(banned_path=str(banned)), out, source, publish)
        return screening_stream.start(source(spark), files.control_set(spark, str(banned)), out, f"{out}/checkpoint", trigger=None, publish=publish)

    start().awaitTermination()
    assert sorted(sent) == [f"{b}-alcohol" for b in range(4)]
    assert progress.total(spark, f"{out}/totals") == 8
    write(tmp_path / "in", [[json.dumps({"id": f"{b}-{c}", "category": c}) for c in ("weapons", "alcohol")] for b in range(5)])
    start().awaitTermination()
    assert sorted(sent)[-1] == "4-weapons" and progress.total(spark, f"{out}/totals") == 10


def test_recommendation_job(spark, tmp_path):
    from marketstream.config import StreamConfig
    from marketstream.streaming import jobs

    path, sent = write(tmp_path / "in", BATCHES[:2]), []
    query = jobs.start_recommendations(
        spark, StreamConfig(), str(tmp_path / "out"), lambda s: files.text_messages(s, path, streaming=True),
        lambda found: sent.extend(ranking.as_messages(found).collect()))
    query.awaitTermination()
    read = jobs.recommendations_read(spark.createDataFrame([(r.key, r.value) for r in sent], "key string, value string"))
    lists = batch_lists(spark, write(tmp_path / "kept", without_late(BATCHES[:2])))
    assert {r.product_id for r in read.collect()} == {p for products in lists.values() for p in products}


def test_settings_are_strict():
    from marketstream import config

    assert config.env_int("N", 5, {}) == 5 and config.env_int("N", 5, {"N": "7"}) == 7
    with pytest.raises(ValueError, match="N is not a whole number"):
        config.env_int("N", 5, {"N": "seven"})


def test_mirror_stream(spark, tmp_path):
    rows = [("k", "v", "client-events", 1), ("k2", "v2", "__x", 0), ("k3", "v3", "products-raw", 2)]
    src = str(tmp_path / "in")
    spark.createDataFrame(rows, "key string, value string, topic string, partition int").write.parquet(src)
    stream = files.table_stream(spark, src)
    mirror_stream.start_to_table(stream, str(tmp_path / "out"), str(tmp_path / "cp"), trigger=None).awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.topic, r.partition, r.key) for r in found) == [
        ("cluster1.client-events", 1, "k"), ("cluster1.products-raw", 2, "k3")]


def test_published_products_are_complete(spark, sf_dir):
    messages = kafka_sink.product_messages(tables.catalogue(spark, sf_dir))
    record = json.loads(messages.filter("key = 'prod-000'").first().value)
    assert set(record) == {f.name for f in schemas.PRODUCT.fields} and record["category"] == ""
