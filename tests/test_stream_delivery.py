"""What a stream has read, and what it has sent, when it fails at any point and starts again."""

import os
import time

import pytest
from pyspark.sql import functions as F

from marketstream.sinks import once
from marketstream.streaming import progress, recommend, screening
from test_activity import event, stream_of, write

MESSAGE = "topic string, partition int, offset bigint"


def run_tracked(spark, out, rows, sink=lambda batch, batch_id: None):
    spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(f"{out}/topic")
    stream = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1).parquet(f"{out}/topic")
    writer = stream.writeStream.queryName("reader").option("checkpointLocation", f"{out}/cp")
    query = writer.foreachBatch(progress.tracked(sink, f"{out}/offsets")).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def committed(spark, out):
    return sorted((tuple(r)[1:] for r in progress.committed(spark, f"{out}/offsets", "g").collect()), key=str)


def test_offsets_over_restarts(spark, tmp_path):
    out = str(tmp_path)
    run_tracked(spark, out, [("a", 0, 5), ("a", 0, 4), ("a", 1, 9)])
    assert committed(spark, out) == [("a", 0, 6, 2), ("a", 1, 10, 1)]
    run_tracked(spark, out, [("a", 0, 7), ("b", 0, 0), ("b", None, 3)])
    run_tracked(spark, out, [("b", 0, 1)])
    expected = [("a", 0, 8, 3), ("a", 1, 10, 1), ("b", 0, 2, 2), ("b", None, 4, 1)]
    assert committed(spark, out) == sorted(expected, key=str)
    assert len(os.listdir(f"{out}/offsets")) <= 3


def test_offsets_of_a_failed_batch_are_not_committed(spark, tmp_path):
    out, fail = str(tmp_path), [True]

    def sink(batch, batch_id):
        if batch_id == 1 and fail.pop():
            raise RuntimeError("no sink")

    run_tracked(spark, out, [("a", 0, 1)], sink)
    with pytest.raises(Exception, match="no sink"):
        run_tracked(spark, out, [("a", 0, 2)], sink)
    assert committed(spark, out) == [("a", 0, 2, 1)]
    fail.append(False)
    run_tracked(spark, out, [("a", 0, 3)], sink)
    assert committed(spark, out) == [("a", 0, 4, 3)]


def test_table_of_batches(spark, tmp_path):
    """A row for each batch with its rows and offsets, over two starts; the watermark moves on."""
    out, table = str(tmp_path), str(tmp_path / "progress")
    listener = progress.ProgressTable(spark, table)
    spark.streams.addListener(listener)
    try:
        for start in range(2):
            path = write(tmp_path / "in", [[event(600 * (3 * start + i), "u", "p"), event(600 * i, "v", "p")] for i in range(3 * (start + 1))])
            recommend.start_update(stream_of(spark, path), out, f"{out}/cp", trigger=None).awaitTermination()
        deadline = time.time() + 30
        while time.time() < deadline:
            found = progress.batches(spark, table).orderBy("batch_id").collect() if os.path.isdir(table) else []
            if sum(r["rows"] for r in found) >= 12:
                break
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    assert sum(r["rows"] for r in found) == 12 and len({r["query"] for r in found}) == 1
    assert len({r["batch_id"] for r in found}) == len(found) >= 6
    marks = [r["watermark"] for r in found if r["watermark"]]
    assert marks == sorted(marks) and marks[-1] > "2024" and max(r["state_rows"] for r in found) > 0
    assert all(r["sources"][0]["end"] for r in found if r["rows"])


class Sink:
    """A sink that records batch by batch, and can fail in the middle of a publish or right after it."""

    def __init__(self, path):
        self.path, self.batch, self.failures = path, 0, {}

    def publish(self, messages):
        if self.failures.pop(("during", self.batch), None):
            messages.orderBy("key").limit(1).write.mode("append").parquet(f"{self.path}/{self.batch}")
            raise RuntimeError("lost in between")
        messages.write.mode("append").parquet(f"{self.path}/{self.batch}")
        if self.failures.pop(("after", self.batch), None):
            raise RuntimeError("lost afterwards")

    def recorded(self, spark, batch_id):
        self.batch = batch_id
        path = f"{self.path}/{batch_id}"
        return spark.read.schema("key string, value string").parquet(path) if os.path.isdir(path) else spark.createDataFrame([], "key string, value string")


def messages(spark):
    return spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "2"), (None, "3")], "key string, value string")


@pytest.mark.parametrize("when", ["during", "after", None])
def test_a_batch_is_sent_once(spark, tmp_path, when):
    """Equal messages, too; the second run sends what is missing, the third nothing."""
    sink = Sink(str(tmp_path / "sink"))
    if when:
        sink.failures[(when, 0)] = True
        with pytest.raises(RuntimeError):
            once.send(messages(spark), 0, str(tmp_path / "ledger"), sink.publish, sink.recorded)
    for _ in range(2):
        once.send(messages(spark), 0, str(tmp_path / "ledger"), sink.publish, sink.recorded)
    got = sorted(map(str, sink.recorded(spark, 0).collect()))
    assert got == sorted(map(str, messages(spark).collect()))


def test_a_sink_is_not_read_without_a_failure(spark, tmp_path):
    def recorded(spark, batch_id):
        raise AssertionError("read")

    for batch_id in range(2):
        once.send(messages(spark), batch_id, str(tmp_path / "ledger"), Sink(str(tmp_path / "sink")).publish, recorded)


@pytest.mark.parametrize("when", ["during", "after"])
def test_recommendations_are_published_once(spark, tmp_path, when):
    """A failure between publish and commit: the batch runs again and the topic has each message once, as first made."""
    path, out, sink = write(tmp_path / "in", [[event(0, "u", "p"), event(1, "v", "p")]]), str(tmp_path / "out"), Sink(str(tmp_path / "sink"))
    lists = []

    def publish(rows):
        lists.append(sorted(r["generated_at"] for r in rows.collect()))
        sink.publish(rows.select(F.col("user_id").alias("key"), F.to_json(F.struct("*")).alias("value")))

    def recorded(spark, batch_id):
        known = spark.read.parquet(f"{out}/results/batch_id={batch_id}").schema
        return sink.recorded(spark, batch_id).select(F.from_json("value", known).alias("r")).select("r.*")

    sink.failures[(when, 0)] = True
    start = lambda: recommend.start_update(stream_of(spark, path), out, f"{out}/cp", trigger=None, publish=publish, recorded=recorded)
    with pytest.raises(Exception, match="lost"):
        start().awaitTermination()
    time.sleep(1.1)
    start().awaitTermination()
    written = recommend.results(spark, out).filter("batch_id = 0")
    sent = recorded(spark, 0)
    assert sent.count() == written.count() > 2 and sent.exceptAll(written.select(*sent.columns)).count() == 0
    assert len(lists) == 2 and set(lists[1]) <= set(lists[0])


def test_screened_products_are_published_once(spark, tmp_path):
    rows = [(f"k{i}", codec_value(i)) for i in range(6)]
    spark.createDataFrame(rows, "key string, value string").coalesce(1).write.parquet(str(tmp_path / "in"))
    banned = spark.createDataFrame([("tobacco",)], "category string")
    sink, out = Sink(str(tmp_path / "sink")), str(tmp_path / "out")
    sink.failures[("during", 0)] = True

    def start():
        stream = spark.readStream.schema("key string, value string").parquet(str(tmp_path / "in"))
        return screening.start(stream, banned, out, str(tmp_path / "cp"), trigger=None, publish=sink.publish, recorded=sink.recorded)

    with pytest.raises(Exception, match="lost"):
        start().awaitTermination()
    start().awaitTermination()
    assert sorted(r["key"] for r in sink.recorded(spark, 0).collect()) == ["k1", "k2", "k4", "k5"]


def codec_value(i):
    import json

    return json.dumps({"id": f"p{i}", "category": "tobacco" if i % 3 == 0 else "food"})


def test_a_folder_without_a_note_counts_for_nothing(spark, tmp_path):
    assert not once.noted(spark, str(tmp_path), once.DONE, 3)
    once.note(spark, str(tmp_path), once.DONE, 3)
    assert once.noted(spark, str(tmp_path), once.DONE, 3) and not once.noted(spark, str(tmp_path), once.DONE, 4)
