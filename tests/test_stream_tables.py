"""Late rows beside counted rows, and result tables that hold the newest row of each key."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketstream.operators import activity
from marketstream.plans import recommendations
from marketstream.sinks import triggered, upsert
from marketstream.sinks.files import batch_folder, write_batch
from marketstream.streaming import lateness, recommend
from test_activity import as_dict, event, stream_of, write

T0 = 1_704_067_200
EVENT = T.StructType([T.StructField("id", T.LongType()), T.StructField("event_time", T.TimestampType())])


def events(spark, rows):
    """(id, second) rows; no second: no time."""
    return spark.createDataFrame(rows, "id bigint, s bigint").select("id", F.timestamp_seconds(F.col("s") + T0).alias("event_time"))


def run_split(spark, out, batches, starts=1):
    per = -(-len(batches) // starts)
    for i, batch in enumerate(batches):
        events(spark, batch).coalesce(1).write.mode("append").parquet(f"{out}/in")
        if (i + 1) % per and i + 1 < len(batches):
            continue
        stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(f"{out}/in")
        lateness.start(stream, out, f"{out}/cp", trigger=None).awaitTermination()


def counted_ids(spark, out, files_per_batch):
    found = activity.sliding_counts(lateness.on_time(spark, out, EVENT, maxFilesPerTrigger=files_per_batch), by=["id"])
    writer = found.writeStream.outputMode("update").option("checkpointLocation", f"{out}/counting")
    triggered(writer.foreachBatch(lambda batch, i: write_batch(batch, f"{out}/counts", i)), None).start().awaitTermination()
    return {r["id"] for r in spark.read.schema(found.schema).parquet(f"{out}/counts").collect()}


def brute_late(batches):
    high, out = None, {}
    for batch in batches:
        for i, s in batch:
            if s is not None and high is not None and s // 120 * 120 + 300 <= high - 600:
                out[i] = high - 600
        high = max([high, *(s for _, s in batch)], key=lambda s: -1 if s is None else s)
    return out


@pytest.mark.parametrize("starts", [1, 3])
def test_late_and_counted_are_all(spark, tmp_path, starts):
    """Random stragglers in many batches, some batches empty or all late; the counting stream reads in other batches."""
    rng, out, n = random.Random(starts), str(tmp_path), 0
    batches = []
    for b in range(9):
        size = rng.choice([0, 5, 30]) if b else 20
        times = [600 * b + rng.randrange(600) - rng.choice([0, 0, 400, 1500, 9000]) for _ in range(size)]
        batches.append([(n + i, t) for i, t in enumerate(times)])
        n += size
    batches.append([(n, 0), (n + 1, None)])
    run_split(spark, out, batches, starts)
    late = {r["id"]: r["w"] for r in lateness.late(spark, out, EVENT).select("id", (F.unix_seconds("watermark") - T0).alias("w")).collect()}
    assert late == brute_late(batches) and late
    counted = counted_ids(spark, out, "2")
    assert not counted & set(late) and counted | set(late) | {n + 1} == set(range(n + 2))
    assert len(glob.glob(f"{out}/marks/batch_id=*")) <= 2


def test_a_batch_that_runs_again_splits_alike(spark, tmp_path):
    out = str(tmp_path)
    run_split(spark, out, [[(0, 9000)], [(1, 100), (2, 9100)]])
    before = sorted(map(tuple, lateness.late(spark, out, EVENT).collect()))
    commits = glob.glob(f"{out}/cp/commits/*")
    for name in (max(commits), f"{out}/cp/commits/.{os.path.basename(max(commits))}.crc"):
        os.remove(name)
    run_split(spark, out, [[]])
    assert sorted(map(tuple, lateness.late(spark, out, EVENT).collect())) == before and len(before) == 1


ROW = T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.LongType())])


def put(spark, out, batch_id, rows, every=4):
    write_batch(spark.createDataFrame(rows, ROW), f"{out}/log", batch_id)
    upsert.commit(spark, f"{out}/log", f"{out}/table", batch_id, ROW, ["key"], every)


def read(spark, out):
    found = upsert.current(spark, f"{out}/log", f"{out}/table", ROW, ["key"])
    return {r["key"]: (r["value"], r["version"]) for r in found.collect()}


def test_newest_rows(spark, tmp_path):
    """Against a dictionary, with batches left out, nulls as keys and values, and batches that run again."""
    rng, out, known = random.Random(6), str(tmp_path), {}
    assert read(spark, out) == {}
    for batch_id in [b for b in range(24) if b % 5 != 2]:
        rows = [(k, rng.choice([None, rng.randrange(100)])) for k in rng.sample([None, *"abcdefgh"], rng.randrange(5))]
        for _ in range(rng.choice([1, 2])):
            put(spark, out, batch_id, rows)
        known |= {k: (v, batch_id) for k, v in rows}
        assert read(spark, out) == known
        # What a reader takes is bounded by the base and a few batches, and old folders go.
        assert len(upsert._pointers(spark, f"{out}/table")[0]["deltas"]) < 4
        assert len(os.listdir(f"{out}/table/pointer")) <= 3 and len(glob.glob(f"{out}/table/base/*")) <= 2


def test_a_batch_counts_when_its_pointer_is_written(spark, tmp_path):
    out = str(tmp_path)
    put(spark, out, 0, [("a", 1)])
    write_batch(spark.createDataFrame([("a", 2), ("b", 2)], ROW), f"{out}/log", 1)
    assert read(spark, out) == {"a": (1, 0)}
    upsert.commit(spark, f"{out}/log", f"{out}/table", 1, ROW, ["key"])
    assert read(spark, out) == {"a": (2, 1), "b": (2, 1)}


def test_reading_does_not_grow_with_the_stream(spark, tmp_path):
    """After many batches over the same keys a reader opens the base and at most ``every`` - 1 batches."""
    out = str(tmp_path)
    for batch_id in range(13):
        put(spark, out, batch_id, [("a", batch_id), ("b", batch_id)])
    found = upsert.current(spark, f"{out}/log", f"{out}/table", ROW, ["key"])
    folders = {os.path.basename(os.path.dirname(f)) for f in found.inputFiles()}
    assert folders == {"batch_id=11", "batch_id=12"} and os.path.isdir(batch_folder(f"{out}/log", 3))


def test_lists_of_the_table_are_the_newest(spark, tmp_path, monkeypatch):
    """The table of lists equals the newest of all versions; the folders of counts stay few though batches are empty."""
    monkeypatch.setattr(recommend, "SNAPSHOT", 4)
    monkeypatch.setattr(upsert, "EVERY", 3)
    out, rng, batches = str(tmp_path / "out"), random.Random(2), []
    assert recommend.current(spark, out).collect() == []
    for start in range(8):
        batches.append([event(60 * start + rng.randrange(60), f"u{rng.randrange(3)}", f"p{rng.randrange(4)}") for _ in range(6)])
        path = write(tmp_path / "in", batches)
        recommend.start_update(stream_of(spark, path), out, str(tmp_path / "cp"), trigger=None).awaitTermination()
        assert as_dict(recommend.current(spark, out)) == as_dict(recommend.latest(recommend.results(spark, out)))
    last = max(int(f.rpartition("=")[2]) for f in glob.glob(f"{out}/changes/batch_id=*"))
    assert last > 12
    assert len(glob.glob(f"{out}/changes/batch_id=*")) <= 2 * 4 + 1 and len(glob.glob(f"{out}/counts/batch_id=*")) <= 2


def test_batches_of_many_files_are_counted_whole(spark, tmp_path, monkeypatch):
    """Parts are written by many tasks, and late and counted are still all events, each once."""
    rng, settings = random.Random(3), ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    rows = [(i, T0 + rng.randrange(30 * 86_400)) for i in range(4000)]
    found = spark.createDataFrame(rows, "event_id bigint, s bigint").select("event_id", F.timestamp_seconds("s").alias("ts"))
    found.repartition(6).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(recommendations, "scratch_dir", lambda _, name: str(tmp_path / name))
    before = {k: spark.conf.get(k) for k in settings}
    for k in settings:
        spark.conf.set(k, "4000")
    try:
        got = recommendations.late_stream(spark, str(tmp_path)).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(list((tmp_path / "late" / "in").glob("*.parquet"))) >= 3 * recommendations.LATE_BATCHES
    assert sorted(r["event_id"] for r in got) == list(range(4000)) and {r["late"] for r in got} == {True, False}
