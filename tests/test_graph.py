"""The declared graph: its checks, and all jobs of the marketplace with files in the place of topics."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketstream import schemas
from marketstream.config import ScreeningConfig, StreamConfig
from marketstream.operators import ranking
from marketstream.streaming import graph, jobs
from test_activity import event

A, B = (T.StructType([T.StructField("x", t)]) for t in (T.StringType(), T.LongType()))
MESSAGES = "key binary, value binary"


def never():
    raise AssertionError("started")


@pytest.mark.parametrize(("edges", "nodes", "fault"), [
    ([graph.Edge("t", A)], [graph.Node("n", never, reads={"t": A})], "nothing writes t"),
    ([], [graph.Node("n", never, reads={"t": A})], "n reads t, which is not declared"),
    ([graph.Edge("t", A, True)], [graph.Node("n", never, reads={"t": B})], "n reads t as another record"),
    ([graph.Edge("t", A)], [graph.Node("n", never, writes={"t": B})], "n writes t as another record"),
    ([graph.Edge("t", A, True)], [], "no job uses t"),
    ([graph.Edge("t", A, True)] * 2, [graph.Node("n", never, reads={"t": A})] * 2, "topic t is declared twice; job n is declared twice"),
    ([graph.Edge("t", A), graph.Edge("u", A)], [graph.Node("n", never, {"t": A}, {"u": A}), graph.Node("m", never, {"u": A}, {"t": A})], "feed themselves"),
    ([graph.Edge("t", A)], [graph.Node("n", never, {"t": A}, {"t": A})], "feed themselves"),
])
def test_faults_are_found_before_anything_starts(edges, nodes, fault):
    with pytest.raises(ValueError, match=fault):
        graph.Graph(edges, nodes)


def test_writers_come_before_readers():
    edges = [graph.Edge(t, A, t == "in") for t in ("in", "mid", "out")]
    nodes = [graph.Node("last", never, {"out": A}), graph.Node("first", never, {"in": A}, {"mid": A}), graph.Node("second", never, {"mid": A}, {"out": A})]
    assert graph.Graph(edges, nodes).order == ["first", "second", "last"]


class Query:
    def __init__(self, fails=False):
        self.isActive, self.fails = True, fails

    def stop(self):
        self.isActive = False

    def exception(self):
        return RuntimeError("broken") if self.fails else None


def test_all_jobs_run_or_none():
    running, begun = Query(), []

    def start(name, query):
        def run():
            begun.append(name)
            if query is None:
                raise OSError("no topic")
            return query

        return run

    edges = [graph.Edge("in", A, True), graph.Edge("mid", A)]
    nodes = [graph.Node("first", start("first", None), {"in": A}, {"mid": A}), graph.Node("second", start("second", running), {"mid": A})]
    with pytest.raises(OSError, match="no topic"):
        graph.Graph(edges, nodes).start()
    assert begun == ["second", "first"] and not running.isActive


def test_one_failure_stops_all():
    failed, other = Query(fails=True), Query()
    failed.stop()
    with pytest.raises(RuntimeError, match="broken"):
        graph.run_until_stopped({"a": failed, "b": other}, poll=0.01)
    assert not other.isActive


def topics(spark, root):
    """Folders that play topics: a way to put a table of messages into one, sources and publishers by topic."""
    def put(name):
        return lambda found: found.select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value")).write.mode(
            "append").parquet(f"{root}/{name}")

    def source(name):
        return lambda s: s.readStream.schema(MESSAGES).parquet(f"{root}/{name}")

    return put, source


def test_marketplace(spark, tmp_path):
    """Events and products in; lists, their readers' rows, allowed products and the store's lines out, over two runs."""
    events, products = StreamConfig(top_k=2), ScreeningConfig(banned_path=str(tmp_path / "none.json"))
    put, source = topics(spark, tmp_path / "topics")
    names = [events.topic_in, events.topic_out, products.topic_in, products.topic_out]
    send = {products.topic_out: put(products.topic_out), events.topic_out: lambda found: put(events.topic_out)(ranking.as_messages(found))}
    whole = jobs.marketplace(spark, events, products, str(tmp_path / "out"), {n: source(n) for n in names}, send)
    assert whole.order.index("screening") < whole.order.index("storage")
    assert whole.order.index("recommendations") < whole.order.index("read-back")
    as_messages = lambda rows, key: spark.createDataFrame([(r[key], json.dumps(r)) for r in rows], "key string, value string")
    for run in range(2):
        put(events.topic_in)(as_messages([event(60 * run + i, "u1", f"p{i % 3}") for i in range(5)], "user_id"))
        goods = [{"id": f"{run}-{c}", "category": c, "price": 1.0} for c in ("tobacco", "books", "toys")]
        put(products.topic_in)(as_messages(goods, "id").union(spark.createDataFrame([("x", "no json")], "key string, value string")))
        whole.run_in_turn()
    stored = spark.read.schema(schemas.PRODUCT).json(str(tmp_path / "out/storage/products")).collect()
    assert sorted(r["id"] for r in stored) == sorted(f"{run}-{c}" for run in range(2) for c in ("books", "toys"))
    read = spark.read.parquet(str(tmp_path / "out/read-back/read")).collect()
    assert {r["user_id"] for r in read} == {"u1"} and {r["position"] for r in read} == {1, 2} and not any(r["raw"] for r in read)
    assert {r["product_id"] for r in read} <= {"p0", "p1", "p2"}


def test_jobs_of_the_marketplace_run_side_by_side(spark, tmp_path):
    """With a trigger all jobs run at once, and stopping ends them together."""
    events, products = StreamConfig(), ScreeningConfig(banned_path=str(tmp_path / "none.json"))
    put, source = topics(spark, tmp_path / "topics")
    names = [events.topic_in, events.topic_out, products.topic_in, products.topic_out]
    nothing = spark.createDataFrame([], "key string, value string")
    for name in names:
        put(name)(nothing)
    send = {products.topic_out: put(products.topic_out), events.topic_out: lambda found: None}
    queries = jobs.marketplace(spark, events, products, str(tmp_path / "out"), {n: source(n) for n in names}, send, trigger="1 second").start()
    try:
        assert len(queries) == 4 and all(q.isActive for q in queries.values())
        for query in queries.values():
            query.processAllAvailable()
    finally:
        graph.stop(queries)
    assert not any(q.isActive for q in queries.values()) and all(q.exception() is None for q in queries.values())
