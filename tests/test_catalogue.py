import json

import pytest
from pyspark.sql import functions as F

from marketstream.operators import control_set, membership, mirror, numbering, offsets, screening, search
from marketstream.sinks import files as file_sink
from marketstream.sinks import kafka as kafka_sink
from marketstream.sources import files, kafka
from marketstream import schemas

CATEGORIES = (
    ["electronics"] * 3 + ["books"] * 2 + ["footwear", "appliances", "sports", "transport", "electronics", "gaming",
     "accessories", "sports", "kitchen", "home"] + ["tobacco", "alcohol", "weapons", "alcohol", "tobacco"]
)


def product(i, category, **more):
    return {
        "id": f"prod-{i:03d}", "name": more.get("name", f"Товар {i}"), "category": category,
        "description": more.get("description", "описание"), "price": 100.0 + i, "currency": "RUB", "quantity": i,
        "seller_id": "seller-1", "brand": more.get("brand", "Brand"), "tags": more.get("tags", ["tag"]),
        "created_at": "2024-01-10T08:00:00Z",
    }


@pytest.fixture(scope="module")
def catalogue_file(tmp_path_factory):
    rows = [product(i, c) for i, c in enumerate(CATEGORIES, start=1)]
    rows[0]["name"] = "Ноутбук Dell XPS 13"
    rows[11]["description"] = "рюкзак с отсеком для ноутбука"
    path = tmp_path_factory.mktemp("catalogue") / "products.json"
    path.write_text(json.dumps(rows, ensure_ascii=False, indent=2), encoding="utf-8")
    return str(path)


@pytest.fixture(scope="module")
def banned(spark):
    return files.control_set(spark, "/nonexistent/banned.json")


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


def test_default_set_screens_fifteen_of_twenty(spark, catalogue_file, banned):
    products = files.catalogue(spark, catalogue_file)
    assert ids(screening.filtered(products, banned)) == [f"prod-{i:03d}" for i in range(16, 21)]
    assert len(ids(screening.passed(products, banned))) == 15
    tally = {(r.status, r.category): r.n for r in screening.tally(screening.audit(products, banned)).collect()}
    assert tally[("FILTERED", "tobacco")] == 2 and tally[("FILTERED", "alcohol")] == 2


def test_exact_match_lets_odd_categories_pass(spark, banned):
    rows = [product(1, None), product(2, ""), product(3, "Tobacco"), product(4, " weapons "), product(5, "tobacco")]
    products = spark.createDataFrame(rows, schemas.PRODUCT)
    for small in (True, False):
        assert ids(screening.passed(products, banned, small=small)) == ["prod-001", "prod-002", "prod-003", "prod-004"]
        assert ids(screening.filtered(products, banned, small=small)) == ["prod-005"]
        assert ids(screening.passed(products, banned, normalise=True, small=small)) == ["prod-001", "prod-002"]


def test_broken_catalogue_is_an_error(spark, tmp_path):
    path = tmp_path / "broken.json"
    path.write_text('[{"id": "a"}, {"id": ')
    with pytest.raises(Exception, match="(?i)malformed"):
        files.catalogue(spark, str(path)).collect()


def test_control_set_file(spark, tmp_path):
    path = tmp_path / "banned.json"
    path.write_text('["weapons", "alcohol", "weapons"]')
    found = files.control_set(spark, str(path))
    assert [r.category for r in control_set.listing(found).collect()] == ["alcohol", "weapons"]
    path.write_text("not json")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.control_set(spark, str(path)).collect()


def test_edits_normalise_and_repeat_harmlessly(spark, banned):
    def names(df):
        return sorted(r.category for r in df.collect())

    assert names(control_set.add(banned, [" Weapons "])) == ["alcohol", "tobacco", "weapons"]
    with_cosmetics = control_set.add(banned, ["Cosmetics"])
    assert names(with_cosmetics) == ["alcohol", "cosmetics", "tobacco", "weapons"]
    assert names(control_set.remove(with_cosmetics, ["COSMETICS "])) == names(banned)
    assert names(control_set.remove(banned, ["unknown"])) == names(banned)
    for edit in (control_set.add, control_set.remove):
        with pytest.raises(Exception, match="blank"):
            edit(banned, ["  \t"]).collect()


def test_search(spark, catalogue_file):
    products = files.catalogue(spark, catalogue_file)
    assert ids(search.search(products, "НОУТБУК")) == ["prod-001", "prod-012"]
    assert search.found(search.search(products, "nothing")).first().found == 0
    assert search.found(search.search(products, "")).first().found == 20
    assert ids(search.search(products, ["ноутбук", "dell"])) == ["prod-001"]


def test_search_does_not_match_across_fields(spark):
    products = spark.createDataFrame([product(1, None, name="ab", description="cd")], schemas.PRODUCT)
    assert ids(search.search(products, "bc")) == []
    assert ids(search.search(products, "B")) == ["prod-001"]


@pytest.mark.parametrize("small", [True, False])
def test_screens_are_a_partition_of_skewed_input(spark, small):
    """A third of the rows share one category, another third have none."""
    n = 3000
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("c"), (F.col("id") % 100).cast("string"))).alias("category"))
    names = spark.createDataFrame([("hot",), ("c5",), ("hot",), (None,)], "category string")
    good, bad = screening.passed(rows, names, small=small), screening.filtered(rows, names, small=small)
    assert sorted(ids(good) + ids(bad)) == sorted(str(i) for i in range(n))
    assert bad.filter("category = 'hot'").count() == 1000
    assert screening.audit(rows, names, small=small).groupBy("status").count().count() == 2


def test_large_set_is_not_broadcast(spark):
    keys = spark.range(500).select(F.col("id").cast("string").alias("k"))
    assert not membership.is_small(keys, rows=100)
    assert not membership.is_small(keys, bytes_=100)
    assert membership.is_small(keys)
    joined = membership.join_set(keys, keys, "k", "left_semi", small=False)
    assert joined.count() == 500


@pytest.mark.parametrize("hits_small", [True, False])
@pytest.mark.parametrize("how", ["left_anti", "left_semi", "left"])
def test_set_joins_are_the_same_at_every_size(spark, monkeypatch, how, hits_small):
    """Against Spark's own join: a key with a third of the rows, keys of the set that do not occur, nulls, repeated rows."""
    n = 6000
    rows = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("c"), F.pmod(F.xxhash64("id"), F.lit(500)).cast("string"))).alias("k"))
    keys = spark.range(0, 4000, 3).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("k"), F.col("id").alias("more"))
    keys = keys.union(spark.createDataFrame([("hot", 7), (None, 8)], "k string, more bigint"))
    rows = rows.selectExpr("k", "'theirs' AS __may", "1 AS __word", "'x' AS __found")
    count = lambda df: sorted(map(str, df.groupBy(*df.columns).count().collect()))
    expected = count(rows.join(keys, "k", how))
    assert count(membership.join_set(rows, keys, "k", how, small=True)) == expected
    monkeypatch.setattr(membership, "is_small", lambda df: hits_small)
    assert count(membership.join_set(rows, keys, "k", how, small=False)) == expected


def test_rows_of_a_hot_key_are_not_shuffled(spark):
    """A table of one column whose key owns all rows: the large set is cut to the keys that occur, which are broadcast."""
    rows = spark.range(100_000).select(F.when(F.col("id") < 10**9, "hot").alias("k"))
    keys = spark.range(5000).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("k")).union(spark.sql("SELECT 'hot' AS k"))
    joined = membership.join_set(rows, keys, "k", "left_semi", small=False)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and joined.count() == 100_000


def test_filter_lets_few_other_keys_pass(spark):
    keys = spark.range(20_000).select(F.col("id").cast("string").alias("k"))
    other = spark.range(20_000, 40_000).select(F.col("id").cast("string").alias("k"))
    assert membership.marked(keys, keys, "k").filter("__may").count() == 20_000
    assert membership.marked(other, keys, "k").filter("__may").count() < 20


@pytest.mark.parametrize("small", [True, False])
def test_screens_take_map_columns_and_streams(spark, tmp_path, small):
    from pyspark.sql import Row

    rows = [Row(id=str(i), category=c, tags={"k": str(i)}, deep=[{"m": {"x": i}}]) for i, c in enumerate(["hot", None, "cold", "hot"])]
    schema = "id string, category string, tags map<string,string>, deep array<struct<m:map<string,int>>>"
    table = spark.createDataFrame(rows, schema)
    names = spark.createDataFrame([("hot",)], "category string")
    assert ids(screening.passed(table, names, small=small)) == ["1", "2"]
    assert ids(screening.filtered(table, names, small=small)) == ["0", "3"]
    assert screening.audit(table, names, small=small).filter("status = 'PASSED'").count() == 2
    table.write.parquet(str(tmp_path / "in"))
    stream = screening.passed(spark.readStream.schema(table.schema).parquet(str(tmp_path / "in")), names, small=small)
    stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start(
        str(tmp_path / "out")).awaitTermination()
    assert ids(spark.read.parquet(str(tmp_path / "out"))) == ["1", "2"]


def test_running_values_across_ranges(spark):
    rows = [(i * 3, (i * 7919) % 101) for i in range(200)]
    table = spark.createDataFrame(rows, "at long, v long")
    for levels, width in ((2, 32), (3, 9), (1, 700)):
        for combine, python in ((F.max, max), (F.sum, sum)):
            got = {r.at: r.o for r in numbering.before(table, [], "at", "v", combine, "o", levels, width).collect()}
            assert got == {a: python([v for b, v in rows if b < a]) if a else None for a, _ in rows}
    with pytest.raises(Exception, match="out of range"):
        numbering.before(table, [], "at", "v", F.sum, "o", 2, 10).collect()


@pytest.mark.parametrize("name", ["late_rows", "product_receipts"])
def test_no_ordered_pass_in_one_task(spark, sf_dir, name):
    from marketstream.plans import registry

    plan = registry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan


def test_json_lines_are_json(spark, tmp_path, catalogue_file):
    path = str(tmp_path / "out")
    file_sink.append_json_lines(files.catalogue(spark, catalogue_file).coalesce(1), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert len(lines) == 20
    assert json.loads(lines[0])["price"] == 101.0
    file_sink.append_json_lines(files.catalogue(spark, catalogue_file), path)
    assert files.json_lines(spark, path, schemas.PRODUCT).count() == 40


def test_passed_messages_keep_their_key(spark):
    keyed = spark.createDataFrame([product(1, "books")], schemas.PRODUCT).withColumn("key", F.lit("other"))
    row = kafka_sink.passed_messages(keyed).first()
    assert row.key == "other" and json.loads(row.value)["id"] == "prod-001"


def test_mirror_covers_whole_names(spark):
    topics = ["products-raw", "a.internal", "a-internal", "ainternal", "x.replica", "__offsets", "_one", "client-events"]
    rows = spark.createDataFrame([(t, 3) for t in topics], "topic string, partition int")
    kept = sorted(r.topic for r in kafka.keep_topics(rows, exclude=mirror.EXCLUDED_TOPICS).collect())
    assert kept == ["_one", "ainternal", "client-events", "products-raw"]
    assert sorted(r.topic for r in mirror.mirror(rows).collect()) == ["cluster1.client-events", "cluster1.products-raw"]


def test_numbering_of_a_hot_group(spark):
    rows = spark.range(1000).select(F.when(F.col("id") < 700, "hot").otherwise("cold").alias("g"), (F.col("id") * 7 - 900).alias("o"))
    numbered = numbering.number_rows(rows, ["g"], "o", width=50)
    for group, size in (("hot", 700), ("cold", 300)):
        found = [r.offset for r in numbered.filter(F.col("g") == group).orderBy("o").collect()]
        assert found == list(range(size))


def test_lag(spark):
    committed = spark.createDataFrame(
        [("sink", "t", 0, 460), ("sink", "t", 1, 1408), ("sink", "t", 2, 694), ("proc", "t", 0, None)],
        "group string, topic string, partition int, current_offset long")
    ends = spark.createDataFrame([("t", 0, 462), ("t", 1, 1410), ("t", 2, 697)], "topic string, partition int, log_end_offset long")
    lags = offsets.consumer_lag(committed, ends)
    assert {(r.group, r.partition): r.lag for r in lags.collect()} == {
        ("sink", 0): 2, ("sink", 1): 2, ("sink", 2): 3, ("proc", 0): None}
    assert {r.group: r.lag for r in offsets.total_lag(lags).collect()} == {"sink": 7, "proc": None}


def test_kafka_options():
    secure = kafka.security_options("u", "p", "/ca.crt")
    assert secure["kafka.security.protocol"] == "SASL_SSL" and 'username="u"' in secure["kafka.sasl.jaas.config"]
    assert kafka.security_options(None, None) == {}
    with pytest.raises(ValueError):
        kafka.security_options("u", None)
    with pytest.raises(ValueError):
        kafka.security_options("u", 'p";x="')
    assert kafka.read_options("b:1", ["x", "y"])["subscribe"] == "x,y"
    assert kafka.read_options("b:1", pattern="a.*", starting="latest")["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        kafka.read_options("b:1")
    assert kafka.write_options("b:1", "t") == {"kafka.bootstrap.servers": "b:1", "kafka.acks": "all", "topic": "t"}
