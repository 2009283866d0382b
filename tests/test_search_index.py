"""Searches through signatures: equal to the scan for every word, with fewer parts read."""

import random

import pytest
from pyspark.sql import functions as F

from marketstream import schemas
from marketstream.operators import search
from marketstream.sources import search_index, tables

WORDS = ["Ноутбук", "Lamp", "İstanbul", "straße", "a b", "漢字テスト", "x", "", "red\nline", "50%_off", "\U0001f600\U0001f601\U0001f602"]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    rng = random.Random(4)
    text = lambda: rng.choice([None, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(4))) + str(rng.randrange(999))])
    rows = [
        (f"p{i}", text(), text(), text(), 1.0, "RUB", 1, "s", text(), rng.choice([None, [], [text(), text()]]), "2024-01-01T00:00:00Z")
        for i in range(400)
    ]
    rows.append(rows[0])
    df = spark.createDataFrame(rows, schemas.PRODUCT)
    path = str(tmp_path_factory.mktemp("index"))
    search_index.build(df, path, 16)
    return df, path


def ids(df):
    return sorted(r["id"] for r in df.select("id").collect())


@pytest.mark.parametrize("query", ["ноутбук", "НОУТ", "lam", "LAMP", "straße", "字テスト", "la", "x", "", "a b", "mp5", "\U0001f601\U0001f602", "no such", "red\nl", "%_o", "istanbul"])
def test_equals_the_scan(spark, odd, query):
    df, path = odd
    assert ids(search_index.find(spark, path, query)) == ids(search.search(df, query))


def test_words_of_a_query(spark, odd):
    df, path = odd
    assert ids(search_index.find(spark, path, ["red\nline", "Lamp"])) == ids(search.search(df, ["red\nline", "Lamp"]))


def test_parts_without_the_query_are_not_read(spark, sf_dir, tmp_path):
    """A rare word stands in few parts; the scan is pruned to them. Every part that holds it is among them."""
    path = str(tmp_path)
    search_index.build(tables.catalogue(spark, sf_dir), path, 20)
    n = search_index.products(spark, path).select("part").distinct().count()
    one = search_index.products(spark, path).filter("id = 'prod-037'").first()
    holding = {r["part"] for r in search.search(search_index.products(spark, path), one["name"]).select("part").collect()}
    kept = {r["part"] for r in search_index.candidates(spark, path, one["name"]).collect()}
    assert one["part"] in holding <= kept and len(kept) < n / 2
    assert search_index.candidates(spark, path, "qqqqq").count() == 0
    plan = search_index.find(spark, path, one["name"])._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan


def test_empty_catalogue(spark, tmp_path):
    search_index.build(spark.createDataFrame([], schemas.PRODUCT), str(tmp_path), 4)
    for query in ("", "abc"):
        assert search_index.find(spark, str(tmp_path), query).collect() == []


def test_number_of_parts(spark, tmp_path):
    for parts in (0, search_index.MOST_PARTS + 1):
        with pytest.raises(ValueError, match="parts"):
            search_index.build(spark.createDataFrame([], schemas.PRODUCT), str(tmp_path), parts)


def test_signatures_have_every_run(spark, odd):
    """All runs of all texts are marked in their part."""
    _, path = odd
    rows = search_index.products(spark, path).select("part", F.explode(search_index.all_runs()).alias("run")).distinct().limit(50).collect()
    for r in rows:
        assert r["part"] in {c["part"] for c in search_index.candidates(spark, path, r["run"]).collect()}
