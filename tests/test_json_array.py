"""Arrays cut anywhere: every range size gives the elements a parser of the whole file gives."""

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketstream.operators import membership
from marketstream.plans import catalogue
from marketstream.sources import files, json_array

KIND = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("s", T.StringType()), T.StructField("tags", T.ArrayType(T.StringType())),
    T.StructField("sub", T.StructType([T.StructField("x", T.StringType())])),
])
HARD = ['"', "\\", '\\"', "}", "{", "]", "[", ",", '"},{"', "\\\\", "é", "漢", "\n", "a" * 40, " ", "\t"]


def record(rng, i):
    text = lambda: "".join(rng.choice(HARD) for _ in range(rng.randrange(6)))
    return {"id": i, "s": text(), "tags": [text() for _ in range(rng.randrange(3))], "sub": {"x": text()}}


@pytest.fixture
def ranges(spark):
    """Ranges of so many bytes for one test."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def use(size):
        for k in before:
            spark.conf.set(k, str(size))

    yield use
    for k, v in before.items():
        spark.conf.set(k, v)


def read(spark, path, kind=KIND, separator="}"):
    return [r["element"].asDict(recursive=True) for r in json_array.read(spark, path, kind, separator).collect()]


@pytest.mark.parametrize("separator", ["}", ",", ":"])
@pytest.mark.parametrize("size", [37, 200, 1 << 20])
def test_random_arrays(spark, tmp_path, ranges, separator, size):
    """Several files of several forms, with every sign that could mislead inside their strings."""
    rng, expected = random.Random(size), []
    for n, (count, indent) in enumerate([(40, None), (15, 2), (1, 1), (0, None), (0, 2)]):
        rows = [record(rng, 100 * n + i) for i in range(count)]
        expected += rows
        (tmp_path / f"{n}.json").write_text(rng.choice(["", "\n  "]) + json.dumps(rows, ensure_ascii=n == 0, indent=indent) + "\n", encoding="utf-8")
    ranges(size)
    assert sorted(read(spark, str(tmp_path), separator=separator), key=lambda r: r["id"]) == expected


@pytest.mark.parametrize("small", [True, False])
def test_one_file_is_many_tasks(spark, tmp_path, ranges, monkeypatch, small):
    """Tasks read parts of the file, whether the table of ranges is broadcast or joined; whole elements are not moved."""
    monkeypatch.setattr(membership, "is_small", lambda df: small)
    rng = random.Random(1)
    rows = [record(rng, i) for i in range(300)]
    path = tmp_path / "big.json"
    path.write_text(json.dumps(rows))
    ranges(path.stat().st_size // 7)
    found = json_array.elements(spark, str(path), "}")
    parts = json_array.read(spark, str(path), KIND).withColumn("part", F.spark_partition_id())
    assert spark.read.text(str(path), lineSep="}").rdd.getNumPartitions() >= 7
    assert sorted(json.loads(r["text"])["id"] for r in found.collect()) == list(range(300))
    assert parts.select("part").distinct().count() > 1


@pytest.mark.parametrize("text", [
    "not json", "{}", '{"a": [1]}', '[{"id": 1}', '[{"id": 1}]]', '[{"id": 1}][{"id": 2}]', '[{"id": 1}], [{"id": 2}]', '[{"id": 1} {"id": 2}]',
    '[{"id": 1},, {"id": 2}]', '[{"id": 1},]', '[{"id": "x"}]', '[{"id": 1}] x', 'x [{"id": 1}]', '[{"s": "a]', '[{"id": 1]', "[1]", "]", "[[{}]",
])
@pytest.mark.parametrize("size", [5, 1 << 20])
def test_broken_files_are_errors(spark, tmp_path, ranges, text, size):
    path = tmp_path / "broken.json"
    path.write_text(text)
    ranges(size)
    with pytest.raises(Exception, match="(?i)malformed"):
        json_array.read(spark, str(path), KIND).collect()


def test_names(spark, tmp_path, ranges):
    names = ["a,b", '"', "]", "", "\\", "x"] * 5
    path = tmp_path / "names.json"
    path.write_text(json.dumps([*names, None]))
    ranges(9)
    assert {r["category"] for r in files.control_set(spark, str(path)).collect()} == set(names)


def test_signs_that_are_no_separators(spark, tmp_path):
    for sign in ('"', "\\", "ab", ""):
        with pytest.raises(ValueError, match="separator"):
            json_array.elements(spark, str(tmp_path), sign)


def test_escaped_quotes():
    import numpy as np

    odd, _ = json_array.marks(np.frombuffer(rb'a"\"\\"b"\\\"c"', np.uint8))
    assert odd.tolist() == [False] + [True] * 5 + [False] * 2 + [True] * 6 + [False]


def test_every_written_file_holds_one_array(spark, tmp_path):
    rows = spark.range(45_000).select(F.to_json(F.struct(F.col("id"), F.lit("a").alias("s"))).alias("value"))
    path = catalogue.as_json_array(rows, str(tmp_path / "arrays"))
    assert all(len(json.loads(f.read_text())) for f in tmp_path.glob("arrays/*.txt"))
    assert json_array.read(spark, path, KIND).select("element.id").distinct().count() == 45_000


def test_repeated_names_are_dealt_over_the_files(spark, tmp_path):
    rows = spark.range(45_000).select(F.lit('"tobacco"').alias("value"))
    path = catalogue.as_json_array(rows, str(tmp_path / "names"))
    sizes = [len(json.loads(f.read_text())) for f in tmp_path.glob("names/*.txt")]
    assert sum(sizes) == 45_000 and max(sizes) < 20_000
    assert [r["category"] for r in files.control_set(spark, path).collect()] == ["tobacco"]
