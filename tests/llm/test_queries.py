"""The registered queries: SQL where there is some, and the pipeline's rows against its stages' own rules."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from marketstream.llm import decontaminate, mixing, queries, quality, registry, sharding, simhash
from marketstream.llm.common import table
from oracle_check import connect, spark_rows, sql_rows

SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf_dir, name):
    got = spark_rows(entry.queries()[name](spark, sf_dir))
    assert got == sql_rows(connect(sf_dir), SQL[name]) and got[1]


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(SQL)))
def test_one_row_per_document(spark, sf_dir, name):
    docs = {r["doc_id"] for r in table(spark, sf_dir, "documents").select("doc_id").collect()}
    rows = entry.queries()[name](spark, sf_dir).collect()
    assert len(rows) == len(docs) and {r["doc_id"] for r in rows} == docs


def test_every_number_is_there():
    names = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert names == list(range(1, 14)) and len(corpus_pipeline.STAGES) == 5 and "pipeline" in entry.queries()


def test_pipeline(spark, sf_dir):
    """Each stage by its operator's report on what the stage before kept."""
    docs, bench = table(spark, sf_dir, "documents").collect(), table(spark, sf_dir, "benchmark")
    schema = table(spark, sf_dir, "documents").schema
    left = {r["doc_id"]: r for r in docs}
    as_table = lambda: spark.createDataFrame(list(left.values()), schema)

    model = queries.quality_model(spark, sf_dir)
    kept = {r["doc_id"] for r in quality.scores(as_table(), model).collect() if r["kept"]}
    left = {k: r for k, r in left.items() if k in kept}
    first = {r["doc_id"] for r in simhash.near_duplicates(as_table()).collect() if r["doc_id"] == r["component_id"]}
    left = {k: r for k, r in left.items() if k in first}
    bad = {r["doc_id"] for r in decontaminate.report(as_table(), bench).collect() if r["contaminated"]}
    left = {k: r for k, r in left.items() if k not in bad}
    copies = {r["doc_id"]: r["copies"] for r in mixing.mixture(as_table()).collect()}
    wanted = sorted((k, left[k]["text"]) for k in left for _ in range(copies[k]))

    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert sorted((r["doc_id"], r["text"]) for r in rows) == wanted and 0 < len(wanted) < len(docs) * 3 and bad
    where = {r["doc_id"]: r["shard"] for r in sharding.report(as_table(), [1.0] * queries.SHARDS).collect()}
    assert all(r["shard"] == where[r["doc_id"]] for r in rows)
    for shard in {r["shard"] for r in rows}:
        slots = sorted(r["slot"] for r in rows if r["shard"] == shard)
        assert slots == list(range(len(slots)))


def test_stages_take_empty_tables(spark, odd, sf_dir):
    docs = odd.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).collect() == []


def test_stages_take_odd_tables(spark, odd, sf_dir):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, sf_dir).columns == odd.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, odd, sf_dir).count() == odd.count()
