"""Rendezvous hashing: few moves, weights, slots without gaps."""

import zlib
from collections import Counter

from helpers import clashing
from marketstream.llm import sharding


def test_one_more_shard_takes_rows_only_into_itself(make):
    docs = make([f"text {i}" for i in range(3000)])
    rows = sharding.report(docs, [1.0] * 10).collect()
    moved = [r for r in rows if r["grown_shard"] != r["shard"]]
    assert {r["grown_shard"] for r in moved} == {10} and 180 < len(moved) < 370
    assert max(Counter(r["shard"] for r in rows).values()) < 400
    for shard in range(10):
        assert sorted(r["slot"] for r in rows if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in rows)))
    again = sharding.report(docs.repartition(7), [1.0] * 10).collect()
    assert sorted(again) == sorted(rows)


def test_weights_set_the_shares(make):
    docs = make(["x"] * 4000)
    n = Counter(r["shard"] for r in sharding.sharded(docs, "doc_id", [1.0, 3.0, 0.0]).collect())
    assert set(n) == {0, 1} and 850 < n[0] < 1150


def test_odd_rows(odd, empty):
    docs = clashing(odd, "shard", "slot", "_part", "_shift")
    rows = sharding.report(odd, [1.0] * 5).collect()
    assert len(rows) == odd.count() and len({r["shard"] for r in rows if r["doc_id"] is None}) == 1
    assert {(r["size"], r["text_crc32"]) for r in rows if r["doc_id"] in (4, 5)} == {(16, 0)}
    assert [r["text_crc32"] for r in rows if r["doc_id"] == 8] == [zlib.crc32(b"one")]
    out = sharding.sharded(docs, "doc_id", [1.0] * 5)
    assert {"_part", "_shift", "text"} <= set(out.columns)
    assert len({(r["shard"], r["slot"]) for r in out.collect()}) == odd.count()
    assert sharding.report(empty, [1.0]).collect() == []
