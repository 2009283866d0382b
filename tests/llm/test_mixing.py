"""Targets against their definition; rounding keeps sums and expectations."""

import random

import numpy as np
import pytest

from helpers import clashing, prose
from marketstream.llm import mixing


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """The excess over the bound is shared again by weight until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in target]
        left = total - sum(target.values())
        share = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / share >= most * sizes[s]] if share else []
        if not over:
            return target | {s: left * weight[s] / share for s in open_}
        target |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 5, None: 7, "é": 40}, {"a": 0, "b": 3}, {"x": 9}, {"a": 1, "b": 1, "c": 1, "d": 1000}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size bigint")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_words_come_near_the_targets(make):
    rng = random.Random(2)
    docs = make([(i, prose(rng, rng.randrange(1, 9)), rng.choice("aaaaaabcd")) for i in range(600)])
    rows = mixing.mixture(docs, bucket=20, fan_in=3).collect()
    assert len(rows) == 600
    for s in "abcd":
        own = [r for r in rows if r["source"] == s]
        assert own[0]["source_size"] == sum(r["size"] for r in own)
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own)
        ratio = own[0]["target"] / own[0]["source_size"]
        assert {r["copies"] for r in own} <= {int(ratio), int(ratio) + 1} and max(r["copies"] for r in own) <= 3
    again = mixing.mixture(docs.repartition(5), bucket=20, fan_in=3).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))


def test_a_trade_keeps_words_and_expectations():
    rng = np.random.default_rng(4)
    for _ in range(300):
        p, q, a, b = rng.random(), rng.random(), int(rng.integers(1, 50)), int(rng.integers(1, 50))
        outcomes = [mixing.trade(p, a, q, b, u) for u in (np.arange(2000) + 0.5) / 2000]
        assert all(x in (0, 1) or y in (0, 1) for x, y in outcomes)
        assert all(-1e-12 <= z <= 1 + 1e-12 for o in outcomes for z in o)
        assert all(abs(a * x + b * y - a * p - b * q) < 1e-9 for x, y in outcomes)
        assert abs(np.mean([x for x, _ in outcomes]) - p) < 2e-3


def test_odd_rows(odd, empty):
    rows = mixing.mixture(clashing(odd, "size", "target", "group", "key", "copies")).collect()
    assert len(rows) == odd.count() and all(0 <= r["copies"] <= 3 for r in rows)
    docs = clashing(odd, "copies", "_nth", "_text_hash", "_id")
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(str(r["doc_id"]) for r in rows for _ in range(r["copies"]))
    assert mixing.mixture(empty).collect() == [] and mixing.mixed(empty).collect() == []
