"""Suffix-array search against scanning every window."""

import hashlib
import random
import re

import numpy as np
import pytest

from helpers import WORDS, clashing
from marketstream.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=13):
    doc, hit, ids, longest = words_of(text), set(), set(), {}
    for key, item in items:
        w = words_of(item)
        size = min(window, len(w))
        for b in range(len(w) - size + 1) if w else ():
            for i in range(len(doc) - size + 1):
                if doc[i : i + size] == w[b : b + size]:
                    hit |= set(range(i, i + size))
                    ids.add(str(key))
                    n = size
                    while i + n < len(doc) and b + n < len(w) and doc[i + n] == w[b + n]:
                        n += 1
                    longest[str(key)] = max(longest.get(str(key), 0), n)
    joined = ",".join(sorted(ids))
    return len(doc), len(hit), len(ids), hashlib.sha256(joined.encode()).hexdigest(), 0 < len(hit) and 20 * len(hit) >= len(doc), longest


def bench_table(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def case(seed):
    rng = random.Random(seed)
    vocabulary = WORDS[:6]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 12, 13, 14, 30, 60]))) for i in range(12)] + [(20, ""), (21, "... !"), (22, None)]
    texts = [text(rng.randrange(60)) for _ in range(40)]
    for i, (_, item) in enumerate(items[:10]):
        w = item.split()
        texts.append(text(20) + "; " + "-".join(w[: rng.randrange(1, len(w) + 1)]).upper() + " | " + text(i * 30))
    return items, [*texts, "", None, items[3][1], items[4][1] * 3]


def check(got, texts, items):
    for r in got:
        *wanted, longest = brute(texts[r["doc_id"] - 1], items)
        assert [r[c] for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")] == wanted
        assert {m["item_id"]: m["n_words"] for m in r["matches"]} == longest
        for m in r["matches"]:
            item = words_of(dict((str(k), t) for k, t in items)[m["item_id"]])
            doc = words_of(texts[r["doc_id"] - 1])
            assert doc[m["doc_word"] :][: m["n_words"]] == item[m["item_word"] :][: m["n_words"]]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, make, seed):
    items, texts = case(seed)
    got = decontaminate.report(make(texts), bench_table(spark, items)).collect()
    assert len(got) == len(texts)
    check(got, texts, items)


def test_blocks_and_shards_do_not_change_the_result(spark, make):
    items, texts = case(3)
    docs, bench = make(texts), bench_table(spark, items)
    whole = {r["doc_id"]: r for r in decontaminate.report(docs, bench).collect()}
    for options in ({"block_bytes": 300}, {"shard": 64}):
        got = decontaminate.report(docs, bench, **options).collect()
        check(got, texts, items)
        assert all(r["n_hit"] == whole[r["doc_id"]]["n_hit"] for r in got)


def test_longer_windows(spark, make):
    items, texts = case(4)
    got = decontaminate.report(make(texts), bench_table(spark, items), window=25, shard=40).collect()
    for r in got:
        assert [r["n_words"], r["n_hit"], r["n_items"]] == list(brute(texts[r["doc_id"] - 1], items, 25)[:3])


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    seq = rng.integers(0, 4, 500)
    order = decontaminate.suffix_array(seq, 500, 16)
    keys = [tuple(seq[i : i + 16]) for i in order]
    assert keys == sorted(keys) and sorted(order) == list(range(500))


def test_odd_rows(spark, odd, empty):
    bench = bench_table(spark, [(1, "one"), (1, "Ünï 漢字"), (None, "one two")])
    docs = clashing(odd, "scan", "_scan", "_part", "n_hit")
    rows = decontaminate.report(docs, bench).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert (by[9]["n_hit"], by[9]["n_items"]) == (2, 1) and by[8]["n_hit"] == 1 and by[4]["n_words"] == 0
    kept = decontaminate.decontaminated(docs, bench)
    assert kept.columns == docs.columns and {8, 9, -11}.isdisjoint({r["doc_id"] for r in kept.collect()})
    assert decontaminate.report(empty, bench).collect() == []
    none = decontaminate.report(odd, bench.limit(0)).collect()
    assert len(none) == odd.count() and not any(r["n_hit"] or r["contaminated"] for r in none)
