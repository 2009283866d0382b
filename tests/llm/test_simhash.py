"""SimHash fingerprints and components against all pairs."""

import itertools
import random

import pytest
import xxhash

import corpus_pipeline
from helpers import clashing, prose
from marketstream.llm import components, simhash
from marketstream.operators import membership


def brute_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64(s, 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, most=2):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= most:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(values))]


def near_texts(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(30):
        base = prose(rng, rng.randrange(1, 40)).split()
        texts.append(" ".join(base))
        for _ in range(rng.randrange(6)):
            copy = list(base)
            copy[rng.randrange(len(copy))] = "changed"
            texts.append("\n\t".join(copy).upper() if rng.random() < 0.3 else " ".join(copy))
    return [*texts, "", None, " \n", "a", "a b", "a b c"]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(make, seed):
    texts = near_texts(seed)
    values = [brute_fingerprint(t) for t in texts]
    roots = brute_components(values)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(make(texts)).collect()}
    assert len(got) == len(texts)
    for i, (v, r) in enumerate(zip(values, roots, strict=True), 1):
        assert (got[i]["fingerprint"], got[i]["component_id"]) == (f"{v:016x}", r + 1)


def test_links_are_all_near_pairs(spark):
    rng = random.Random(3)
    values = {rng.getrandbits(64) for _ in range(40)}
    for v in list(values):
        for _ in range(8):
            values.add(v ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))))
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    table = spark.createDataFrame(signed, "fingerprint bigint")
    wanted = {(a[0], b[0]) for a in signed for b in signed if a[0] < b[0] and ((a[0] ^ b[0]) & (1 << 64) - 1).bit_count() <= 2}
    rows = simhash.links(table).collect()
    assert len(rows) == len(wanted) > 50 and {tuple(r) for r in rows} == wanted


def test_long_chains_are_one_component(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (1001, 1000), (5, 5), (None, 7), (2000, 1001)]
    got = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {1001: 1000, 2000: 1000}


def test_no_row_goes_for_another_text_of_its_id(spark, make):
    rng = random.Random(6)
    a, b, c, d = (prose(rng) for _ in range(4))
    rows = [(1, a, "x"), (2, a, "x"), (2, b, "x"), (3, b, "x"), (4, c, "x"), (4, c, "x"), (4, d, "x"), (None, a, "x"), (None, a, "x")]
    stage = dict(corpus_pipeline.STAGES)["SimHash near-dedup"]
    got = [(r["doc_id"], r["text"]) for r in stage(spark, make(rows), "").collect()]
    assert sorted(got, key=str) == sorted([(1, a), (2, b), (4, c), (4, d), (None, a), (None, a)], key=str)


def test_odd_rows(odd, empty):
    rows = simhash.near_duplicates(clashing(odd, "fingerprint", "component_id")).collect()
    assert len(rows) == odd.count()
    blank = [r for r in rows if r["fingerprint"] == "0" * 16]
    assert len(blank) == 4 and {r["component_id"] for r in blank} == {4}
    docs = clashing(odd, "fingerprint", "component_id")
    kept = simhash.deduplicated(docs)
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert kept.columns == docs.columns and ids == [-11, 1, 3, 4, 7, 8, 9, 10, 12]
    assert simhash.near_duplicates(empty).collect() == [] and simhash.deduplicated(empty).collect() == []


def test_one_row_each_is_the_same_beyond_the_broadcast_bound(make, odd, monkeypatch):
    """Keys to drop are broadcast up to a bound and found through a filter beyond it; ids, repeats and missing ids come out alike."""
    rng = random.Random(7)
    texts = [prose(rng) for _ in range(12)]
    docs = make([(i % 40, texts[rng.randrange(12)] + rng.choice(["", " one more"]), "a") for i in range(90)] + [(None, texts[0], "b")] * 3)
    for table in (docs, clashing(odd, "_key", "fingerprint", "__may")):
        rows = lambda: sorted(map(str, simhash.one_row_each(table).collect()))
        small = rows()
        for hits_small in (True, False):
            calls = itertools.cycle([False, hits_small])  # the set is large; then the keys of it that occur are measured
            with monkeypatch.context() as patch:
                patch.setattr(membership, "is_small", lambda df, calls=calls: next(calls))
                assert rows() == small
    assert simhash.one_row_each(odd.limit(0)).collect() == []
