"""Consistent weighted sampling against the similarity it estimates."""

import hashlib
import random
from collections import Counter

import pytest

from helpers import WORDS, clashing
from marketstream.llm import fingerprints


def jaccard(a, b):
    a, b = Counter(a.lower().split()), Counter(b.lower().split())
    most = sum((a | b).values())
    return sum((a & b).values()) / most if most else 1.0


def expected(rows):
    """By descending id, then the edited text of each."""
    out = []
    for i, (key, text) in enumerate(rows):
        cut = len(text) // 2
        following = rows[(i + 1) % len(rows)][1]
        out.append((key, text, text[: len(text) - cut] + following[:cut], following))
    return out


def test_edited_texts_and_unbiased_likeness(make, monkeypatch):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 60))) for _ in range(300)]
    docs = make([(7 * i - 400, t, "a") for i, t in enumerate(texts)])
    monkeypatch.setattr("marketstream.llm.neighbours.ROWS", 16)
    got = {r["doc_id"]: r for r in fingerprints.report(docs).collect()}
    assert len(got) == 300
    off = []
    for key, text, edited, following in expected([(7 * i - 400, t) for i, t in reversed(list(enumerate(texts)))]):
        r = got[key]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert len(r["fingerprint"]) == len(r["edited_fingerprint"]) == 8 * fingerprints.SAMPLES
        off += [r["near_edited"] - jaccard(text, edited), r["near_next"] - jaccard(text, following)]
    assert abs(sum(off) / len(off)) < 0.02 and max(map(abs, off)) < 0.45


def test_buckets_do_not_change_the_result(make):
    from marketstream.llm.neighbours import with_next

    docs = make([(i * i, f"text {i}", "a") for i in range(40)]).select("doc_id", "text")
    for size in (1, 3, 1000):
        rows = with_next(docs, "doc_id", "text", size).filter("not _guest").collect()
        assert {(r["text"], r["next"]) for r in rows} == {(f"text {i}", f"text {(i - 1) % 40}") for i in range(40)}


def test_odd_rows(odd, empty):
    rows = fingerprints.report(clashing(odd, "fingerprint", "next", "_bucket")).collect()
    assert len(rows) == odd.count()
    of = {(r["doc_id"], r["n_chars"]): r for r in rows}
    assert of[(1, of[(1, max(n for i, n in of if i == 1))]["n_chars"])]["fingerprint"] in {r["fingerprint"] for r in rows if r["doc_id"] == 2}
    blank = {r["fingerprint"] for r in rows if r["doc_id"] in (4, 5, 6)}
    assert blank == {"________" * fingerprints.SAMPLES}
    assert all(0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1 for r in rows)
    assert fingerprints.report(empty).collect() == []


def test_plan_is_native_and_shuffles_texts_once(make):
    docs = make(["a b", "c d"])
    plan = fingerprints.report(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("weight", [1, 2, 7])
def test_samples_of_a_heavier_word_only_get_smaller(spark, weight):
    from pyspark.sql import functions as F

    row = spark.range(50).select(*[
        fingerprints.sample(F.col("id"), F.lit(w), 3).alias(n) for w, n in ((weight, "less"), (weight + 1, "more"))
    ])
    assert row.filter("more > less").count() == 0
