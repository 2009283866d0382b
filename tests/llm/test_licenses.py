"""License notices against containment in every window."""

import random
import re

from helpers import clashing, prose
from marketstream.llm import licenses, queries


def cut(text, n=5):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return [tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))] if w else []


def brute(text, notices, least=0.8):
    found, own = {}, cut(text)
    for name, notice in notices.items():
        wanted = set(cut(notice))
        m, stride = len(wanted), max(1, len(wanted) // 4)
        hits = {}
        for start in range(0, len(own), stride):
            share = len(wanted & set(own[start : start + m + stride - 1])) / m
            if share >= least:
                hits[start] = share
        if hits:
            found[name] = (max(hits.values()), len(hits), min(hits))
    return found


def test_equals_every_window(make):
    rng = random.Random(3)
    notices = licenses.NOTICES | {"long": prose(rng, 12), "short": "all rights"}
    texts = [prose(rng, 5) for _ in range(20)]
    for notice in notices.values():
        for i in range(6):
            words = notice.split()
            if i > 2:
                words[rng.randrange(len(words))] = "other"
            texts.append(prose(rng, i) + "\n" + " ".join(words).upper() + "\n" + prose(rng, 2))
    texts += [*notices.values(), licenses.NOTICES["MIT"] * 5, " ".join(notices.values())]
    got = {}
    for r in licenses.scan(make(texts), notices).collect():
        got.setdefault(r["doc_id"], {})[r["license_id"]] = (r["containment"], r["n_windows"], r["first_word"])
    assert got == {i: f for i, t in enumerate(texts, 1) if (f := brute(t, notices))} and len(got) > 25


def test_query_finds_whole_texts_and_headers(spark, make, tmp_path):
    rng = random.Random(4)
    names = ["MIT-text", "BSD-3-Clause-text", "ISC-text", "Apache-2.0-header", "GPL-3.0-header", "MPL-2.0-header", "CC-BY-SA-4.0"]
    texts = [prose(rng, 9) + "\n" + licenses.NOTICES[name] + "\n" + prose(rng, 9) for name in names]
    make([*texts, prose(rng, 30)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["license_id"]): r["containment"] for r in queries.op4_license_scan(spark, str(tmp_path)).collect()}
    assert [got.get((i, name)) for i, name in enumerate(names, 1)] == [1.0] * len(names)
    assert all(doc_id <= len(names) for doc_id, _ in got)


def test_bands_guarantee_retrieval():
    assert all(licenses.chance(m, max(1, m // 4)) > 0.999999 for m in range(1, 500))


def test_odd_rows(odd, empty):
    docs = clashing(odd, "license_id", "words", "all", "window", "bands")
    assert licenses.scan(docs, licenses.NOTICES).collect() == []
    assert [(r["doc_id"], r["containment"]) for r in licenses.scan(docs, {"x": "one two"}).collect()] == [(9, 1.0)]
    assert licenses.scan(empty, licenses.NOTICES).collect() == licenses.scan(odd, {}).collect() == []


def test_plan_is_native(make):
    plan = licenses.scan(make(["a b"]), licenses.NOTICES)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
