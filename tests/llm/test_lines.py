"""Line templates against a direct evaluation of the tree."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import WORDS, clashing
from marketstream.llm import lines


def brute(docs, leading=3, least=3, fixed=1):
    """The text that each document keeps."""
    parsed, in_leaf = [], defaultdict(set)
    for doc in docs:
        for i, line in enumerate((doc[1] or "").split("\n")):
            t = tuple("<*>" if re.search("[0-9]", x) else x for x in re.findall(r"[^\x09-\x0d\x20]+", line))
            if t:
                parsed.append((doc, i, t))
                in_leaf[len(t), t[:leading]].add(doc)
    parsed = [(d, i, t) for d, i, t in parsed if len(in_leaf[len(t), t[:leading]]) >= least]
    together, docs_of = Counter(), defaultdict(set)
    for d, _, t in parsed:
        docs_of[t].add(d)
    for t, who in docs_of.items():
        for place, token in enumerate(t):
            together[len(t), t[:leading], place, token] += len(who)
    template = {t: tuple(x if together[len(t), t[:leading], p, x] >= least else "<*>" for p, x in enumerate(t)) for t in docs_of}
    template = {t: m for t, m in template.items() if sum(x != "<*>" for x in m) >= fixed}
    often = defaultdict(set)
    for d, _, t in parsed:
        if t in template:
            often[len(t), t[:leading], template[t]].add(d)
    gone = {(d, i) for d, i, t in parsed if t in template and len(often[len(t), t[:leading], template[t]]) >= least}
    return {d: None if d[1] is None else "\n".join(x for i, x in enumerate(d[1].split("\n")) if (d, i) not in gone) for d in docs}


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice(WORDS)
    docs = []
    for i in range(60):
        text = [" ".join(word() for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(1, 6))]
        text += [f"signed in as {word()} at {rng.randrange(99)}:00 from home"] * rng.randrange(2) + ["All rights reserved."] * (i % 3 == 0)
        text += [f"read more about {word()} {word()} {word()} {word()}"] * (i % 4 == 0) + ["", "  "]
        rng.shuffle(text)
        docs.append((i, "\n".join(text)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_the_tree(make, seed):
    docs = corpus(seed)
    wanted = brute(docs)
    got = {r["doc_id"]: r for r in lines.deduplicated(make([(*d, "a") for d in docs]), least=3).collect()}
    for d in docs:
        assert got[d[0]]["text"] == wanted[d]
        assert got[d[0]]["n_lines"] == d[1].count("\n") + 1
        assert got[d[0]]["n_dropped"] == d[1].count("\n") - wanted[d].count("\n") or not wanted[d]
    kept = "\n".join(r["text"] for r in got.values())
    assert "All rights reserved." not in kept and "signed in" not in kept and "read more" not in kept


def test_lines_of_mostly_variable_tokens(make):
    """One fixed token is enough: pages, dates and log lines of many documents go, numbers alone stay."""
    docs = [(i, f"own words {'abcdefghijkl'[i]}\nPage {i} of 12\nPosted 2024-01-{i:02}\n2024-01-05 12:0{i}:00 INFO start\n{i} {i + 1}", "a") for i in range(12)]
    rows = lines.deduplicated(make(docs)).collect()
    assert {r["text"] for r in rows} == {f"own words {'abcdefghijkl'[i]}\n{i} {i + 1}" for i in range(12)}
    assert {r["text"] for r in lines.deduplicated(make(docs[:9])).collect()} == {t for _, t, _ in docs[:9]}


def test_very_many_lines(make):
    """Lines of a long text go by their place; a line that one text has often counts as one document."""
    long = "\n".join(["again and again", f"only {'x' * 3}"] * 4000)
    docs = make([(i, f"again and again\nkeep {'abcdefghijklmnop'[i]}", "a") for i in range(10)] + [(99, long, "a")])
    rows = {r["doc_id"]: r for r in lines.deduplicated(docs).collect()}
    assert rows[3]["text"] == "keep d" and rows[99]["n_dropped"] == 4000 and rows[99]["text"] == "\n".join(["only xxx"] * 4000)


def test_odd_rows(odd, empty):
    rows = lines.deduplicated(clashing(odd, "doc", "line", "leaf", "gone"), least=2).collect()
    assert len(rows) == odd.count()
    by = {r["doc_id"]: r for r in rows}
    assert by[4]["text"] is None and by[4]["n_lines"] == 0 and by[5]["text"] == "" and by[6]["text"] == " \n\t "
    assert [r["n_dropped"] for r in rows if r["doc_id"] in (1, 2)] == [0] * 3  # tokens with digits fix nothing
    plain = odd.withColumn("text", F.regexp_replace("text", "[0-9]", ""))
    assert [(r["text"], r["n_dropped"]) for r in lines.deduplicated(plain, least=2).collect() if r["doc_id"] == 2] == [("", 1)] * 2
    assert by[12]["text"] == "né\x00ro a\x00" and lines.deduplicated(empty).collect() == []
